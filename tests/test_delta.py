from tidemark.sources.delta import merge_statement


def test_merge_statement_parses(spark):
    sql = merge_statement("/lake/silver/stocks", "v", ["ticker", "timestamp"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert "MergeIntoTable" in plan and "'s.ticker = 't.ticker" in plan
