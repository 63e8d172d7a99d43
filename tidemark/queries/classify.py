"""Queries over the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.operators import metrics
from tidemark.plans import classify
from tidemark.queries.registry import FEATURES, query

NAMES = adapters.FEATURES
BINS, PAIR_BINS = 10, 5

LONG = f"""with {FEATURES}, long as (
  select id, label, cast(substr(feature, 2) as integer) as i, feature, value
  from (unpivot features on {', '.join(NAMES)} into name feature value value))"""


def _bin(value: str, low: str, high: str, bins: int) -> str:
    return f"cast(least(floor(({value} - {low}) * {bins}.0::double / ({high} - {low})), {bins - 1}) as integer)"


@query(
    "feature_label_names",
    f"""with {FEATURES} select *, case label when 0 then 'sentosa' when 1 then 'versicolor' else 'virginica' end
    as class_name from features""",
)
def feature_label_names(spark, sf_dir):
    return classify.named(adapters.features(spark, sf_dir))


@query(
    "feature_summary",
    f"""{LONG} select label, feature, count(*) as n, round(quantile_cont(value, 0.25), 6) as q1,
      round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.75), 6) as q3,
      min(value) as least, max(value) as most from long group by label, feature""",
)
def feature_summary(spark, sf_dir):
    found = classify.summary(adapters.features(spark, sf_dir), NAMES)
    return found.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(
    "feature_histogram",
    f"""{LONG}, edges as (select feature, min(value) as lo, max(value) as hi from long group by feature)
    select label, feature, {_bin('value', 'lo', 'hi', BINS)} as bin, count(*) as n
    from long join edges using (feature) group by all""",
)
def feature_histogram(spark, sf_dir):
    return classify.histogram(adapters.features(spark, sf_dir), NAMES, BINS)


EDGES = "edges as (select i, feature, min(value) as lo, max(value) as hi from long group by i, feature)"


@query(
    "pair_bins",
    f"""{LONG}, {EDGES}, binned as (
      select id, label, i, feature, {_bin('value', 'lo', 'hi', PAIR_BINS)} as bin from long join edges using (i, feature))
    select a.label, a.feature as x, b.feature as y, a.bin as x_bin, b.bin as y_bin, count(*) as n
    from binned a join binned b on a.id = b.id and a.i < b.i group by all""",
)
def pair_bins(spark, sf_dir):
    return classify.pair_bins(adapters.features(spark, sf_dir), NAMES, PAIR_BINS)


@query(
    "feature_corr",
    f"""{LONG} select a.feature as x, b.feature as y,
      case when a.i = b.i then 1.0::double else round(corr(a.value, b.value), 6) end as corr
    from long a join long b on a.id = b.id group by a.feature, b.feature, a.i, b.i""",
)
def feature_corr(spark, sf_dir):
    found = classify.correlations(adapters.features(spark, sf_dir), NAMES)
    return found.withColumn("corr", F.round("corr", 6))


SPLIT = f"""with {FEATURES}, split as (
  select *, row_number() over (order by md5('0|' || cast(id as varchar)), id)
            <= ceil(0.25 * count(*) over ()) as test from features)"""

_D2 = " + ".join(f"(t.{c} - r.{c}) * (t.{c} - r.{c})" for c in NAMES)

KNN = f"""{SPLIT}, pairs as (
  select t.id, r.label as train_label,
         row_number() over (partition by t.id order by {_D2}, r.id) as place
  from (select * from split where test) t, (select * from split where not test) r), votes as (
  select id, train_label, count(*) as n from pairs where place <= 3 group by all), voted as (
  select id, train_label as pred from (
    select *, row_number() over (partition by id order by n desc, train_label) as place from votes) where place = 1),
predicted as (
  select id, label, {', '.join(NAMES)}, pred, pred = label as correct from split join voted using (id))"""

CONFUSION = f"""{KNN}, classes as (select label as c from predicted union select pred as c from predicted),
confusion as (
  select a.c as label, b.c as pred, count(p.id) as n from classes a cross join classes b
  left join predicted p on p.label = a.c and p.pred = b.c group by all)"""

REPORT = f"""{CONFUSION}, sides as (
  select c, sum(case when label = c and pred = c then n else 0 end)::double as tp,
         sum(case when label = c then n else 0 end)::double as support,
         sum(case when pred = c then n else 0 end)::double as predicted
  from classes, confusion group by c), shares as (
  select c, support, coalesce(tp / nullif(predicted, 0), 0) as precision,
         coalesce(tp / nullif(support, 0), 0) as recall from sides), scored as (
  select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from shares)
select cast(c as varchar) as class, round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1, 6) as f1, cast(support as bigint) as support from scored
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       cast(sum(support) as bigint) from scored
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       cast(sum(support) as bigint) from scored"""


def _predicted(spark, sf_dir):
    return classify.predict(adapters.features(spark, sf_dir), NAMES)


@query("split_train_test", f"{SPLIT} select * from split")
def split_train_test(spark, sf_dir):
    return classify.split(adapters.features(spark, sf_dir))


@query("knn_predict", f"{KNN} select * from predicted")
def knn_predict(spark, sf_dir):
    return _predicted(spark, sf_dir)


@query("knn_accuracy", f"{KNN} select round(avg(cast(correct as int)), 6) as accuracy from predicted")
def knn_accuracy(spark, sf_dir):
    return metrics.accuracy(_predicted(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


@query("knn_confusion", f"{CONFUSION} select * from confusion")
def knn_confusion(spark, sf_dir):
    return metrics.confusion(_predicted(spark, sf_dir))


@query("knn_report", REPORT)
def knn_report(spark, sf_dir):
    found = metrics.report(metrics.confusion(_predicted(spark, sf_dir)))
    return found.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})
