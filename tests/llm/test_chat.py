import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
WILD = ["<", "|", "<|", "<||im_end|>", "<|im_end|>", "<|im_start|>user\n", "\n", "é", "日", "plain words ", "\\", "$1", ""]


def conversations(n=12, turns=40, seed=3):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be kind " * pick.randrange(1, 40)))
        for t in range(1, pick.randrange(2, turns)):
            text = "".join(pick.choice(WILD) for _ in range(pick.randrange(0, 200)))
            rows.append((c, t * 90, "assistant" if t % 2 == 0 else "user", text))
    return rows


def test_windows_keep_budget_history_and_mask(spark):
    rows = conversations()
    out = chat.windows(spark.createDataFrame(rows, SCHEMA), 600, 120).collect()
    cost = lambda t: chat.TURN_TOKENS + -(-len(t) // 4)
    by = {}
    for r in out:
        by.setdefault(r["conv_id"], []).append(r)
    for c, windows in by.items():
        turns = [(role, text) for conv, _, role, text in rows if conv == c]
        new, learned, before = [], [], []
        for w in sorted(windows, key=lambda w: w["window"]):
            parts = [p[: -len(chat.END)] for p in w["formatted"].split(chat.START)[1:]]
            read = [(p.split("\n", 1)[0], p.split("\n", 1)[1]) for p in parts]
            repeated, fresh = read[: w["repeated"]], read[w["repeated"] :]
            if before:
                if turns[0][0] == "system":
                    assert repeated[0][0] == "system"
                    repeated = repeated[1:]
                assert repeated == (before[-len(repeated) :] if repeated else [])
                assert sum(cost(t) for _, t in repeated) <= 120
            before = [t for t in fresh if t[0] != "system"]
            new += fresh
            learned += [w["formatted"][s["start"] : s["start"] + s["length"]] for s in w["loss"]]
            assert w["cost"] == sum(cost(t) for _, t in read) and w["over"] == (w["cost"] > 600)
            if w["over"]:  # one turn that does not fit with its system turn
                assert len([t for t in read if t[0] != "system"]) == 1
        plain = lambda t: __import__("re").sub(r"<\|(\|+)", r"<\1", t)
        assert [(r, plain(t)) for r, t in new] == turns
        assert [plain(t) for t in learned] == [t for r, t in turns if r == "assistant"]
    assert sum(len(w) for w in by.values()) > len(by)


def test_a_long_turn_opens_its_own_window(spark):
    """Turns that fit each, but not together; one that never fits; a system turn that alone is over the budget."""
    rows = [(1, 0, "user", "x" * 354 * 4), (1, 1, "assistant", "y" * 704 * 4), (1, 2, "user", "short")]
    rows += [(2, 0, "user", "a"), (2, 1, "assistant", "z" * 9000), (2, 2, "user", "b"), (2, 3, "assistant", "c")]
    rows += [(3, 0, "system", "s" * 9000), (3, 1, "user", "d"), (3, 2, "assistant", "e")]
    out = {(r["conv_id"], tuple(t["text"][0] for t in r["all"])): r for r in chat.windows(spark.createDataFrame(rows, SCHEMA)).withColumn("all", chat.turns_of(F.col("formatted"))).collect()}
    assert {k: (r["over"], r["repeated"]) for k, r in out.items()} == {
        (1, ("x",)): (False, 0), (1, ("y",)): (False, 0), (1, ("s",)): (False, 0),
        (2, ("a",)): (False, 0), (2, ("z",)): (True, 0), (2, ("b", "c")): (False, 0),
        (3, ("s",)): (True, 0), (3, ("s", "d")): (True, 1), (3, ("s", "e")): (True, 1),
    }


def test_the_cost_is_an_argument(spark):
    rows = [(1, t, "user", "w w w w w w") for t in range(30)]
    words = lambda text: F.size(F.split(text, " "))
    out = chat.windows(spark.createDataFrame(rows, SCHEMA), 60, 10, words).collect()
    assert all(r["cost"] == 10 * (r["formatted"].count(chat.START)) <= 60 and not r["over"] for r in out)
    assert sum(r["formatted"].count(chat.START) - r["repeated"] for r in out) == 30


def test_marks_in_texts_are_escaped_and_read_back(spark):
    texts = ["".join(random.Random(k).choice(WILD) for _ in range(9)) for k in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "<|im" not in r["e"]


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", None), (1, None, "user", "first"), (1, 5, "assistant", "tie"), (1, 5, "assistant", "tie"),
        (1, 5, "assistant", "again"), (2, 0, "system", "only"), (3, 0, "assistant", "x" * 50_000), (3, 1, "odd\nrole <|", "y"),
    ]
    extra = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", window int, place string")
    back = {r["conv_id"]: r for r in chat.read_back(chat.windows(extra)).orderBy("window").groupBy("conv_id").agg(
        F.flatten(F.collect_list("turns")).alias("turns"), F.array_join(F.collect_list("loss"), "").alias("loss")).collect()}
    assert [tuple(t) for t in back[None]["turns"]] == [("", ""), ("user", "")]
    assert [t["text"] for t in back[1]["turns"]] == ["first", "again", "tie", "tie"] and back[1]["loss"] == "againtietie"
    assert [tuple(t) for t in back[2]["turns"]] == [("system", "only")] and back[2]["loss"] == ""
    assert [tuple(t) for t in back[3]["turns"]] == [("assistant", "x" * 50_000), ("odd\nrole <|", "y")]
    assert chat.windows(extra.limit(0)).count() == 0


def test_a_long_conversation_is_spread(spark):
    turns = spark.range(3000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    out = chat.read_back(chat.windows(turns))
    assert out.agg(F.sum(F.size("turns"))).first()[0] == 3000
    plan = chat._placed(turns)._jdf.queryExecution().executedPlan().toString()
    assert "conv_id" in plan and "block" in plan and "Python" not in plan


@pytest.mark.parametrize("column", ["turns_sha256", "loss_sha256"])
def test_probe_conversation(spark, sf, column):
    row = chat.op2_chat(spark, sf).filter("conv_id = -1").first()
    whole = f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n"
    assert row[column] == hashlib.sha256((whole if column == "turns_sha256" else chat.PROBE).encode()).hexdigest()
