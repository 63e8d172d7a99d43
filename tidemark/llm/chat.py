"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts every ``<`` before a run of ``|`` gets one ``|`` more, so
that no control string is left in them, and reading takes it off again; roles are percent-encoded. A turn costs what the
argument ``tokens`` says of its escaped text, by default one for every four characters, and ``TURN_TOKENS`` for its marks.

Windows: prefix sums of the costs of a conversation, without its system turn, are cut into cells of half of what the
budget leaves beside system turn and history, and a window has the turns that begin in one cell. A turn that is longer
than a cell is the last that begins there, and opens a window of its own. Each window begins with the system turn, then
repeats the last turns of the window before it, as many as fit into the history, unless the window would then exceed the
budget; both are outside the loss mask there. So no window exceeds the budget but those of a single turn that does so
with its system turn, as texts are never cut; these are marked ``over``.
The mask is a list of spans, in code points, over the texts of the assistant turns that are new in the window.

Prefix sums are taken in blocks of ``BLOCK_TURNS`` turn numbers and then over the totals of the blocks, so that a
conversation with very many turns is spread over many tasks.

Defined cases: turns go by number, null first, then role and text; null roles and texts are empty; rows with a null
conversation are one conversation; repeated rows are turns of their own; the system turn is the first one if its role is
``system``, later ones are ordinary; other columns are ignored; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import text as texts

BUDGET = 1024
HISTORY = 256
TURN_TOKENS = 4
BLOCK_TURNS = 256
START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<|$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", r"<$1")


def four_characters(text: Column) -> Column:
    """One token for every four characters."""
    return F.ceil(F.length(text) / 4)


def _placed(turns: DataFrame, tokens: Callable[[Column], Column] = four_characters) -> DataFrame:
    """Each turn with its place, the cost before it, and the cost of the conversation's system turn."""
    each = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text")
    )
    each = each.withColumn("cost", TURN_TOKENS + tokens(F.col("text"))).withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv_id", "block").orderBy(*order)
    each = each.withColumn("place", F.row_number().over(inside) - 1)
    each = each.withColumn("before", F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cost"))
    blocks = each.groupBy("conv_id", "block").agg(
        F.sum("cost").alias("cost"), F.count("*").alias("turns"),
        F.max(F.when((F.col("place") == 0) & (F.col("role") == "system"), F.col("cost"))).alias("system"),
    )
    over = Window.partitionBy("conv_id").orderBy("block")
    so_far = over.rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.select(
        F.col("conv_id").alias("of"), F.col("block").alias("of_block"),
        (F.sum("turns").over(so_far) - F.col("turns")).alias("places"), (F.sum("cost").over(so_far) - F.col("cost")).alias("costs"),
        F.coalesce(F.first("system").over(so_far), F.lit(0)).alias("system"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & F.col("block").eqNullSafe(F.col("of_block"))
    return each.join(blocks, same).select(
        "conv_id", "role", "text", "cost", "system", (F.col("place") + F.col("places")).alias("place"), (F.col("before") + F.col("costs")).alias("before")
    )


def windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[Column], Column] = four_characters
) -> DataFrame:
    """(conv_id, window, formatted, repeated, loss, cost, over) from (conv_id, turn, role, text).

    ``repeated`` counts the leading turns that are not new; ``loss`` holds (start, length) of each text to learn.
    """
    placed = _placed(turns, tokens)
    is_system = (F.col("place") == 0) & (F.col("system") > 0)
    cell = F.greatest(F.lit(1), F.floor((budget - history - F.col("system")) / 2))
    begin = F.greatest(F.lit(0), F.col("before") - F.col("system"))
    cells = placed.withColumn("cell", cell).withColumn("begin", begin).withColumn("own", F.when(is_system, 0).otherwise(F.col("cost")))
    alone = (F.col("own") > F.col("cell")).cast("int")
    cells = cells.withColumn("window", 2 * F.floor(F.col("begin") / F.col("cell")) + alone)
    # Where a window ends the next turn begins, in that cell, and in a window of its own or not.
    same = Window.partitionBy("conv_id", "window")
    cells = cells.withColumn("end", F.max(F.col("before") + F.col("cost") - F.col("system")).over(same))
    after = 2 * F.floor(F.col("end") / F.col("cell"))
    carried = ~is_system & (F.col("end") - F.col("begin") <= history)
    at = lambda window, new, mark: F.struct(window.alias("window"), F.lit(new).alias("new"), F.col(mark).alias("mark"))
    places = F.array(at(F.col("window"), True, "begin"), at(after, False, "end"), at(after + 1, False, "end"))
    shown = cells.withColumn("at", F.explode(F.filter(places, lambda p: p["new"] | (carried & (p["window"] > F.col("window"))))))
    turn = F.struct("place", F.col("at.new").alias("new"), F.url_encode("role").alias("role"), "text", F.col("at.mark").alias("mark"), F.col("own").alias("cost"))
    grouped = shown.groupBy("conv_id", F.col("at.window").alias("window")).agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.first("system").alias("system"))
    # Only the window whose first turn begins where they end repeats turns, and only if it can.
    fresh = F.filter("turns", lambda t: t["new"])
    first = F.array_min(F.transform(fresh, lambda t: t["mark"]))
    repeated = F.filter("turns", lambda t: ~t["new"] & (t["mark"] == first))
    total = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda so_far, t: so_far + t["cost"])
    fits = F.col("system") + total(F.col("kept")) <= budget
    grouped = grouped.filter(F.size(fresh) > 0).withColumn("fresh", fresh).withColumn("kept", F.concat(repeated, fresh))
    grouped = grouped.withColumn("turns", F.when(fits, F.col("kept")).otherwise(F.col("fresh"))).withColumn("cost", F.col("system") + total(F.col("turns")))
    system = placed.filter(is_system).select(
        F.col("conv_id").alias("of"),
        F.array(F.struct("place", F.lit(False).alias("new"), "role", "text", F.lit(0).cast("long").alias("mark"), F.lit(0).cast("long").alias("cost"))).alias("first"),
    )
    with_system = grouped.join(system, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("window") > 0), "left")
    none = F.array().cast(system.schema["first"].dataType)
    whole = with_system.select("conv_id", "window", "cost", F.concat(F.coalesce("first", none), "turns").alias("turns"))

    def spans(so_far: Column, t: Column) -> Column:
        text_at = so_far["at"] + len(START) + F.length(t["role"]) + 1
        span = F.when(t["new"] & (t["role"] == "assistant"), F.array(F.struct(text_at.alias("start"), F.length(t["text"]).alias("length"))))
        none = F.array().cast("array<struct<start:int,length:int>>")
        return F.struct(
            (text_at + F.length(t["text"]) + len(END)).alias("at"), F.concat(so_far["spans"], F.coalesce(span, none)).alias("spans")
        )

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    formatted = F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)))
    return whole.select(
        "conv_id", "window", F.array_join(formatted, "").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["new"])).alias("repeated"), F.aggregate("turns", nothing, spans, lambda s: s["spans"]).alias("loss"),
        "cost", (F.col("cost") > budget).alias("over"),
    )


def turns_of(formatted: Column) -> Column:
    """The (role, text) of each turn, read from a formatted window."""

    def parsed(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END))
        return F.struct(F.url_decode(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != ""), parsed)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss): the new turns of each window and the text under its mask."""
    new = F.expr("slice(all, repeated + 1, greatest(size(all) - repeated, 0))")
    masked = F.transform("loss", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["length"])))
    return formatted.withColumn("all", turns_of(F.col("formatted"))).select(
        "conv_id", "window", new.alias("turns"), F.array_join(masked, "").alias("loss"), F.length("formatted").cast("long").alias("chars")
    )


PROBE = "<|im_end|><|im_start|>assistant ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back, as digests."""
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    turns = texts.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = read_back(windows(turns)).select("conv_id", "window", F.array_join(lines, "").alias("lines"), F.size("turns").alias("n"), "loss", "chars")
    ordered = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list(F.struct("window", "lines", "loss"))).alias("parts")
    )
    joined = lambda field: F.array_join(F.col(f"parts.{field}"), "")
    return ordered.select(
        "conv_id", "n_turns", F.sha2(joined("lines"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars",
    )


OP2_SQL = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{PROBE}' union all select -1, 1, 'assistant', '{PROBE}'),
costs as (
  select *, length(regexp_replace(text, '<([|]+)', '<|\\1', 'g')) as chars,
         {TURN_TOKENS} + cast(ceil(chars / 4.0) as bigint) as cost
  from turns),
placed as (
  select *, row_number() over w - 1 as place, sum(cost) over (w rows unbounded preceding) - cost as before,
         case when first_value(role) over w = 'system' then first_value(cost) over w else 0 end as system
  from costs window w as (partition by conv_id order by turn nulls first, role, text)),
cells as (
  select *, place = 0 and system > 0 as is_system, greatest(1, floor(({BUDGET - HISTORY} - system) / 2.0)) as cell,
         greatest(0, before - system) as start, case when place = 0 and system > 0 then 0 else cost end as own,
         2 * floor(start / cell) + case when own > cell then 1 else 0 end as win
  from placed),
ends as (select *, max(before + cost - system) over (partition by conv_id, win) as fin from cells),
fresh as (select conv_id, win, min(start) as first_start, sum(own) as cost, any_value(system) as system from ends group by conv_id, win),
carried as (
  select e.conv_id, f.win, role, chars, f.system + f.cost + sum(own) over (partition by e.conv_id, f.win) <= {BUDGET} as fits
  from ends e join fresh f on e.conv_id is not distinct from f.conv_id and f.first_start = e.fin
    and f.win > e.win and f.win - 2 * floor(e.fin / e.cell) in (0, 1)
  where not is_system and fin - start <= {HISTORY}),
systems as (
  select e.conv_id, e.role, e.chars, count(*) as times
  from ends e join fresh f on e.conv_id is not distinct from f.conv_id and f.win > 0
  where e.is_system group by all),
sizes as (
  select conv_id, sum(n) as formatted_chars from (
    select conv_id, length(role) + chars + 24 as n from ends
    union all select conv_id, length(role) + chars + 24 from carried where fits
    union all select conv_id, (length(role) + chars + 24) * times from systems) group by conv_id)
select p.conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
       cast(any_value(formatted_chars) as bigint) as formatted_chars
from placed p join sizes s on p.conv_id is not distinct from s.conv_id
group by p.conv_id"""
