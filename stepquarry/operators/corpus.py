"""From accepted problems to a corpus: split, expansion, chat format, ids, lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepquarry.functions.replies import written
from stepquarry.functions.words import paraphrases, shown_steps
from stepquarry.plans.runtime import settle

# The held-out share, and characters of text a token is taken for.
EVAL_SHARE = 0.13
CHARS_PER_TOKEN = 3.5

SYSTEM = "Turn the geometry task into an ordered list of construction steps and answer with one JSON object only."


def shuffle_key(*keys: Column, seed: int = 42) -> Column:
    """A seeded random order that a lost task finds again: the MD5 of the keys and the seed."""
    return F.md5(F.concat_ws("-", *[k.cast("string") for k in keys], F.lit(str(seed))))


def numbered(df: DataFrame, group: list[str], order: list[Column], spread: Column) -> DataFrame:
    """Adds ``number``, from 1 within each group by the order, without one task a group.

    ``spread`` is a leading part of the order as a small integer: rows are ranked
    within (group, spread), and the counts of the parts before give the offset.
    """
    rows = df.withColumn("_part", spread)
    counts = rows.groupBy(*group, "_part").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    on = F.col("_part") == F.col("_p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_{g}"))
    out = rows.withColumn("_rank", rank).join(bases, on)
    return out.withColumn("number", (F.col("_rank") + F.col("_base")).cast("long")).drop("_part", "_p", "_base", "_rank", *[f"_{g}" for g in group])


def split_by_source(problems: DataFrame, key: str, source: str = "source", share: float = EVAL_SHARE, seed: int = 42) -> DataFrame:
    """(key, source, split): of each source max(1, round-half-even(share * n)) rows go to eval, the first of a seeded order.

    A null source is a source of its own.
    """
    rows = problems.select(key, source).withColumn("_h", shuffle_key(F.col(key), seed=seed))
    spread = F.conv(F.substring("_h", 1, 2), 16, 10).cast("int")
    rows = numbered(rows, [source], [F.col("_h"), F.col(key)], spread)
    sizes = rows.groupBy(F.col(source).alias("_s")).agg(F.count("*").alias("_n"))
    held = F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(share).cast("decimal(10,4)"), 0))
    out = rows.join(sizes, F.col(source).eqNullSafe(F.col("_s")))
    return out.select(key, source, F.when(F.col("number") <= held, "eval").otherwise("train").alias("split"))


def expanded(problems: DataFrame, statement: str = "problem_statement", most_extra: int = 3) -> DataFrame:
    """One row for the statement and each of its rewordings, with ``variant`` from 0; a null statement stays one row."""
    every = F.coalesce(paraphrases(F.col(statement), most_extra), F.array(F.lit(None).cast("string")))
    rows = problems.withColumn("_v", every).select(*[c for c in problems.columns if c != statement], F.posexplode("_v").alias("variant", statement))
    return rows


def chat(problems: DataFrame, keys: list[str], system: str = SYSTEM) -> DataFrame:
    """(keys, messages): system, user with the statement, assistant with the steps as JSON, named objects shown.

    A null statement gives a null content; null steps give a null target.
    """
    shown = problems.select(*keys, "problem_statement", shown_steps(F.col("problem_statement"), F.col("construction_steps")).alias("_steps"))

    def targets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="_steps").assign(_target=b["_steps"].map(written).astype(object))

    kept = [f for f in shown.schema if f.name != "_steps"]
    done = shown.mapInPandas(targets, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", _target string")
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return done.select(*keys, F.array(turn("system", F.lit(system)), turn("user", F.col("problem_statement")), turn("assistant", F.col("_target"))).alias("messages"))


def next_ids(rows: DataFrame, order: list[str], taken: DataFrame, column: str = "id", floor: int = 1000) -> DataFrame:
    """``rows`` with ``new_id``: one more than the greatest id of ``taken``, or ``floor`` if that is more, and so on, in order.

    The order is made by a range partitioning and offsets, not in one task.
    """
    start = taken.agg(F.greatest(F.coalesce(F.max(column), F.lit(0)), F.lit(floor - 1)).alias("_start"))
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    parts = settle(parts, "ordered")
    counts = parts.groupBy("_p").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("_p", before.alias("_base"))
    out = parts.join(F.broadcast(bases), "_p").crossJoin(F.broadcast(start))
    return out.withColumn("new_id", F.col("_start") + F.col("_base") + F.col("_i") + 1).drop("_p", "_i", "_base", "_start")


def quantiles(values: DataFrame, label: str, value: str, shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """(label, n, max, q...): per label the value at index min(n - 1, floor(q * n)) of the sorted values.

    Values are counted first, so what is ranked is one row a distinct value. Nulls are left out.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(label, value).agg(F.count("*").alias("c"))
    by = Window.partitionBy(label)
    upto = F.sum("c").over(by.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumns({"upto": upto, "n": F.sum("c").over(by)})
    aggs = [F.min(F.when(F.col("upto") > F.least(F.col("n") - 1, F.floor(F.lit(q).cast("decimal(10,4)") * F.col("n"))), F.col(value))).alias(f"q{round(q * 100)}") for q in shares]
    return rows.groupBy(label).agg(F.first("n").alias("n"), F.max(value).alias("max"), *aggs)


def sequence_length(longest: Column) -> Column:
    """A training length for the longest example in characters: the next multiple of 256 tokens, at least 1024."""
    tokens = F.bround(longest / CHARS_PER_TOKEN, 0).cast("long")
    return F.greatest(F.lit(1024), 256 * (F.floor(tokens / 256) + 1)).cast("long")


def prompt(rules: str, examples: DataFrame, order: str) -> DataFrame:
    """One row ``prompt``: the rules, then each example as JSON by ``order``, parted by blank lines; for a few examples only."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.to_json(F.struct(*examples.columns)).alias("j"))))
    return examples.agg(F.concat_ws("\n\n", F.lit(rules), F.transform(rows, lambda r: r["j"])).alias("prompt"))


def repair_request(failed: Column, most: int = 6) -> Column:
    """The text that names the first failed steps."""
    return F.concat(F.lit("These steps failed: "), F.array_join(F.slice(failed, 1, most), "; "))


def chat_lengths(chats: DataFrame, *keys: str) -> DataFrame:
    """(keys, full, completion) of chat rows (keys, messages): characters of all contents, and of the last message's; null contents have none."""
    sizes = F.transform("messages", lambda m: F.coalesce(F.char_length(m["content"]), F.lit(0)).cast("long"))
    full = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n)
    return chats.select(*keys, full.alias("full"), F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0)).alias("completion"))
