"""Queries of the operators of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepquarry.llm import incremental, mojibake, neardup, overlap, packing, splits, tokenizer
from stepquarry.plans.runtime import settle
from stepquarry.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = splits.groups(splits.keyed(table(spark, d, "train")))
    return rows.where("group_size > 1").select("ex_id", "group_id")


def p2_split(spark: SparkSession, d: str) -> DataFrame:
    rows = splits.groups(splits.keyed(table(spark, d, "train")))
    return splits.assign(rows, table(spark, d, "split_plan"))


def p2_balance(spark: SparkSession, d: str) -> DataFrame:
    """Whether each source's rows in each split are within one group of the plan."""
    train, plan = table(spark, d, "train"), table(spark, d, "split_plan")
    rows = splits.balance(p2_split(spark, d), train, plan)
    return rows.select("split", "source", F.round("planned", 4).alias("planned"), (F.abs(F.col("rows") - F.col("planned")) <= F.col("largest")).alias("within"))


def _problem_sets(spark: SparkSession, d: str) -> DataFrame:
    return neardup.record_sets(table(spark, d, "problems"), F.col("problem_key"), F.col("problem_statement"), F.col("construction_steps"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.alike_pairs(_problem_sets(spark, d))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.alike_groups(_problem_sets(spark, d)).withColumnRenamed("key", "problem_key")


def _eval_overlaps(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    held = table(spark, d, "eval_problems").select(F.col("eval_id").alias("key"), "split", "source", F.col("problem_statement").alias("text"))
    return held, overlap.overlaps(held, overlap.user_messages(table(spark, d, "train")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _eval_overlaps(spark, d)[1].select(F.col("key_a").alias("eval_id"), F.col("key_b").alias("ex_id"))


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    held, pairs = _eval_overlaps(spark, d)
    return overlap.overlap_counts(pairs, held)


def _weighted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    held = table(spark, d, "eval_problems").select(F.col("eval_id").alias("key"), "split", "source", F.col("problem_statement").alias("text"))
    return held, overlap.weighted_overlaps(held, overlap.user_messages(table(spark, d, "train")))


def p4_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps by weighted cosine: rare terms count for more than common ones."""
    rows = _weighted(spark, d)[1]
    return rows.select(F.col("key_a").alias("eval_id"), F.col("key_b").alias("ex_id"), F.round("dot", 6).alias("cosine"))


def p4_weighted_counts(spark: SparkSession, d: str) -> DataFrame:
    held, pairs = _weighted(spark, d)
    return overlap.overlap_counts(pairs, held)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The batches are taken one after another; each reads the index, not the history."""
    text, steps = F.col("problem_statement"), F.col("construction_steps")
    # keys of the three tables may clash, so the history gets keys by hash of table and key
    old = [(table(spark, d, n), F.xxhash64(F.lit(n), F.col(k))) for n, k in (("fewshot_problems", "id"), ("problems", "problem_key"))]
    history = neardup.record_sets(old[0][0], old[0][1], text, steps).unionByName(neardup.record_sets(old[1][0], old[1][1], text, steps))
    firsts, _ = neardup.classes_of(history)
    index = incremental.PrefixIndex.over(firsts)
    new = table(spark, d, "new_geometry_problems")
    batches = [r[0] for r in new.select("batch_id").distinct().collect()]
    for batch in sorted(batches, key=lambda b: (b is None, b or 0)):  # a row without a batch comes last
        rows = new.where(F.col("batch_id").eqNullSafe(batch))
        incremental.ingest(index, neardup.record_sets(rows, F.col("new_id"), text, steps))
    all_rows = neardup.record_sets(new, F.col("new_id"), text, steps)
    return incremental.refused(all_rows, index.sets(since=1)).select(F.col("key").alias("new_id"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encoded(table(spark, d, "documents"), "doc_id", "text")


def _pieces(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    items = settle(tokenizer.sizes(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("doc_id", "key"), "sizes")
    limits = table(spark, d, "pack_limits").withColumnRenamed("capacity_tokens", "capacity")
    return packing.packed(items, limits), limits


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d)[0].withColumnRenamed("key", "doc_id")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(*_pieces(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.mended(table(spark, d, "documents"), "doc_id", "text").where("garbled").select("doc_id")


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    rows = mojibake.mended(table(spark, d, "documents"), "doc_id", "text").where("garbled")
    return rows.select("doc_id", "restored", "stretches_restored", "stretches_lost")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_split, p2_balance, p3_found, p3_groups, p4_found, p4_counts, p4_weighted, p4_weighted_counts, p5_found, p6_ids, p7_pack, p7_fill, p8_found, p8_restored)
}
