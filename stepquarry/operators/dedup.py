"""Exact and best-match duplicates against reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepquarry.functions.text import hashed
from stepquarry.functions.words import command_heads, content_words, jaccard
from stepquarry.operators import setsim as S
from stepquarry.operators.nearest import nearest
from stepquarry.plans.runtime import settle

# What counts as a duplicate.
SURE, LIKELY, SAME_STEPS = 0.5, 0.4, 0.85


#: Similarities down to which matches are looked for by prefixes, one after another; rows without a match so far go on.
#: None: statements share so many common words that comparing all pairs by blocks costs less.
LEVELS = ()


def features(df: DataFrame, key: Column, statement: Column, steps: Column, source: str = "") -> DataFrame:
    """(gid, words, heads, toks, source) of a table; ``key`` must also give the order of the rows, ``source`` says where they are from."""
    words = content_words(statement)
    return df.select(key.cast("long").alias("gid"), words.alias("words"), command_heads(steps).alias("heads"), hashed(words).alias("toks"), F.lit(source).alias("source"))


def _best(pairs: DataFrame, new: DataFrame, refs: DataFrame, least: float) -> DataFrame:
    """(new_id, ref_id, source, words_j, heads_j) of the best of the pairs (a, b) of each row, if it is above 0 and at least ``least``."""
    n = new.select(F.col("gid").alias("a"), F.col("words").alias("nw"), F.col("heads").alias("nh"))
    r = refs.select(F.col("gid").alias("b"), F.col("words").alias("rw"), F.col("heads").alias("rh"), "source")
    rows = pairs.join(n, "a").join(r, "b").select("a", "b", "source", jaccard(F.col("nw"), F.col("rw")).alias("words_j"), jaccard(F.col("nh"), F.col("rh")).alias("heads_j"))
    best = rows.where((F.col("words_j") > 0) & (F.col("words_j") >= least)).groupBy("a").agg(F.max(F.struct("words_j", (-F.col("b")).alias("o"), "source", "heads_j")).alias("m"))
    return best.select(F.col("a").alias("new_id"), (-F.col("m.o")).alias("ref_id"), "m.source", "m.words_j", "m.heads_j")


def best_match(new: DataFrame, refs: DataFrame, levels: tuple[float, ...] = LEVELS, least: float = 0.0) -> DataFrame:
    """(new_id, ref_id, source, words_j, heads_j): for each of ``new`` the first reference of greatest word similarity above 0.

    Both are settled ``features``. Rows are compared with all references by blocks;
    ``levels`` first finds matches from prefix postings, at one similarity after
    another, and only rows without a match so far go on, which pays where words are
    rare. Whatever the levels, the result is that of comparing all. Rows that share
    no word with any reference, or whose best is below ``least``, have no row. heads_j is that reference's own, not the
    best.
    """
    order = S.token_order(refs.select("toks").unionByName(new.select("toks")), "toks") if levels else None
    out = None
    for level in (x for x in levels if x >= least):
        measure = S.Jaccard(level)
        x, y = (S.postings(S.prefixes(side, order, measure)) for side in (new, refs))
        found = settle(_best(S.met(x, y, S.places_allow(measure) & S.maps_allow(measure)), new, refs, level), "matches")
        out = found if out is None else out.unionByName(found)
        new = settle(new.join(found.select(F.col("new_id").alias("gid")), "gid", "left_anti"), "left")
    rest = settle(_best(nearest(new, refs, least=least), new, refs, least), "matches")
    return rest if out is None else out.unionByName(rest)


def flagged(matches: DataFrame) -> DataFrame:
    """The matches that are duplicates."""
    return matches.where((F.col("words_j") >= SURE) | ((F.col("words_j") >= LIKELY) & (F.col("heads_j") >= SAME_STEPS)))


def new_statements(batch: DataFrame, known: DataFrame, order: list[str], passes: Column, text: str = "problem_statement") -> DataFrame:
    """``batch`` with ``passes`` and ``is_dup``: its stripped statement is in ``known`` or in an earlier row of the batch that was accepted.

    A row that does not pass is no reason to refuse a later one with its statement:
    that one is looked at again. Null statements count as the empty one, a null
    ``passes`` as false. Statements meet as 128-bit hashes. ``order`` must tell the
    rows of the batch apart. The earliest passing row of a statement is found by
    aggregation, so a very common one is no single task's.
    """
    key = lambda: F.md5(F.trim(F.coalesce(F.col(text), F.lit(""))))
    seen = known.select(key().alias("_k")).distinct().withColumn("_seen", F.lit(True))
    rows = batch.withColumn("_k", key()).withColumn("_at", F.struct(*order)).withColumn("passes", F.coalesce(passes, F.lit(False)))
    first = rows.groupBy("_k").agg(F.min(F.when(F.col("passes"), F.col("_at"))).alias("_first")).join(seen, "_k", "left")
    rows = rows.join(first, "_k")
    return rows.withColumn("is_dup", F.coalesce("_seen", F.lit(False)) | F.coalesce(F.col("_first") < F.col("_at"), F.lit(False))).drop("_k", "_at", "_first", "_seen")
