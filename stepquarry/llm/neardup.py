"""Near-duplicate records with small edits: the grouped prefix join.

Two records are *alike* if the Jaccard similarity of their token sets is 0.7 or
more, or 0.5 or more while that of their command sets is 0.8 or more.

* Records with equal token and command sets are one class; only classes are joined.
* Classes with the same size and the same rarest-token prefix are one group;
  only groups write postings. Group pairs are filtered by size and position,
  then expanded to member pairs, filtered by parity maps, and verified exactly.
* The first condition joins on token prefixes at 0.7. The second joins on command
  prefixes at 0.8 and uses 0.5 on tokens as a filter.
* A group may hold a large part of all rows: one stock figure under many different
  statements. Its members are never paired with each other directly. They are
  joined once more: for the second condition on (group pair, token of the text's
  prefix at 0.5), for the first, where all members of a group share a prefix, on
  (group, one of the next tokens after it). So what a hot group costs follows its
  members. Only pairs of two different groups with near-equal text prefixes are
  expanded as they are, with size and parity map tested inside the join.

Null or empty statements have no tokens, thus similarity 0 to everything and no
pairs. Null steps count as no commands. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepquarry.functions import text as X
from stepquarry.llm.components import components
from stepquarry.operators import setsim as S
from stepquarry.plans.runtime import settle

TEXT = S.Jaccard(0.7)
LOOSE = S.Jaccard(0.5)
STEPS = S.Jaccard(0.8)
PAIR = ("a", "b")


def record_sets(df: DataFrame, key: Column, statement: Column, steps: Column) -> DataFrame:
    """(key, toks, cmds): hashed token and command sets of every record."""
    return df.select(key.cast("long").alias("key"), X.hashed(X.tokens(statement)).alias("toks"), X.hashed(X.commands(steps)).alias("cmds"))


def alike(a: str = "a", b: str = "b") -> Column:
    """The exact test on columns ``{a}_toks``, ``{a}_cmds`` and the same of ``b``."""
    on_text = lambda n: S.tenths(f"{a}_toks", f"{b}_toks", n)
    return on_text(7) | (on_text(5) & S.tenths(f"{a}_cmds", f"{b}_cmds", 8))


def classes_of(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settled (gid, toks, cmds) of classes with equal sets and (key, gid) of members; gid is the least key.

    Sets without tokens are left out: they are alike nothing.
    """
    k1, k2 = X.set_key(F.col("toks"))
    c1, c2 = X.set_key(F.col("cmds"))
    hashes = ["k1", "k2", "c1", "c2"]
    sets = settle(sets.where(F.size("toks") > 0).select("key", "toks", "cmds", k1.alias("k1"), k2.alias("k2"), c1.alias("c1"), c2.alias("c2")), "sets")
    firsts = settle(sets.groupBy(*hashes).agg(F.min("key").alias("gid"), F.first("toks").alias("toks"), F.first("cmds").alias("cmds")), "classes")
    members = sets.select("key", *hashes).join(firsts.select("gid", *hashes), hashes).select("key", "gid")
    return firsts.select("gid", "toks", "cmds"), members


def grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settled groups (PREFIX columns, n) of settled prefix rows, and (group, gid) of the members of those with several.

    A group holds the sets with one size and one prefix; its gid is its least. The
    parity map counts only where n is 1.
    """
    keys = {"p1": F.xxhash64("size", "prefix"), "p2": F.xxhash64(F.lit(977), "size", "prefix")}
    rows = rows.withColumns(keys)
    firsts = rows.groupBy(*keys).agg(F.min("gid").alias("gid"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("size", "lead", "prefix", "msize", *S.MAPS)])
    firsts = settle(firsts, "groups")
    several = firsts.where("n > 1").select(*keys, F.col("gid").alias("group"))
    return firsts.drop(*keys), settle(rows.select("gid", *keys).join(several, [*keys]).select("group", "gid"), "members")


def group_pairs(groups: DataFrame, measure: S.Jaccard, mapped: S.Jaccard) -> DataFrame:
    """Settled pairs (a, b, several) of groups whose postings meet; several: either has more than one member."""
    rows = S.postings(groups, "n")
    known = (F.col("x.n") > 1) | (F.col("y.n") > 1) | S.maps_allow(mapped)
    pairs = S.met_within(rows, S.places_allow(measure) & known, ((F.col("x.n") > 1) | (F.col("y.n") > 1)).alias("several"))
    return settle(pairs, "met")


def expanded(pairs: DataFrame, members: DataFrame, keyed: DataFrame, within: DataFrame | None, ok: Column) -> DataFrame:
    """Member pairs (a, b), a < b, of group pairs with several members, and of the pairs within one group.

    ``keyed`` are postings of single records: members meet by (group pair, token)
    only. ``within`` are other such postings for the pairs inside one group.
    """
    across = pairs.where("several").select(*PAIR)
    inside = members.select(F.col("group").alias("a"), F.col("group").alias("b")).distinct()
    sides = [(across, keyed), (inside, within)] if within is not None else [(across.unionByName(inside), keyed)]
    out = None
    for wanted, rows in sides:
        ends = wanted.select(F.col("a").alias("group")).unionByName(wanted.select(F.col("b").alias("group"))).distinct()
        held = ends.join(members, "group", "left").select("group", F.coalesce("gid", "group").alias("gid")).join(rows, "gid")
        x = wanted.join(held.withColumnRenamed("group", "a"), "a").alias("x")
        y = wanted.join(held.withColumnRenamed("group", "b"), "b").alias("y")
        on = (F.col("x.a") == F.col("y.a")) & (F.col("x.b") == F.col("y.b")) & (F.col("x.sig") == F.col("y.sig")) & ((F.col("x.a") < F.col("x.b")) | (F.col("x.gid") < F.col("y.gid"))) & ok
        found = x.join(y, on).select(F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b"))
        out = found if out is None else out.unionByName(found)
    return out


def next_tokens(sets: DataFrame, order: S.Order, measure: S.Jaccard) -> DataFrame:
    """Postings of the tokens after the long prefix by which two sets with one size and prefix must meet again.

    Of n tokens they share a prefix of p and need 2t/(1+t) n in all: so they share
    one of the next n - ceil(2t/(1+t) n) + 1, unless the prefix alone is enough.
    Then they meet at a key that all have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes, starts = S.flat(batch.column(1))
            toks = values[S.arranged(values, sizes, order.of(values))]
            cut, more = measure.long_prefix(sizes).astype(np.int64), measure.short_prefix(sizes).astype(np.int64)
            place = np.arange(len(values)) - np.repeat(starts, sizes)
            late = (place >= np.repeat(cut, sizes)) & (place < np.repeat(cut + more, sizes))
            taken = np.add.reduceat(late.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
            enough = cut >= sizes - more + 1
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *taken]), pa.int32()), pa.array(toks[late]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(enough), lists], names=["gid", "enough", "next"])

    rows = sets.select("gid", "toks").mapInArrow(run, "gid long, enough boolean, next array<long>")
    return rows.select("gid", F.explode(F.when(F.col("enough"), F.array(F.lit(0).cast("long"))).otherwise(F.col("next"))).alias("sig"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of gid whose sets are alike."""
    a = sets.select(F.col("gid").alias("a"), F.col("toks").alias("a_toks"), F.col("cmds").alias("a_cmds"))
    b = sets.select(F.col("gid").alias("b"), F.col("toks").alias("b_toks"), F.col("cmds").alias("b_cmds"))
    return pairs.join(a, "a").join(b, "b").where(alike()).select("a", "b")


def class_links(sets: DataFrame) -> DataFrame:
    """Settled pairs (a, b), a < b, of alike classes among settled (gid, toks, cmds)."""
    by_token, by_command = S.token_order(sets, "toks"), S.token_order(sets, "cmds")
    texts = settle(S.prefixes(sets, by_token, TEXT), "texts")
    steps = settle(S.prefixes(sets, by_command, STEPS, of="cmds"), "steps")
    maps = texts.select("gid", "msize", *S.MAPS)

    groups, members = grouped(texts)
    pairs = group_pairs(groups, TEXT, TEXT)
    late = next_tokens(sets.join(members.select("gid"), "gid", "left_semi"), by_token, TEXT).join(maps, "gid")
    near = pairs.where("not several").select(*PAIR).unionByName(expanded(pairs, members, maps.withColumn("sig", F.lit(0)), late, S.maps_allow(TEXT)))

    groups, members = grouped(steps)
    pairs = group_pairs(groups, STEPS, LOOSE)
    wanted = members.select("gid").unionByName(pairs.where("several").select(F.col("a").alias("gid"))).unionByName(pairs.where("several").select(F.col("b").alias("gid"))).distinct()
    half = S.postings(S.prefixes(sets.join(wanted, "gid", "left_semi"), by_token, LOOSE))
    drawn = pairs.where("not several").select(*PAIR).unionByName(expanded(pairs, members, half, None, S.places_allow(LOOSE) & S.maps_allow(LOOSE)))
    return settle(verified(near.unionByName(drawn).distinct(), sets), "links")


def alike_pairs(sets: DataFrame) -> DataFrame:
    """All pairs (key_a, key_b), key_a < key_b, of alike records (key, toks, cmds), equal copies included."""
    firsts, members = classes_of(sets)
    members = settle(members, "members")
    links = class_links(firsts)
    a = members.select(F.col("gid").alias("a"), F.col("key").alias("ka"))
    b = members.select(F.col("gid").alias("b"), F.col("key").alias("kb"))
    across = links.join(a, "a").join(b, "b").select("ka", "kb")
    within = a.join(b, F.col("a") == F.col("b")).where("ka < kb").select("ka", "kb")
    return across.unionByName(within).select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))


def alike_groups(sets: DataFrame) -> DataFrame:
    """One row a record: (key, class_id, group_id, links).

    class_id: least key with the same sets; group_id: least key that a chain of
    alike records reaches; links: classes alike the record's own. Copies are not
    expanded into pairs. Records without tokens are their own class and group.
    """
    firsts, members = classes_of(sets)
    links = class_links(firsts)
    ends = links.select(F.col("a").alias("gid")).unionByName(links.select(F.col("b").alias("gid")))
    info = ends.groupBy("gid").agg(F.count("*").alias("links"))
    info = info.join(components(links).withColumnRenamed("node", "gid"), "gid")
    known = members.join(info, "gid", "left")
    known = known.select("key", F.col("gid").alias("class_id"), F.coalesce("root", "gid").alias("group_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    bare = sets.where(F.size("toks") == 0).select("key", F.col("key").alias("class_id"), F.col("key").alias("group_id"), F.lit(0).cast("long").alias("links"))
    return known.unionByName(bare)
