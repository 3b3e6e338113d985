"""Splits that keep related records together: grouped iterative stratification.

Records belong together if they share a key of any kind (here: the same source
and id, or the same construction). The keys, not the records, form the graph, so
a key with a third of all rows is one node. Keys are 128-bit digests. Components
come from components.py.

Components are then placed by iterative stratification over label vectors (rows
per source; every source is a label): the label with the fewest outstanding rows
first, its largest components first, each to the split that needs that label most;
of equal needs the split with most room for rows at all. Components with one label
vector are alike, so what reaches the driver is one row for each different vector
and label in it, and all components of a vector are placed in one step, which gives
what placing them one by one would. Where a component too large for the plan left
one split with too many rows, others are moved out of it at the end. The components themselves are numbered and
look their split up in parallel.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
from collections import defaultdict
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepquarry.llm.components import components
from stepquarry.plans.runtime import settle

SALTS = 64


def construction_in(text: str | None) -> list[str] | None:
    """Commands, without white space, of the first JSON object in ``text`` with a non-empty list construction_steps.

    Whatever surrounds the object is ignored; an object that is cut off is none.
    """
    if not text:
        return None
    at, decoder = text.find("{"), json.JSONDecoder()
    while at >= 0:
        try:
            found, end = decoder.raw_decode(text, at)
        except (ValueError, RecursionError):
            end = at + 1
        else:
            steps = found.get("construction_steps")
            if isinstance(steps, list) and steps:
                cmds = [s["command"] for s in steps if isinstance(s, dict) and isinstance(s.get("command"), str)]
                return ["".join(c.split()) for c in cmds] or None
        at = text.find("{", end)
    return None


def _constructions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keys = []
        for texts in b["replies"]:
            found = next((c for c in map(construction_in, texts if texts is not None else []) if c), None)
            keys.append(None if found is None else "\x1f".join(found))
        yield pd.DataFrame({"ex_id": b["ex_id"], "source": b["source"], "id": b["id"], "made": pd.Series(keys, dtype=object)})


def keyed(train: DataFrame) -> DataFrame:
    """Settled (ex_id, source, ka, kb): the keys by (source, id) and by construction; null where there is none."""
    replies = F.transform(F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == "assistant"), lambda m: m["content"])
    rows = train.select("ex_id", "source", "id", F.coalesce(replies, F.array().cast("array<string>")).alias("replies"))
    rows = rows.mapInPandas(_constructions, "ex_id long, source string, id long, made string")
    ka = F.when(F.col("source").isNotNull() & F.col("id").isNotNull(), F.md5(F.concat_ws("\x1f", F.lit("id"), F.col("id").cast("string"), "source")))
    kb = F.when(F.col("made").isNotNull(), F.md5(F.concat_ws("\x1f", F.lit("made"), "made")))
    return settle(rows.select("ex_id", "source", ka.alias("ka"), kb.alias("kb")), "keyed")


def groups(rows: DataFrame) -> DataFrame:
    """(ex_id, source, group_id, group_size) of keyed rows; group_id is the least ex_id of the group.

    Rows without a key are groups of one.
    """
    roots = components(rows.where("ka is not null and kb is not null").select(F.col("ka").alias("a"), F.col("kb").alias("b")))
    own = rows.withColumn("node", F.coalesce("ka", "kb"))
    lone = own.where("node is null").select("ex_id", "source", F.col("ex_id").alias("group_id"), F.lit(1).cast("long").alias("group_size"))
    own = settle(own.where("node is not null").join(roots, "node", "left").select("ex_id", "source", F.coalesce("root", "node").alias("root")), "rooted")
    sizes = own.groupBy("root").agg(F.min("ex_id").alias("group_id"), F.count("*").alias("group_size"))
    return own.join(sizes, "root").select("ex_id", "source", "group_id", "group_size").unionByName(lone)


def shared_out(need: list[float], room: list[float], step: float, n: int) -> list[int]:
    """How many of ``n`` equal steps each split gets if each step goes to the split of greatest need, which it lowers by ``step``.

    Of equal needs the split with most room, then the first. The level to which the
    needs sink is found at once; only what is left over, less than one step a split,
    is placed step by step.
    """
    order = sorted(range(len(need)), key=lambda s: -need[s])
    level, total = 0.0, 0.0
    for k, s in enumerate(order, 1):  # the k greatest needs sink to one level
        total += need[s]
        level = (total - n * step) / k
        if k == len(order) or need[order[k]] <= level:
            break
    got = [max(0, math.floor((x - level) / step - 1e-9)) for x in need]
    while sum(got) > n:
        got[max(range(len(got)), key=got.__getitem__)] -= 1
    for _ in range(n - sum(got)):
        s = max(range(len(need)), key=lambda s: (round(need[s] - got[s] * step, 6), room[s], -s))
        got[s] += 1
    return got


def stratify(kinds: list[tuple[int, Mapping[int, int], int]], fractions: list[float]) -> list[list[int]]:
    """How many components of each kind go to each split.

    A kind is (its key, rows per label of one component, components).
    """
    total: dict[int, int] = defaultdict(int)
    having: dict[int, list[int]] = defaultdict(list)
    for i, (_, rows, n) in enumerate(kinds):
        for j, t in rows.items():
            total[j] += t * n
            having[j].append(i)
    need = {j: [f * t for f in fractions] for j, t in total.items()}
    room = [f * sum(total.values()) for f in fractions]
    sizes = [sum(rows.values()) for _, rows, _ in kinds]
    outstanding, placed, done = dict(total), [[0] * len(fractions) for _ in kinds], [False] * len(kinds)
    rarest = [(t, j) for j, t in total.items()]  # with entries that are out of date
    heapq.heapify(rarest)
    while rarest:
        left, label = heapq.heappop(rarest)
        if left <= 0 or left != outstanding[label]:
            continue
        for i in sorted((i for i in having[label] if not done[i]), key=lambda i: (-sizes[i], kinds[i][0])):
            _, rows, n = kinds[i]
            placed[i] = shared_out(need[label], room, rows[label], n)
            done[i] = True
            for s, k in enumerate(placed[i]):
                room[s] -= k * sizes[i]
                for j, t in rows.items():
                    need[j][s] -= k * t
            for j, t in rows.items():
                outstanding[j] -= t * n
                if j != label:
                    heapq.heappush(rarest, (outstanding[j], j))
    even_out(kinds, placed, sizes, need, room)
    return placed


def even_out(kinds: list[tuple[int, Mapping[int, int], int]], placed: list[list[int]], sizes: list[int], need: dict[int, list[float]], room: list[float]) -> None:
    """Move components from the split with most rows too many to the one with most too few, as long as that brings both nearer to the plan.

    Only a component too large for the plan leaves something to do here: all else is
    within a row or so. Components whose labels the one has too much of and the
    other too little go first.
    """
    while True:
        over, under = min(range(len(room)), key=room.__getitem__), max(range(len(room)), key=room.__getitem__)
        gap = min(-room[over], room[under])
        fits = [i for i, p in enumerate(placed) if p[over] and sizes[i] <= gap]
        if not fits:
            return
        gain = {i: sum(t * (need[j][under] - need[j][over]) for j, t in kinds[i][1].items()) / sizes[i] for i in fits}
        for i in sorted(fits, key=lambda i: (-gain[i], -sizes[i], kinds[i][0])):
            n = min(placed[i][over], int(gap // sizes[i]))
            placed[i][over] -= n
            placed[i][under] += n
            gap -= n * sizes[i]
            for s, sign in ((over, n), (under, -n)):
                room[s] += sign * sizes[i]
                for j, t in kinds[i][1].items():
                    need[j][s] += sign * t


def assign(grouped: DataFrame, plan: DataFrame) -> DataFrame:
    """(ex_id, group_id, split) of grouped rows by ``plan`` (split, fraction), a table of a few rows.

    Fractions are scaled to sum to 1. An empty ``grouped`` or plan gives no rows.
    """
    rules = sorted((r["split"], float(r["fraction"])) for r in plan.where("fraction > 0").collect())
    if not rules:
        return grouped.select("ex_id", "group_id", F.lit(None).cast("string").alias("split")).limit(0)
    scale = sum(f for _, f in rules)
    names, fractions = [n for n, _ in rules], [f / scale for _, f in rules]
    grouped = settle(grouped, "grouped")
    each = grouped.groupBy("group_id", F.coalesce("source", F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    comps = each.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("vector"), F.sum("n").alias("size"))

    comps = comps.select("group_id", "vector", F.xxhash64("vector").alias("kind"), F.pmod(F.xxhash64("group_id"), F.lit(SALTS)).cast("int").alias("salt"))
    comps = settle(comps, "comps")
    by_salt = settle(comps.groupBy("kind", "salt").agg(F.count("*").alias("c"), F.first("vector").alias("vector")), "kinds")
    rows = by_salt.groupBy("kind").agg(F.sum("c").alias("c"), F.first("vector").alias("vector")).orderBy("kind").toArrow()
    vectors = rows["vector"].combine_chunks()
    flat, ends = vectors.flatten(), vectors.offsets.to_pylist()
    labels, counts = (flat.field(c).to_pylist() for c in ("label", "n"))
    number_of = {n: j for j, n in enumerate(sorted(set(labels)))}
    kinds = [(k, {number_of[labels[x]]: counts[x] for x in range(ends[i], ends[i + 1])}, c) for i, (k, c) in enumerate(zip(rows["kind"].to_pylist(), rows["c"].to_pylist()))]
    placed = stratify(kinds, fractions)
    # components of a kind are numbered through the salts; each split takes a run of numbers
    ends = [(k[0], list(itertools.accumulate(row))) for k, row in zip(kinds, placed)]
    table = grouped.sparkSession.createDataFrame(ends, "kind long, ends array<long>")
    before = F.sum("c").over(Window.partitionBy("kind").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_salt.select("kind", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("kind", "salt").orderBy("group_id")) - 1 + F.col("base")
    split = F.coalesce(F.element_at(F.array(*map(F.lit, names)), F.size(F.filter("ends", lambda e: e <= F.col("number"))) + 1))
    chosen = comps.join(bases, ["kind", "salt"]).join(table, "kind").withColumn("number", number).select("group_id", split.alias("split"))
    return grouped.join(chosen, "group_id").select("ex_id", "group_id", "split")


def balance(split: DataFrame, rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(split, source, rows, planned, largest) of assigned rows (ex_id, group_id, split): how near each source's shares come to the plan.

    largest is the greatest number of rows of that source in one group, which no
    placement can divide. Splits that got none of a source count too.
    """
    each = split.join(rows.select("ex_id", "source"), "ex_id")
    largest = each.groupBy("source", "group_id").agg(F.count("*").alias("n")).groupBy("source").agg(F.sum("n").alias("total"), F.max("n").alias("largest"))
    rules = plan.where("fraction > 0")
    rules = rules.join(F.broadcast(rules.agg(F.sum("fraction").alias("_sum")))).select("split", (F.col("fraction") / F.col("_sum")).alias("fraction"))
    got = each.groupBy("split", "source").agg(F.count("*").alias("n")).select(F.col("split").alias("_split"), F.col("source").alias("_source"), "n")
    every = largest.join(F.broadcast(rules))  # the plan has a few rows, the sources one each
    out = every.join(got, (F.col("split") == F.col("_split")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    return out.select("split", "source", F.coalesce("n", F.lit(0)).cast("long").alias("rows"), (F.col("fraction") * F.col("total")).alias("planned"), "largest")
