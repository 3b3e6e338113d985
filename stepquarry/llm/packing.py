"""Filling containers of a fixed capacity: minimum bin slack.

For one container after another an item, at first the largest left, is put in, and
a bitset subset-sum over the lengths left finds the fullest way to fill what
remains. Items of one length are alike, so the search needs only how many items of
each length are left: at most ``capacity`` counts, whatever the corpus. A
combination is repeated as often as its scarcest length allows (or half as often),
so the searches are at most ``capacity`` (or that times the logarithm of the
items). Where the containers come out more than the sizes call for, other ways to
start and to choose among equally full combinations are tried, and the best is
kept. The items themselves are then numbered within their length, in parallel, and
look their container up.

An item above the capacity is cut into full containers and a rest, which is
packed like any item. Items of size 0 take no room: they come out as piece 0 with
0 tokens and a null container. A capacity that is null or below 1 gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepquarry.plans.runtime import settle

SALTS = 64


#: How a container starts and in which order lengths are offered to fill it: by length, by what all its items take, or
#: by their number; and which part of the possible repeats of a combination is taken before the next search.
WAYS = (("length", "length", 1.0), ("room", "room", 1.0), ("room", "room", 0.5), ("room", "number", 0.5))
_BY = {"length": lambda k, n: k, "room": lambda k, n: (k * n, k), "number": lambda k, n: (n, k)}


def fullest(capacity: int, left: dict[int, int], start: str = "length", offer: str = "length") -> dict[int, int]:
    """The combination {length: items} of one item of the first length by ``start`` and what fills the rest best.

    Of equally full combinations the one with lengths offered early is taken; the search ends once nothing is left free.
    """
    seed = max(left, key=lambda k: _BY[start](k, left[k]))
    room = capacity - seed
    mask, sums, stages = (1 << (room + 1)) - 1, 1, []
    for length in sorted(left, key=lambda k: _BY[offer](k, left[k]), reverse=True):
        n = min(left[length] - (length == seed), room // length)
        step = 1
        while n > 0:  # powers of two, then the rest, so that every number up to n is a sum of some
            take = min(step, n)
            stages.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            n -= take
            step *= 2
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, {seed: 1}
    for length, take, before in reversed(stages):
        if not before >> at & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def patterns(capacity: int, counts: dict[int, int]) -> list[tuple[int, dict[int, int]]]:
    """(containers, combination) in the order they are filled: by the first of WAYS that needs no more than must be, else by the best."""
    counts = {k: v for k, v in counts.items() if v > 0}
    least = max(-(-sum(k * v for k, v in counts.items()) // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
    best, fewest = [], None
    for start, offer, part in WAYS:
        left, out, n = dict(counts), [], 0
        while left:
            combo = fullest(capacity, left, start, offer)
            times = max(1, int(part * min(left[k] // v for k, v in combo.items())))
            for k, v in combo.items():
                left[k] -= v * times
                if not left[k]:
                    del left[k]
            out.append((times, combo))
            n += times
        if fewest is None or n < fewest:
            best, fewest = out, n
        if fewest <= least:
            break
    return best


def packed(items: DataFrame, limits: DataFrame) -> DataFrame:
    """(profile, key, piece, start_token, n_tokens, container) of settled ``items`` (key, n) for each of ``limits`` (profile, capacity).

    ``limits`` is a table of a few rows. Containers are named within their profile.
    """
    spark = items.sparkSession
    rules = [(r[0], int(r[1])) for r in limits.where("capacity >= 1").select("profile", "capacity").distinct().orderBy("profile", "capacity").collect()]
    rule = spark.createDataFrame(rules, "profile string, capacity long")
    each = items.crossJoin(F.broadcast(rule)) if len(rules) != 1 else items.withColumns({"profile": F.lit(rules[0][0]), "capacity": F.lit(rules[0][1]).cast("long")})
    each = each.withColumns({"whole": F.expr("n div capacity"), "rest": F.col("n") % F.col("capacity")})
    cut = each.where("whole > 0").select("profile", "capacity", "key", F.explode(F.expr("sequence(0L, whole - 1)")).alias("piece"))
    cut = cut.select(
        "profile", "key", "piece", (F.col("piece") * F.col("capacity")).alias("start_token"), F.col("capacity").alias("n_tokens"),
        F.concat_ws("-", F.lit("whole"), F.col("capacity"), F.col("key"), F.col("piece")).alias("container"),
    )
    nothing = each.where("n = 0").select("profile", "key", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start_token"), F.col("n").alias("n_tokens"), F.lit(None).cast("string").alias("container"))

    slots = each.where("rest > 0").select("profile", "capacity", "key", "whole", "rest", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"))
    by_salt = settle(slots.groupBy("profile", "capacity", "rest", "salt").agg(F.count("*").alias("c")), "lengths")
    totals = by_salt.groupBy("profile", "capacity", "rest").agg(F.sum("c").alias("c")).collect()  # at most the capacity a profile
    places = []
    for profile, capacity in rules:
        first, used = 0, {}
        for times, combo in patterns(capacity, {r["rest"]: r["c"] for r in totals if (r["profile"], r["capacity"]) == (profile, capacity)}):
            for length, n in combo.items():
                places.append((profile, capacity, length, used.get(length, 0), n, first))
                used[length] = used.get(length, 0) + n * times
            first += times
    plan = spark.createDataFrame(places, "profile string, capacity long, rest long, start long, per long, first long")
    plan = plan.groupBy("profile", "capacity", "rest").agg(F.array_sort(F.collect_list(F.struct("start", "per", "first"))).alias("runs"))

    before = F.coalesce(F.sum("c").over(Window.partitionBy("profile", "capacity", "rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = by_salt.withColumn("base", before).drop("c")
    number = F.row_number().over(Window.partitionBy("profile", "capacity", "rest", "salt").orderBy("key")) - 1
    on = ["profile", "capacity", "rest"]
    numbered = slots.withColumn("number", number).join(bases, [*on, "salt"]).withColumn("number", F.col("number") + F.col("base"))
    run = F.element_at(F.filter("runs", lambda r: r["start"] <= F.col("number")), -1)
    placed = numbered.join(plan, on).withColumn("run", run)
    container = F.concat_ws("-", F.lit("mixed"), F.col("capacity"), F.col("run.first") + F.expr("(number - run.start) div run.per"))
    placed = placed.select("profile", "key", F.col("whole").alias("piece"), (F.col("whole") * F.col("capacity")).alias("start_token"), F.col("rest").alias("n_tokens"), container.alias("container"))
    return cut.unionByName(placed).unionByName(nothing)


def fill(pieces: DataFrame, limits: DataFrame) -> DataFrame:
    """(profile, capacity, containers, tokens, free, least_containers) of packed pieces; least: the bound by total size."""
    used = pieces.where("container is not null").groupBy("profile", "container").agg(F.sum("n_tokens").alias("t"))
    sums = used.groupBy("profile").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    out = sums.join(F.broadcast(limits.select("profile", "capacity")), "profile")
    return out.select("profile", "capacity", "containers", "tokens", (F.col("containers") * F.col("capacity") - F.col("tokens")).alias("free"), F.ceil(F.col("tokens") / F.col("capacity")).cast("long").alias("least_containers"))
