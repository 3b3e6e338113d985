"""Gates over repeated trials of a figure: did it build, is it degenerate, do its checks hold.

``trials_of`` turns probed coordinates into one row a (problem, trial) with the
points as a map; everything else is arithmetic and conditional aggregation on
such rows. A problem with very many trials is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepquarry.operators import checks as C

# Bounds of a sound figure and the share of clean trials that keeps it.
MOST_COORDINATE = 1e5
LEAST_EXTENT = 0.5
COINCIDE = 1e-4
LEAST_DISTINCT = 0.5
KEEP = 0.6


#: Trials of one problem are spread over so many tasks when they meet what belongs to the problem.
SALTS = 8


def point_steps(problems: DataFrame, key: str, steps: str = "construction_steps") -> DataFrame:
    """(problem_id, n_steps, points) of every problem: its number of steps, and the names of those of class point, in order."""
    named = F.filter(steps, lambda s: (s["class"] == "point") & s["name"].isNotNull())
    names = F.coalesce(F.transform(named, lambda s: s["name"]), F.array().cast("array<string>"))
    return problems.select(F.col(key).alias("problem_id"), F.coalesce(F.size(steps), F.lit(0)).alias("n_steps"), names.alias("points"))


def of_problem(trials: DataFrame, each: DataFrame) -> DataFrame:
    """Trials joined with rows of their problem; as one problem may have a large part of all trials, both sides are salted."""
    x = trials.withColumn("_salt", F.pmod(F.xxhash64("trial"), F.lit(SALTS)))
    y = each.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return x.join(y, ["problem_id", "_salt"]).drop("_salt")


def latest(probes: DataFrame) -> DataFrame:
    """One row a (problem_id, trial, pos, name): the one loaded last, of those the one recorded last; twice-delivered rows fall away."""
    order = F.struct("loaded_at", "recorded_at", "x", "y")
    best = probes.groupBy("problem_id", "trial", "pos", "name").agg(F.max(order).alias("r"))
    return best.select("problem_id", "trial", "pos", "name", "r.x", "r.y")


def trials_of(probes: DataFrame) -> DataFrame:
    """(problem_id, trial, pts, coords, scale): points in step order, the map from name to (x, y), the figure's larger side.

    Points without both coordinates were not readable and are left out; of a name
    that occurs twice the later step counts. Rows with a null problem, trial or
    name are ignored. The side is taken over finite points and is 1 for less than
    two points or no extent.
    """
    rows = latest(probes.where("problem_id is not null and trial is not null and name is not null")).where("x is not null and y is not null")
    pts = F.array_sort(F.collect_list(F.struct("pos", "name", "x", "y"))).alias("pts")
    finite = F.when((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")), True)
    side = F.greatest(*[F.max(F.when(finite, F.col(c))) - F.min(F.when(finite, F.col(c))) for c in ("x", "y")]).alias("side")
    out = rows.groupBy("problem_id", "trial").agg(pts, side)
    last = F.aggregate(
        "pts",
        F.lit(None).cast("map<string,struct<x:double,y:double>>"),
        lambda m, p: F.coalesce(F.map_concat(F.map_filter(m, lambda k, _: k != p["name"]), F.create_map(p["name"], F.struct(p["x"].alias("x"), p["y"].alias("y")))), F.create_map(p["name"], F.struct(p["x"].alias("x"), p["y"].alias("y")))),
    )
    # a map of distinct names needs no fold; the fold is taken only where a name repeats
    names = F.transform("pts", lambda p: p["name"])
    plain = F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))))
    scale = F.when((F.size("pts") >= 2) & (F.col("side") > 1e-9), F.col("side")).otherwise(1.0)
    return out.select("problem_id", "trial", "pts", F.coalesce(plain, last).alias("coords"), scale.alias("scale"))


def built(trials: DataFrame, points: DataFrame) -> DataFrame:
    """Trials with n_steps and ``failed``: the point steps, in order, that have no coordinates.

    Every problem of ``points`` has a row: one without trials has one with a null
    trial and nothing failed. Trials of unknown problems are left out.
    """
    failed = F.filter("points", lambda n: ~F.map_contains_key("coords", n))
    tried = of_problem(trials, points).withColumn("failed", failed).drop("points")
    none = points.join(trials.select("problem_id").distinct(), "problem_id", "left_anti")
    none = none.select("problem_id", "n_steps", F.array().cast("array<string>").alias("failed"))
    return tried.unionByName(none, allowMissingColumns=True)


def gate_all(trials: DataFrame) -> DataFrame:
    """(problem_id, clean, trials, ok, sample_failure): ok if every trial built; the first failing trial's list.

    A problem without steps has nothing that could fail, and one without trials none that failed: both are ok.
    """
    ok, there = F.size("failed") == 0, F.col("trial").isNotNull()
    out = trials.groupBy("problem_id").agg(F.count_if(ok & there).alias("clean"), F.count("trial").alias("trials"), F.min(F.when(~ok, F.struct("trial", "failed"))).alias("bad"))
    return out.select("problem_id", "clean", "trials", (F.col("clean") == F.col("trials")).alias("ok"), F.col("bad.failed").alias("sample_failure"))


def out_of_bounds(pts: Column) -> Column:
    """Points that are not finite or too far out."""
    return F.filter(pts, lambda p: F.isnan(p["x"]) | F.isnan(p["y"]) | (F.abs(p["x"]) > MOST_COORDINATE) | (F.abs(p["y"]) > MOST_COORDINATE))


def extent(pts: Column) -> Column:
    """Diagonal of the bounding box."""
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.hypot(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys))


def cluster_count(pts: Column, tol: Column) -> Column:
    """Leaders of a greedy clustering in step order: a point leads unless an earlier leader is nearer than tol."""
    none = F.array().cast("array<struct<x:double,y:double>>")
    lead = lambda acc, p: F.when(F.exists(acc, lambda c: F.hypot(c["x"] - p["x"], c["y"] - p["y"]) < tol), acc).otherwise(F.concat(acc, F.array(F.struct(p["x"].alias("x"), p["y"].alias("y")))))
    return F.size(F.aggregate(pts, none, lead))


def degeneracy(pts: Column) -> Column:
    """Why a figure is degenerate: out_of_bounds, collapsed or coincident; null if it is sound.

    The first that applies, in this order. Fewer than two points are only tested for bounds.
    """
    n, size = F.size(pts), extent(pts)
    few = cluster_count(pts, COINCIDE * size) < F.greatest(F.lit(3), F.ceil(LEAST_DISTINCT * n))
    return (
        F.when(F.size(out_of_bounds(pts)) > 0, "out_of_bounds")
        .when((n >= 2) & (size < LEAST_EXTENT), "collapsed")
        .when((n >= 2) & few, "coincident")
    )


def gate_majority(trials: DataFrame, keep: float = KEEP) -> DataFrame:
    """(problem_id, clean, trials, kept, last_reason): kept if the share of built, sound trials reaches ``keep``; the last bad trial's reason.

    A problem without steps is dropped as no_steps, one without trials as no_trials.
    """
    there = F.col("trial").isNotNull()
    reason = F.when(there & (F.size("failed") > 0), "broken").when(there, degeneracy(F.col("pts")))
    rows = trials.select("problem_id", "trial", "n_steps", reason.alias("reason"))
    bad = F.max(F.when(F.col("reason").isNotNull(), F.struct("trial", "reason"))).alias("bad")
    out = rows.groupBy("problem_id").agg(F.count_if(there & F.col("reason").isNull()).alias("clean"), F.count("trial").alias("trials"), F.max("n_steps").alias("n_steps"), bad)
    kept = (F.col("n_steps") > 0) & (F.col("trials") > 0) & (F.col("clean") >= F.lit(keep) * F.col("trials"))
    why = F.when(F.col("n_steps") == 0, "no_steps").when(F.col("trials") == 0, "no_trials").when(~kept, F.col("bad.reason"))
    return out.select("problem_id", "clean", "trials", kept.alias("kept"), why.alias("last_reason"))


def checks_of(problems: DataFrame, key: str) -> DataFrame:
    """Parsed checks (problem_id, idx, kind, names_one, names_two, deg, internal) of (key, checks as JSON texts)."""
    rows = problems.select(F.col(key).alias("problem_id"), F.posexplode("checks").alias("idx", "check"))
    return C.parsed(rows).drop("check")


def checked(trials: DataFrame, checks: DataFrame) -> DataFrame:
    """(problem_id, trial, idx, kind, holds, reason) for every check on every trial of its problem."""
    rows = of_problem(trials.where("trial is not null").select("problem_id", "trial", "coords", "scale"), checks)
    return C.evaluated(rows).select("problem_id", "trial", "idx", "kind", "holds", "reason")


def gate_checks(results: DataFrame) -> DataFrame:
    """(problem_id, results, ok, first_reason): ok if every check holds on every trial; the first failure, as kind: reason, by trial, then check."""
    said = F.concat_ws(": ", F.coalesce("kind", F.lit("none")), "reason").alias("said")
    bad = F.min(F.when(~F.col("holds"), F.struct("trial", "idx", said))).alias("bad")
    out = results.groupBy("problem_id").agg(F.count("*").alias("results"), F.bool_and("holds").alias("ok"), bad)
    return out.select("problem_id", "results", "ok", F.col("bad.said").alias("first_reason"))


def gates_in_order(build: DataFrame, check: DataFrame) -> DataFrame:
    """(problem_id, status, failure): broken, then unproven, then accepted; what failed first, as a list.

    Problems without checks, or without trials to check, pass the second gate.
    """
    rows = build.select("problem_id", F.col("ok").alias("built"), "sample_failure").join(check.select("problem_id", F.col("ok").alias("proved"), "first_reason"), "problem_id", "left")
    status = F.when(~F.col("built"), "broken").when(~F.coalesce("proved", F.lit(True)), "unproven").otherwise("accepted")
    failure = F.when(F.col("status") == "broken", F.col("sample_failure")).when(F.col("status") == "unproven", F.array("first_reason"))
    return rows.withColumn("status", status).select("problem_id", "status", failure.alias("failure"))


def view_box(pts: DataFrame, width: int = 800, height: int = 600) -> DataFrame:
    """(problem_id, trial, x_min, x_max, y_min, y_max): the window around the finite points given, which should be the visible ones.

    Each side gets a margin of 18 % of the extent, 1.5 at least; then the window is
    widened about its middle so that both axes have the units a pixel of ``width`` by ``height``.
    """
    ok = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    box = pts.where(ok).groupBy("problem_id", "trial").agg(*[f(c).alias(f"{n}{c}") for c in ("x", "y") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    span = {c: F.col(f"hi{c}") - F.col(f"lo{c}") for c in ("x", "y")}
    wide = {c: span[c] + 2 * F.greatest(0.18 * span[c], F.lit(1.5)) for c in span}
    unit = F.greatest(wide["x"] / width, wide["y"] / height)
    mid = {c: (F.col(f"hi{c}") + F.col(f"lo{c}")) / 2 for c in span}
    sides = [(mid[c] + unit * (sign * pixels / 2)).alias(f"{c}_{n}") for c, pixels in (("x", width), ("y", height)) for sign, n in ((-1, "min"), (1, "max"))]
    return box.select("problem_id", "trial", *sides)
