"""Parameters for points that lie on a path, and the mending of intersection indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepquarry.functions.words import path_of_point, split_arguments

# Fixed value: how far the random strata keep from both ends of a path.
INSET = 0.04
# Fixed value: points nearer than this have collapsed.
COLLAPSED = 1e-6


def exploded(problems: DataFrame, key: str, steps: str = "construction_steps") -> DataFrame:
    """(problem_id, pos, name, type, class, label, command): a row a step; null steps are left out but count for pos."""
    rows = problems.select(F.col(key).alias("problem_id"), F.posexplode(steps).alias("pos", "s")).where("s is not null")
    return rows.select("problem_id", "pos", *[F.col("s")[c].alias(c) for c in ("name", "type", "class", "label", "command")])


def on_paths(steps: DataFrame) -> DataFrame:
    """(problem_id, pos, name, path, ordinal, points): point steps of the form Point(path) on a path that is no infinite line.

    ordinal counts from 1 among the points of the path in step order. The class of
    a path's name is that of the last step so named.
    """
    last = Window.partitionBy("problem_id", "name").orderBy(F.desc("pos"))
    lines = steps.withColumn("rn", F.row_number().over(last)).where("rn = 1 AND class = 'line'").select("problem_id", F.col("name").alias("path"))
    placed = steps.where("class = 'point'").withColumn("path", path_of_point(F.col("command"))).where("path is not null")
    placed = placed.where(~F.col("path").startswith("Line(")).join(lines, ["problem_id", "path"], "left_anti")
    by = Window.partitionBy("problem_id", "path")
    return placed.select("problem_id", "pos", "name", "path", F.row_number().over(by.orderBy("pos")).alias("ordinal"), F.count("*").over(by).alias("points"))


def even(ordinal: Column, points: Column) -> Column:
    """The i-th of k points at i / (k + 1), to four places."""
    return F.round(ordinal.cast("decimal(18,0)") / (points + 1).cast("decimal(18,0)"), 4).cast("double")


def _share(*parts: Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def strewn(paths: DataFrame, trials: int, seed: int = 42) -> DataFrame:
    """(problem_id, trial, pos, name, path, t): in each trial one random t in each of the path's k strata, strata in random order.

    The randomness is a hash of seed, problem, trial, path and stratum, so a lost task computes the same again.
    """
    rows = paths.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))) if trials > 0 else paths.withColumn("trial", F.lit(0)).limit(0)
    who = [F.lit(seed), F.col("problem_id"), F.col("trial"), F.col("path")]
    stratum = F.row_number().over(Window.partitionBy("problem_id", "trial", "path").orderBy(F.xxhash64(*who, F.col("ordinal")), "ordinal")) - 1
    rows = rows.withColumn("stratum", stratum)
    t = INSET + (F.col("stratum") + _share(*who, F.col("stratum"), F.lit("t"))) * (1 - 2 * INSET) / F.col("points")
    return rows.select("problem_id", "trial", "pos", "name", "path", F.round(t, 4).alias("t"))


def with_parameters(steps: DataFrame, chosen: DataFrame, *more: str) -> DataFrame:
    """``steps`` with the command Point(path, t) where ``chosen`` (problem_id, pos, path, t) has a parameter; both may have further key columns ``more``."""
    keys = ["problem_id", *more, "pos"]
    joined = steps.join(chosen.select(*keys, "path", "t"), keys, "left")
    command = F.when(F.col("t").isNotNull(), F.concat(F.lit("Point("), "path", F.lit(", "), F.format_string("%.4f", "t"), F.lit(")"))).otherwise(F.col("command"))
    return joined.withColumn("command", command).drop("path", "t")


def evenly(steps: DataFrame) -> DataFrame:
    """``steps`` with the parameters of ``even``, as trial 0."""
    return with_parameters(steps, on_paths(steps).withColumn("t", even(F.col("ordinal"), F.col("points")))).withColumn("trial", F.lit(0))


def at_random(steps: DataFrame, trials: int, seed: int = 42) -> DataFrame:
    """``steps`` once for each of ``trials`` trials, with the parameters of ``strewn``."""
    each = steps.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    return with_parameters(each, strewn(on_paths(steps), trials, seed), "trial")


def flipped(command: Column) -> Column:
    """An Intersect command with its index 1 made 2 and any other made 1; null if it has none.

    The index is the last of three arguments or more outside all brackets, a whole number.
    """
    parts = split_arguments(F.regexp_extract(F.trim(command), r"^Intersect\((.*)\)$", 1))
    last = F.try_element_at(parts, F.lit(-1))
    other = F.when(F.try_to_number(last, F.lit("9" * 18)) == 1, F.lit("2")).otherwise(F.lit("1"))
    mended = F.concat(F.lit("Intersect("), F.array_join(F.concat(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(other)), ", "), F.lit(")"))
    return F.when((F.size(parts) > 2) & last.rlike("^[0-9]{1,18}$"), mended)


def collapsed(trials: DataFrame) -> DataFrame:
    """(problem_id, trial, pos, name, onto): points of a trial's ``pts`` that lie on an earlier point, with the first such.

    Points are compared within their own trial's array, so no pairs of rows are formed.
    """
    near = lambda p, q: (q["pos"] < p["pos"]) & (F.hypot(p["x"] - q["x"], p["y"] - q["y"]) < COLLAPSED)
    found = F.transform("pts", lambda p: F.struct(p["pos"].alias("pos"), p["name"].alias("name"), F.get(F.filter("pts", lambda q: near(p, q)), F.lit(0))["name"].alias("onto")))
    rows = trials.select("problem_id", "trial", F.explode(found).alias("f")).select("problem_id", "trial", "f.*")
    return rows.where("onto is not null")


def index_fixes(steps: DataFrame, trials: DataFrame) -> DataFrame:
    """(problem_id, pos, name, old, new): steps whose point collapsed in some trial and whose Intersect index can be flipped.

    One pass; where an evaluator can build the figure anew, it is called up to three times.
    """
    hit = collapsed(trials).select("problem_id", "pos").distinct()
    rows = steps.join(hit, ["problem_id", "pos"], "left_semi").withColumn("new", flipped(F.col("command")))
    return rows.where("new is not null").select("problem_id", "pos", "name", F.col("command").alias("old"), "new")
