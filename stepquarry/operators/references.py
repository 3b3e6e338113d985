"""The graph that a step list encodes by names: references, dead steps, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepquarry.functions.words import WORD


def references(steps: DataFrame) -> DataFrame:
    """(problem_id, pos, ref, ref_pos): names of steps of the same problem that a command uses; ref_pos is the first step so named."""
    names = steps.where("name is not null").groupBy("problem_id", F.col("name").alias("ref")).agg(F.min("pos").alias("ref_pos"))
    used = steps.select("problem_id", "pos", F.explode(F.array_distinct(F.regexp_extract_all("command", F.lit(WORD), F.lit(0)))).alias("ref"))
    return used.join(names, ["problem_id", "ref"]).select("problem_id", "pos", "ref", "ref_pos")


def dead_steps(steps: DataFrame) -> DataFrame:
    """(problem_id, pos, name): helper steps that no other step uses."""
    used = references(steps).where("pos <> ref_pos").select("problem_id", F.col("ref").alias("name")).distinct()
    return steps.where("type = 'construction' AND name is not null").join(used, ["problem_id", "name"], "left_anti").select("problem_id", "pos", "name")


def early_uses(steps: DataFrame) -> DataFrame:
    """(problem_id, pos, ref, ref_pos): uses of a name at or before the step that makes it."""
    return references(steps).where("ref_pos >= pos")
