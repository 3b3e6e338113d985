"""JSON-lines sources: strict, tolerant and keyed scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROBLEM = (
    "id BIGINT, problem_statement STRING, construction_steps ARRAY<STRUCT<name: STRING, type: STRING, class: STRING, label: STRING, command: STRING>>, "
    "checks ARRAY<VARIANT>"
)
_LINE = "_corrupt_record"


def strict(spark: SparkSession, path: str, schema: str = PROBLEM) -> DataFrame:
    """One row a line; blank lines are skipped, any bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def if_there(spark: SparkSession, path: str, schema: str = PROBLEM) -> DataFrame:
    """As strict, but a path that does not exist has no rows."""
    try:
        return strict(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def tolerant(spark: SparkSession, path: str, schema: str = PROBLEM) -> DataFrame:
    """As strict, but bad lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def last_of_each(lines: DataFrame, key: str, position: str) -> DataFrame:
    """Of each key the row last by ``position``, with ``first_position``, where its key first occurred."""
    rows = lines.groupBy(key).agg(F.min(position).alias("first_position"), F.max(position).alias(position))
    return lines.join(rows, [key, position])


def in_order(rows: DataFrame, key: str, wanted: list, fallback: int = 8, order: str | None = None) -> DataFrame:
    """The rows whose key is in ``wanted``, in that order; if there are none, the first ``fallback`` by ``order``."""
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    places = spark.createDataFrame(list(enumerate(wanted)), f"_place int, {key} {kind}")
    found = rows.join(F.broadcast(places), key).orderBy("_place").drop("_place")
    return found if not found.isEmpty() else rows.orderBy(order or key).limit(fallback)


def tagged(source: str, df: DataFrame) -> DataFrame:
    """The rows with their provenance."""
    return df.withColumn("_source", F.lit(source))


def union_tagged(**tables: DataFrame) -> DataFrame:
    """All tables, each tagged with its name; a column that a table lacks is null."""
    out = None
    for name, df in tables.items():
        out = tagged(name, df) if out is None else out.unionByName(tagged(name, df), allowMissingColumns=True)
    return out


def load_error(text: Column) -> Column:
    """Why a pasted record can't be used: empty, not_json, no_steps or null if it can."""
    value = F.try_parse_json(text)
    steps = F.try_variant_get(value, "$.construction_steps", "array<variant>")
    blank = F.coalesce(text, F.lit("")).rlike(r"^\s*$")
    return F.when(blank, "empty").when(value.isNull(), "not_json").when(steps.isNull(), "no_steps")
