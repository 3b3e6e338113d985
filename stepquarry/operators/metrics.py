"""Counts over gated and scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; null for a whole of 0."""
    return F.try_divide(100.0 * part, whole)


def audit_summary(rows: DataFrame) -> DataFrame:
    """(total, render_ok, with_checks, checks_ok, render_only) of rows (built, n_checks, proved); checks count only where the figure built."""
    tested = F.col("built") & (F.coalesce("n_checks", F.lit(0)) > 0)
    return rows.agg(
        F.count("*").alias("total"), F.count_if("built").alias("render_ok"), F.count_if(tested).alias("with_checks"),
        F.count_if(tested & F.col("proved")).alias("checks_ok"), F.count_if(F.col("built") & ~tested).alias("render_only"),
    )


def score(rows: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(total, parse_ok, render_ok, pct_of_all, pct_of_parsed) of predictions (steps, built); no steps is a parse failure."""
    parsed = F.coalesce(F.size("steps"), F.lit(0)) > 0
    good = parsed & F.coalesce("built", F.lit(False))
    out = rows.groupBy(*(group or [])).agg(F.count("*").alias("total"), F.count_if(parsed).alias("parse_ok"), F.count_if(good).alias("render_ok"))
    return out.withColumns({"pct_of_all": percent(F.col("render_ok"), F.col("total")), "pct_of_parsed": percent(F.col("render_ok"), F.col("parse_ok"))})


def functional_eval(rows: DataFrame) -> DataFrame:
    """(total, parsed, renderable, pct_parsed, pct_renderable, pct_of_parsed) of predictions (steps, kept), kept by the majority gate."""
    parsed = F.coalesce(F.size("steps"), F.lit(0)) > 0
    good = parsed & F.coalesce("kept", F.lit(False))
    out = rows.agg(F.count("*").alias("total"), F.count_if(parsed).alias("parsed"), F.count_if(good).alias("renderable"))
    shares = {"pct_parsed": ("parsed", "total"), "pct_renderable": ("renderable", "total"), "pct_of_parsed": ("renderable", "parsed")}
    return out.withColumns({n: percent(F.col(a), F.col(b)) for n, (a, b) in shares.items()})


def yields(attempts: DataFrame, accepted: Column, **sums: str) -> DataFrame:
    """(attempts, accepted, yield and a sum for each of ``sums``): what came of all attempts; the yield of none is 0."""
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in sums.items()]
    out = attempts.agg(F.count("*").alias("attempts"), F.count_if(accepted).alias("accepted"), *totals)
    return out.withColumn("yield", F.col("accepted") / F.greatest(F.col("attempts"), F.lit(1)))


def totals(rows: DataFrame, *by: str) -> DataFrame:
    """Rows by status."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def accept_first(rows: DataFrame, group: list[str], order: list[str], ok: Column, wanted: int, attempts_a_unit: int = 4) -> DataFrame:
    """Of each group the first ``wanted`` rows that are ok among its first wanted * attempts_a_unit; with ``attempt`` and ``number``."""
    w = Window.partitionBy(*group).orderBy(*order)
    tried = rows.withColumn("attempt", F.row_number().over(w)).where(F.col("attempt") <= wanted * attempts_a_unit).where(ok)
    return tried.withColumn("number", F.row_number().over(w)).where(F.col("number") <= wanted)
