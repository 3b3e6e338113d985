"""Sinks with the guards that a curation run needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str) -> None:
    """JSON lines, whatever was there before is replaced."""
    df.write.mode("overwrite").json(path)


def append_accepted(df: DataFrame, path: str) -> bool:
    """Append JSON lines if there are any; whether there were."""
    if df.isEmpty():
        return False
    df.write.mode("append").json(path)
    return True


def write_rejects(df: DataFrame, path: str, *, only_if_any: bool) -> bool:
    """Replace the rejects; with ``only_if_any`` an empty result leaves what is there."""
    if only_if_any and df.isEmpty():
        return False
    overwrite(df, path)
    return True


def keep(df: DataFrame, path: str | None) -> bool:
    """Write the kept rows if a path is given and there are any."""
    if not path or df.isEmpty():
        return False
    overwrite(df, path)
    return True


def array_report(df: DataFrame, order: str) -> DataFrame:
    """One row ``report``: a JSON array of the rows by ``order``; for tables of a bounded size only."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), *[F.col(c) for c in df.columns if c != order])))
    return df.agg(F.to_json(rows).alias("report"))
