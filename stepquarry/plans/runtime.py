"""Session helpers: the shared scratch folder, lineage cuts, size-checked broadcasts.

Nothing here creates a session or changes its settings; the cluster's own
configuration is read from the session that a query is given.
"""

from __future__ import annotations

import atexit
import itertools
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_serial = itertools.count()
_run = uuid.uuid4().hex[:12]
_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this run below ``spark.checkpoint.dir``.

    The setting is read from the session. Only where it is unset and the whole
    application is one process, as in tests, a temporary folder takes its place;
    on a cluster an unset folder is an error, as each machine would have its own.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            found = spark.sparkContext._jsc.sc().getCheckpointDir()
            if found.isDefined():
                base = found.get()
            elif spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
                base = "file://" + tempfile.mkdtemp(prefix="stepquarry-")
            else:
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _roots[app] = f"{base.rstrip('/')}/stepquarry-{_run}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone already
        pass


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_root(spark)}/{name}-{next(_serial)}"


def settle(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder once and read it back.

    Unlike ``checkpoint()`` this evaluates the plan only once, keeps the
    columnar layout, so later reads prune columns, and survives the loss of
    any executor.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_counted(df: DataFrame, name: str = "cut", **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``settle`` that also gives the number of rows ``n`` and further aggregates, taken while writing."""
    taken = Observation()
    aggs = {"n": F.count(F.lit(1)), **counts}
    out = settle(df.observe(taken, *[a.alias(k) for k, a in aggs.items()]), name)
    got = taken.get
    if set(got) != set(aggs):  # an empty plan may have been cut short
        got = out.agg(*[a.alias(k) for k, a in aggs.items()]).first().asDict()
    return out, {k: v or 0 for k, v in got.items()}


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most_rows`` rows, else as it is.

    The check stops counting one row beyond the bound. ``df`` should be settled.
    """
    n = df.limit(most_rows + 1).count()
    return F.broadcast(df) if n <= most_rows else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="stepquarry-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(out))
