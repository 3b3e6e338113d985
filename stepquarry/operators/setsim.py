"""Exact set-similarity candidates by rarest-first prefixes.

Every record is a set of 64-bit token hashes. Tokens get one global order,
rarest first, from a histogram of token counts over all records; the histogram
has ``2**HIST_BITS`` counters whatever the corpus, so it may be broadcast. Any
total order is right, the counts only decide how selective it is.

Two records can reach the threshold only if the first token they share, in that
order, lies in a prefix of both. How long a prefix must be depends on which of
the two is smaller: a partner of at least its own size must share more, so as
the smaller one a record is held by a short prefix (``lead``), as the larger one
by a long one. An equi-join of short with long prefixes meets every true pair
once for each shared token; sizes, positions and a 256-bit parity map of the set
drop nearly all other pairs inside the join.

Prefixes are made in whole Arrow batches; postings are exploded from them, and
joined, inside the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIST_BITS = 20
_MASK = (1 << HIST_BITS) - 1
_EPS = 1e-9
MAPS = ("b0", "b1", "b2", "b3")
PREFIX = "gid long, size int, lead int, prefix array<long>, msize int, b0 long, b1 long, b2 long, b3 long"


@dataclass
class Order:
    """Token counts by bucket, shared with the executors."""

    counts: object  # Broadcast of a numpy array

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return self.counts.value[tokens & _MASK]


def bucket_counts(sets: DataFrame, column: str) -> DataFrame:
    """(bucket, n): tokens of all records by bucket; at most 2**HIST_BITS rows, counted before the shuffle."""
    return sets.select(F.explode(column).alias("t")).groupBy(F.col("t").bitwiseAND(F.lit(_MASK)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def shared_order(counts: DataFrame) -> Order:
    """The order by (bucket, n) rows."""
    rows, total = counts.select("bucket", "n").toArrow(), np.zeros(1 << HIST_BITS, np.int64)
    total[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return Order(counts.sparkSession.sparkContext.broadcast(total))


def token_order(sets: DataFrame, column: str) -> Order:
    """The order by the counts of all tokens in ``column``."""
    return shared_order(bucket_counts(sets, column))


@dataclass(frozen=True)
class Jaccard:
    """A Jaccard similarity of at least ``t``."""

    t: float

    def long_prefix(self, size):
        """Tokens of a prefix that meets any partner."""
        return size - np.ceil(self.t * size - _EPS) + 1

    def short_prefix(self, size):
        """Tokens of a prefix that meets any partner of at least the same size."""
        return size - np.ceil(2 * self.t / (1 + self.t) * size - _EPS) + 1

    def common(self, a: str, b: str) -> str:
        """Least number of common tokens of two sets of these sizes, as SQL."""
        return f"{self.t / (1 + self.t)!r}D * ({a} + {b}) - {_EPS!r}D"


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, sizes and starts of a list array without nulls."""
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], np.diff(ends), ends[:-1] - ends[0]


def parity_maps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per set 256 bits, each the parity of the tokens that fall on it, as four signed words."""
    where = np.repeat(np.arange(len(sizes)), sizes) * 256 + ((values >> np.int64(24)) & 255)
    bits = np.bincount(where, minlength=len(sizes) * 256).reshape(-1, 256) & 1
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)


def arranged(values: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices that put the tokens of each set rarest first."""
    return np.lexsort((values, counts, np.repeat(np.arange(len(sizes)), sizes)))


def chosen(values: np.ndarray, sizes: np.ndarray, starts: np.ndarray, keep: np.ndarray) -> pa.ListArray:
    """The first ``keep`` values of each list."""
    inside = np.arange(len(values)) - np.repeat(starts, sizes) < np.repeat(keep, sizes)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *keep]), pa.int32()), pa.array(values[inside]))


def prefixes(sets: DataFrame, order: Order, measure: Jaccard, of: str = "toks", mapped: str = "toks") -> DataFrame:
    """PREFIX rows of ``sets``: the rarest-first long prefix of ``of``, of which the first ``lead`` are the short one.

    The parity map and its set's size ``msize`` are those of ``mapped``, so pairs
    can be filtered by a second similarity. Records without tokens have no row:
    their similarity is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes, starts = flat(batch.column(1))
            others, msizes, _ = flat(batch.column(2))
            toks = values[arranged(values, sizes, order.of(values))]
            keep, lead = measure.long_prefix(sizes).astype(np.int64), measure.short_prefix(sizes).astype(np.int32)
            maps = parity_maps(others, msizes)
            columns = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(lead), chosen(toks, sizes, starts, keep), pa.array(msizes, pa.int32()), *[pa.array(maps[:, i]) for i in range(4)]]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PREFIX.split(", ")])

    rows = sets.where(F.size(of) > 0).select(F.col("gid").cast("long").alias("gid"), F.col(of).alias("_of"), F.col(mapped).alias("_map"))
    return rows.mapInArrow(run, PREFIX)


def postings(rows: DataFrame, *keep: str) -> DataFrame:
    """(sig, pos, gid, size, lead boolean, msize, b0..b3 and columns ``keep``): a row for each token of each prefix."""
    each = rows.select("gid", "size", F.col("lead").alias("_lead"), "msize", *MAPS, *keep, F.posexplode("prefix").alias("pos", "sig"))
    return each.select("sig", "pos", "gid", "size", (F.col("pos") < F.col("_lead")).alias("lead"), "msize", *MAPS, *keep)


def maps_allow(measure: Jaccard, x: str = "x", y: str = "y") -> Column:
    """Whether the mapped sets may reach the measure: by their sizes, and by the symmetric difference that their parity maps prove."""
    gap = " + ".join(f"bit_count({x}.{m} ^ {y}.{m})" for m in MAPS)
    return F.expr(f"least({x}.msize, {y}.msize) >= {measure.common(f'{x}.msize', f'{y}.msize')} AND {gap} <= {x}.msize + {y}.msize - 2 * ({measure.common(f'{x}.msize', f'{y}.msize')})")


def places_allow(measure: Jaccard, x: str = "x", y: str = "y") -> Column:
    """Whether two sets whose first common token is at these positions may reach the measure."""
    return F.expr(f"least({x}.size - {x}.pos, {y}.size - {y}.pos) >= {measure.common(f'{x}.size', f'{y}.size')}")


def met_within(rows: DataFrame, ok: Column, *also: Column) -> DataFrame:
    """Distinct pairs (a, b), a < b, of gid in postings that share a token and pass ``ok`` on x and y, the smaller set as x.

    ``also`` are further columns that follow from the pair.
    """
    x, y = rows.where("lead").alias("x"), rows.alias("y")
    first = (F.col("x.size") < F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.gid") < F.col("y.gid")))
    pairs = x.join(y, (F.col("x.sig") == F.col("y.sig")) & first & ok)
    return pairs.select(F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b"), *also).distinct()


def met(asked: DataFrame, held: DataFrame, ok: Column, *, broadcast: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (a, b, and of the held side ``keep``) of gid that share a token and pass ``ok``, asked as x and held as y.

    A posting is taken in the roles that it may have, smaller or larger, so short
    prefixes meet long ones only. ``broadcast`` sends the asked side, whose size
    the caller has checked, to all tasks: then the held side is scanned, not moved.
    """
    both, one = F.array(F.lit(0), F.lit(1)), F.lit(1)
    x = asked.withColumn("role", F.explode(F.when(F.col("lead"), both).otherwise(F.array(one))))
    y = held.withColumn("role", F.explode(F.when(F.col("lead"), both).otherwise(F.array(F.lit(0)))))
    x, y = (F.broadcast(x) if broadcast else x).alias("x"), y.alias("y")
    smaller = F.when(F.col("x.role") == 0, F.col("x.size") <= F.col("y.size")).otherwise(F.col("x.size") > F.col("y.size"))
    pairs = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.role") == F.col("y.role")) & smaller & ok)
    return pairs.select(F.col("x.gid").alias("a"), F.col("y.gid").alias("b"), *[F.col(f"y.{c}").alias(c) for c in keep]).distinct()


def tenths(column_a: str, column_b: str, at_least: int) -> Column:
    """Whether the Jaccard similarity of two arrays of distinct members is at_least/10 or more; exact."""
    common = F.size(F.array_intersect(column_a, column_b))
    union = F.size(column_a) + F.size(column_b) - common
    return (union > 0) & (common * 10 >= union * at_least)
