"""Same or near-same records across splits: the weighted cosine join.

Both sides become unit vectors over tokens, with weights of 1 or by inverse
document frequency, rarest terms first. Inverted lists hold, of every vector, only
the terms up to where what is left cannot reach the threshold t against any vector
of the other side:

* residual norm: what is left of a unit vector has norm r, and its dot product with
  a unit vector is r at most;
* maximum weight: it is at most the sum of its weights, each times the greatest
  weight that the term has in any vector of the other side. The greatest weights are
  gathered over all vectors, in ``2**BITS`` counters (the greatest of the terms
  that share one), so they may be broadcast.

A term whose residual norm or bound by maximum weights is below t has no entry. An
entry of a list holds the term, the vector and its residual norm from there on. Two
vectors that meet in a list are taken on only if the product of their residual
norms reaches t and, with unit weights, if their sizes and parity maps (as in
``setsim``) leave enough common terms; then they get their exact dot product.

For that product one of the two norms must reach the root of t: such an entry
*leads*, and entries that don't lead meet only those of the other side that do.

Lists of usual terms would grow with the corpus on both sides. Where the counts of
its terms let a list expect more than ``HOT`` vectors, it is cut up by the next
term that the two vectors share, and again up to ``DEEP`` terms: the list of
(c1, c2) holds vectors whose first two common terms these are. Its norm takes the
squares of the earlier terms and the rest from the last one on; both bounds hold
for it as they do for one term. Every pair meets in the list of its own first
common terms, as both sides cut up a list by the same counts; a pair
with no more of them meets in a list that says so. There are many
such entries, so those that don't lead are made only where the other side has a
leading one, by a bitmap of at most 2**``MOST_BITS`` bits. Vectors of more than
``WIDE`` terms would have too many; pairs with one of them meet in lists of single terms.

With unit weights a Jaccard similarity of j implies a cosine of at least
2j / (1 + j), so the join at that threshold loses no pair and an exact test of
the Jaccard similarity may follow.

Null and empty texts have no terms and no pairs. Rows with equal token sets are
one class on either side and are expanded only for the result. Weights by
frequency are ln(1 + N / n) for a term in n of the N classes of both sides,
counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepquarry.functions import text as X
from stepquarry.operators import setsim as S
from stepquarry.plans.runtime import settle, small_side

BITS = 20
#: Rounding may not lose a pair at the threshold.
SLACK = 1e-9
#: Most terms whose exact counts are broadcast; more are joined by shuffle.
TERMS = 1_000_000
#: Vectors of both sides that a list may expect before it is cut up, and most terms of an entry.
HOT, DEEP = 500, 3
#: Most vectors, as a share, that have the last term of a list that is cut up; what follows is as common, and cuts it into lists hardly smaller.
PARTS = 0.2
#: Vectors of more terms have entries of one term only.
WIDE = 128
#: Bits, by vector and at most (as a power of 2), that tell which lists have a leading entry.
BITS_EACH, MOST_BITS = 256, 27
#: Vectors whose entries are made at once.
ROWS = 1000
LISTS = "sig long, gid long, rest double"
MAPPED = f"{LISTS}, size int, {', '.join(f'{m} long' for m in S.MAPS)}"


def user_messages(train: DataFrame) -> DataFrame:
    """(key, text) of the messages with role user in any case; a row may have several."""
    users = F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == "user")
    return train.select(F.col("ex_id").alias("key"), F.explode(users).alias("m")).select("key", F.col("m.content").alias("text"))


def classes_of(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settled (gid, toks) of distinct token sets and (gid, key) of the rows that have them."""
    rows = texts.select(F.col("key").cast("long").alias("key"), X.hashed(X.tokens(F.col("text"))).alias("toks")).where(F.size("toks") > 0)
    k1, k2 = X.set_key(F.col("toks"))
    rows = settle(rows.withColumns({"k1": k1, "k2": k2}), "vectors")
    firsts = settle(rows.groupBy("k1", "k2").agg(F.min("key").alias("gid"), F.first("toks").alias("toks")), "classes")
    members = rows.select("key", "k1", "k2").join(firsts.select("gid", "k1", "k2"), ["k1", "k2"]).select("gid", "key").distinct()
    return firsts.select("gid", "toks"), members


def unit_vectors(sets: DataFrame, order: S.Order) -> DataFrame:
    """(gid, terms, weights) of (gid, toks): all weights equal, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes, _ = S.flat(batch.column(1))
            ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
            terms = values[S.arranged(values, sizes, order.of(values))]
            weights = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(terms)), pa.ListArray.from_arrays(ends, pa.array(weights))], names=["gid", "terms", "weights"])

    return sets.select("gid", "toks").mapInArrow(run, "gid long, terms array<long>, weights array<double>")


def frequencies(*sides: DataFrame) -> tuple[DataFrame, int]:
    """Settled exact (term, n) over the classes of all sides, and the number of classes."""
    both = sides[0].select("toks")
    for s in sides[1:]:
        both = both.unionByName(s.select("toks"))
    return settle(both.select(F.explode("toks").alias("term")).groupBy("term").agg(F.count("*").alias("n")), "terms"), both.count()


def idf_vectors(sets: DataFrame, terms: DataFrame, records: int) -> DataFrame:
    """(gid, terms, weights) of (gid, toks) by the exact frequencies (term, n), rarest first."""
    each = sets.select("gid", F.explode("toks").alias("term")).join(small_side(terms, TERMS), "term")
    rows = each.groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("n", "term"))).alias("v"))
    raw = rows.select("gid", F.transform("v", lambda t: t["term"]).alias("terms"), F.transform("v", lambda t: F.log1p(F.lit(float(records)) / t["n"])).alias("w"))
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, w: a + w * w))
    return raw.withColumn("_norm", norm).select("gid", "terms", F.transform("w", lambda w: w / F.col("_norm")).alias("weights"))


def greatest(vectors: DataFrame) -> np.ndarray:
    """The greatest weight of the terms of each counter; at most 2**BITS rows a task are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(1 << BITS)
        for batch in batches:
            terms, weights = S.flat(batch.column(0))[0], S.flat(batch.column(1))[0]
            np.maximum.at(best, terms & ((1 << BITS) - 1), weights)
        used = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(best[used])], names=["k", "w"])

    rows = vectors.select("terms", "weights").mapInArrow(run, "k int, w double").groupBy("k").agg(F.max("w").alias("w")).toArrow()
    out = np.zeros(1 << BITS)
    out[rows["k"].to_numpy()] = rows["w"].to_numpy()
    return out


@dataclass(frozen=True)
class Usual:
    """The counts of all terms by counter, the number of vectors that they are of, and most vectors that a list may expect."""

    order: S.Order
    records: int
    most: int

    def shares(self, terms: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(self.order.of(terms), 1) / self.records)

    def hot(self, shares: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether lists of terms whose shares have these sums expect too many vectors, and a term after the last one would part them."""
        return (shares + np.log(self.records) > np.log(self.most)) & (last <= np.log(PARTS))


def suffixes(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums from each place to the end of its list."""
    total = np.cumsum(x)
    return np.repeat(total[np.cumsum(sizes) - 1], sizes) - total + x


def mixed(sig: np.ndarray, more: np.ndarray) -> np.ndarray:
    return (sig ^ (sig >> 29)) * np.int64(-7046029254386353131) + more


def marked(bits: np.ndarray, sig: np.ndarray) -> np.ndarray:
    where = sig & (len(bits) * 64 - 1)
    return (bits[where >> 6] >> (where & 63).astype(np.uint64)) & np.uint64(1) == 1


def entries(terms: np.ndarray, weights: np.ndarray, sizes: np.ndarray, theirs: np.ndarray, t: float, least: float, usual: Usual | None, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(list, number of the vector, norm, whether cut up further) of the entries whose norm is at least ``least``, by number of terms."""
    squares, most = weights * weights, weights * theirs[terms & ((1 << BITS) - 1)]
    rest, bound = np.maximum(suffixes(squares, sizes), 0), suffixes(most, sizes)
    of, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    places = of * 2 - rest  # ascending
    shares = usual.shares(terms) if usual else np.zeros(len(terms))
    at, sig, share = np.arange(len(terms)), terms, shares
    held, sure = np.zeros(len(terms)), np.zeros(len(terms))  # of the terms before the last: squares, and weights times the greatest of the other side

    def kept(sig: np.ndarray, norm: np.ndarray, reach: np.ndarray) -> np.ndarray:
        keep = (norm >= least - SLACK) & (reach >= t - SLACK)
        return keep if bits is None else keep & ((norm >= np.sqrt(t - SLACK)) | marked(bits, sig))

    for depth in range(1, DEEP + 1):
        norm = np.sqrt(held + rest[at])
        keep = kept(sig, norm, sure + bound[at])
        at, sig, share, held, sure, norm = (x[keep] for x in (at, sig, share, held, sure, norm))
        hot = usual.hot(share, shares[at]) if usual and depth < DEEP else np.zeros(len(at), bool)
        yield sig, of[at], norm, hot
        if not hot.any():
            return
        at, sig, share, held, sure = (x[hot] for x in (at, sig, share, held, sure))
        held, sure = held + squares[at], sure + most[at]
        ended, norm = mixed(sig, np.int64(depth)), np.sqrt(held)  # of two vectors that have no more terms in common
        keep = kept(ended, norm, sure)
        yield ended[keep], of[at[keep]], norm[keep], np.zeros(keep.sum(), bool)
        last = np.searchsorted(places, of[at] * 2 - (least - SLACK) ** 2 + held + SLACK, "right")
        further = np.maximum(np.minimum(last, ends[of[at]]) - at - 1, 0)
        src = np.repeat(np.arange(len(at)), further)
        at = at[src] + 1 + np.arange(len(src)) - np.repeat(np.cumsum(further) - further, further)
        sig = mixed(sig[src], terms[at])
        share, held, sure = share[src] + shares[at], held[src], sure[src]


def lists(vectors: DataFrame, theirs: np.ndarray, t: float, usual: Usual | None = None, bits: np.ndarray | None = None, *, mapped: bool = False) -> DataFrame:
    """LISTS entries, or MAPPED ones with size and parity map, of (gid, terms, weights) for a join at t with vectors whose greatest weights are ``theirs``.

    With ``usual`` hot lists are cut up; with ``bits``, of the other side, entries that don't lead need a leading one there.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((theirs, bits))
    schema = MAPPED if mapped else LISTS
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                terms, sizes, _ = S.flat(batch.column(1))
                of_vector = [batch.column(0).to_numpy()]
                if mapped:
                    of_vector += [sizes.astype(np.int32), *S.parity_maps(terms, sizes).T]
                for sig, of, norm, hot in entries(terms, S.flat(batch.column(2))[0], sizes, shared.value[0], t, t, usual, shared.value[1]):
                    sig, of, norm = sig[~hot], of[~hot], norm[~hot]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (sig, of_vector[0][of], norm, *[v[of] for v in of_vector[1:]])], names=names)

    return vectors.where(F.size("terms") > 0).mapInArrow(run, schema)


def leading(vectors: DataFrame, theirs: np.ndarray, t: float, usual: Usual | None, records: int) -> np.ndarray:
    """Bitmap, by 64-bit words, of the lists, whole or cut up, in which ``vectors`` have a leading entry."""
    words = 1 << min(max(records * BITS_EACH, 1 << 16).bit_length(), MOST_BITS) - 6
    shared = vectors.sparkSession.sparkContext.broadcast(theirs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(words, np.uint64)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                terms, sizes, _ = S.flat(batch.column(1))
                for sig, *_ in entries(terms, S.flat(batch.column(2))[0], sizes, shared.value, t, np.sqrt(t - SLACK), usual, None):
                    where = sig & (words * 64 - 1)
                    np.bitwise_or.at(bits, where >> 6, np.uint64(1) << (where & 63).astype(np.uint64))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(bits[used].view(np.int64))], names=["k", "w"])

    rows = vectors.where(F.size("terms") > 0).mapInArrow(run, "k int, w long").groupBy("k").agg(F.bit_or("w").alias("w")).toArrow()
    out = np.zeros(words, np.uint64)
    out[rows["k"].to_numpy()] = rows["w"].to_numpy().view(np.uint64)
    return out


def met(p: DataFrame, q: DataFrame, t: float) -> DataFrame:
    """Distinct (a, b) of gid in LISTS or MAPPED entries of the two sides that share a list and may reach t; of the two one leads."""
    lead = f"rest >= {float(np.sqrt(t - SLACK))!r}D"
    p = p.withColumn("role", F.explode(F.expr(f"IF({lead}, array(0, 1), array(0))"))).alias("p")
    q = q.withColumn("role", F.expr(f"IF({lead}, 0, 1)")).alias("q")
    near = f"p.sig = q.sig AND p.role = q.role AND p.rest * q.rest >= {t - SLACK!r}D"
    if "size" in p.columns:
        common = f"{t - SLACK!r}D * sqrt(CAST(p.size AS DOUBLE) * q.size)"
        gap = " + ".join(f"bit_count(p.{m} ^ q.{m})" for m in S.MAPS)
        near += f" AND least(p.size, q.size) >= {common} AND {gap} <= p.size + q.size - 2 * {common}"
    return p.join(q, F.expr(near)).select(F.col("p.gid").alias("a"), F.col("q.gid").alias("b")).distinct()


def candidates(x: DataFrame, y: DataFrame, t: float, usual: Usual, sizes: tuple[tuple[int, int], tuple[int, int]], unit: bool) -> DataFrame:
    """Distinct (a, b) of vectors (gid, terms, weights) of either side that may reach t; sizes: of each side the vectors, and the wide ones among them; unit: all weights of a vector are equal."""
    (n, wide_x), (m, wide_y) = sizes
    most = greatest(x), greatest(y)
    narrow, wide = F.size("terms") <= WIDE, F.size("terms") > WIDE
    nx, ny = (x.where(narrow) if wide_x else x), (y.where(narrow) if wide_y else y)
    lead = leading(nx, most[1], t, usual, n), leading(ny, most[0], t, usual, m)
    pairs = met(lists(nx, most[1], t, usual, lead[1], mapped=unit), lists(ny, most[0], t, usual, lead[0], mapped=unit), t)
    if wide_x:
        pairs = pairs.unionByName(met(lists(x.where(wide), most[1], t, mapped=unit), lists(y, most[0], t, mapped=unit), t))
    if wide_y:
        pairs = pairs.unionByName(met(lists(nx, most[1], t, mapped=unit), lists(y.where(wide), most[0], t, mapped=unit), t))
    return pairs


def cosine_join(left: DataFrame, right: DataFrame, t: float, *, weighting: str = "unit") -> DataFrame:
    """Pairs (a, b, dot) of settled (gid, toks) of either side with a cosine of at least ``t``; weighting "unit" or "idf"."""
    order = S.token_order(left.select("toks").unionByName(right.select("toks")), "toks")
    sizes = tuple(tuple(s.agg(F.count("*"), F.count_if(F.size("toks") > WIDE)).first()) for s in (left, right))
    if weighting == "unit":
        x, y = (unit_vectors(s, order) for s in (left, right))
    else:
        terms, n = frequencies(left, right)
        x, y = (settle(idf_vectors(s, terms, n), "vectors") for s in (left, right))
    pairs = candidates(x, y, t, Usual(order, max(sizes[0][0] + sizes[1][0], 1), HOT), sizes, weighting == "unit")
    if weighting == "unit":  # then the dot product is a count, and the JVM has it
        held = pairs.join(left.select(F.col("gid").alias("a"), F.col("toks").alias("x")), "a").join(right.select(F.col("gid").alias("b"), F.col("toks").alias("y")), "b")
        dot = F.size(F.array_intersect("x", "y")) / F.sqrt(F.size("x").cast("double") * F.size("y"))
        return held.select("a", "b", dot.alias("dot")).where(F.col("dot") >= t - SLACK)

    def dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tx, wx, ty, wy in zip(*(batch.column(i) for i in range(2, 6))):
                _, i, j = np.intersect1d(np.asarray(tx.values), np.asarray(ty.values), assume_unique=True, return_indices=True)
                out.append(float(np.asarray(wx.values)[i] @ np.asarray(wy.values)[j]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "dot"])

    held = pairs.join(x.select(F.col("gid").alias("a"), F.col("terms").alias("tx"), F.col("weights").alias("wx")), "a").join(y.select(F.col("gid").alias("b"), F.col("terms").alias("ty"), F.col("weights").alias("wy")), "b")
    return held.select("a", "b", "tx", "wx", "ty", "wy").mapInArrow(dots, "a long, b long, dot double").where(F.col("dot") >= t - SLACK)


def overlaps(held_out: DataFrame, train: DataFrame, jaccard_tenths: int = 7) -> DataFrame:
    """All pairs (key_a, key_b, dot) of (key, text) rows with a Jaccard similarity of at least jaccard_tenths/10."""
    left, lm = classes_of(held_out)
    right, rm = classes_of(train)
    j = jaccard_tenths / 10
    near = cosine_join(left, right, 2 * j / (1 + j))
    x = left.select(F.col("gid").alias("a"), F.col("toks").alias("x"))
    y = right.select(F.col("gid").alias("b"), F.col("toks").alias("y"))
    links = near.join(x, "a").join(y, "b").where(S.tenths("x", "y", jaccard_tenths)).select("a", "b", "dot")
    return of_rows(links, lm, rm)


def weighted_overlaps(held_out: DataFrame, train: DataFrame, t: float = 0.8) -> DataFrame:
    """All pairs (key_a, key_b, dot) of (key, text) rows with a cosine of at least t of their vectors by inverse document frequency."""
    left, lm = classes_of(held_out)
    right, rm = classes_of(train)
    return of_rows(cosine_join(left, right, t, weighting="idf"), lm, rm)


def of_rows(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Links (a, b, dot) of classes as pairs (key_a, key_b, dot) of their members (gid, key); a row with several texts counts by its nearest."""
    links = links.join(left.select(F.col("gid").alias("a"), F.col("key").alias("key_a")), "a")
    links = links.join(right.select(F.col("gid").alias("b"), F.col("key").alias("key_b")), "b")
    return links.groupBy("key_a", "key_b").agg(F.max("dot").alias("dot"))


def overlap_counts(pairs: DataFrame, held_out: DataFrame) -> DataFrame:
    """(split, source, held_out_rows, overlapping_rows, pairs) over pairs (key_a, key_b) and held-out rows (key, split, source).

    Rows without overlaps count too; a null source is a source of its own.
    """
    per_row = pairs.groupBy(F.col("key_a").alias("key")).agg(F.count("*").alias("n"))
    rows = held_out.select("key", "split", "source").join(per_row, "key", "left")
    return rows.groupBy("split", "source").agg(
        F.count("*").alias("held_out_rows"), F.count("n").alias("overlapping_rows"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("pairs")
    )
