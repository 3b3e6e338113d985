"""New batches against all history: an incremental inverted index.

The index is a folder that outlives the session that made it:

* ``order``: the token counts that fix the order of tokens, taken from the first
  history. Later records are ordered by it too, which stays exact and only costs
  selectivity as the vocabulary drifts (make a new index then).
* ``postings/seg=N/part=K``: the rarest-token prefixes of accepted records, in
  segments, one an append. A segment has as many parts, by token, as its size
  calls for (``PART_ROWS`` a part), and is sorted by token within a part.
* ``sets/seg=N/part=K``: token and command sets of the same records, parted by
  record, for verification.
* ``manifest-N.json``: the segments that count. It is put in place by a rename
  after everything it names was written, so an append that fails leaves the index
  as it was, and ``open`` goes on where the last complete append ended.

A batch is tokenised and writes its prefixes once; these probe the index, meet
each other, and what is accepted of them is appended. The history is never
tokenised, grouped or shuffled again: probes (broadcast up to ``PROBE_ROWS``) meet
only those parts of the postings that hold one of their tokens, and only those
parts of the sets that hold a candidate are read to verify. So k prefix tokens
read at most k parts of a segment, until a batch is large enough to need them all.
Small segments are merged ``MERGE`` at a time, so there are few of them and each
posting is written again only as often as the logarithm of the index.

A command that more than ``HOT`` records of the first history hold is no key by
itself, as its list would grow with the corpus: it is one together with each token
of the text's prefix at 0.5, which the second condition asks for anyway.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepquarry.functions import text as X
from stepquarry.llm.neardup import LOOSE, STEPS, TEXT, alike
from stepquarry.operators import setsim as S
from stepquarry.plans.runtime import settle, settle_counted, shared_path

#: Most probe rows (about 80 bytes each) and candidate pairs that are broadcast at once.
PROBE_ROWS = 400_000
PART_ROWS, MOST_PARTS, MERGE, HOT = 65_536, 32_768, 8, 1_000
#: Most links within a batch that are resolved in one task; more are resolved in rounds.
LINKS_AT_ONCE = 100_000
SETS = "gid long, toks array<long>, cmds array<long>, at int"
POSTINGS = "sig long, pos int, gid long, size int, lead boolean, msize int, b0 long, b1 long, b2 long, b3 long, fam int, at int"


@dataclass
class Manifest:
    """Segments (seg, level, rows, parts, set_parts), the number of appends, and of this manifest."""

    segments: list[dict] = field(default_factory=list)
    appends: int = 0
    number: int = 0


class Store:
    """Small files beside the index's tables, through the cluster's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def latest(self) -> Manifest | None:
        """The manifest of the highest number, if there is any."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path())] if self.fs.exists(self._path()) else []
        numbers = [int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")]
        if not numbers:
            return None
        stream = self.fs.open(self._path(f"manifest-{max(numbers)}.json"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def commit(self, m: Manifest) -> None:
        """Put a manifest in place; fails if another writer was faster."""
        held, final = self._path(f"pending-{m.number}"), self._path(f"manifest-{m.number}.json")
        stream = self.fs.create(held, True)
        stream.write(bytearray(json.dumps(m.__dict__).encode()))
        stream.close()
        if self.fs.exists(final) or not self.fs.rename(held, final):
            raise RuntimeError(f"another writer has appended to {self.path}")


def parts_for(rows: int) -> int:
    """A power of two, so that a part of a segment follows from the low bits of the key."""
    return min(MOST_PARTS, 1 << max(0, -(-rows // PART_ROWS) - 1).bit_length())


def hit(bitmap: bytes | None, parts: int) -> list[int]:
    """The parts, of so many, in which a key falls whose low bits are set in the bitmap."""
    n = int.from_bytes(bytes(bitmap or b""), "little")
    found, at = set(), 0
    while n and len(found) < parts:
        low = (n & -n).bit_length() - 1
        at += low
        found.add(at % parts)
        n >>= low + 1
        at += 1
    return sorted(found)


def low_bits(key: str) -> Column:
    """An aggregate: which of the MOST_PARTS low bits patterns the keys have, as 4 KB."""
    return F.bitmap_construct_agg(F.pmod(F.col(key), F.lit(MOST_PARTS)))


class PrefixIndex:
    """Index of accepted records; ``sets`` rows are (gid, toks, cmds)."""

    def __init__(self, spark: SparkSession, path: str, manifest: Manifest):
        self.spark, self.path, self.manifest, self.store = spark, path, manifest, Store(spark, path)
        counts = spark.read.schema("bucket int, n long, fam int").parquet(f"{path}/order")
        self.by_token, self.by_command = (S.shared_order(counts.where(F.col("fam") == fam)) for fam in (1, 2))
        #: Buckets of commands that are no keys by themselves; like the order they never change.
        self.hot = counts.where((F.col("fam") == 2) & (F.col("n") > HOT)).select(F.col("bucket").alias("_hot"))

    @classmethod
    def over(cls, history: DataFrame, path: str | None = None) -> PrefixIndex:
        """A new index of the settled (gid, toks, cmds) ``history``, which also fixes the token order."""
        spark = history.sparkSession
        path = path or shared_path(spark, "index")
        counts = [S.bucket_counts(history, c).withColumn("fam", F.lit(fam)) for fam, c in ((1, "toks"), (2, "cmds"))]
        counts[0].unionByName(counts[1]).coalesce(1).write.parquet(f"{path}/order")  # at most 2 * 2**20 rows
        made = cls(spark, path, Manifest())
        rows, counts = settle_counted(made.rows(history), "postings")
        made.append(history, history.count(), rows, counts["n"])
        return made

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PrefixIndex:
        """The index as the last complete append left it."""
        found = Store(spark, path).latest()
        if found is None:
            raise FileNotFoundError(f"no index in {path}")
        return cls(spark, path, found)

    def rows(self, sets: DataFrame) -> DataFrame:
        """Postings of both conditions (POSTINGS but for ``at``); those on commands carry the text's size and parity map."""
        texts = S.postings(S.prefixes(sets, self.by_token, TEXT)).withColumn("fam", F.lit(1))
        steps = S.postings(S.prefixes(sets, self.by_command, STEPS, of="cmds")).withColumn("fam", F.lit(2))
        if (self.by_command.counts.value > HOT).any():
            half = S.prefixes(sets, self.by_token, LOOSE).select("gid", F.col("prefix").alias("half"))
            bucket = F.col("sig").bitwiseAND(F.lit((1 << S.HIST_BITS) - 1)) == F.col("_hot")
            split = steps.join(F.broadcast(self.hot), bucket, "left_semi").join(half, "gid").withColumn("sig", F.explode(F.transform("half", lambda t: F.xxhash64("sig", t)))).drop("half")
            steps = steps.join(F.broadcast(self.hot), bucket, "left_anti").unionByName(split)
        # texts and commands never share a key
        return texts.unionByName(steps.withColumn("sig", F.xxhash64(F.lit(2), "sig")))

    def append(self, sets: DataFrame, n_sets: int, postings: DataFrame, n_postings: int) -> None:
        """Add accepted records, of the settled ``sets`` and their ``postings``, as one segment."""
        m = self.manifest
        at = F.lit(m.appends).cast("int")
        seg = self._write(len(self._all()), sets.select("gid", "toks", "cmds", at.alias("at")), n_sets, postings.withColumn("at", at), n_postings)
        self._commit([*m.segments, seg], m.appends + 1)
        self._merge()

    def _all(self) -> range:
        """Numbers of the segments ever named, dropped ones included."""
        return range(1 + max([s["seg"] for s in self.manifest.segments], default=-1))

    def _commit(self, segments: list[dict], appends: int) -> None:
        new = Manifest(segments, appends, self.manifest.number + 1)
        self.store.commit(new)
        self.manifest = new

    def _write(self, seg: int, sets: DataFrame, n_sets: int, postings: DataFrame, n_postings: int) -> dict:
        level, k = 0, n_postings // PART_ROWS
        while k >= MERGE:
            level, k = level + 1, k // MERGE
        out = {"seg": seg, "level": level, "rows": n_postings, "sets": n_sets, "parts": parts_for(n_postings), "set_parts": parts_for(4 * n_sets)}
        for name, df, key, parts in (("postings", postings, "sig", out["parts"]), ("sets", sets, "gid", out["set_parts"])):
            parted = df.withColumn("part", F.pmod(F.col(key), F.lit(parts)).cast("int")).repartition(parts, "part").sortWithinPartitions("part", key)
            # files of an append that failed earlier may be there
            parted.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/{name}/seg={seg}")
        return out

    def _merge(self) -> None:
        """Make one segment of ``MERGE`` of one level, as long as there are so many. Old files stay until ``vacuum``."""
        while True:
            levels: dict[int, list[dict]] = {}
            for s in self.manifest.segments:
                levels.setdefault(s["level"], []).append(s)
            old = next((v for v in levels.values() if len(v) >= MERGE), None)
            if old is None:
                return
            new = self._write(len(self._all()), self._read("sets", old), sum(s["sets"] for s in old), self._read("postings", old), sum(s["rows"] for s in old))
            new["level"] = max(new["level"], old[0]["level"] + 1)
            self._commit([s for s in self.manifest.segments if s not in old] + [new], self.manifest.appends)

    def vacuum(self) -> None:
        """Delete the files that no segment of the manifest names; for when nothing read before is used any more."""
        named = {s["seg"] for s in self.manifest.segments}
        for seg in set(self._all()) - named:
            for name in ("postings", "sets"):
                self.store.fs.delete(self.store._path(f"{name}/seg={seg}"), True)

    def _read(self, name: str, segments: list[dict], bitmap: bytes | None = None) -> DataFrame:
        """Rows of the segments, as one scan; with a bitmap of low bits only of the parts that it hits."""
        schema, n, k = (POSTINGS, "rows", "parts") if name == "postings" else (SETS, "sets", "set_parts")
        there = [s for s in segments if s[n]]
        if not there:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{name}"
        rows = self.spark.read.schema(f"{schema}, seg int, part int").option("basePath", base).parquet(*[f"{base}/seg={s['seg']}" for s in there])
        if bitmap is not None:
            wanted = {s["seg"]: hit(bitmap, s[k]) for s in there}
            full = [s["seg"] for s in there if len(wanted[s["seg"]]) == s[k]]
            if len(full) < len(there):
                each = [f"seg IN ({', '.join(map(str, full))})"] if full else []
                each += [f"seg = {g} AND part IN ({', '.join(map(str, parts)) or '-1'})" for g, parts in wanted.items() if g not in full]
                rows = rows.where(" OR ".join(f"({e})" for e in each))
        return rows.drop("seg", "part")

    def sets(self, since: int = 0) -> DataFrame:
        """The accepted records (gid, toks, cmds), or those of the appends from number ``since`` on."""
        return self._read("sets", self.manifest.segments).where(F.col("at") >= since).drop("at")

    def links(self, sets: DataFrame, n_sets: int) -> tuple[DataFrame, dict[str, int], DataFrame]:
        """Settled links (a, b, old) of settled ``sets``, their counts, and the settled postings of ``sets``.

        a is alike b, which is indexed (old) or another of ``sets`` with a lesser gid.
        """
        rows, seen = settle_counted(self.rows(sets), "probes", bits=low_bits("sig"))
        held = self._read("postings", self.manifest.segments, seen["bits"]).drop("at").withColumn("old", F.lit(True))
        held = held.unionByName(rows.withColumn("old", F.lit(False)))
        fits = F.when(F.col("x.fam") == 1, S.places_allow(TEXT) & S.maps_allow(TEXT)).otherwise(S.places_allow(STEPS) & S.maps_allow(LOOSE))
        ok = fits & (F.col("y.old") | (F.col("y.gid") < F.col("x.gid")))
        pairs, found = settle_counted(S.met(rows, held, ok, broadcast=seen["n"] <= PROBE_ROWS, keep=("old",)), "candidates", bits=low_bits("b"))
        a = sets.select(F.col("gid").alias("a"), F.col("toks").alias("a_toks"), F.col("cmds").alias("a_cmds"))
        b = self._read("sets", self.manifest.segments, found["bits"]).select("gid", "toks", "cmds", F.lit(True).alias("old")).unionByName(sets.select("gid", "toks", "cmds", F.lit(False).alias("old")))
        b = b.select(F.col("gid").alias("b"), F.col("toks").alias("b_toks"), F.col("cmds").alias("b_cmds"), "old")
        both = (F.broadcast(pairs) if found["n"] <= PROBE_ROWS else pairs).join(b, ["b", "old"]).join(a, "a").where(alike()).select("a", "b", "old")
        out, counts = settle_counted(both, "links")
        return out, counts | {"postings": seen["n"], "candidates": found["n"]}, rows


def first_wins(links: DataFrame, n: int) -> DataFrame:
    """The gids that are refused when records are taken by gid: those alike an indexed record or an earlier kept one.

    ``links`` (a, b, old) are n settled rows. Up to LINKS_AT_ONCE they are taken in
    order in one task. More are resolved in rounds: in each the nodes without an
    undecided earlier neighbour are kept and refuse their neighbours.
    """
    if n <= LINKS_AT_ONCE:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: set[int] = set()
            for batch in batches:
                for a, b, old in zip(*(c.to_pylist() for c in batch.columns)):
                    if old or b not in out:
                        out.add(a)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.int64())], names=["gid"])

        return links.select("a", "b", "old").coalesce(1).sortWithinPartitions("a", "b").mapInArrow(run, "gid long")
    refused = gone = settle(links.where("old").select(F.col("a").alias("gid")).distinct(), "refused")
    open_ = links.where("not old").select("a", "b")
    while True:
        rest = open_.join(refused.withColumnRenamed("gid", "a"), "a", "left_anti").join(refused.withColumnRenamed("gid", "b"), "b", "left_anti")
        open_, left = settle_counted(rest, "open")
        if not left["n"]:
            return gone
        free = open_.select("b").distinct().join(open_.select(F.col("a").alias("b")), "b", "left_anti")
        refused = settle(open_.join(free, "b", "left_semi").select(F.col("a").alias("gid")).distinct(), "refused")
        gone = gone.unionByName(refused)


def ingest(index: PrefixIndex, batch: DataFrame) -> dict[str, int]:
    """Take one batch of (key, toks, cmds): append what is accepted to the index. Gives counts of what was done.

    Records are taken by key. Rows with equal sets are one class led by its least
    key; the others are refused with it or because of it. Records without tokens
    are alike nothing: they are accepted and need no postings.
    """
    firsts, size = settle_counted(leaders(batch), "leaders")
    links, counts, rows = index.links(firsts, size["n"])
    refused, gone = settle_counted(first_wins(links, counts["n"]), "refused")
    small = F.broadcast(refused) if gone["n"] <= PROBE_ROWS else refused
    index.append(firsts.join(small, "gid", "left_anti"), size["n"] - gone["n"], rows.join(small, "gid", "left_anti"), counts["postings"])
    return counts | {"records": size["n"], "refused": gone["n"]}


def leaders(batch: DataFrame) -> DataFrame:
    """(gid, toks, cmds) of the classes with equal, non-empty token sets; gid is the least key."""
    hashes = dict(zip(("k1", "k2", "c1", "c2"), [*X.set_key(F.col("toks")), *X.set_key(F.col("cmds"))]))
    rows = batch.where(F.size("toks") > 0).withColumns(hashes).groupBy(*hashes)
    return rows.agg(F.min("key").alias("gid"), F.first("toks").alias("toks"), F.first("cmds").alias("cmds")).drop(*hashes)


def refused(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """Keys of the ingested rows (key, toks, cmds) that were refused, given the accepted leaders (gid)."""
    return rows.where(F.size("toks") > 0).select("key").join(accepted.select(F.col("gid").alias("key")), "key", "left_anti")
