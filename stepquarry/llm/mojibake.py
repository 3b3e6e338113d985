"""Garbled text from wrong character encoding: find it, restore it.

1. *Twins.* Texts are cut into sentences; names, numbers and capitals are masked.
   Sentences that are equal once their non-ASCII characters are stripped are near
   twins. Where one form is far rarer than the commonest form of its key, the two
   are aligned: ASCII characters are the anchors, and the stretches between them
   pair up. Sentences are cut and masked once and written; only their 64-bit hashes
   and counts are shuffled, and the texts of just those forms that have a twin are
   read again. Forms are compared by rows and by different texts, as copies may hide
   the rarer form or be the commoner.
2. *Transformations.* For each aligned pair the chains "written in one encoding,
   read in another", once or twice over, are tried; a chain that explains enough
   different pairs is learned. At most a few hundred chains exist. Where bytes were
   lost (U+FFFD) no chain explains a pair: there the word around it is learned with
   what stands in its place, if all its twins agree.
3. *Application.* Every non-ASCII stretch of every text is undone by each learned
   chain. It is garbled if the outcome is made of character pairs that are much
   more common in the corpus than those it had. The pair counts cover all different
   texts, so copies add nothing, and live in ``2**BITS`` counters, so they may be broadcast.

U+FFFD stands for bytes that could not be read: it is a case that no chain can
restore, but a learned word may. Correct text in rare letters is no case, as no chain turns it
into commoner text. Null and empty texts are no cases.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepquarry.plans.runtime import settle, small_side

BITS = 20
#: Encodings that texts are written in, and that they are wrongly read in.
WRITTEN = ("utf-8", "cp1252", "mac-roman", "cp437", "cp850", "cp1250", "iso8859-2", "cp852", "cp1251", "koi8-r", "cp866", "iso8859-5", "cp1253", "iso8859-7", "gb18030", "big5", "shift_jis")
READ = ("latin-1", "cp1252", "mac-roman", "cp437", "cp850", "cp1250", "iso8859-2", "cp852", "cp1251", "koi8-r", "cp866", "cp1253", "cp1254", "gb18030", "big5", "shift_jis")
_WIDE = {"gb18030", "big5", "shift_jis", "utf-8"}
#: By how much, in logarithms, undoing must raise the mean count of a stretch's character pairs. Valid UTF-8 behind
#: single bytes is hardly chance, so nothing need be gained; behind double bytes, or from one single-byte encoding to
#: another, the gain is the evidence, and a lesser one counts only beside a sure one of the same chain in the text.
GAIN_UTF8, GAIN_WIDE, GAIN_SWAP, GAIN_BESIDE = 0.0, math.log(5.0), math.log(20.0), math.log(5.0)
#: A rarer twin must be this many times rarer.
RARER = 4
#: Different aligned pairs that a chain must explain.
SUPPORT = 3
SELECTED_ROWS = 1_000_000
#: Most learned words that are sent to all tasks; more are joined to the texts that lack them.
WORDS = 50_000
LOST = "\ufffd"
STRETCH = re.compile(r"[^\x00-\x7f]+")

Chain = tuple[tuple[str, str], ...]


@lru_cache(maxsize=64)
def _single(codec: str) -> tuple[dict[int, str], dict[str, int]]:
    """Byte to character and back; bytes without a character stand for the control of that number, as browsers have it."""
    to = {}
    for b in range(256):
        try:
            to[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            to[b] = chr(b)
    return to, {c: b for b, c in to.items()}


def write(text: str, codec: str) -> bytes | None:
    if codec in _WIDE:
        try:
            return text.encode(codec)
        except UnicodeEncodeError:
            return None
    back = _single(codec)[1]
    try:
        return bytes([back[c] for c in text])
    except KeyError:
        return None


def read(data: bytes, codec: str) -> str | None:
    if codec in _WIDE:
        try:
            return data.decode(codec)
        except UnicodeDecodeError:
            return None
    to = _single(codec)[0]
    return "".join([to[b] for b in data])


def steps() -> list[tuple[str, str]]:
    """(written, read) pairs that garble: one side at least is UTF-8, or both are single-byte encodings."""
    return [(w, r) for w in WRITTEN for r in READ if w != r and (w == "utf-8" or not ({w, r} & _WIDE) and (w, r) != ("cp1252", "latin-1"))]


def garble(text: str, chain: Chain) -> str | None:
    for w, r in chain:
        data = write(text, w)
        text = data if data is None else read(data, r)
        if text is None:
            return None
    return text


def undo(text: str, chain: Chain) -> str | None:
    for w, r in reversed(chain):
        data = write(text, r)
        text = data if data is None else read(data, w)
        if text is None:
            return None
    return text


def explaining(found: str, meant: str) -> list[Chain]:
    """The chains of one or two steps that turn ``meant`` into ``found``; two only where one doesn't do."""
    out = []
    middle = []
    for s in steps():
        g = garble(meant, (s,))
        if g == found:
            out.append((s,))
        elif g is not None and s[0] == "utf-8" and g != meant:
            middle.append((s, g))
    if not out:
        out = [(a, b) for a, g in middle for b in steps() if b[0] == "utf-8" and garble(g, (b,)) == found]
    return out


def aligned(found: str, meant: str) -> list[tuple[str, str]]:
    """Differing non-ASCII stretches of two texts between the same ASCII anchors; none if the anchors differ."""
    a, b = STRETCH.split(found), STRETCH.split(meant)
    if a != b:
        return []
    return [(x, y) for x, y in zip(STRETCH.findall(found), STRETCH.findall(meant)) if x != y]


_MASK = {chr(i): "A" if 65 <= i <= 90 else "0" if 48 <= i <= 57 else " " for i in (*range(33), *range(48, 58), *range(65, 91))}


def _masked(c: str) -> str:
    return _MASK.get(c, c)


_BEFORE, _AFTER = re.compile(r"[A-Za-z]*\Z"), re.compile(r"[A-Za-z]*")


def around(text: str, i: int, j: int) -> tuple[str, str]:
    """The ASCII letters next to a stretch."""
    return _BEFORE.search(text, max(0, i - 30), i)[0], _AFTER.match(text, j)[0]


def pair_slots(before: str, stretch: str, after: str) -> list[int]:
    """Counters of the character pairs of a stretch and its two neighbours."""
    s = "".join(map(_masked, before + stretch + after))
    return [xxhash.xxh64_intdigest(s[i : i + 2]) & ((1 << BITS) - 1) for i in range(len(s) - 1)]


def stretches(text: str) -> Iterator[tuple[int, int, str, str]]:
    for m in STRETCH.finditer(text):
        i, j = m.span()
        yield i, j, text[i - 1 : i] or " ", text[j : j + 1] or " "


def pair_counts(docs: DataFrame) -> np.ndarray:
    """In how many different texts (of the rows' column ``text``) each character pair occurs, by counter.

    Texts meet as 64-bit hashes beside their counters, so no text is shuffled; of
    one that many rows share each task gives only one row.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            keys, found = [], []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text and not text.isascii() and h not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known.add(h)
                    seen = {(a, text[i:j], b) for i, j, a, b in stretches(text)}
                    keys.append(h)
                    found.append(np.array(list({k for x in seen for k in pair_slots(*x)}), np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.binary())], names=["h", "slots"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total[np.frombuffer(x, np.int32)] += 1  # a text has each counter once
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["k", "n"])

    texts = docs.select(F.xxhash64("text").alias("h"), "text").mapInArrow(slots, "h long, slots binary").groupBy("h").agg(F.first("slots").alias("slots"))
    rows = texts.select("slots").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BITS, np.float32)
    counts[rows["k"].to_numpy()] = rows["n"].to_numpy()
    return counts


def sentences(docs: DataFrame) -> DataFrame:
    """Settled (key, form, sentence, h): masked sentences with non-ASCII characters; key, form and h are hashes of the stripped and the whole sentence and of the row's text.

    With fewer than three ASCII characters there are no anchors, and so no twins.
    """
    cut = docs.where(F.col("text").rlike(r"[^\x00-\x7F]")).select(F.xxhash64("text").alias("h"), F.explode(F.split("text", r"(?<=[.!?:;])[ \t]+|[\r\n]+")).alias("s")).where(F.col("s").rlike(r"[^\x00-\x7F]"))
    masked = F.regexp_replace(F.regexp_replace(F.trim("s"), r"[A-Z][A-Za-z0-9]*", "A"), r"[0-9]+([./][0-9]+)?", "0")
    cut = cut.select("h", masked.alias("sentence"))
    bare = F.regexp_replace("sentence", r"[^\x00-\x7F]+", "")
    return settle(cut.select(F.xxhash64(bare).alias("key"), F.xxhash64("sentence").alias("form"), "sentence", "h", F.length(bare).alias("n")).where("n >= 3").drop("n"), "sentences")


def twins(docs: DataFrame) -> DataFrame:
    """Distinct (found, meant) sentences with one key, of which the first is far rarer, in rows or in different texts.

    By texts, copies of a garbled one don't pass for the usual form; by rows, copies
    of a clean one still show which form is usual.
    """
    cut = sentences(docs)
    counts = cut.groupBy("key", "form", "h").agg(F.count("*").alias("c")).groupBy("key", "form").agg(F.sum("c").alias("c"), F.count("*").alias("t"))
    counts = settle(counts, "forms")
    tops = [F.max(F.struct(n, "form")).alias(f"top_{n}") for n in ("c", "t")]
    both = counts.join(counts.groupBy("key").agg(*tops, F.count("*").alias("forms")).where("forms > 1"), "key")
    rare = [both.where(F.col(n) * RARER <= F.col(f"top_{n}.{n}")).select("key", "form", F.col(f"top_{n}.form").alias("meant")) for n in ("c", "t")]
    rare = settle(rare[0].unionByName(rare[1]).distinct(), "rare")
    wanted = settle(rare.select("key", "form").unionByName(rare.select("key", F.col("meant").alias("form"))).distinct(), "wanted")
    texts = cut.join(small_side(wanted, SELECTED_ROWS), ["key", "form"]).groupBy("key", "form").agg(F.first("sentence").alias("sentence"))
    texts = settle(texts, "twins")
    pairs = rare.join(texts, ["key", "form"]).withColumnRenamed("sentence", "found").drop("form")
    return pairs.join(texts.withColumnRenamed("form", "meant").withColumnRenamed("sentence", "clean"), ["key", "meant"]).select("found", F.col("clean").alias("meant"))


def learned(pairs: DataFrame) -> tuple[list[Chain], DataFrame]:
    """The chains that explain SUPPORT different aligned pairs or more, best first; and settled (before, f, after, m): letters before, stretch, letters after and what is meant, where bytes were lost."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for f, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if STRETCH.split(f) == STRETCH.split(m):
                    for x, y in zip(STRETCH.finditer(f), STRETCH.findall(m)):
                        if x[0] != y:
                            seen.add((x[0], y, *(around(f, *x.span()) if LOST in x[0] else ("", ""))))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in seen], pa.string()) for i in range(4)], names=["f", "m", "before", "after"])

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for f, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update("|".join(f"{w}>{r}" for w, r in c) for c in explaining(f, m))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["chain", "n"])

    found = settle(pairs.mapInArrow(runs, "f string, m string, before string, after string"), "aligned")
    lost = F.col("f").contains(LOST)
    rows = found.where(~lost).select("f", "m").distinct().mapInArrow(chains, "chain string, n long")
    rows = rows.groupBy("chain").agg(F.sum("n").alias("n")).where(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "chain").collect()
    words = found.where(lost & (F.length("before") + F.length("after") >= 2)).groupBy("before", "f", "after").agg(F.min("m").alias("m"), F.max("m").alias("other"))
    words = settle(words.where(F.col("m") == F.col("other")).drop("other"), "words")
    return [tuple(tuple(s.split(">")) for s in r["chain"].split("|")) for r in rows], words


def words_of_texts(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(h, words) of the different texts (column ``text``) that have learned words; h is the text's hash."""

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {(h, *around(text, *m.span()), m[0]) for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in STRETCH.finditer(text) if LOST in m[0]}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int64(), pa.string(), pa.string(), pa.string()))], names=["h", "before", "after", "f"])

    lacking = rows.where(F.col("text").contains(LOST)).select(F.xxhash64("text").alias("h"), "text")
    each = lacking.mapInArrow(gaps, "h long, before string, after string, f string").distinct().join(words, ["before", "f", "after"])
    return each.groupBy("h").agg(F.collect_list(F.struct("before", "f", "after", "m")).alias("words"))


class Mender:
    """Undoes learned chains where that makes the text much more usual, and puts learned words in for what was lost."""

    def __init__(self, chains: list[Chain], counts: np.ndarray, words: dict[tuple[str, str, str], str] | None = None):
        self.chains, self.counts, self.words, self.known = chains, counts, words or {}, {}

    def score(self, before: str, stretch: str, after: str) -> tuple[float, float]:
        """Mean logarithm of the counts of the character pairs: of all, and of the two at the ends.

        Within a character's garbled bytes the pairs say nothing, as one always draws
        the next after it; at the ends they show what usually stands there.
        """
        logs = [math.log1p(self.counts[k]) for k in pair_slots(before, stretch, after)]
        return sum(logs) / len(logs), (logs[0] + logs[-1]) / 2

    def verdict(self, before: str, stretch: str, after: str) -> tuple[str, bool, Chain] | None:
        """(restored, whether that is sure, chain) of a stretch that a chain makes more usual, else none."""
        key = (_masked(before), stretch, after)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = self._verdict(before, stretch, after)
        return self.known[key]

    def _undone(self, stretch: str) -> Iterator[tuple[str, Chain, float]]:
        """What the chains make of a stretch, and the gain that each calls for; UTF-8 steps also once again."""
        for chain in self.chains:
            got = undo(stretch, chain)
            if not got or got == stretch:
                continue
            utf8 = chain[0][0] == "utf-8"
            if not utf8 and stretch.isspace():  # white space alone is usual in any text
                continue
            yield got, chain, GAIN_SWAP if not utf8 else GAIN_WIDE if chain[-1][1] in _WIDE else GAIN_UTF8
            if utf8 and len(chain) == 1 and not got.isascii():
                for first in self.chains:
                    if first[0][0] == "utf-8" and len(first) == 1:
                        again = undo(got, first)
                        if again and again != got:
                            yield again, first + chain, GAIN_UTF8 if chain[0][1] not in _WIDE else GAIN_WIDE

    def _verdict(self, before: str, stretch: str, after: str) -> tuple[str, bool, Chain] | None:
        was, best = self.score(before, stretch, after), None
        for got, chain, least in self._undone(stretch):
            now = self.score(before, got, after)
            gain = now[0] - was[0]
            if least == GAIN_UTF8:
                gain = max(gain, now[1] - was[1])
            if gain >= min(least, GAIN_BESIDE) and (best is None or gain > best[0]):
                best = (gain, got, gain >= least, chain)
        return best and best[1:]

    def mend(self, text: str | None) -> tuple[bool, str | None, int, int]:
        """(garbled, text as far as it can be restored, stretches restored, stretches that can't be)."""
        if not text or text.isascii():
            return False, text, 0, 0
        found, any_ = [], LOST in text
        for m in STRETCH.finditer(text):
            i, j = m.span()
            v = self.verdict(text[i - 1 : i] or " ", m[0], text[j : j + 1] or " ")
            found.append((i, j, v))
            any_ = any_ or v is not None
        if not any_:
            return False, text, 0, 0
        sure = sorted({v[2] for _, _, v in found if v and v[1]})
        beside = [c for c in sure if c[0][0] == "utf-8" and c[-1][1] not in _WIDE]
        out, at, good, bad = [], 0, 0, 0
        for i, j, v in found:
            stretch = text[i:j]
            if not v:  # beside a sure case of valid UTF-8 the same chain needs no proof of its own
                v = next(((got, True, c) for c in beside if (got := undo(stretch, c)) and got != stretch), None)
            if v and (v[1] or v[2] in sure):
                out += [text[at:i], v[0]]
                at, good = j, good + 1
            elif LOST in stretch:
                before, after = around(text, i, j)
                word = self.words.get((before, stretch, after))
                if word is None:
                    bad += 1
                else:
                    out += [text[at:i], word]
                    at, good = j, good + 1
        out.append(text[at:])
        return good + bad > 0, "".join(out), good, bad


def mended(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, garbled, restored, stretches_restored, stretches_lost) of every row; restored is the text itself where nothing was undone."""
    rows = docs.select(key, F.col(text).alias("text"))
    counts = pair_counts(rows)
    chains, words = learned(twins(rows))
    few = words.limit(WORDS + 1).count() <= WORDS
    known = {(r["before"], r["f"], r["after"]): r["m"] for r in words.collect()} if few else {}
    shared = docs.sparkSession.sparkContext.broadcast((chains, counts, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mender = Mender(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for i, t in enumerate(part.column(1).to_pylist()):
                    if part.num_columns > 2:  # the text's own words
                        mender.words = {(w["before"], w["f"], w["after"]): w["m"] for w in part.column(2)[i].as_py() or ()}
                    out.append(mender.mend(t))
                kinds = (pa.bool_(), pa.string(), pa.int64(), pa.int64())
                columns = [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[key, "garbled", "restored", "stretches_restored", "stretches_lost"])

    schema = f"{key} {rows.schema[key].dataType.simpleString()}, garbled boolean, restored string, stretches_restored long, stretches_lost long"
    if few:
        return rows.mapInArrow(run, schema)
    lacks = F.coalesce(F.col("text").contains(LOST), F.lit(False))
    own = rows.where(lacks).withColumn("h", F.xxhash64("text")).join(words_of_texts(rows, words), "h", "left").select(key, "text", "words")
    return rows.where(~lacks).mapInArrow(run, schema).unionByName(own.mapInArrow(run, schema))
