import random

import pytest
from pyspark.sql import functions as F

from stepquarry.llm import components as G
from stepquarry.llm import incremental as I
from stepquarry.llm import neardup as N
from stepquarry.llm import overlap as O
from stepquarry.operators import setsim as S
from stepquarry.plans.runtime import settle

STEPS = "array<struct<name:string,type:string,class:string,label:string,command:string>>"


def similar(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def alike(a, b):
    j = similar(a[0], b[0])
    return j >= 0.7 or (j >= 0.5 and similar(a[1], b[1]) >= 0.8)


def records(n, seed):
    """Random records over a skewed vocabulary, many of them edited copies; some empty, some exact copies."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    out = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.5:
            words, cmds = (list(x) for x in r.choice(out))
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                if words and r.random() < 0.5:
                    words.pop(r.randrange(len(words)))
                else:
                    words.append(r.choice(vocab))
            if r.random() < 0.5 and cmds:
                cmds[r.randrange(len(cmds))] = f"c{r.randrange(50)}"
        elif kind < 0.55:
            words, cmds = [], [f"c{r.randrange(50)}"]
        else:
            words, cmds = r.choices(vocab, weights, k=r.randrange(1, 40)), [f"c{r.randrange(50)}" for _ in range(r.randrange(0, 12))]
        out.append((words, cmds))
    return out


def frame(spark, recs, start=0):
    rows = [(start + i, " ".join(w) if w else (None if i % 2 else ""), [("n", None, None, None, c) for c in cs] if cs else None, "clash", 1) for i, (w, cs) in enumerate(recs)]
    return spark.createDataFrame(rows, f"key long, statement string, steps {STEPS}, gid string, toks int")


def sets(spark, recs, start=0):
    return N.record_sets(frame(spark, recs, start), F.col("key"), F.col("statement"), F.col("steps"))


@pytest.mark.parametrize("seed", [1, 2])
def test_all_alike_pairs_and_no_others(spark, seed):
    recs = records(220, seed)
    got = [tuple(r) for r in N.alike_pairs(sets(spark, recs)).collect()]
    have = [(set(w), set(c)) for w, c in recs]
    want = {(i, j) for j in range(len(recs)) for i in range(j) if alike(have[i], have[j])}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_groups_agree_with_pairs(spark):
    recs = records(120, 3)
    pairs = [tuple(r) for r in N.alike_pairs(sets(spark, recs)).collect()]
    root = {i: i for i in range(len(recs))}
    for _ in recs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["key"]: r["group_id"] for r in N.alike_groups(sets(spark, recs)).collect()}
    assert got == root


def test_copies_are_one_class_not_all_pairs(spark):
    recs = [(["a", "b", "c"], ["x"])] * 300 + [(["d", "e"], [])]
    rows = N.alike_groups(sets(spark, recs)).collect()
    assert {(r["class_id"], r["links"]) for r in rows} == {(0, 0), (300, 0)} and len(rows) == 301


def test_nothing_in_nothing_out(spark):
    empty = sets(spark, [(["a"], [])]).limit(0)
    assert N.alike_pairs(empty).count() == 0 and N.alike_groups(empty).count() == 0
    bare = sets(spark, [([], ["c"]), ([], ["c"])])
    assert N.alike_pairs(bare).count() == 0 and N.alike_groups(bare).count() == 2


def test_very_long_texts(spark):
    words = [f"t{i}" for i in range(30_000)]
    recs = [(words, ["c"]), (words[:29_000], ["c"]), (words[:15_000], ["c"]), (["x"], [])]
    got = {tuple(r) for r in N.alike_pairs(sets(spark, recs)).collect()}
    assert got == {(0, 1), (0, 2), (1, 2)}


@pytest.mark.parametrize("weighting", ["unit", "idf"])
def test_cosine_join_against_brute_force(spark, weighting):
    import math

    left, right = records(80, 5), records(150, 6) + records(80, 5)[:20]
    rows = lambda recs: spark.createDataFrame([(i, " ".join(w)) for i, (w, _) in enumerate(recs)], "key long, text string")
    a, _ = O.classes_of(rows(left))
    b, _ = O.classes_of(rows(right))
    got = {(r["a"], r["b"]): r["dot"] for r in O.cosine_join(a, b, 0.8, weighting=weighting).collect()}
    x, y = ({r["gid"]: set(r["toks"]) for r in s.collect()} for s in (a, b))
    every = [*x.values(), *y.values()]
    squared = {t: 1.0 if weighting == "unit" else math.log(1 + len(every) / sum(t in v for v in every)) ** 2 for v in every for t in v}
    weight = lambda s: sum(squared[t] for t in s)
    want = {(i, j): weight(p & q) / (weight(p) * weight(q)) ** 0.5 for i, p in x.items() for j, q in y.items()}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert set(got) == set(want) and len(want) > 10 and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_greatest_weights_prune_lists(spark):
    import numpy as np

    sets = spark.createDataFrame([(1, list(range(20)))], "gid long, toks array<long>")
    vectors = O.unit_vectors(sets, S.token_order(sets, "toks"))
    most = O.greatest(vectors)
    assert np.isclose(most[:20], 20**-0.5).all() and most[20:].max() == 0
    # alone, the residual norm keeps as many as leave 0.8, for which 13 of 20 terms are needed; the greatest weights call for 16
    assert O.lists(vectors, most * 0 + 1, 0.8).count() == 20 - 13 + 1
    assert O.lists(vectors, most, 0.8).count() == 20 - 16 + 1
    assert O.lists(vectors, most * 0.7, 0.8).count() == 0


@pytest.mark.parametrize("weighting", ["unit", "idf"])
@pytest.mark.parametrize("wide", [128, 12])
def test_lists_that_are_cut_up_lose_no_pair(spark, monkeypatch, weighting, wide):
    left, right = records(80, 5), records(150, 6) + records(80, 5)[:20]
    rows = lambda recs: spark.createDataFrame([(i, " ".join(w)) for i, (w, _) in enumerate(recs)], "key long, text string")
    a, _ = O.classes_of(rows(left))
    b, _ = O.classes_of(rows(right))
    whole = {(r["a"], r["b"]) for r in O.cosine_join(a, b, 0.8, weighting=weighting).collect()}
    monkeypatch.setattr(O, "HOT", 4)
    monkeypatch.setattr(O, "WIDE", wide)
    assert {(r["a"], r["b"]) for r in O.cosine_join(a, b, 0.8, weighting=weighting).collect()} == whole and len(whole) > 10


def test_usual_words_do_not_make_all_vectors_meet(spark):
    """Texts of 5 rare words and many of 400 usual ones; a few are edited copies."""
    r = random.Random(3)
    rare, usual = [f"n{i}" for i in range(600)], [f"u{i}" for i in range(400)]
    text = lambda: r.sample(rare, 5) + r.sample(usual, r.randrange(40, 60))
    texts = [text() for _ in range(600)]
    left = [texts[i][3:] + r.sample(rare, 2) if i % 20 == 0 else text() for i in range(300)]
    rows = lambda recs: spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(recs)], "key long, text string")
    a, b = (O.classes_of(rows(t))[0] for t in (left, texts))
    want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(texts) if len(set(x) & set(y)) >= 0.85 * (len(x) * len(y)) ** 0.5}
    assert {(x["a"], x["b"]) for x in O.cosine_join(a, b, 0.85).collect()} == want and len(want) == 15
    order = S.token_order(a.unionByName(b), "toks")
    x, y = (O.unit_vectors(s, order) for s in (a, b))
    most, t = (O.greatest(x), O.greatest(y)), 0.85
    plain = O.lists(x, most[1], t).alias("p").join(O.lists(y, most[0], t).alias("q"), "sig").count()
    by = O.Usual(order, 900, 30)
    lead = O.leading(x, most[1], t, by, 300), O.leading(y, most[0], t, by, 600)
    p, q = O.lists(x, most[1], t, by, lead[1]), O.lists(y, most[0], t, by, lead[0])
    cut = p.alias("p").join(q.alias("q"), "sig").where(f"p.rest >= {t**0.5} OR q.rest >= {t**0.5}").count()
    assert plain > 50_000 and cut < plain / 3
    assert O.candidates(x, y, t, by, ((300, 0), (600, 0)), True).count() < 5 * len(want)


def refused_of(index, spark, recs, start):
    return {r["key"] for r in I.refused(sets(spark, recs, start), index.sets(since=1)).collect()}


def by_hand(recs, known):
    have = [(set(w), set(c)) for w, c in recs]
    kept, out = have[:known], set()
    for i in range(known, len(have)):
        if any(alike(have[i], h) for h in kept):
            out.add(i)
        else:
            kept.append(have[i])
    return out


@pytest.mark.parametrize("hot", [1_000, 3])
def test_batches_against_history(spark, monkeypatch, hot):
    monkeypatch.setattr(I, "HOT", hot)
    recs = records(150, 8)
    firsts, _ = N.classes_of(sets(spark, recs[:60], 1_000_000))
    index = I.PrefixIndex.over(firsts)
    for at in (60, 90, 120):
        I.ingest(index, sets(spark, recs[at : at + 30], at))
    got = refused_of(index, spark, recs[60:], 60)
    assert got == by_hand(recs, 60) and len(got) > 10


def test_an_index_opened_again_goes_on_where_it_was(spark, tmp_path):
    recs = records(120, 11)
    firsts, _ = N.classes_of(sets(spark, recs[:60], 1_000_000))
    path = f"file://{tmp_path}/index"
    I.ingest(I.PrefixIndex.over(firsts, path), sets(spark, recs[60:90], 60))
    other = spark.newSession()
    index = I.PrefixIndex.open(other, path)
    I.ingest(index, sets(other, recs[90:], 90))
    assert {r["key"] for r in I.refused(sets(other, recs[60:], 60), index.sets(since=1)).collect()} == by_hand(recs, 60)
    with pytest.raises(FileNotFoundError):
        I.PrefixIndex.open(spark, f"file://{tmp_path}/nothing")


def test_an_append_that_fails_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    recs = records(90, 12)
    firsts, _ = N.classes_of(sets(spark, recs[:60], 1_000_000))
    path = f"file://{tmp_path}/index"
    index = I.PrefixIndex.over(firsts, path)
    before = index.sets().count()

    def broken(*_):
        raise OSError

    with monkeypatch.context() as m:
        m.setattr(I.Store, "commit", broken)
        with pytest.raises(OSError):
            I.ingest(index, sets(spark, recs[60:], 60))
    again = I.PrefixIndex.open(spark, path)
    assert again.sets().count() == before
    I.ingest(again, sets(spark, recs[60:], 60))
    assert refused_of(again, spark, recs[60:], 60) == by_hand(recs, 60)
    with pytest.raises(RuntimeError):  # the first one's manifest is out of date now
        I.ingest(index, sets(spark, recs[:1], 500))


def test_segments_are_merged_and_parts_pruned(spark, monkeypatch):
    monkeypatch.setattr(I, "MERGE", 2)
    monkeypatch.setattr(I, "PART_ROWS", 8)
    recs = records(100, 9)
    firsts, _ = N.classes_of(sets(spark, recs[:50], 1_000_000))
    index = I.PrefixIndex.over(firsts)
    for at in range(50, 100, 10):
        I.ingest(index, sets(spark, recs[at : at + 10], at))
    assert len(index.manifest.segments) < 6 and index.manifest.appends == 6
    assert refused_of(index, spark, recs[50:], 50) == by_hand(recs, 50)
    index.vacuum()
    assert refused_of(index, spark, recs[50:], 50) == by_hand(recs, 50)
    rows = index._read("postings", index.manifest.segments)
    keys = [r["sig"] for r in rows.select("sig").limit(2).collect()]
    bits = spark.createDataFrame([(k,) for k in keys], "sig long").agg(I.low_bits("sig").alias("b")).first()["b"]
    near = index._read("postings", index.manifest.segments, bits)
    assert {r["sig"] for r in near.select("sig").collect()} >= set(keys) and near.count() < rows.count()


def test_parts():
    assert [I.parts_for(n) for n in (0, 1, I.PART_ROWS, I.PART_ROWS + 1, 5 * I.PART_ROWS, 10**12)] == [1, 1, 1, 2, 8, I.MOST_PARTS]
    bits = bytearray(4096)
    for k in (0, 5, 9, 32_767):
        bits[k // 8] |= 1 << k % 8
    assert I.hit(bits, 4) == [0, 1, 3] and I.hit(bits, 1) == [0] and I.hit(bytes(4096), 8) == [] and I.hit(None, 8) == []


@pytest.mark.parametrize("probes, links", [(10, 1_000), (1_000_000, 0)])
def test_batch_too_large_to_broadcast_or_for_one_task(spark, monkeypatch, probes, links):
    recs = records(100, 9)
    monkeypatch.setattr(I, "PROBE_ROWS", probes)
    monkeypatch.setattr(I, "LINKS_AT_ONCE", links)
    firsts, _ = N.classes_of(sets(spark, recs[:50], 1_000_000))
    index = I.PrefixIndex.over(firsts)
    I.ingest(index, sets(spark, recs[50:], 50))
    assert refused_of(index, spark, recs[50:], 50) == by_hand(recs, 50)


def test_empty_batch_and_empty_history(spark):
    empty, _ = N.classes_of(sets(spark, [(["a"], [])]).limit(0))
    index = I.PrefixIndex.over(empty)
    I.ingest(index, sets(spark, [(["a"], [])]).limit(0))
    assert index.sets(since=1).count() == 0
    rows = sets(spark, [(["a", "b"], []), (["b", "a"], []), ([], ["c"])], 5)
    assert I.ingest(index, rows)["records"] == 1
    assert [r["gid"] for r in index.sets(since=1).collect()] == [5]
    assert [r["key"] for r in I.refused(rows, index.sets(since=1)).collect()] == [6]
    assert I.ingest(index, sets(spark, [(["a", "b"], [])], 9))["refused"] == 1


@pytest.mark.parametrize("at_once", [0, 1_000])
def test_first_wins_on_chains(spark, monkeypatch, at_once):
    monkeypatch.setattr(I, "LINKS_AT_ONCE", at_once)
    r = random.Random(4)
    pairs = {(i, i + 1) for i in range(30)} | {tuple(sorted(r.sample(range(60), 2))) for _ in range(40)}
    old = {3, 17, 44}
    out = set()
    for i in range(60):
        if i in old or any(a not in out and b == i for a, b in pairs):
            out.add(i)
    links = spark.createDataFrame([(b, a, False) for a, b in sorted(pairs)] + [(i, 1000 + i, True) for i in old], "a long, b long, old boolean")
    got = I.first_wins(settle(links, "t"), len(pairs) + 3)
    assert {x["gid"] for x in got.collect()} == out


def test_a_hot_construction_costs_what_its_rows_do(spark):
    """A fifth of all rows share one construction under different texts; those that are alike are found."""
    r = random.Random(7)
    vocab = [f"v{i}" for i in range(3000)]
    recs = [(r.sample(vocab, 20), ["p", "q", "s"] if i % 5 == 0 else [f"c{i}", f"d{i}"]) for i in range(1500)]
    for i in range(0, 200, 10):  # edited copies of the text, within the construction: 15 of 20 words
        recs.append((recs[i][0][:14] + r.sample(vocab, 6), ["p", "q", "s"]) if i % 5 == 0 else recs[i])
    firsts, members = N.classes_of(sets(spark, recs))
    steps = settle(S.prefixes(firsts, S.token_order(firsts, "cmds"), N.STEPS, of="cmds"), "s")
    groups, held = N.grouped(steps)
    assert held.count() >= 300
    have = [(set(w), set(c)) for w, c in recs]
    want = {(i, j) for j in range(len(recs)) for i in range(max(0, j - len(recs)), j) if len(have[i][0] & have[j][0]) > 8 and alike(have[i], have[j])}
    assert {tuple(x) for x in N.alike_pairs(sets(spark, recs)).collect()} == want and len(want) >= 15
    half = S.postings(S.prefixes(firsts, S.token_order(firsts, "toks"), N.LOOSE)).select("gid", "sig").join(held, "gid")
    met = half.groupBy("group", "sig").count().selectExpr("sum(count * (count - 1) / 2) AS n").first()["n"]
    assert met < 0.2 * 300 * 299 / 2


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(300):
        for a, b in edges:
            if a is not None and a != b:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long")
    assert {x["node"]: x["root"] for x in G.components(df).collect()} == root
    assert G.components(df.limit(0)).count() == 0
