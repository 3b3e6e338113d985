import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepquarry.llm import mojibake as M
from stepquarry.llm import packing as P
from stepquarry.llm import splits as S
from stepquarry.llm import tokenizer as T
from stepquarry.plans.runtime import settle

MESSAGES = "array<struct<role:string,content:string>>"


def train(spark, rows):
    return spark.createDataFrame([(e, s, i, m, "clash") for e, s, i, m in rows], f"ex_id long, source string, id long, messages {MESSAGES}, ka string")


def answer(*commands):
    return json.dumps({"construction_steps": [{"command": c} for c in commands]})


def test_construction_in_text():
    good = answer("A B", "C")
    assert S.construction_in("see {x}: ```json\n" + good + "\n``` {") == ["AB", "C"]
    assert S.construction_in(good[:-1]) is None and S.construction_in('{"construction_steps": []}') is None
    assert S.construction_in(None) is None and S.construction_in("") is None and S.construction_in("[1]") is None
    assert S.construction_in('{"construction_steps": [null, {"command": null}, {"command": "x y"}]}') == ["xy"]
    assert S.construction_in('{"a":' * 5000) is None


def test_groups_close_over_both_keys(spark):
    rows = [
        (5, "g", 1, [("assistant", answer("A"))]), (3, "g", 1, None), (9, "n", 7, [("Assistant", answer(" A "))]), (8, "n", 7, []),
        (1, None, 1, [("assistant", answer("B"))]), (2, "g", None, [("assistant", "x " + answer("B") + " y")]), (4, None, None, None), (6, "g", 2, [("user", answer("A")), (None, None)]),
    ]
    got = {r["ex_id"]: (r["group_id"], r["group_size"]) for r in S.groups(S.keyed(train(spark, rows))).collect()}
    assert got == {5: (3, 4), 3: (3, 4), 9: (3, 4), 8: (3, 4), 1: (1, 2), 2: (1, 2), 4: (4, 1), 6: (6, 1)}
    assert S.groups(S.keyed(train(spark, rows).limit(0))).count() == 0


def plan(spark):
    return spark.createDataFrame([("train", 0.8), ("validation", 0.08), ("test", 0.12)], "split string, fraction double")


@pytest.mark.parametrize("giant", [0, 900])
def test_splits_keep_groups_and_shares(spark, giant):
    r = random.Random(0)
    rows, e = [], 0
    for g in range(400):
        for _ in range(giant if g == 0 else r.choice([1, 1, 1, 2, 3, 5, 9])):
            rows.append((e, r.choice(["a", "a", "b", None]) if g else "a", g, 0))
            e += 1
    grouped = spark.createDataFrame(rows, "ex_id long, source string, group_id long, group_size long")
    got = S.assign(grouped, plan(spark)).collect()
    assert len(got) == len(rows) and len({x["ex_id"] for x in got}) == len(rows)
    splits = {}
    for x in got:
        splits.setdefault(x["group_id"], set()).add(x["split"])
    assert all(len(s) == 1 for s in splits.values())
    for name, share in (("train", 0.8), ("validation", 0.08), ("test", 0.12)):
        assert abs(sum(x["split"] == name for x in got) / len(rows) - share) < 0.005
    source = {x[0]: x[1] for x in rows}
    for label in ("a", "b", None):
        mine = [x["split"] for x in got if source[x["ex_id"]] == label]
        # a giant without a label leaves less room in its split for the rows that have it
        assert abs(mine.count("test") / len(mine) - 0.12) < (0.12 if giant else 0.03)
    assert {(x["ex_id"], x["split"]) for x in got} == {(x["ex_id"], x["split"]) for x in S.assign(grouped.repartition(5), plan(spark)).collect()}
    assert S.assign(grouped.limit(0), plan(spark)).count() == 0 and S.assign(grouped, plan(spark).limit(0)).count() == 0


def test_large_groups_of_unequal_size_are_placed_by_their_own_size(spark):
    sizes = [1030, 1150, 1270, 1390, 1510]  # all of two leading bits alike
    rows = [(g * 10_000 + i, "a", g, n) for g, n in enumerate(sizes) for i in range(n)]
    grouped = spark.createDataFrame(rows, "ex_id long, source string, group_id long, group_size long")
    shares = spark.createDataFrame([(f"s{n}", n / sum(sizes)) for n in sizes], "split string, fraction double")
    got = {x["split"]: x["count"] for x in S.assign(grouped, shares).groupBy("split").count().collect()}
    assert got == {f"s{n}": n for n in sizes}


def test_rare_sources_are_spread_over_the_splits(spark):
    rows = [(e, f"s{e % 9}", e, 1) for e in range(9 * 300)]
    rows += [(10_000 + 100 * k + i, f"t{k}", 10_000 + 100 * k + i, 1) for k in range(6) for i in range(50)]
    grouped = spark.createDataFrame(rows, "ex_id long, source string, group_id long, group_size long")
    source = {x[0]: x[1] for x in rows}
    got = [(source[x["ex_id"]], x["split"]) for x in S.assign(grouped, plan(spark)).collect()]
    assert len(got) == len(rows)
    for label in set(source.values()):
        mine = [s for n, s in got if n == label]
        for name, share in (("train", 0.8), ("validation", 0.08), ("test", 0.12)):
            assert abs(mine.count(name) - share * len(mine)) <= 1


def test_equal_components_are_shared_out_as_one_by_one():
    r = random.Random(6)
    for _ in range(300):
        need, room = [r.choice([r.uniform(-20, 300), 40.0]) for _ in range(r.randrange(1, 5))], [r.uniform(0, 300) for _ in range(4)]
        step, n, left = r.randrange(1, 9), r.randrange(0, 90), None
        left, want = list(need), [0] * len(need)
        for _ in range(n):
            s = max(range(len(need)), key=lambda s: (round(left[s], 6), room[s], -s))
            left[s] -= step
            want[s] += 1
        got = S.shared_out(need, room, step, n)
        assert sum(got) == n and max(abs(x - y) for x, y in zip(got, want)) <= 1
        # the needs that are left are the same, whichever of two equal splits came first
        assert all(abs(x - y) < 1e-6 for x, y in zip(sorted(a - g * step for a, g in zip(need, got)), sorted(left)))


def test_bulk_placement_keeps_shares():
    kinds = [(0, {0: 1}, 5_000), (1, {1: 3}, 3_000), (2, {0: 7, 1: 3}, 1)]
    placed = S.stratify(kinds, [0.8, 0.08, 0.12])
    assert [sum(p) for p in placed] == [5_000, 3_000, 1]
    for i, share in enumerate([0.8, 0.08, 0.12]):
        assert abs(sum(placed[0][i:i + 1]) + 7 * placed[2][i] - share * 5_007) <= 1 and abs(3 * placed[1][i] + 3 * placed[2][i] - share * 9_003) <= 3
    assert S.stratify([], [1.0]) == []
    many = S.stratify([(k, {k % 40: 1 + k % 7, 40 + k % 3: 2}, 1 + k % 5) for k in range(50_000)], [0.8, 0.08, 0.12])
    assert len(many) == 50_000


@pytest.fixture(scope="module")
def bpe():
    return T.ByteBPE.load(f"{T.FOLDER}/{T.BYTE_BPE_50K}")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{T.FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def ids_of(bpe, texts):
    return [bpe.ids(x) for x in bpe.encode_batch(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_ids_are_those_of_the_library(bpe, library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids_of(bpe, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_awkward_texts(bpe, library):
    texts = ["", " ", "\n\n \t x", "<|endoftext|> <unk></s>", "'S 'LL they'll I'd'm", "=" * 5000, "的" * 3000, "aĞ‍👩‍🔬ﬁ", "\x07\x1b\x00", "  leading", "trailing   ", "a b　c", "x" * 20_000, "12345678901234567890"]
    assert ids_of(bpe, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(bpe, [None, ""]) == [[], []]


def test_words_that_share_prefixes(bpe):
    words = [b"construct", b"construction", b"constructions", b"con", b"c", b"", b"cat"]
    assert bpe.encode_words(words) == {w: bpe.merged(w) for w in words}


def test_encoded_rows(spark, library):
    docs = spark.createDataFrame([(1, "Hello world", [0]), (2, None, None), (3, "", None), (1, "Hello world", None)], "doc_id long, text string, ids array<int>")
    got = sorted((r["doc_id"], r["ids"]) for r in T.encoded(docs, "doc_id", "text").collect())
    hello = library.encode("Hello world", add_special_tokens=False).ids
    assert got == [(1, hello), (1, hello), (2, []), (3, [])]
    assert sorted((r["doc_id"], r["n"]) for r in T.sizes(docs, "doc_id", "text").collect()) == [(1, 2), (1, 2), (2, 0), (3, 0)]
    assert T.encoded(docs.limit(0), "doc_id", "text").count() == 0


def test_fullest_combination_is_best():
    import itertools

    r = random.Random(2)
    for _ in range(60):
        capacity = r.randrange(5, 40)
        left = {r.randrange(1, capacity + 1): r.randrange(1, 4) for _ in range(r.randrange(1, 5))}
        combo = P.fullest(capacity, left)
        assert max(left) in combo and all(combo[k] <= left[k] for k in combo)
        best = max(s for s in (sum(k * n for k, n in zip(left, c)) for c in itertools.product(*[range(v + 1) for v in left.values()]) if c[list(left).index(max(left))] >= 1) if s <= capacity)
        assert sum(k * n for k, n in combo.items()) == best


def limits(spark, *rows):
    return spark.createDataFrame(list(rows), "profile string, capacity long")


def test_packing_places_every_token_once(spark):
    r = random.Random(3)
    sizes = [0, 0, 10, 100, 250, 99, 1] + [r.randrange(1, 60) for _ in range(400)] + [37] * 300
    items = settle(spark.createDataFrame(list(enumerate(sizes)), "key long, n long"), "items")
    rows = P.packed(items, limits(spark, ("s", 50), ("l", 100), ("none", 0), (None, None))).collect()
    for profile, capacity in (("s", 50), ("l", 100)):
        mine = [x for x in rows if x["profile"] == profile]
        assert {x["key"] for x in mine} == set(range(len(sizes)))
        bins = {}
        for k, n in enumerate(sizes):
            parts = sorted((x["piece"], x["start_token"], x["n_tokens"]) for x in mine if x["key"] == k)
            assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[2] for p in parts) == n
            assert len(parts) == 1 if n <= capacity else all(p[2] == capacity for p in parts[:-1])
            assert all(p[1] == p[0] * capacity for p in parts)
        for x in mine:
            if x["n_tokens"]:
                bins[x["container"]] = bins.get(x["container"], 0) + x["n_tokens"]
            else:
                assert x["container"] is None
        alone = sum(n // capacity + (n % capacity > capacity / 2) for n in sizes)  # no two of these share a container
        assert max(bins.values()) <= capacity and len(bins) <= 1.1 * max(-(-sum(sizes) // capacity), alone)
    assert {x["profile"] for x in rows} == {"s", "l"}
    (row,) = [x for x in P.fill(P.packed(items, limits(spark, ("l", 100))), limits(spark, ("l", 100))).collect()]
    assert row["tokens"] == sum(sizes) and row["free"] == row["containers"] * 100 - sum(sizes)


def test_packing_of_nothing(spark):
    none = settle(spark.createDataFrame([], "key long, n long"), "items")
    assert P.packed(none, limits(spark, ("s", 50))).count() == 0
    some = settle(spark.createDataFrame([(1, 5)], "key long, n long"), "items")
    assert P.packed(some, limits(spark)).count() == 0


TEXTS = {
    "fr": "La médiatrice du côté {0} coupe la droite {1} à l’extérieur. Voilà la vraie difficulté, très nettement.",
    "de": "Die Größe {0} hängt nur vom Umkreisradius {1} ab. Übrigens müssen wir die überflüssigen Hilfslinien löschen.",
    "ru": "Окружность через точки {0} и {1} имеет радиус. Отсюда следует, что площадь равна.",
    "en": "A naïve reading puts {0} outside △{1}. It’s clear – the façade isn’t.",
}
DECOYS = ["Þórðr Æ ðæt þing", "ﬁgure ﬀ ① Ⅷ 26²³", "שלום", "Šířka žlábku je úhlů", "├── A ── B ──┤", "🙂👩‍🔬", "Ğ, Ş, İ and ı"]
CHAINS = [(("utf-8", "cp1252"),), (("utf-8", "latin-1"),), (("utf-8", "mac-roman"),), (("utf-8", "cp437"),), (("utf-8", "cp1251"),), (("utf-8", "cp1252"), ("utf-8", "cp1252"))]


def test_garbling_is_undone():
    for text in TEXTS.values():
        for chain in CHAINS:
            g = M.garble(text, chain)
            assert g != text and M.undo(g, chain) == text
            assert M.undo(text, chain) != text or text.isascii()
    assert M.aligned("naÃ¯ve â", "naïve â") == [("Ã¯", "ï")] and M.aligned("abc", "abd") == []
    assert (("utf-8", "cp1252"),) in M.explaining("Ã©", "é")


def test_garbled_texts_are_found_and_restored(spark):
    r = random.Random(5)
    names = ["A", "BC", "P1", "QX", "Z"]
    clean = [t.format(r.choice(names), r.choice(names)) for _ in range(60) for t in TEXTS.values()] + DECOYS * 12
    rows, originals = list(clean), {}
    for chain in CHAINS:
        for _ in range(3):
            for t in TEXTS.values():
                text = t.format(r.choice(names), r.choice(names))
                g = M.garble(text, chain)
                if g and g != text:
                    originals[len(rows)] = text
                    rows.append(g)
    only = "Prof’s remark: A ≥ 5…"  # a text that occurs garbled alone
    originals[len(rows)] = only
    rows.append(M.garble(only, CHAINS[0]))
    lost = len(rows)
    rows += ["Caf� de A", None, "", "plain ASCII", "\n", "x" * 200_000 + "é"]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(rows)], "doc_id long, text string, garbled string")
    got = {x["doc_id"]: x for x in M.mended(docs, "doc_id", "text").collect()}
    flagged = {k for k, x in got.items() if x["garbled"]}
    assert flagged == set(originals) | {lost}
    restored = sum(got[k]["restored"] == t for k, t in originals.items())
    assert restored >= 0.9 * len(originals)
    assert got[lost - 1]["restored"] == only
    assert got[lost]["stretches_lost"] == 1 and got[lost + 1]["restored"] is None
    assert M.mended(docs.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("chain", [(("utf-8", "cp1252"),), (("utf-8", "cp1251"),), (("cp1251", "cp1252"),), (("koi8-r", "cp1251"),)])
def test_copies_of_a_garbled_text_are_found(spark, chain):
    clean = [t.format(f"A{i}", f"B{i}") for i in range(120) for t in TEXTS.values()]
    once = [M.garble(TEXTS["ru"].format(f"C{i}", "D"), chain) for i in range(2)]
    many = M.garble(TEXTS["ru"].format("E", "F"), chain)
    rows = clean + once + [many] * (len(clean) // 2)  # a third of all rows
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {x["doc_id"]: x for x in M.mended(docs, "doc_id", "text").collect()}
    assert {k for k, x in got.items() if x["garbled"]} == set(range(len(clean), len(rows)))
    assert got[len(rows) - 1]["restored"] == TEXTS["ru"].format("E", "F")


def test_copies_of_a_clean_text_still_teach_a_chain(spark):
    rows = [TEXTS["fr"].format("A", "B")] * 8 + [M.garble(TEXTS["fr"].format("A", "B"), CHAINS[0])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert CHAINS[0] in M.learned(M.twins(docs))[0]


def test_lost_bytes_are_restored_by_words_learned_from_twins(spark):
    clean = ["Le côté A est très long.", "Das Dreieck ist gleichschenklig, natürlich."]
    rows = clean * 8 + [clean[0].replace("ô", "\ufffd"), "Un côté, un autre c\ufffdté; mais t\ufffdt ou tard.", clean[1].replace("ü", "\ufffd\ufffd")]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {x["doc_id"]: x for x in M.mended(docs, "doc_id", "text").where("garbled").collect()}
    assert set(got) == {16, 17, 18}
    assert got[16]["restored"] == clean[0] and got[18]["restored"] == clean[1]
    assert got[17]["restored"] == "Un côté, un autre côté; mais t\ufffdt ou tard." and (got[17]["stretches_restored"], got[17]["stretches_lost"]) == (1, 1)


def test_more_learned_words_than_are_sent_to_all_tasks(spark, monkeypatch):
    clean = ["Le côté A est très long.", "Das Dreieck ist gleichschenklig, natürlich.", "Ici, voilà une hauteur du triangle donné."]
    hurt = [clean[0].replace("ô", M.LOST), clean[1].replace("ü", M.LOST * 2), clean[2].replace("à", M.LOST), clean[2].replace("é", M.LOST)]
    rows = clean * 20 + hurt + [f"Un c{M.LOST}té; mais t{M.LOST}t ou tard.", hurt[0], None, ""]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    whole = sorted(M.mended(docs, "doc_id", "text").collect())
    monkeypatch.setattr(M, "WORDS", 1)
    got = sorted(M.mended(docs, "doc_id", "text").collect())
    assert got == whole and len(got) == len(rows)
    by = {x["doc_id"]: x["restored"] for x in got}
    assert [by[60 + i] for i in range(4)] == [clean[0], clean[1], clean[2], clean[2]] and by[65] == clean[0]
    assert by[64] == f"Un côté; mais t{M.LOST}t ou tard."


def test_queries_run(spark, small):
    from stepquarry.llm import queries, sql

    assert set(sql.SQL) <= set(queries.QUERIES)
    assert not queries.p2_balance(spark, small).where("not within").count()
    for name in ("p2_split", "p4_counts", "p6_ids", "p7_pack", "p7_fill", "p8_found", "p8_restored"):
        assert queries.QUERIES[name](spark, small).count() > 0


def test_packing_query_holds_all_tokens(spark, small):
    from stepquarry.llm import queries

    rows = queries.p7_pack(spark, small)
    sums = {x["profile"]: x["t"] for x in rows.groupBy("profile").agg(F.sum("n_tokens").alias("t")).collect()}
    total = queries.p6_ids(spark, small).agg(F.sum(F.size("ids"))).first()[0]
    assert set(sums.values()) == {total}
