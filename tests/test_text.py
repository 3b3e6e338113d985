import json
import time

import numpy as np
from pyspark.sql import functions as F

from stepquarry.functions import replies as J
from stepquarry.functions import text as X
from stepquarry.functions import words as W
from stepquarry.operators import corpus as K
from stepquarry.operators import dedup as D
from stepquarry.operators import metrics as M

STEP = "struct<name:string,type:string,class:string,label:string,command:string>"


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


def test_tokens_and_commands(spark):
    assert sorted(one(spark, "Ångström's x² 12,5 X_y", "string", X.tokens)) == sorted(["ångström", "s", "x²", "12", "5", "x", "y"])
    assert one(spark, None, "string", X.tokens) == [] and one(spark, " -_ ", "string", X.tokens) == []
    steps = [("a", None, None, None, " Circle( A, B )"), None, ("b", None, None, None, None), ("c", None, None, None, "Circle(A,B)")]
    assert one(spark, steps, f"array<{STEP}>", X.commands) == ["Circle(A,B)"]
    assert one(spark, None, f"array<{STEP}>", X.commands) == []


def test_content_words_heads_and_jaccard(spark):
    assert sorted(one(spark, "Let the points P2 and Q lie on a circle; PROVE it's a Circle", "string", W.content_words)) == ["circle", "lie"]
    steps = [("a", None, None, None, "Intersect(Line(A, B), f(x))"), ("b", None, None, None, None)]
    assert sorted(one(spark, steps, f"array<{STEP}>", W.command_heads)) == ["Intersect", "Line"]
    pair = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "a array<string>, b array<string>").select(W.jaccard(F.col("a"), F.col("b")))
    assert [r[0] for r in pair.collect()] == [1 / 3, 0.0]


def test_point_names_and_relabelling(spark):
    text = "Let ABC have incentre I and circumcircle k; A' lies on BC, D1 is the midpoint. Énoncé"
    assert one(spark, text, "string", W.point_names) == ["A", "A'", "B", "C", "D1", "I"]
    assert one(spark, None, "string", W.point_names) == []
    steps = [("I", "construction", "point", None, "x"), ("Z", "construction", "point", "M", "x"), ("incircle", "construction", "circle", None, "x"), ("bisector_A", "construction", "line", None, "x"), ("A", "final", "point", None, "x"), None]
    rows = spark.createDataFrame([("ABC with incentre I, circumcircle, midpoint M", steps)], f"s string, v array<{STEP}>")
    once = rows.withColumn("v", W.shown_steps(F.col("s"), F.col("v")))
    got = once.first()["v"]
    assert [s and s["type"] for s in got] == ["final", "final", "final", "construction", "final", None]
    assert once.withColumn("v", W.shown_steps(F.col("s"), F.col("v"))).first()["v"] == got


def test_paraphrases(spark):
    text = "Let ABC be a triangle with centre O. Prove that it is. Draw k."
    got = one(spark, text, "string", W.paraphrases)
    assert len(got) == 4 and got[0] == text and len(set(got)) == 4
    assert one(spark, "x", "string", W.paraphrases) == ["x"] and one(spark, None, "string", W.paraphrases) is None


def test_paths(spark):
    cases = {"Point(c)": "c", "Point(c, 0.5)": None, "Point((1,2))": None, " Point(Circle(O, 3)) ": "Circle(O, 3)", "Point()": None, "Circle(O)": None, "Point(Segment(A, B), 1)": None, None: None}
    for text, path in cases.items():
        assert one(spark, text, "string", W.path_of_point) == path


def test_replies(spark):
    good = '{"construction_steps": [{"name": "A"}]}'
    def both(text):
        r = spark.createDataFrame([(text,)], "t string").select(J.strict_steps("t").alias("s"), J.lenient_steps("t").alias("l")).first()
        return (r["s"] and json.loads(r["s"]), r["l"] and json.loads(r["l"]))

    steps = [{"name": "A"}]
    assert both(f"```json\n{good}\n```") == (steps, steps)
    assert both('{"construction_steps": [{"name": "A",}]}') == (None, steps)
    assert both('{"construction_steps": [{"name": "A"}{"name": "B"}]}') == (None, [{"name": "A"}, {"name": "B"}])
    assert both("{broken} then " + good) == (None, steps)
    assert both(good[:-2]) == (None, None) and both(None) == (None, None) and both("") == (None, None)
    assert both('{"construction_steps": [{"name": "a } b \\" {"}]}')[0] == [{"name": 'a } b " {'}]


def test_written_steps(spark):
    assert one(spark, [("A", "final", None, None, 'é "x"')], f"array<{STEP}>", J.steps_as_json) == '{"construction_steps": [{"name": "A", "type": "final", "command": "é \\"x\\""}]}'


def test_split_sizes_and_determinism(spark):
    sizes = {"a": 1, "b": 50, "c": 60, "d": 82, "e": 150, None: 3}
    rows = spark.createDataFrame([(i, s) for k, (s, n) in enumerate(sizes.items()) for i in range(k * 1000, k * 1000 + n)], "id long, source string")
    got = {(r["source"], r["split"]): r["n"] for r in M.totals(K.split_by_source(rows, "id"), "source", "split").collect()}
    assert {s: got[s, "eval"] for s in sizes} == {"a": 1, "b": 6, "c": 8, "d": 11, "e": 20, None: 1}
    again = K.split_by_source(rows.repartition(7), "id").where("split = 'eval'").collect()
    assert {r["id"] for r in again} == {r["id"] for r in K.split_by_source(rows, "id").where("split = 'eval'").collect()}


def test_quantiles_and_length(spark):
    rows = spark.createDataFrame([("x", v) for v in [5, 1, 3, 9, None]] + [("y", 7)], "k string, v long")
    got = {r["k"]: (r["n"], r["max"], r["q50"], r["q95"]) for r in K.quantiles(rows, "k", "v").collect()}
    assert got == {"x": (4, 9, 5, 9), "y": (1, 7, 7, 7)}
    assert one(spark, 3584, "long", K.sequence_length) == 1280 and one(spark, 10, "long", K.sequence_length) == 1024


def test_ids_go_on_in_order(spark):
    rows = spark.createDataFrame([(b, n) for b in range(5) for n in range(40)], "b int, n int").repartition(6)
    taken = spark.createDataFrame([(2000,), (None,)], "id long")
    got = sorted((r["b"], r["n"], r["new_id"]) for r in K.next_ids(rows, ["b", "n"], taken).collect())
    assert [x[2] for x in got] == list(range(2001, 2201))
    assert K.next_ids(rows.limit(1), ["b", "n"], taken.limit(0)).first()["new_id"] == 1000
    assert K.next_ids(rows.limit(1), ["b", "n"], taken.limit(0), floor=1).first()["new_id"] == 1


def test_new_statements(spark):
    rows = [(1, " a ", True), (2, "a", True), (3, "b", True), (4, None, True), (5, "", True), (6, "c", True), (7, "d", False), (8, "d", None), (9, "d", True), (10, "d", False), (11, "b", False)]
    batch = spark.createDataFrame(rows, "n long, problem_statement string, good boolean")
    known = spark.createDataFrame([("b ",)], "problem_statement string")
    got = {r["n"]: r["is_dup"] for r in D.new_statements(batch, known, ["n"], F.col("good")).collect()}
    # a row that failed doesn't stand in the way of its later twin; an accepted one does
    assert got == {1: False, 2: True, 3: True, 4: False, 5: True, 6: False, 7: False, 8: False, 9: False, 10: True, 11: True}


def test_best_match_against_brute_force(spark, small):
    from stepquarry.plans.runtime import settle
    from stepquarry.sources.tables import table

    text, steps = F.col("problem_statement"), F.col("construction_steps")
    refs = settle(D.features(table(spark, small, "problems"), F.col("problem_key"), text, steps), "r")
    new = settle(D.features(table(spark, small, "new_geometry_problems"), F.col("new_id"), text, steps), "n")
    got = {(r["new_id"], r["ref_id"], round(r["words_j"], 9)) for r in D.best_match(new, refs).collect()}
    r, want = [(x["gid"], set(x["words"])) for x in refs.orderBy("gid").collect()], set()
    for x in new.collect():
        best = max(r, key=lambda y: (len(y[1] & set(x["words"])) / max(1, len(y[1] | set(x["words"]))), -y[0]))
        j = len(best[1] & set(x["words"])) / max(1, len(best[1] | set(x["words"])))
        if j > 0:
            want.add((x["gid"], best[0], round(j, 9)))
    assert got == want


def test_best_match_at_any_similarity(spark):
    rows = lambda texts: D.features(spark.createDataFrame(list(enumerate(texts)), "k long, s string").withColumn("c", F.array().cast(f"array<{STEP}>")), F.col("k"), F.col("s"), F.col("c"), "old")
    refs = rows(["alpha beta gamma delta", "alpha beta", "zeta eta theta iota kappa mu nu xi omicron pi rho sigma", ""])
    new = rows(["alpha beta gamma delta", "beta gamma", "pi tau upsilon phi chi psi", "omega", None, "beta"])
    got = {r["new_id"]: (r["ref_id"], r["source"], round(r["words_j"], 6)) for r in D.best_match(new, refs).collect()}
    assert got == {0: (0, "old", 1.0), 1: (0, "old", 0.5), 2: (2, "old", 0.058824), 5: (1, "old", 0.5)}
    assert {r["new_id"]: r["ref_id"] for r in D.best_match(new, refs, ()).collect()} == {k: v[0] for k, v in got.items()}
    assert D.best_match(new.limit(0), refs).count() == 0 and D.best_match(new, refs.limit(0)).count() == 0


def test_nearest_in_slices_with_copies_and_ties(spark):
    from stepquarry.operators.nearest import nearest
    from stepquarry.plans.runtime import settle

    rng = np.random.default_rng(5)
    word = lambda: int(rng.zipf(1.2)) % 5000 + 1
    held = [(int(k), sorted({word() for _ in range(rng.integers(0, 30))})) for k in rng.permutation(900)]
    held += [(1000 + n, held[n % 7][1]) for n in range(400)] + [(2000, list(range(1, 3000)))]
    asked = [(n, sorted({word() for _ in range(rng.integers(0, 30))})) for n in range(300)] + [(300 + n, held[n][1]) for n in range(30)] + [(400, []), (401, [9999999]), (402, list(range(5, 2500)))]
    make = lambda rows: settle(spark.createDataFrame(rows, "gid long, toks array<long>").repartition(3), "t")
    want, sets = {}, [(k, set(t)) for k, t in held]
    for a, t in asked:
        j, b = max((len(s & set(t)) / max(1, len(s | set(t))), -k) for k, s in sets)
        if j > 0:
            want[a] = -b
    for tokens in (4_000_000, 2000):
        rows = nearest(make(asked), make(held), tokens).collect()
        assert len(rows) == len(want) and {r["a"]: r["b"] for r in rows} == want


def test_best_match_of_a_least_similarity(spark):
    from stepquarry.plans.runtime import settle

    texts = lambda rows, key: settle(D.features(spark.createDataFrame([(key + n, t) for n, t in enumerate(rows)], "k long, s string").withColumn("c", F.array().cast(f"array<{STEP}>")), F.col("k"), F.col("s"), F.col("c"), "old"), "least")
    refs = texts(["alpha beta gamma delta epsilon", "zeta eta theta", "alpha beta"], 10)
    new = texts(["alpha beta", "gamma delta", "zeta eta iota kappa lambda", "beta zeta mu nu", "zeta eta theta", None], 0)
    every = {tuple(r) for r in D.best_match(new, refs).collect()}
    assert {r[0]: r[3] for r in every} == {0: 1.0, 1: 0.4, 2: 1 / 3, 3: 0.2, 4: 1.0}
    for levels in ((), (0.4, 0.25), (0.9, 0.2)):
        got = {tuple(r) for r in D.best_match(new, refs, levels, least=D.LIKELY).collect()}
        assert got == {r for r in every if r[3] >= D.LIKELY} and len(got) == 3  # 2 of 5 is 0.4 and stays


def test_best_match_among_common_words(spark):
    from stepquarry.plans.runtime import settle

    def rows(n, salt, key):
        texts = spark.range(n).select((F.col("id") + key).alias("k"), F.expr(f"transform(filter(sequence(1, 120), i -> xxhash64(id, i, {salt}) % 3 = 0), i -> concat('w', char(97 + i % 26), char(97 + i div 26)))").alias("w"))
        return settle(D.features(texts.withColumn("c", F.array().cast(f"array<{STEP}>")), F.col("k"), F.array_join("w", " "), F.col("c"), "old"), "common")

    new, refs = rows(5000, 1, 0), rows(10_000, 2, 50_000)
    began = time.time()
    got = {r["new_id"]: (r["ref_id"], r["words_j"]) for r in D.best_match(new, refs).collect()}
    assert time.time() - began < 60 and len(got) == 5000  # a row for each pair and word that it shares would be 700 million
    held = [(r["gid"], set(r["words"])) for r in refs.orderBy("gid").collect()]
    for x in new.where("gid % 500 = 0").collect():
        best = max(held, key=lambda y: (len(y[1] & set(x["words"])) / len(y[1] | set(x["words"])), -y[0]))
        assert got[x["gid"]] == (best[0], len(best[1] & set(x["words"])) / len(best[1] | set(x["words"])))


def test_chat_lengths(spark):
    rows = [(1, [("system", "abc"), ("assistant", "é😀")]), (2, None), (3, []), (4, [("user", None)])]
    got = {r["k"]: (r["full"], r["completion"]) for r in K.chat_lengths(spark.createDataFrame(rows, "k long, messages array<struct<role:string,content:string>>"), "k").collect()}
    assert got[1] == (5, 2) and got[3] == (0, 0) and got[4] == (0, 0)


def test_escapes_count_within_strings_only(spark):
    assert J.first_object(r'\{"construction_steps": [1]} \\', False) == {"construction_steps": [1]}
    assert J.first_object(r'{"a": "\\"} "{"', False) == {"a": "\\"} and J.first_object('{"a": "', True) is None
    assert len(list(J.spans('{"a":' * 50_000))) == 0 and list(J.spans("{{}")) == [(1, 3)]


def test_greedy_reply(spark):
    got = lambda t: one(spark, t, "string", J.greedy_steps)
    assert json.loads(got('so: {"construction_steps": [{"class": "POINT", "name": "A"}, {"name": "B"}, 3]} }'[:-2])) == [{"class": "point", "name": "A"}, {"name": "B"}, 3]
    assert got('{"a": 1} and {"b": 2}') is None and got("none") is None and got(None) is None and got("}{") is None and got("{}") == "[]"


def test_yields(spark):
    rows = spark.createDataFrame([(True, 3), (False, None), (None, 4)], "ok boolean, n long")
    assert tuple(M.yields(rows, F.col("ok"), tokens="n").first()) == (3, 1, 7, 1 / 3)
    assert tuple(M.yields(rows.limit(0), F.col("ok"), tokens="n").first()) == (0, 0, 0, 0.0)


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "steps array<string>, built boolean")
    r = M.score(empty).first()
    assert (r["total"], r["pct_of_all"], r["pct_of_parsed"]) == (0, None, None)
