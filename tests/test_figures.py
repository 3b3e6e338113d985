import json
import math

import pytest
from pyspark.sql import functions as F

from stepquarry.operators import checks as C
from stepquarry.operators import gates as G
from stepquarry.operators import params as P
from stepquarry.operators import references as R

#: A square, its centre, and points on its circle and diagonal.
POINTS = {"A": (0, 0), "B": (4, 0), "C": (4, 4), "D": (0, 4), "O": (2, 2), "M": (2, 0), "E": (8, 0), "F": (2 + 2 * math.sqrt(2), 2), "S": (1, 0.5)}
HOLDS = [
    {"type": "collinear", "points": ["A", "O", "C"]}, {"type": "concyclic", "points": ["A", "B", "C", "D", "F"]},
    {"type": "concurrent", "lines": [["A", "C"], ["B", "D"], ["M", "O"]]}, {"type": "parallel", "a": ["A", "B"], "b": ["D", "C"]},
    {"type": "perpendicular", "a": ["A", "C"], "b": ["B", "D"]}, {"type": "equal_len", "a": ["A", "B"], "b": ["B", "C"]},
    {"type": "on_line", "point": "E", "line": ["A", "B"]}, {"type": "on_circle", "point": "F", "circle": ["A", "B", "C"]},
    {"type": "distinct", "points": ["A", "B", "O"]}, {"type": "tangent_circles", "c1": ["A", "M"], "c2": ["B", "M"]},
    {"type": "tangent_circles", "c1": ["A", "B"], "c2": ["M", "B"], "internal": True}, {"type": "equal_area", "tris": [["A", "B", "C"], ["A", "C", "D"]]},
    {"type": "coincide", "points": ["A", "A"]}, {"type": "midpoint", "point": "M", "of": ["A", "B"]},
    {"type": "len_product_equal", "pairs1": [["A", "B"], ["A", "M"]], "pairs2": [["A", "E"], ["S", "S2"]]},
    {"type": "angle_value", "points": ["B", "A", "C"], "deg": 45}, {"type": "angle_equal", "a": ["B", "A", "C"], "b": ["C", "A", "D"]},
    {"type": "angle_double", "big": ["B", "A", "D"], "small": ["B", "A", "C"]}, {"type": "len_sum_equal", "a": [["A", "B"], ["B", "C"]], "b": [["A", "E"]]},
    {"type": "sum_sq_equal", "a": [["A", "B"], ["B", "C"]], "b": [["A", "C"]]}, {"type": "ptolemy", "points": ["A", "B", "C", "D"]},
]
FAILS = [
    {"type": "collinear", "points": ["A", "B", "C"]}, {"type": "collinear", "points": ["A", "A", "C"]}, {"type": "concyclic", "points": ["A", "B", "C", "O"]},
    {"type": "concyclic", "points": ["A", "M", "B", "O"]}, {"type": "concurrent", "lines": [["A", "B"], ["D", "C"], ["A", "C"]]},
    {"type": "concurrent", "lines": [["A", "C"], ["B", "D"], ["A", "B"]]}, {"type": "parallel", "a": ["A", "B"], "b": ["A", "C"]},
    {"type": "parallel", "a": ["A", "A"], "b": ["A", "B"]}, {"type": "perpendicular", "a": ["A", "B"], "b": ["A", "C"]},
    {"type": "equal_len", "a": ["A", "B"], "b": ["A", "C"]}, {"type": "on_line", "point": "O", "line": ["A", "B"]},
    {"type": "on_circle", "point": "O", "circle": ["A", "B", "C"]}, {"type": "on_circle", "point": "O", "circle": ["A", "M", "B"]},
    {"type": "distinct", "points": ["A", "B", "A"]}, {"type": "tangent_circles", "c1": ["A", "B"], "c2": ["B", "A"]},
    {"type": "equal_area", "tris": [["A", "B", "C"], ["A", "B", "O"]]}, {"type": "coincide", "points": ["A", "B"]}, {"type": "midpoint", "point": "O", "of": ["A", "B"]},
    {"type": "len_product_equal", "pairs1": [["A", "B"]], "pairs2": [["A", "C"]]}, {"type": "angle_value", "points": ["B", "A", "C"], "deg": 46},
    {"type": "angle_value", "points": ["A", "A", "C"], "deg": 0}, {"type": "angle_equal", "a": ["B", "A", "C"], "b": ["B", "A", "D"]},
    {"type": "angle_double", "big": ["B", "A", "C"], "small": ["B", "A", "D"]}, {"type": "len_sum_equal", "a": [["A", "B"]], "b": [["A", "C"]]},
    {"type": "sum_sq_equal", "a": [["A", "B"]], "b": [["A", "C"]]}, {"type": "ptolemy", "points": ["A", "C", "B", "D"]},
    {"type": "nothing"}, {"points": ["A"]}, {"type": "collinear", "points": ["A", "B", "nowhere"]}, {"type": "collinear"}, {"type": "collinear", "points": ["A"]},
    {"type": "midpoint", "of": ["A", "B"]}, {"type": "parallel", "a": ["A"], "b": ["B", "C"]},
]


def evaluated(spark, checks, points=POINTS):
    rows = spark.createDataFrame([(1, [json.dumps(c) for c in checks])], "problem_id long, checks array<string>")
    probes = [(1, 0, i, n, float(x), float(y), None, None) for i, (n, (x, y)) in enumerate(points.items())]
    probes = spark.createDataFrame(probes, "problem_id long, trial int, pos int, name string, x double, y double, recorded_at timestamp, loaded_at timestamp")
    out = G.checked(G.trials_of(probes), G.checks_of(rows, "problem_id"))
    return {r["idx"]: (r["holds"], r["reason"]) for r in out.collect()}


def test_checks_that_hold(spark):
    points = POINTS | {"S2": (2, 0.5)}
    got = evaluated(spark, HOLDS, points)
    assert {c["type"] for c in HOLDS} == set(C.RULES)
    bad = [HOLDS[i] for i, r in got.items() if not r[0]]
    # 4 * 2 = 8 * 1
    assert not bad and len(got) == len(HOLDS)


def test_checks_that_fail(spark):
    got = evaluated(spark, FAILS)
    assert not [FAILS[i] for i, r in got.items() if r[0]] and len(got) == len(FAILS)
    assert got[len(FAILS) - 7][1] == "unknown" and got[len(FAILS) - 5][1] == "missing"


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_a_coordinate_that_is_not_finite_fails(spark, bad):
    got = evaluated(spark, [{"type": "parallel", "a": ["A", "B"], "b": ["A", "Q"]}, {"type": "distinct", "points": ["A", "B"]}], {"A": (0, 0), "B": (1, 0), "Q": (bad, 0)})
    assert got[0] == (False, "missing") and got[1][0]


def test_similar_figures_pass_alike(spark):
    turn = lambda x, y: (3 + 2.5 * (x * 0.6 - y * 0.8), -7 + 2.5 * (x * 0.8 + y * 0.6))
    moved = {n: turn(*p) for n, p in (POINTS | {"S2": (2, 0.5)}).items()}
    got = evaluated(spark, HOLDS, moved)
    assert all(r[0] for i, r in got.items() if HOLDS[i]["type"] != "concurrent")


def probes(spark, rows):
    return spark.createDataFrame(rows, "problem_id long, trial int, pos int, name string, x double, y double, recorded_at string, loaded_at string")


def test_trials_take_the_latest_delivery(spark):
    rows = [(1, 0, 0, "A", 1.0, 1.0, "1", "1"), (1, 0, 0, "A", 2.0, 2.0, "1", "2"), (1, 0, 0, "A", 2.0, 2.0, "1", "2"), (1, 0, 1, "A", 9.0, 9.0, "1", "1"), (1, 0, 2, "B", None, 1.0, "1", "1"), (None, 0, 0, "A", 1.0, 1.0, "1", "1")]
    (r,) = G.trials_of(probes(spark, rows)).collect()
    assert [(p["pos"], p["x"]) for p in r["pts"]] == [(0, 2.0), (1, 9.0)] and r["coords"]["A"]["x"] == 9.0 and len(r["coords"]) == 1


def test_degeneracy(spark):
    def reason(*xy):
        rows = [(1, 0, i, f"P{i}", x, y, "1", "1") for i, (x, y) in enumerate(xy)]
        return G.trials_of(probes(spark, rows)).select(G.degeneracy(F.col("pts")).alias("r")).first()["r"]

    assert reason((0.0, 0.0), (1.0, 1.0), (2.0, 0.0)) is None
    assert reason((0.0, 0.0), (5.0, 5.0)) == "coincident"
    assert reason((0.0, 0.0), (0.49, 0.0), (0.05, 0.05)) == "collapsed"
    assert reason((0.0, 0.0), (float("nan"), 1.0)) == "out_of_bounds" and reason((1.1e5, 0.0)) == "out_of_bounds"
    assert reason((0.0, 0.0)) is None
    assert reason((0.0, 0.0), (0.0, 1e-9), (0.0, 2e-9), (9.0, 9.0), (0.0, 9.0)) is None


def trials(spark, failing, sound=((0.0, 0.0), (3.0, 0.0), (0.0, 3.0))):
    rows = [(1, 3, t, bad, [(i, f"P{i}", x, y) for i, (x, y) in enumerate(sound)]) for t, bad in enumerate(failing)]
    return spark.createDataFrame(rows, "problem_id long, n_steps int, trial int, failed array<string>, pts array<struct<pos:int,name:string,x:double,y:double>>")


def test_gates_by_vote(spark):
    ok, bad = [], ["x"]
    gate = lambda f: G.gate_majority(trials(spark, f)).first()["kept"]
    assert gate([ok, ok, ok, bad, bad]) and not gate([ok] * 4 + [bad] * 3) and gate([ok] * 5 + [bad] * 2)
    r = G.gate_all(trials(spark, [ok, ["y"], ["z"]])).first()
    assert not r["ok"] and r["clean"] == 1 and r["sample_failure"] == ["y"]
    assert G.gate_all(trials(spark, [ok])).first()["sample_failure"] is None
    assert G.gate_all(trials(spark, [ok]).limit(0)).count() == 0


def test_problems_without_steps_or_trials_are_counted(spark):
    step = "struct<name:string,class:string>"
    problems = spark.createDataFrame([(1, [("A", "point")]), (2, []), (3, None), (4, [("A", "point")]), (5, [("l", "line")])], f"id long, construction_steps array<{step}>")
    rows = [(k, t, 0, n, x, 1.0, "1", "1") for k in (1, 2, 5) for t in range(20) for n, x in (("A", float(t)),)] + [(9, 0, 0, "A", 1.0, 1.0, "1", "1")]
    built = G.built(G.trials_of(probes(spark, rows)), G.point_steps(problems, "id"))
    got = {r["problem_id"]: (r["clean"], r["trials"], r["ok"]) for r in G.gate_all(built).collect()}
    assert got == {1: (20, 20, True), 2: (20, 20, True), 3: (0, 0, True), 4: (0, 0, True), 5: (20, 20, True)}
    kept = {r["problem_id"]: (r["kept"], r["last_reason"]) for r in G.gate_majority(built).collect()}
    assert kept == {1: (True, None), 2: (False, "no_steps"), 3: (False, "no_steps"), 4: (False, "no_trials"), 5: (True, None)}


def test_parameters_of_points_on_paths(spark):
    steps = [("O", "point", "(0, 0)"), ("w", "circle", "Circle(O, 3)"), ("l", "line", "Line(O, A)")]
    steps += [(f"P{i}", "point", " Point(w) ") for i in range(5)] + [("Q", "point", "Point(l)"), ("R", "point", "Point(w, 0.5)"), ("S", "point", "Point((1,2))"), ("T", "point", "Point(Line(A, B))"), ("U", "point", "Point(Segment(A, B))"), ("V", "point", None)]
    rows = spark.createDataFrame([(1, [(n, "final", c, None, k) for n, c, k in steps])], "id long, construction_steps array<struct<name:string,type:string,class:string,label:string,command:string>>")
    steps = P.exploded(rows, "id")
    paths = P.on_paths(steps)
    got = {r["name"]: r["t"] for r in paths.withColumn("t", P.even(F.col("ordinal"), F.col("points"))).collect()}
    assert got == {"P0": 0.1667, "P1": 0.3333, "P2": 0.5, "P3": 0.6667, "P4": 0.8333, "U": 0.5}
    drawn = P.strewn(paths, 3).collect()
    assert len(drawn) == 18 and {(r["trial"], r["name"], r["t"]) for r in drawn} == {(r["trial"], r["name"], r["t"]) for r in P.strewn(paths, 3).collect()}
    for trial in range(3):
        ts = sorted(r["t"] for r in drawn if r["trial"] == trial and r["path"] == "w")
        assert all(0.04 + 0.92 * j / 5 - 1e-4 <= t <= 0.04 + 0.92 * (j + 1) / 5 + 1e-4 for j, t in enumerate(ts))
    done = P.with_parameters(steps, paths.withColumn("t", P.even(F.col("ordinal"), F.col("points")))).where("name = 'P1'").first()
    assert done["command"] == "Point(w, 0.3333)"
    assert P.strewn(paths, 0).count() == 0


def test_flipped_index(spark):
    rows = spark.createDataFrame([("Intersect(a, b, 1)",), ("Intersect(a, b, 2)",), ("Intersect(a, b)",), (None,)], "c string")
    assert [r[0] for r in rows.select(P.flipped(F.col("c"))).collect()] == ["Intersect(a, b, 2)", "Intersect(a, b, 1)", None, None]


def test_references(spark):
    rows = [(1, 0, "A", "final", "(0,0)"), (1, 1, "h", "construction", "Circle(A, 1)"), (1, 2, "d", "construction", "Line(A, B)"), (1, 3, "B", "final", "Point(h)"), (1, 4, None, "construction", None)]
    steps = spark.createDataFrame(rows, "problem_id long, pos int, name string, type string, command string")
    assert [r["name"] for r in R.dead_steps(steps).collect()] == ["d"]
    assert [(r["pos"], r["ref"]) for r in R.early_uses(steps).collect()] == [(2, "B")]


def built(*steps, t=0.25):
    from stepquarry.operators import construct as E

    rows = E.built([None if s is None else dict(zip(("name", "command"), s)) for s in steps], lambda i: t)
    return {n: (status, x if x is None else (round(x, 6) + 0.0, round(y, 6) + 0.0)) for _, n, status, x, y in rows}


def test_evaluator():
    got = built(
        ("A", "(0, 0)"), ("B", "(4, 0)"), ("C", "(4/1, 4)"), None, ("M", "Midpoint(A, B)"), ("k", "Circle(A, B, C)"), ("O", "Center(k)"), ("p", "Point(Circle(A, 2))"),
        ("X", "Intersect(Line(A, C), Line(B, O))"), ("D", "A + C - B"), ("R", "Rotate(B, 90°, A)"), ("S", "Reflect(C, Line(A, B))"), ("sq", "Polygon(A, B, 4)"), ("V", "Vertex(sq, 4)"),
        ("I1", "Intersect(Circle(A, 5), Line(A, B), 1)"), ("I2", "Intersect(Circle(A, 5), Line(A, B), 2)"), ("I3", "Intersect(Circle(A, 1), Line(C, D))"), ("T", "Tangent((0, 5), Circle(A, 3))"),
        ("h", "Incircle(A, B, (0, 3))"), ("J", "Center(h)"), ("N", "Nonsense(A)"), ("Q", "Midpoint(N, A)"), ("W", "Midpoint(nowhere, A)"), ("v", "Vector(A, B)"), ("U", "Translate(C, v)"), ("Z", None), ("G", "Centroid(Polygon(A, B, C))"),
    )
    want = {"M": (2, 0), "O": (2, 2), "p": (0, 2), "X": (4, 4), "D": (0, 4), "R": (0, 4), "S": (4, -4), "V": (0, 4), "I1": (-5, 0), "I2": (5, 0), "J": (1, 1), "U": (8, 4), "G": (2.666667, 1.333333)}
    want["X"] = (2, 2)
    for n, p in want.items():
        assert got[n] == ("ok", p), n
    assert got["T"] == ("ok", None) and got["I3"][0] == "failed" and got["N"][0] == "unsupported" and got["Q"][0] == "failed" and got["W"][0] == "unsupported" and got["Z"][0] == "unsupported"


def test_evaluated_figures_pass_their_checks(spark):
    from stepquarry.operators import construct as E

    steps = [("A", "(0, 0)"), ("B", "(6, 1)"), ("k", "Circle(A, B)"), ("P", "Point(k)"), ("M", "Midpoint(P, B)"), ("Q", "Intersect(Line(P, B), k, 1)")]  # Q falls on P
    rows = [(1, [(n, "final", "point" if n.isupper() else "circle", None, c) for n, c in steps], [json.dumps({"type": "equal_len", "a": ["A", "P"], "b": ["A", "B"]}), json.dumps({"type": "perpendicular", "a": ["A", "M"], "b": ["P", "B"]})])]
    problems = spark.createDataFrame(rows, "problem_id long, construction_steps array<struct<name:string,type:string,class:string,label:string,command:string>>, checks array<string>")
    table = P.exploded(problems, "problem_id")
    at_random = P.at_random(table, 4)
    results = G.checked(G.trials_of(E.as_probes(E.evaluate(at_random))), G.checks_of(problems, "problem_id")).collect()
    assert len(results) == 8 and all(r["holds"] for r in results)
    again = E.evaluate(at_random)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, E.evaluate(P.at_random(table.repartition(3), 4)).collect()))
    assert len({(r["x"], r["y"]) for r in again.where("name = 'P'").collect()}) == 4
    (fix,) = E.fixed_indices(P.evenly(table)).collect()
    assert (fix["pos"], fix["old"], fix["new"]) == (5, "Intersect(Line(P, B), k, 1)", "Intersect(Line(P, B), k, 2)")
    assert E.report(again).where("total = 6 AND failed = 0").count() == 4


def test_indices_are_read_from_the_arguments():
    from stepquarry.operators import construct as E

    assert E.other_index(" Intersect(Circle(A, 1), l, 2) ") == "Intersect(Circle(A, 1), l, 1)" and E.other_index("Intersect(a, b, 1)") == "Intersect(a, b, 2)"
    assert E.other_index("Intersect(a, 1)") is None and E.other_index("Intersect(a, b, i)") is None and E.other_index("Point(a, b, 1)") is None and E.other_index("") is None
    assert E.collapsed([(0, "A", "ok", 0.0, 0.0), (1, "B", "ok", 9e-7, 0.0), (2, "C", "ok", 1.1e-6, -1.1e-6), (3, "D", "ok", None, None), (4, "E", "ok", float("nan"), 0.0)]) == [1]
