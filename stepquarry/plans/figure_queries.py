"""Queries over figures: trials, checks, gates, degeneracy, parameters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepquarry.functions import words as W
from stepquarry.operators import checks as C
from stepquarry.operators import construct as E
from stepquarry.operators import corpus as K
from stepquarry.operators import gates as G
from stepquarry.operators import metrics as M
from stepquarry.operators import params as P
from stepquarry.operators import references as R
from stepquarry.plans.registry import query
from stepquarry.sources.tables import table


def all_problems(spark: SparkSession, d: str) -> DataFrame:
    """Accepted and reference problems under one key, as in probes."""
    columns = ["problem_statement", "construction_steps", "checks"]
    own = table(spark, d, "problems").select(F.col("problem_key").alias("problem_id"), *columns)
    return own.unionByName(table(spark, d, "fewshot_problems").select(F.col("id").alias("problem_id"), *columns))


def _trials(spark: SparkSession, d: str) -> DataFrame:
    return G.trials_of(table(spark, d, "probes"))


def _built(spark: SparkSession, d: str) -> DataFrame:
    return G.built(_trials(spark, d), G.point_steps(all_problems(spark, d), "problem_id"))


PROBLEMS = """
prob AS (SELECT problem_key AS problem_id, problem_statement, construction_steps, checks FROM problems
         UNION ALL SELECT id, problem_statement, construction_steps, checks FROM fewshot_problems)
"""
TRIALS = f"""{PROBLEMS},
probed AS (SELECT problem_id, trial, pos, name, x, y, recorded_at, loaded_at FROM probes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY problem_id, trial, pos, name ORDER BY loaded_at DESC, recorded_at DESC) AS rn
           FROM probed WHERE problem_id IS NOT NULL AND trial IS NOT NULL AND name IS NOT NULL),
pt AS (SELECT problem_id, trial, pos, name, x, y FROM ranked WHERE rn = 1 AND x IS NOT NULL AND y IS NOT NULL),
tr AS (SELECT problem_id, trial, list({{'pos': pos, 'name': name, 'x': x, 'y': y}} ORDER BY pos) AS pts,
              greatest(max(x) FILTER (isfinite(x) AND isfinite(y)) - min(x) FILTER (isfinite(x) AND isfinite(y)),
                       max(y) FILTER (isfinite(x) AND isfinite(y)) - min(y) FILTER (isfinite(x) AND isfinite(y))) AS side
       FROM pt GROUP BY problem_id, trial),
co AS (SELECT *, map_from_entries(list_transform(pts, lambda p: (p.name, {{'x': p.x, 'y': p.y}}))) AS coords,
              CASE WHEN len(pts) >= 2 AND side > 1e-9 THEN side ELSE 1.0 END AS scale FROM tr)
"""
BUILT = f"""{TRIALS},
ps AS (SELECT problem_id, coalesce(len(construction_steps), 0) AS n_steps,
              coalesce([s.name for s in construction_steps if s.class = 'point' AND s.name IS NOT NULL], CAST([] AS VARCHAR[])) AS points FROM prob),
bu AS (SELECT ps.problem_id, n_steps, trial, pts, coords, scale,
              CASE WHEN trial IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_filter(ps.points, lambda n: NOT map_contains(co.coords, n)) END AS failed
       FROM ps LEFT JOIN co USING (problem_id))
"""


@query(f"WITH {TRIALS} SELECT problem_id, trial, count(*) AS points FROM pt GROUP BY problem_id, trial")
def trial_points(spark: SparkSession, d: str) -> DataFrame:
    return _trials(spark, d).select("problem_id", "trial", F.size("pts").cast("long").alias("points"))


@query(f"""WITH {BUILT} SELECT problem_id, count(trial) FILTER (len(failed) = 0) AS clean, count(trial) AS trials,
       bool_and(len(failed) = 0) AS ok, array_to_string(arg_min(failed, trial) FILTER (len(failed) > 0), ' ') AS sample_failure
FROM bu GROUP BY problem_id""")
def trial_gate_all(spark: SparkSession, d: str) -> DataFrame:
    return G.gate_all(_built(spark, d)).withColumn("sample_failure", F.array_join("sample_failure", " "))


_BOUNDS = "list_filter(pts, lambda p: isnan(p.x) OR isnan(p.y) OR abs(p.x) > 1e5 OR abs(p.y) > 1e5)"
_EXTENT = "sqrt(power(list_max([p.x for p in pts]) - list_min([p.x for p in pts]), 2) + power(list_max([p.y for p in pts]) - list_min([p.y for p in pts]), 2))"


@query(f"WITH {TRIALS}, f AS (SELECT problem_id, trial, unnest({_BOUNDS}) AS p FROM co) SELECT problem_id, trial, p.pos AS pos, p.name AS name FROM f")
def points_out_of_bounds(spark: SparkSession, d: str) -> DataFrame:
    rows = _trials(spark, d).select("problem_id", "trial", F.explode(G.out_of_bounds(F.col("pts"))).alias("p"))
    return rows.select("problem_id", "trial", "p.pos", "p.name")


@query(f"WITH {TRIALS} SELECT problem_id, trial, round({_EXTENT}, 6) AS extent, {_EXTENT} < 0.5 AS collapsed FROM co WHERE len({_BOUNDS}) = 0")
def figure_extent(spark: SparkSession, d: str) -> DataFrame:
    size = G.extent(F.col("pts"))
    return _trials(spark, d).where(F.size(G.out_of_bounds(F.col("pts"))) == 0).select("problem_id", "trial", F.round(size, 6).alias("extent"), (size < G.LEAST_EXTENT).alias("collapsed"))


_GREEDY = f"""
cl(problem_id, trial, pts, tol, i, leaders) AS (
  SELECT problem_id, trial, pts, 1e-4 * ext, 1, [pts[1]] FROM (SELECT *, {_EXTENT} AS ext FROM co WHERE len({_BOUNDS}) = 0 AND len(pts) >= 2) q
  UNION ALL
  SELECT problem_id, trial, pts, tol, i + 1,
         CASE WHEN len(list_filter(leaders, lambda c: sqrt(power(c.x - pts[i + 1].x, 2) + power(c.y - pts[i + 1].y, 2)) < tol)) > 0
              THEN leaders ELSE list_append(leaders, pts[i + 1]) END
  FROM cl WHERE i < len(pts)),
lead AS (SELECT problem_id, trial, len(leaders) AS clusters, len(pts) AS points FROM cl WHERE i = len(pts))
"""


@query(f"WITH RECURSIVE {TRIALS}, {_GREEDY} SELECT problem_id, trial, CAST(clusters AS BIGINT) AS clusters FROM lead")
def point_clusters(spark: SparkSession, d: str) -> DataFrame:
    rows = _trials(spark, d).where((F.size(G.out_of_bounds(F.col("pts"))) == 0) & (F.size("pts") >= 2))
    return rows.select("problem_id", "trial", G.cluster_count(F.col("pts"), G.COINCIDE * G.extent(F.col("pts"))).cast("long").alias("clusters"))


_REASON = f"""
why AS (SELECT bu.problem_id, bu.trial, n_steps, CASE WHEN bu.trial IS NULL THEN NULL WHEN len(failed) > 0 THEN 'broken' WHEN len({_BOUNDS}) > 0 THEN 'out_of_bounds'
          WHEN len(pts) >= 2 AND {_EXTENT} < 0.5 THEN 'collapsed'
          WHEN lead.clusters < greatest(3, ceil(0.5 * lead.points)) THEN 'coincident' END AS reason
        FROM bu LEFT JOIN lead ON lead.problem_id = bu.problem_id AND lead.trial = bu.trial)
"""
_MAJORITY = """
SELECT problem_id, clean, trials, n_steps > 0 AND trials > 0 AND clean >= 0.6 * trials AS kept,
       CASE WHEN n_steps = 0 THEN 'no_steps' WHEN trials = 0 THEN 'no_trials' WHEN clean < 0.6 * trials THEN last END AS last_reason
FROM (SELECT problem_id, max(n_steps) AS n_steps, count(trial) FILTER (reason IS NULL) AS clean, count(trial) AS trials,
             arg_max(reason, trial) FILTER (reason IS NOT NULL) AS last FROM why GROUP BY problem_id)
"""


@query(f"WITH RECURSIVE {BUILT}, {_GREEDY}, {_REASON} {_MAJORITY}")
def trial_gate_majority(spark: SparkSession, d: str) -> DataFrame:
    return G.gate_majority(_built(spark, d))


@query(f"WITH RECURSIVE {BUILT}, {_GREEDY}, {_REASON} SELECT kept, count(*) AS n FROM ({_MAJORITY}) GROUP BY kept")
def keep_drop(spark: SparkSession, d: str) -> DataFrame:
    return M.totals(G.gate_majority(_built(spark, d)), "kept")


# Checks: each rule once more in SQL, on lists of points p1 and p2.


def _d(p: str, q: str) -> str:
    return f"sqrt(power({p}.x - {q}.x, 2) + power({p}.y - {q}.y, 2))"


def _x(a: str, b: str, c: str, d: str) -> str:
    """Cross product of b - a and d - c."""
    return f"(({b}.x - {a}.x) * ({d}.y - {c}.y) - ({b}.y - {a}.y) * ({d}.x - {c}.x))"


def _o(a: str, b: str, c: str, d: str) -> str:
    return f"(({b}.x - {a}.x) * ({d}.x - {c}.x) + ({b}.y - {a}.y) * ({d}.y - {c}.y))"


def _off(p: str, a: str, b: str) -> str:
    return f"(abs({_x(a, b, a, p)}) / nullif({_d(a, b)}, 0))"


def _den(a: str, b: str, c: str) -> str:
    return f"(2 * ({a}.x * ({b}.y - {c}.y) + {b}.x * ({c}.y - {a}.y) + {c}.x * ({a}.y - {b}.y)))"


def _centre(a: str, b: str, c: str) -> str:
    s = lambda p: f"({p}.x * {p}.x + {p}.y * {p}.y)"
    x = f"({s(a)} * ({b}.y - {c}.y) + {s(b)} * ({c}.y - {a}.y) + {s(c)} * ({a}.y - {b}.y)) / nullif({_den(a, b, c)}, 0)"
    y = f"({s(a)} * ({c}.x - {b}.x) + {s(b)} * ({a}.x - {c}.x) + {s(c)} * ({b}.x - {a}.x)) / nullif({_den(a, b, c)}, 0)"
    return f"{{'x': {x}, 'y': {y}}}"


def _cut(a: str, b: str, c: str, d: str) -> str:
    t = f"({_x(a, c, c, d)} / nullif({_x(a, b, c, d)}, 0))"
    return f"{{'x': {a}.x + {t} * ({b}.x - {a}.x), 'y': {a}.y + {t} * ({b}.y - {a}.y)}}"


def _flat(a: str, b: str, c: str) -> str:
    return f"abs({_x(a, b, a, c)}) / power(greatest({_d(a, b)}, {_d(b, c)}, {_d(a, c)}, 1.0), 2) < 1e-6 OR abs({_x(a, b, a, c)}) < 1e-4"


def _ang(v: str, p: str, q: str) -> str:
    arms = f"({_d(v, p)} * {_d(v, q)})"
    return f"(CASE WHEN {_d(v, p)} >= 1e-12 AND {_d(v, q)} >= 1e-12 THEN degrees(acos(greatest(-1.0, least(1.0, {_o(v, p, v, q)} / {arms})))) END)"


def _eq(x: str, y: str) -> str:
    return f"(abs({x} - {y}) <= 1e-6 * greatest({x}, {y}, 1e-12))"


def _every(items: str, var: str, test: str) -> str:
    return f"(len(list_filter({items}, lambda {var}: NOT coalesce({test}, false))) = 0)"


_T = "(1e-6 * scale)"


def _len(items: str, power: int = 1) -> str:
    return f"list_transform({items}, lambda g: power({_d('g[1]', 'g[2]')}, {power}))"


def _par(measure) -> str:
    return f"{_d('p1[1][1]', 'p1[1][2]')} >= {_T} AND {_d('p2[1][1]', 'p2[1][2]')} >= {_T} AND abs({measure('p1[1][1]', 'p1[1][2]', 'p2[1][1]', 'p2[1][2]')}) / ({_d('p1[1][1]', 'p1[1][2]')} * {_d('p2[1][1]', 'p2[1][2]')}) <= 1e-6"


def _triangle(t: str) -> str:
    return f"(abs({_x(t + '[1]', t + '[2]', t + '[1]', t + '[3]')}) / 2)"


_P = lambda i: f"p1[1][{i}]"
_Q = lambda i: f"p2[1][{i}]"
_SQL_RULES = {
    "collinear": f"{_d(_P(1), _P(2))} >= {_T} AND {_every('p1[1][3:]', 'p', _off('p', _P(1), _P(2)) + ' <= ' + _T)}",
    "concyclic": f"abs({_den(_P(1), _P(2), _P(3))}) >= 1e-12 AND {_every('p1[1][4:]', 'p', 'abs(' + _d('o', 'p') + ' - ' + _d('o', _P(1)) + ') <= ' + _T)}",
    "concurrent": f"abs({_x('p1[1][1]', 'p1[1][2]', 'p1[2][1]', 'p1[2][2]')}) >= 1e-12 AND {_every('p1[3:]', 'g', _d('g[1]', 'g[2]') + ' >= ' + _T + ' AND ' + _off('k', 'g[1]', 'g[2]') + ' <= ' + _T)}",
    "parallel": _par(_x),
    "perpendicular": _par(_o),
    "equal_len": f"abs({_d(_P(1), _P(2))} - {_d(_Q(1), _Q(2))}) <= {_T}",
    "on_line": f"{_d(_Q(1), _Q(2))} >= {_T} AND {_off(_P(1), _Q(1), _Q(2))} <= {_T}",
    "on_circle": f"abs({_den(_Q(1), _Q(2), _Q(3))}) >= 1e-12 AND abs({_d('o', _P(1))} - {_d('o', _Q(1))}) <= {_T}",
    "distinct": _every("range(1, len(p1[1]) + 1)", "i", _every("p1[1][i + 1:]", "q", _d("p1[1][i]", "q") + " >= 1e-3 * scale")),
    "tangent_circles": f"abs({_d(_P(1), _Q(1))} - CASE WHEN coalesce(internal, false) THEN abs({_d(_P(1), _P(2))} - {_d(_Q(1), _Q(2))}) ELSE {_d(_P(1), _P(2))} + {_d(_Q(1), _Q(2))} END) <= {_T}",
    "equal_area": f"{_every('p1', 't', _eq(_triangle('t'), _triangle('p1[1]')))}",
    "coincide": f"{_d(_P(1), _P(2))} <= {_T}",
    "midpoint": f"sqrt(power({_P(1)}.x - ({_Q(1)}.x + {_Q(2)}.x) / 2, 2) + power({_P(1)}.y - ({_Q(1)}.y + {_Q(2)}.y) / 2, 2)) <= {_T}",
    "len_product_equal": _eq(f"list_product({_len('p1')})", f"list_product({_len('p2')})"),
    "angle_value": f"abs({_ang(_P(2), _P(1), _P(3))} - deg) <= 1e-2",
    "angle_equal": f"abs({_ang(_P(2), _P(1), _P(3))} - {_ang(_Q(2), _Q(1), _Q(3))}) <= 1e-2",
    "angle_double": f"abs({_ang(_P(2), _P(1), _P(3))} - 2 * {_ang(_Q(2), _Q(1), _Q(3))}) <= 1e-2",
    "len_sum_equal": _eq(f"list_sum({_len('p1')})", f"list_sum({_len('p2')})"),
    "sum_sq_equal": _eq(f"list_sum({_len('p1', 2)})", f"list_sum({_len('p2', 2)})"),
    "ptolemy": _eq(f"({_d(_P(1), _P(3))} * {_d(_P(2), _P(4))})", f"({_d(_P(1), _P(2))} * {_d(_P(3), _P(4))} + {_d(_P(1), _P(4))} * {_d(_P(2), _P(3))})"),
}
#: Where the names of a check stand, for the two lists of point tuples; a name in capitals has tuples as they are.
_MEMBERS = {
    "collinear": ("points", ""), "concyclic": ("points", ""), "concurrent": ("LINES", ""), "parallel": ("a", "b"), "perpendicular": ("a", "b"),
    "equal_len": ("a", "b"), "on_line": ("point", "line"), "on_circle": ("point", "circle"), "distinct": ("points", ""), "tangent_circles": ("c1", "c2"),
    "equal_area": ("TRIS", ""), "coincide": ("points", ""), "midpoint": ("point", "of"), "len_product_equal": ("PAIRS1", "PAIRS2"), "angle_value": ("points", ""),
    "angle_equal": ("a", "b"), "angle_double": ("big", "small"), "len_sum_equal": ("A", "B"), "sum_sq_equal": ("A", "B"), "ptolemy": ("points", ""),
}
#: Kinds that the tables' checks don't use are tested on the first four points of every problem, by position, as well.
_MADE = {
    "on_circle": ([[4]], [[1, 2, 3]]), "tangent_circles": ([[1, 2]], [[3, 4]]), "coincide": ([[1, 2]], []),
    "len_product_equal": ([[1, 2], [3, 4]], [[1, 3], [2, 4]]), "angle_double": ([[1, 2, 3]], [[1, 3, 2]]), "ptolemy": ([[1, 2, 3, 4]], []),
}

#: A figure beside those of the tables, under problem -1: the checks on it hold, or fail by little more than their tolerance.
#: Names with a digit are off by 0.00002 (2) or 0.000002 (3); the tolerance on lengths is 0.000008.
_HAIR = 2e-5
PLANTED = {
    "A": (0, 0), "B": (4, 0), "C": (4, 4), "D": (0, 4), "O": (2, 2), "M": (2, 0), "E": (8, 0), "F": (2 + 8**0.5, 2), "S": (1, 0.5), "T": (2, 0.5), "B2": (4 + _HAIR, 0), "C2": (4, 4 + _HAIR),
    "D2": (0, 4 + _HAIR), "D3": (_HAIR, 4), "F2": (2 + 8**0.5 + _HAIR, 2), "M2": (2 + _HAIR, 0), "M3": (2 + _HAIR / 10, 0), "N2": (2, _HAIR), "O2": (2, 2 + _HAIR), "O3": (2, 2 + _HAIR / 10), "U2": (2 + _HAIR, 4),
    "B4": (4.007, 0), "D4": (0.002, 4),
}
_two = lambda kind, good, bad: [{"type": kind} | x for x in (good, bad)]
PLANTED_CHECKS = [
    *_two("collinear", {"points": ["A", "C", "O3"]}, {"points": ["A", "C", "O2"]}), *_two("concyclic", {"points": ["A", "B", "C", "D"]}, {"points": ["A", "B", "C", "D2"]}),
    *_two("concurrent", {"lines": [["A", "C"], ["B", "D"], ["M", "O3"]]}, {"lines": [["A", "C"], ["B", "D"], ["M2", "U2"]]}), *_two("parallel", {"a": ["A", "B"], "b": ["D", "C"]}, {"a": ["A", "B"], "b": ["D", "C2"]}),
    *_two("perpendicular", {"a": ["A", "B"], "b": ["A", "D"]}, {"a": ["A", "B"], "b": ["A", "D3"]}), *_two("equal_len", {"a": ["A", "B"], "b": ["B", "C"]}, {"a": ["A", "B2"], "b": ["B", "C"]}),
    *_two("on_line", {"point": "E", "line": ["A", "B"]}, {"point": "N2", "line": ["A", "B"]}), *_two("on_circle", {"point": "F", "circle": ["A", "B", "C"]}, {"point": "F2", "circle": ["A", "B", "C"]}),
    *_two("distinct", {"points": ["A", "B", "O"]}, {"points": ["A", "B", "B4"]}), *_two("tangent_circles", {"c1": ["A", "M"], "c2": ["B", "M"]}, {"c1": ["A", "M2"], "c2": ["B", "M"]}),
    *_two("tangent_circles", {"c1": ["A", "B"], "c2": ["M", "B"], "internal": True}, {"c1": ["A", "B2"], "c2": ["M", "B"], "internal": True}),
    *_two("equal_area", {"tris": [["A", "B", "C"], ["A", "C", "D"]]}, {"tris": [["A", "B", "C"], ["A", "C", "D2"]]}), *_two("coincide", {"points": ["O", "O3"]}, {"points": ["O", "O2"]}),
    *_two("midpoint", {"point": "M3", "of": ["A", "B"]}, {"point": "M2", "of": ["A", "B"]}),
    *_two("len_product_equal", {"pairs1": [["A", "B"], ["A", "M"]], "pairs2": [["A", "E"], ["S", "T"]]}, {"pairs1": [["A", "B2"], ["A", "M"]], "pairs2": [["A", "E"], ["S", "T"]]}),
    *_two("angle_value", {"points": ["B", "A", "C"], "deg": 45.005}, {"points": ["B", "A", "C"], "deg": 45.02}), *_two("angle_equal", {"a": ["B", "A", "C"], "b": ["C", "A", "D"]}, {"a": ["B", "A", "C"], "b": ["C", "A", "D4"]}),
    *_two("angle_double", {"big": ["B", "A", "D"], "small": ["B", "A", "C"]}, {"big": ["B", "A", "D4"], "small": ["B", "A", "C"]}),
    *_two("len_sum_equal", {"a": [["A", "B"], ["B", "C"]], "b": [["A", "E"]]}, {"a": [["A", "B2"], ["B", "C"]], "b": [["A", "E"]]}), *_two("sum_sq_equal", {"a": [["A", "B"], ["B", "C"]], "b": [["A", "C"]]}, {"a": [["A", "B2"], ["B", "C"]], "b": [["A", "C"]]}),
    *_two("ptolemy", {"points": ["A", "B", "C", "D"]}, {"points": ["A", "B", "C", "O"]}), *_two("collinear", {"points": ["A", "B", "M"]}, {"points": ["A", "B", "nowhere"]}),
]
_PROBE = "problem_id long, trial int, pos int, name string, x double, y double"


def _planted_trials(spark: SparkSession, d: str, points: dict[int, dict]) -> DataFrame:
    """The tables' trials, and one of each of the figures given by (negative) problem id."""
    rows = [(k, 0, i, n, float(x), float(y)) for k, figure in points.items() for i, (n, (x, y)) in enumerate(figure.items())]
    more = spark.createDataFrame(rows, _PROBE).withColumns({"recorded_at": F.lit(None).cast("timestamp"), "loaded_at": F.lit(None).cast("timestamp")})
    return G.trials_of(table(spark, d, "probes").unionByName(more))


def _planted_sql(points: dict[int, dict]) -> str:
    rows = ", ".join(f"({k}, 0, {i}, '{n}', CAST({float(x)!r} AS DOUBLE), CAST({float(y)!r} AS DOUBLE), NULL, NULL)" for k, figure in points.items() for i, (n, (x, y)) in enumerate(figure.items()))
    return TRIALS.replace("FROM probes)", f"FROM probes UNION ALL VALUES {rows})")


def _planted_checks(spark: SparkSession, d: str) -> DataFrame:
    """The checks of all problems and of the planted figure."""
    checks = all_problems(spark, d).select("problem_id", "checks")
    return G.checks_of(checks.unionByName(spark.createDataFrame([(-1, [json.dumps(c) for c in PLANTED_CHECKS])], "problem_id long, checks array<string>")), "problem_id")


def _names(member: str) -> str:
    if not member:
        return "CAST([] AS VARCHAR[][])"
    if member == "point":
        return "[[c ->> '$.point']]"
    return f"TRY_CAST(c -> '$.{member.lower()}' AS VARCHAR[][])" if member.isupper() else f"[TRY_CAST(c -> '$.{member}' AS VARCHAR[])]"


def _by_kind(value) -> str:
    return "CASE kind " + " ".join(f"WHEN '{k}' THEN {value(k)}" for k in _MEMBERS) + " END"


def _checks_sql(made: bool) -> str:
    """CTEs up to ``ev`` (problem_id, trial, idx, kind, usable, rule): every check on every trial."""
    values = ", ".join("'" + json.dumps(c) + "'" for c in PLANTED_CHECKS)
    extra = ""
    if made:
        for kind, sides in _MADE.items():
            lists = ["[" + ", ".join("[" + ", ".join(f"points[{i}]" for i in g) + "]" for g in side) + "]" if side else "CAST([] AS VARCHAR[][])" for side in sides]
            extra += f" UNION ALL SELECT problem_id, -1, '{kind}', {lists[0]}, {lists[1]}, NULL, NULL FROM ps WHERE len(points) >= 4"
    centre = lambda p: _centre(p + "[1]", p + "[2]", p + "[3]")
    return f"""WITH {BUILT.replace(TRIALS, _planted_sql({-1: PLANTED}))},
ck AS (SELECT problem_id, checks FROM prob UNION ALL SELECT -1, [{values}]),
cx AS (SELECT problem_id, i - 1 AS idx, CASE WHEN json_valid(checks[i]) THEN CAST(checks[i] AS JSON) END AS c FROM (SELECT problem_id, checks, unnest(range(1, len(checks) + 1)) AS i FROM ck)),
ckk AS (SELECT problem_id, idx, c, c ->> '$.type' AS kind FROM cx),
nm AS (SELECT problem_id, idx, kind, {_by_kind(lambda k: _names(_MEMBERS[k][0]))} AS n1, {_by_kind(lambda k: _names(_MEMBERS[k][1]))} AS n2,
              TRY_CAST(c ->> '$.deg' AS DOUBLE) AS deg, TRY_CAST(c ->> '$.internal' AS BOOLEAN) AS internal FROM ckk{extra}),
lk AS (SELECT problem_id, trial, idx, kind, scale, deg, internal,
         list_transform(n1, lambda g: list_transform(g, lambda n: map_extract_value(coords, n))) AS p1,
         list_transform(n2, lambda g: list_transform(g, lambda n: map_extract_value(coords, n))) AS p2 FROM co JOIN nm USING (problem_id)),
us AS (SELECT *, CASE kind WHEN 'concyclic' THEN {centre("p1[1]")} WHEN 'on_circle' THEN {centre("p2[1]")} END AS o,
         CASE kind WHEN 'concurrent' THEN {_cut("p1[1][1]", "p1[1][2]", "p1[2][1]", "p1[2][2]")} END AS k,
         len(p1) > 0 AND len(list_filter(p1, lambda g: g IS NULL)) + len(list_filter(p2, lambda g: g IS NULL)) = 0
         AND len(list_filter(list_concat(flatten(p1), flatten(p2)), lambda p: p IS NULL OR NOT (isfinite(p.x) AND isfinite(p.y)))) = 0 AS usable FROM lk),
ev AS (SELECT *, coalesce({_by_kind(lambda k: _SQL_RULES[k])}, false) AS rule FROM us)
"""


def _made(spark: SparkSession, d: str, kind: str) -> DataFrame:
    pts = G.point_steps(all_problems(spark, d), "problem_id").where(F.size("points") >= 4)
    side = lambda groups: F.array(*[F.array(*[F.get("points", F.lit(i - 1)) for i in g]) for g in groups]).cast("array<array<string>>")
    one, two = _MADE[kind]
    return pts.select("problem_id", F.lit(-1).alias("idx"), F.lit(kind).alias("kind"), side(one).alias("names_one"), side(two).alias("names_two"), F.lit(None).cast("double").alias("deg"), F.lit(None).cast("boolean").alias("internal"))


def _register(kind: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        checks = _planted_checks(spark, d).where(F.col("kind") == kind)
        checks = checks.unionByName(_made(spark, d, kind)) if kind in _MADE else checks
        return G.checked(_planted_trials(spark, d, {-1: PLANTED}), checks).select("problem_id", "trial", "idx", "holds")

    run.__doc__ = f"Checks of kind {kind}: those of the tables, and those on a planted figure, which hold or fail by a hair."
    query(_checks_sql(kind in _MADE) + f"SELECT problem_id, trial, CAST(idx AS INTEGER) AS idx, coalesce(usable, false) AND rule AS holds FROM ev WHERE kind = '{kind}'", name=f"check_{kind}")(run)


for _kind in C.RULES:
    _register(_kind)

_RESULTS = (
    _checks_sql(False)
    + f"""
, re AS (SELECT problem_id, trial, idx, kind, CASE WHEN kind IS NULL OR kind NOT IN ({", ".join(f"'{k}'" for k in _MEMBERS)}) THEN 'unknown'
         WHEN NOT coalesce(usable, false) THEN 'missing' WHEN NOT rule THEN 'fails' END AS reason FROM ev),
cg AS (SELECT problem_id, count(*) AS results, bool_and(reason IS NULL) AS ok,
              arg_min(coalesce(kind, 'none') || ': ' || reason, trial * 1000000 + idx) FILTER (reason IS NOT NULL) AS first_reason FROM re GROUP BY problem_id)
"""
)
_BUILD = """, bg AS (SELECT problem_id, bool_and(len(failed) = 0) AS ok, arg_min(failed, trial) FILTER (len(failed) > 0) AS sample_failure FROM bu GROUP BY problem_id),
st AS (SELECT bg.problem_id, CASE WHEN NOT bg.ok THEN 'broken' WHEN NOT coalesce(cg.ok, true) THEN 'unproven' ELSE 'accepted' END AS status,
              CASE WHEN NOT bg.ok THEN array_to_string(sample_failure, ' ') WHEN NOT coalesce(cg.ok, true) THEN first_reason END AS failure
       FROM bg LEFT JOIN cg USING (problem_id))
"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    return G.checked(_planted_trials(spark, d, {-1: PLANTED}), _planted_checks(spark, d))


@query(_RESULTS + "SELECT problem_id, trial, CAST(idx AS INTEGER) AS idx, kind, reason IS NULL AS holds, reason FROM re")
def check_results(spark: SparkSession, d: str) -> DataFrame:
    """Every check of every kind on every trial, with the reason of a failure."""
    return _checked(spark, d)


@query(_RESULTS + "SELECT * FROM cg")
def check_gate(spark: SparkSession, d: str) -> DataFrame:
    return G.gate_checks(_checked(spark, d))


def _gated(spark: SparkSession, d: str) -> DataFrame:
    trials = _trials(spark, d)
    checks = G.gate_checks(G.checked(trials, G.checks_of(all_problems(spark, d), "problem_id")))
    return G.gates_in_order(G.gate_all(G.built(trials, G.point_steps(all_problems(spark, d), "problem_id"))), checks)


@query(_RESULTS + _BUILD + "SELECT status, count(*) AS n FROM st GROUP BY status")
def gate_status(spark: SparkSession, d: str) -> DataFrame:
    """Gates in order, and how many problems end at each."""
    return M.totals(_gated(spark, d), "status")


@query(_RESULTS + _BUILD + "SELECT problem_id, status, failure AS _failure FROM st WHERE status <> 'accepted'")
def rejected_problems(spark: SparkSession, d: str) -> DataFrame:
    """The problems that a gate refuses, with what failed first."""
    rows = _gated(spark, d).where("status <> 'accepted'")
    return rows.select("problem_id", "status", F.array_join("failure", " ").alias("_failure"))


@query(_RESULTS + _BUILD + """, au AS (SELECT bg.problem_id, bg.ok AS built, coalesce(len(prob.checks), 0) > 0 AS has, coalesce(cg.ok, true) AS proved FROM bg JOIN prob USING (problem_id) LEFT JOIN cg USING (problem_id))
SELECT count(*) AS total, count(*) FILTER (built) AS render_ok, count(*) FILTER (built AND has) AS with_checks, count(*) FILTER (built AND has AND proved) AS checks_ok, count(*) FILTER (built AND NOT has) AS render_only FROM au""")
def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    """All problems; one without trials has nothing that failed."""
    trials, problems = _trials(spark, d), all_problems(spark, d)
    proved = G.gate_checks(G.checked(trials, G.checks_of(problems, "problem_id")))
    rows = G.gate_all(G.built(trials, G.point_steps(problems, "problem_id"))).select("problem_id", F.col("ok").alias("built"))
    rows = rows.join(problems.select("problem_id", F.size("checks").alias("n_checks")), "problem_id")
    rows = rows.join(proved.select("problem_id", F.col("ok").alias("proved")), "problem_id", "left").withColumn("proved", F.coalesce("proved", F.lit(True)))
    return M.audit_summary(rows.withColumn("n_checks", F.coalesce("n_checks", F.lit(0))))


_SCORED = f"""
WITH {BUILT}, g AS (SELECT problem_id, bool_and(len(failed) = 0) AND count(trial) > 0 AS built FROM bu GROUP BY problem_id),
s AS (SELECT p.source, coalesce(len(p.construction_steps), 0) > 0 AS parsed, coalesce(g.built, false) AS built
      FROM problems p LEFT JOIN g ON g.problem_id = p.problem_key)
SELECT source, count(*) AS total, count(*) FILTER (parsed) AS parse_ok, count(*) FILTER (parsed AND built) AS render_ok,
       round(100.0 * count(*) FILTER (parsed AND built) / count(*), 6) AS pct_of_all,
       round(100.0 * count(*) FILTER (parsed AND built) / nullif(count(*) FILTER (parsed), 0), 6) AS pct_of_parsed
FROM s GROUP BY source
"""


@query(_SCORED)
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    """A prediction that was never rendered is not render-valid."""
    built = G.gate_all(_built(spark, d)).select(F.col("problem_id").alias("problem_key"), (F.col("ok") & (F.col("trials") > 0)).alias("built"))
    rows = table(spark, d, "problems").select("problem_key", "source", F.col("construction_steps").alias("steps")).join(built, "problem_key", "left")
    out = M.score(rows, ["source"])
    return out.withColumns({c: F.round(c, 6) for c in ("pct_of_all", "pct_of_parsed")})


@query(f"""WITH RECURSIVE {BUILT}, {_GREEDY}, {_REASON}, mj AS ({_MAJORITY}),
s AS (SELECT coalesce(len(p.construction_steps), 0) > 0 AS parsed, coalesce(mj.kept, false) AS kept FROM problems p LEFT JOIN mj ON mj.problem_id = p.problem_key)
SELECT count(*) AS total, count(*) FILTER (parsed) AS parsed, count(*) FILTER (parsed AND kept) AS renderable, round(100.0 * count(*) FILTER (parsed) / count(*), 6) AS pct_parsed,
       round(100.0 * count(*) FILTER (parsed AND kept) / count(*), 6) AS pct_renderable, round(100.0 * count(*) FILTER (parsed AND kept) / count(*) FILTER (parsed), 6) AS pct_of_parsed FROM s""")
def functional_eval(spark: SparkSession, d: str) -> DataFrame:
    """Predictions that parse, and that the majority gate keeps."""
    kept = G.gate_majority(_built(spark, d)).select(F.col("problem_id").alias("problem_key"), "kept")
    rows = table(spark, d, "problems").select("problem_key", F.col("construction_steps").alias("steps")).join(kept, "problem_key", "left")
    return M.functional_eval(rows).withColumns({c: F.round(c, 6) for c in ("pct_parsed", "pct_renderable", "pct_of_parsed")})


# Audit predicates on the first points of each trial, and of planted figures on which they hold and fail.

_AUDITS = {
    "equal_len": (4, lambda p: C.audit_equal_len(*p), f"abs({_d('a', 'b')} - {_d('c', 'd')}) <= 1e-4 * greatest(1.0, {_d('a', 'b')}, {_d('c', 'd')})", [(0, 0), (4, 0), (0, 1), (4.0003, 1)], [(0, 0), (4, 0), (0, 1), (4.0005, 1)]),
    "collinear": (3, lambda p: C.audit_collinear(*p), f"abs({_x('a', 'b', 'a', 'c')}) / power(greatest({_d('a', 'b')}, {_d('b', 'c')}, {_d('a', 'c')}, 1.0), 2) < 1e-6 OR abs({_x('a', 'b', 'a', 'c')}) < 1e-4", [(0, 0), (400, 0), (200, 0.0003)], [(0, 0), (40, 0), (20, 0.0001)]),
    "concyclic": (4, lambda p: C.audit_concyclic(*p), f"CASE WHEN abs({_den('a', 'b', 'c')}) < 1e-12 THEN ({_flat('a', 'b', 'c')}) AND ({_flat('a', 'b', 'd')}) ELSE abs({_d(_centre('a', 'b', 'c'), 'd')} - {_d(_centre('a', 'b', 'c'), 'a')}) <= 1e-3 * greatest(1.0, {_d(_centre('a', 'b', 'c'), 'a')}) END", [(0, 0), (4, 0), (4, 4), (0, 4.002)], [(0, 0), (4, 0), (4, 4), (0, 4.005)]),
    "on_circle": (3, lambda p: C.audit_on_circle(p[0], p[1], C.dist(p[1], p[2])), f"abs({_d('a', 'b')} - {_d('b', 'c')}) <= 1e-3 * greatest(1.0, {_d('b', 'c')})", [(4.003, 0), (0, 0), (0, 4)], [(4.005, 0), (0, 0), (0, 4)]),
    "perpendicular": (4, lambda p: C.audit_perpendicular(*p), f"coalesce({_d('a', 'b')} >= 1e-9 AND {_d('c', 'd')} >= 1e-9 AND abs({_o('a', 'b', 'c', 'd')}) / nullif({_d('a', 'b')} * {_d('c', 'd')}, 0) < 1e-4, false)", [(0, 0), (4, 0), (1, 1), (1.0003, 5)], [(0, 0), (4, 0), (1, 1), (1.0005, 5)]),
    "parallel": (4, lambda p: C.audit_parallel(*p), f"coalesce({_d('a', 'b')} >= 1e-9 AND {_d('c', 'd')} >= 1e-9 AND abs({_x('a', 'b', 'c', 'd')}) / nullif({_d('a', 'b')} * {_d('c', 'd')}, 0) < 1e-4, false)", [(0, 0), (4, 0), (1, 1), (5, 1.0003)], [(0, 0), (4, 0), (1, 1), (5, 1.0005)]),
    "ratio": (3, lambda p: C.audit_ratio(p[0], p[1], p[2], F.lit(1.0)), f"coalesce({_d('b', 'c')} >= 1e-9 AND abs({_d('a', 'b')} / nullif({_d('b', 'c')}, 0) - 1.0) <= 1e-3 * greatest(1.0, {_d('a', 'b')} / nullif({_d('b', 'c')}, 0)), false)", [(0, 0), (4.003, 0), (8.003, 0)], [(0, 0), (4.005, 0), (8.005, 0)]),
    "concurrent": (6, lambda p: C.audit_concurrent(*p), f"coalesce(abs({_x('a', 'b', 'c', 'd')}) >= 1e-12 AND abs({_x('a', 'b', 'e', 'f')}) >= 1e-12 AND {_d(_cut('a', 'b', 'c', 'd'), _cut('a', 'b', 'e', 'f'))} < 1e-3 * greatest(1.0, {_d('a', 'b')}), false)", [(0, 0), (4, 0), (1, -1), (1, 1), (1.003, -1), (1.003, 1)], [(0, 0), (4, 0), (1, -1), (1, 1), (1.005, -1), (1.005, 1)]),
}
#: Points on one line, on which the circle through three has no centre.
_LINES = {-3: [(0, 0), (1, 0), (2, 0), (5, 0)], -4: [(0, 0), (1, 0), (2, 0), (5, 1)]}


def _register_audit(name: str) -> None:
    n, rule, sql, good, bad = _AUDITS[name]
    letters = "abcdef"[:n]
    points = ", ".join(f"pts[{i + 1}] AS {c}" for i, c in enumerate(letters))
    planted = {-1: good, -2: bad} | (_LINES if name == "concyclic" else {})
    figures = {k: {c: p for c, p in zip("abcdef", v)} for k, v in planted.items()}

    def run(spark: SparkSession, d: str) -> DataFrame:
        trials = _planted_trials(spark, d, figures).where(F.size(G.out_of_bounds(F.col("pts"))) == 0)
        # as in the audit itself, renders that failed are left out
        points = G.point_steps(all_problems(spark, d), "problem_id").unionByName(spark.createDataFrame([(k, 1, []) for k in figures], "problem_id long, n_steps int, points array<string>"))
        rows = G.built(trials, points).where((F.size("failed") == 0) & (F.size("pts") >= n))
        return rows.select("problem_id", "trial", rule([F.get("pts", F.lit(i)) for i in range(n)]).alias("holds"))

    built = BUILT.replace(TRIALS, _planted_sql(figures)).replace("FROM prob)", "FROM prob UNION ALL VALUES " + ", ".join(f"({k}, 1, CAST([] AS VARCHAR[]))" for k in figures) + ")")
    query(f"WITH {built}, q AS (SELECT problem_id, trial, {points} FROM bu WHERE len(failed) = 0 AND len(pts) >= {n} AND len({_BOUNDS}) = 0) SELECT problem_id, trial, {sql} AS holds FROM q", name=f"audit_{name}")(run)


for _name in _AUDITS:
    _register_audit(_name)


@query(f"""WITH {TRIALS},
vs AS (SELECT problem_id, CAST(i - 1 AS INTEGER) AS pos FROM (SELECT problem_id, construction_steps AS s, unnest(range(1, len(construction_steps) + 1)) AS i FROM prob) WHERE coalesce(s[i].type, '') <> 'construction' AND s[i] IS NOT NULL),
f AS (SELECT pt.* FROM pt JOIN vs USING (problem_id, pos) WHERE isfinite(x) AND isfinite(y)),
b AS (SELECT problem_id, trial, min(x) lx, max(x) hx, min(y) ly, max(y) hy FROM f GROUP BY problem_id, trial),
u AS (SELECT *, greatest((hx - lx + 2 * greatest((hx - lx) * 0.18, 1.5)) / 800, (hy - ly + 2 * greatest((hy - ly) * 0.18, 1.5)) / 600) AS u FROM b)
SELECT problem_id, trial, round((lx + hx) / 2 - u * 400, 5) AS x_min, round((lx + hx) / 2 + u * 400, 5) AS x_max,
       round((ly + hy) / 2 - u * 300, 5) AS y_min, round((ly + hy) / 2 + u * 300, 5) AS y_max FROM u""")
def view_box(spark: SparkSession, d: str) -> DataFrame:
    """The window of each trial around the points shown; helpers are hidden and don't widen it."""
    pts = _trials(spark, d).select("problem_id", "trial", F.explode("pts").alias("p")).select("problem_id", "trial", "p.pos", "p.x", "p.y")
    shown = _steps(spark, d).where("coalesce(type, '') <> 'construction'").select("problem_id", "pos")
    box = G.view_box(pts.join(shown, ["problem_id", "pos"]))
    return box.select("problem_id", "trial", *[F.round(c, 5).alias(c) for c in ("x_min", "x_max", "y_min", "y_max")])


@query(f"WITH {TRIALS} SELECT problem_id, trial, name, floor(x * 100 + 0.5) / 100 AS x, floor(y * 100 + 0.5) / 100 AS y FROM pt WHERE isfinite(x) AND isfinite(y)")
def rounded_points(spark: SparkSession, d: str) -> DataFrame:
    rows = _trials(spark, d).select("problem_id", "trial", F.explode("pts").alias("p")).where("abs(p.x) < double('inf') AND abs(p.y) < double('inf')")
    return rows.select("problem_id", "trial", "p.name", W.rounded(F.col("p.x")).alias("x"), W.rounded(F.col("p.y")).alias("y"))


@query(f"""WITH {TRIALS}, q AS (SELECT problem_id, trial, unnest(pts) AS p, pts FROM co),
w AS (SELECT problem_id, trial, p.pos AS pos, p.name AS name, list_filter(pts, lambda o: o.pos < p.pos AND sqrt(power(o.x - p.x, 2) + power(o.y - p.y, 2)) < 1e-6) AS near FROM q)
SELECT problem_id, trial, pos, name, near[1].name AS onto FROM w WHERE len(near) > 0""")
def collapsed_points(spark: SparkSession, d: str) -> DataFrame:
    return P.collapsed(_trials(spark, d))


STEPS = f"""{PROBLEMS},
sx AS (SELECT problem_id, CAST(i - 1 AS INTEGER) AS pos, construction_steps[i] AS s
       FROM (SELECT problem_id, construction_steps, unnest(range(1, len(construction_steps) + 1)) AS i FROM prob)),
st AS (SELECT problem_id, pos, s.name AS name, s.type AS type, s.class AS class, s.label AS label, s.command AS command FROM sx WHERE s IS NOT NULL)
"""


def _steps(spark: SparkSession, d: str) -> DataFrame:
    return P.exploded(all_problems(spark, d), "problem_id")


@query(f"WITH {STEPS} SELECT * FROM st")
def steps_exploded(spark: SparkSession, d: str) -> DataFrame:
    return _steps(spark, d)


@query()
def index_fixes(spark: SparkSession, d: str) -> DataFrame:
    """Steps whose intersection index is to be flipped because their point collapsed onto an earlier one."""
    return P.index_fixes(_steps(spark, d), _trials(spark, d))


_PATHS = f"""{STEPS},
pa AS (SELECT *, trim(regexp_extract(trim(command), '^Point\\((.*)\\)$', 1)) AS path FROM st WHERE class = 'point' AND regexp_full_match(trim(command), 'Point\\(.*\\)')),
pb AS (SELECT * FROM pa WHERE path <> '' AND NOT starts_with(path, '(') AND NOT starts_with(path, 'Line(')
       AND NOT contains(regexp_replace(regexp_replace(regexp_replace(path, '\\([^()]*\\)', '', 'g'), '\\([^()]*\\)', '', 'g'), '\\([^()]*\\)', '', 'g'), ',')),
lc AS (SELECT problem_id, name, arg_max(class, pos) AS class FROM st GROUP BY problem_id, name),
pc AS (SELECT pb.* FROM pb LEFT JOIN lc ON lc.problem_id = pb.problem_id AND lc.name = pb.path WHERE coalesce(lc.class, '') <> 'line'),
pn AS (SELECT problem_id, pos, name, path, row_number() OVER (PARTITION BY problem_id, path ORDER BY pos) AS ordinal, count(*) OVER (PARTITION BY problem_id, path) AS points FROM pc)
"""


@query(f"WITH {_PATHS} SELECT problem_id, pos, name, path, CAST(round(CAST(ordinal AS DECIMAL(18,6)) / (points + 1) + 1e-9, 4) AS DOUBLE) AS t FROM pn")
def even_parameters(spark: SparkSession, d: str) -> DataFrame:
    rows = P.on_paths(_steps(spark, d))
    return rows.select("problem_id", "pos", "name", "path", P.even(F.col("ordinal"), F.col("points")).alias("t"))


@query(f"WITH {_PATHS} SELECT problem_id, path, count(*) AS points FROM pn GROUP BY problem_id, path")
def points_per_path(spark: SparkSession, d: str) -> DataFrame:
    return P.on_paths(_steps(spark, d)).groupBy("problem_id", "path").agg(F.count("*").alias("points"))


@query()
def random_parameters(spark: SparkSession, d: str) -> DataFrame:
    """Random t in shuffled strata for five trials; drawn by hash, so there is no SQL for it."""
    return P.strewn(P.on_paths(_steps(spark, d)), 5)


@query()
def parameterised_steps(spark: SparkSession, d: str) -> DataFrame:
    """All steps with the even parameters written into their commands."""
    steps = _steps(spark, d)
    paths = P.on_paths(steps)
    return P.with_parameters(steps, paths.withColumn("t", P.even(F.col("ordinal"), F.col("points"))))


_REFS = f"""{STEPS},
rn AS (SELECT problem_id, name AS ref, min(pos) AS ref_pos FROM st WHERE name IS NOT NULL GROUP BY problem_id, name),
ru AS (SELECT DISTINCT problem_id, pos, unnest(regexp_extract_all(command, '[\\p{{L}}\\p{{N}}_]+')) AS ref FROM st),
rf AS (SELECT ru.problem_id, ru.pos, ref, rn.ref_pos FROM ru JOIN rn USING (problem_id, ref))
"""


@query(f"WITH {_REFS} SELECT * FROM rf")
def step_references(spark: SparkSession, d: str) -> DataFrame:
    return R.references(_steps(spark, d))


@query(f"WITH {_REFS} SELECT problem_id, pos, name FROM st WHERE type = 'construction' AND name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rf WHERE rf.problem_id = st.problem_id AND rf.ref = st.name AND rf.pos <> rf.ref_pos)")
def dead_steps(spark: SparkSession, d: str) -> DataFrame:
    return R.dead_steps(_steps(spark, d))


@query(f"WITH {_REFS} SELECT * FROM rf WHERE ref_pos >= pos")
def early_uses(spark: SparkSession, d: str) -> DataFrame:
    return R.early_uses(_steps(spark, d))


@query(f"WITH {STEPS} SELECT problem_id, pos, CASE WHEN coalesce(class, '') IN ('line', 'segment', 'ray') THEN NULL WHEN trim(coalesce(label, '')) <> '' THEN trim(label) ELSE name END AS caption, coalesce(type, '') <> 'construction' AS visible FROM st")
def captions(spark: SparkSession, d: str) -> DataFrame:
    rows = _steps(spark, d)
    return rows.select("problem_id", "pos", W.caption(F.struct("name", "class", "label")).alias("caption"), (F.coalesce("type", F.lit("")) != "construction").alias("visible"))


@query(_RESULTS + _BUILD + """SELECT problem_id, 'These steps failed: ' || array_to_string(sample_failure[1:6], '; ') AS request FROM bg WHERE NOT ok""")
def repair_requests(spark: SparkSession, d: str) -> DataFrame:
    """What is said about a figure that did not build: its first failed steps."""
    bad = G.gate_all(_built(spark, d)).where("not ok")
    return bad.select("problem_id", K.repair_request(F.col("sample_failure")).alias("request"))


#: Trials of a figure at random, as many as the gates ask for.
TRIALS_AT_RANDOM = 5


@query(f"""WITH {BUILT}, bg AS (SELECT problem_id, max(n_steps) AS total, arg_min(failed, trial) FILTER (len(failed) > 0) AS failed FROM bu GROUP BY problem_id),
{_PATHS[_PATHS.index("sx AS"):]},
rw AS (SELECT problem_id, count(*) AS rewrites, string_agg(name || ' = Point(' || path || ', ' || printf('%.4f', round(CAST(ordinal AS DECIMAL(18,6)) / (points + 1) + 1e-9, 4)) || ')', chr(10) ORDER BY pos) AS list FROM pn GROUP BY problem_id)
SELECT bg.problem_id, CAST(total AS INTEGER) AS total, CAST(coalesce(len(failed), 0) AS INTEGER) AS failed, coalesce(rewrites, 0) AS rewrites, list FROM bg LEFT JOIN rw USING (problem_id)""")
def render_status(spark: SparkSession, d: str) -> DataFrame:
    """Of each problem its steps, how many of them failed in the first trial that failed, and the parameters written into it."""
    steps = _steps(spark, d)
    paths = P.on_paths(steps).withColumn("t", P.even(F.col("ordinal"), F.col("points")))
    said = F.format_string("%s = Point(%s, %.4f)", "name", "path", "t")
    rewrites = paths.groupBy("problem_id").agg(F.count("*").alias("rewrites"), F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))).alias("r"))
    rows = G.gate_all(_built(spark, d)).join(G.point_steps(all_problems(spark, d), "problem_id"), "problem_id").join(rewrites, "problem_id", "left")
    listed = F.array_join(F.transform("r", lambda r: r["said"]), "\n")
    failed = F.coalesce(F.size("sample_failure"), F.lit(0))
    return rows.select("problem_id", F.col("n_steps").alias("total"), failed.alias("failed"), F.coalesce("rewrites", F.lit(0)).cast("long").alias("rewrites"), listed.alias("list"))


def _random(spark: SparkSession, d: str) -> DataFrame:
    return E.evaluate(P.at_random(_steps(spark, d), TRIALS_AT_RANDOM))


@query()
def evaluated_steps(spark: SparkSession, d: str) -> DataFrame:
    """Every step of every problem built by the evaluator in five trials at random; its conventions are its own, so there is no SQL."""
    return _random(spark, d)


@query()
def evaluator_checks(spark: SparkSession, d: str) -> DataFrame:
    """The problems' checks on figures that the evaluator built, by kind and outcome."""
    trials = G.trials_of(E.as_probes(_random(spark, d)))
    return G.checked(trials, G.checks_of(all_problems(spark, d), "problem_id")).groupBy("kind", "holds").agg(F.count("*").alias("n"))


@query()
def evaluator_report(spark: SparkSession, d: str) -> DataFrame:
    """Steps, and those that failed or are unsupported, of every figure with even parameters."""
    return E.report(E.evaluate(P.evenly(_steps(spark, d))))


@query()
def evaluator_failures(spark: SparkSession, d: str) -> DataFrame:
    """Of every trial at random the number of steps that gave no object."""
    return E.report(_random(spark, d)).select("problem_id", "trial", (F.col("failed") + F.col("unsupported")).alias("failed"))


def _points(built: DataFrame, steps: DataFrame) -> DataFrame:
    points = steps.where("class = 'point'").select("problem_id", "pos")
    return built.where("status = 'ok' AND x is not null").join(points, ["problem_id", "pos"]).select("problem_id", "trial", "pos", "name", "x", "y")


@query()
def evaluator_points(spark: SparkSession, d: str) -> DataFrame:
    """The points of figures with even parameters, to two places."""
    steps = _steps(spark, d)
    rows = _points(E.evaluate(P.evenly(steps)), steps)
    return rows.withColumns({c: W.rounded(F.col(c)) for c in ("x", "y")})


@query()
def evaluator_probes(spark: SparkSession, d: str) -> DataFrame:
    """The points of figures at random, in full precision."""
    steps = _steps(spark, d)
    return _points(_random(spark, d), steps)


@query()
def drag_probe(spark: SparkSession, d: str) -> DataFrame:
    """Of each point on a path whether another parameter moves it, by more than 0.000001."""
    steps = _steps(spark, d)
    on = P.on_paths(steps).select("problem_id", "pos", "path")
    at = lambda rows, n: _points(rows, steps).where("trial = 0").select("problem_id", "pos", F.col("x").alias(f"x{n}"), F.col("y").alias(f"y{n}"))
    both = at(E.evaluate(P.evenly(steps)), 1).join(at(E.evaluate(P.at_random(steps, 1)), 2), ["problem_id", "pos"]).join(on, ["problem_id", "pos"])
    return both.select("problem_id", "pos", "path", (F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) > 1e-6).alias("moved"))


@query()
def index_repair(spark: SparkSession, d: str) -> DataFrame:
    """Intersection indices flipped by building each figure, with even parameters, up to three times."""
    return E.fixed_indices(P.evenly(_steps(spark, d)))
