"""SQL of the queries of this subpackage that SQL can express on whole tables."""

_TOKENS = "coalesce(list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')), CAST([] AS VARCHAR[]))"
_COMMANDS = (
    "coalesce(list_distinct([regexp_replace(s.command, '\\s+', '', 'g') for s in {0} if s.command IS NOT NULL]), CAST([] AS VARCHAR[]))"
)


def _common(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


_ALIKE = """
  (st * 10 >= 7 * (na + nb - st) AND na + nb - st > 0)
  OR (st * 10 >= 5 * (na + nb - st) AND na + nb - st > 0 AND ca + cb - sc > 0 AND sc * 10 >= 8 * (ca + cb - sc))
"""

_WEIGHTED = f"""
WITH m AS (SELECT ex_id, unnest(messages) AS m FROM train),
x AS (SELECT DISTINCT ex_id AS k, list_sort({_TOKENS.format("m.content")}) AS t FROM m WHERE lower(trim(m.role)) = 'user'),
y AS (SELECT eval_id AS k, split, source, list_sort({_TOKENS.format("problem_statement")}) AS t FROM eval_problems),
c AS (SELECT 'x' AS side, t FROM (SELECT DISTINCT t FROM x WHERE len(t) > 0) UNION ALL SELECT 'y', t FROM (SELECT DISTINCT t FROM y WHERE len(t) > 0)),
u AS (SELECT side, t, unnest(t) AS w FROM c),
f AS (SELECT w, ln(1 + (SELECT count(*) FROM c) / count(*)) AS i FROM u GROUP BY w),
v AS (SELECT side, t, w, i / sqrt(sum(i * i) OVER (PARTITION BY side, t)) AS i FROM u JOIN f USING (w)),
d AS (SELECT p.t AS yt, q.t AS xt, sum(p.i * q.i) AS dot FROM v p JOIN v q USING (w) WHERE p.side = 'y' AND q.side = 'x' GROUP BY p.t, q.t HAVING sum(p.i * q.i) >= 0.8 - 1e-9),
r AS (SELECT y.k AS eval_id, x.k AS ex_id, max(dot) AS dot FROM d JOIN y ON y.t = d.yt JOIN x ON x.t = d.xt GROUP BY y.k, x.k)
"""

SQL = {
    "p3_found": f"""
WITH s AS (SELECT problem_key AS k, {_TOKENS.format("problem_statement")} AS t, {_COMMANDS.format("construction_steps")} AS c FROM problems),
p AS (SELECT a.k AS key_a, b.k AS key_b, {_common("a.t", "b.t")} AS st, len(a.t) AS na, len(b.t) AS nb,
             {_common("a.c", "b.c")} AS sc, len(a.c) AS ca, len(b.c) AS cb
      FROM s a JOIN s b ON a.k < b.k)
SELECT key_a, key_b FROM p WHERE {_ALIKE}
""",
    "p4_found": f"""
WITH m AS (SELECT ex_id, unnest(messages) AS m FROM train),
x AS (SELECT DISTINCT ex_id, {_TOKENS.format("m.content")} AS t FROM m WHERE lower(trim(m.role)) = 'user'),
y AS (SELECT eval_id, {_TOKENS.format("problem_statement")} AS t FROM eval_problems),
p AS (SELECT y.eval_id, x.ex_id, {_common("y.t", "x.t")} AS s, len(y.t) + len(x.t) AS n
      FROM y, x WHERE len(y.t) * 10 >= 7 * len(x.t) AND len(x.t) * 10 >= 7 * len(y.t) AND len(x.t) > 0)
SELECT DISTINCT eval_id, ex_id FROM p WHERE s * 10 >= 7 * (n - s)
""",
    "p2_found": """
WITH RECURSIVE m AS (SELECT ex_id, source, id, unnest(messages) AS m FROM train),
a AS (SELECT ex_id, regexp_extract(m.content, '\\{.*\\}', 0, 's') AS j FROM m WHERE lower(trim(m.role)) = 'assistant'),
c AS (SELECT ex_id, [regexp_replace(x ->> '$.command', '\\s+', '', 'g') for x in CAST(json_extract(j, '$.construction_steps') AS JSON[])] AS c
      FROM a WHERE j <> '' AND json_valid(j) AND json_type(j, '$.construction_steps') = 'ARRAY' AND json_array_length(j, '$.construction_steps') > 0),
k AS (SELECT ex_id, 'i' || source || '/' || id AS k FROM train WHERE source IS NOT NULL AND id IS NOT NULL
      UNION SELECT ex_id, 'c' || array_to_string(c, chr(31)) FROM c),
e AS (SELECT DISTINCT x.ex_id AS a, y.f AS b FROM k x JOIN (SELECT k, min(ex_id) AS f FROM k GROUP BY k) y USING (k)),
b AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w AS (SELECT a, b AS g FROM b UNION SELECT w.a, b.b FROM w JOIN b ON w.g = b.a),
g AS (SELECT a AS ex_id, min(g) AS group_id FROM w GROUP BY a),
n AS (SELECT group_id FROM g GROUP BY group_id HAVING count(*) > 1)
SELECT ex_id, group_id FROM g WHERE group_id IN (SELECT group_id FROM n)
""",
    "p4_counts": f"""
WITH m AS (SELECT ex_id, unnest(messages) AS m FROM train),
x AS (SELECT DISTINCT ex_id, {_TOKENS.format("m.content")} AS t FROM m WHERE lower(trim(m.role)) = 'user'),
y AS (SELECT eval_id, split, source, {_TOKENS.format("problem_statement")} AS t FROM eval_problems),
p AS (SELECT y.eval_id, x.ex_id, {_common("y.t", "x.t")} AS s, len(y.t) + len(x.t) AS n
      FROM y, x WHERE len(y.t) * 10 >= 7 * len(x.t) AND len(x.t) * 10 >= 7 * len(y.t) AND len(x.t) > 0),
f AS (SELECT eval_id, count(DISTINCT ex_id) AS n FROM p WHERE s * 10 >= 7 * (n - s) GROUP BY eval_id)
SELECT split, source, count(*) AS held_out_rows, count(f.n) AS overlapping_rows, CAST(coalesce(sum(f.n), 0) AS BIGINT) AS pairs
FROM y LEFT JOIN f USING (eval_id) GROUP BY split, source
""",
    "p4_weighted": _WEIGHTED + "SELECT eval_id, ex_id, round(dot, 6) AS cosine FROM r",
    "p4_weighted_counts": _WEIGHTED
    + """
, n AS (SELECT eval_id, count(*) AS n FROM r GROUP BY eval_id)
SELECT split, source, count(*) AS held_out_rows, count(n.n) AS overlapping_rows, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS pairs
FROM y LEFT JOIN n ON n.eval_id = y.k GROUP BY split, source
""",
    "p2_balance": """
SELECT p.split, t.source, round(p.fraction / (SELECT sum(fraction) FROM split_plan) * t.n, 4) AS planned, true AS "within"
FROM split_plan p, (SELECT source, count(*) AS n FROM train GROUP BY source) t
""",
    "p3_groups": f"""
WITH RECURSIVE s AS (SELECT problem_key AS k, list_sort({_TOKENS.format("problem_statement")}) AS t, list_sort({_COMMANDS.format("construction_steps")}) AS c FROM problems),
g AS (SELECT t, c, min(k) AS g FROM s WHERE len(t) > 0 GROUP BY t, c),
m AS (SELECT s.k, coalesce(g.g, s.k) AS class_id FROM s LEFT JOIN g ON s.t = g.t AND s.c = g.c),
p AS (SELECT a.g AS a, b.g AS b, {_common("a.t", "b.t")} AS st, len(a.t) AS na, len(b.t) AS nb, {_common("a.c", "b.c")} AS sc, len(a.c) AS ca, len(b.c) AS cb FROM g a JOIN g b ON a.g <> b.g),
l AS (SELECT a, b FROM p WHERE {_ALIKE}),
w AS (SELECT a, b AS r FROM l UNION SELECT w.a, l.b FROM w JOIN l ON w.r = l.a),
r AS (SELECT a, least(a, min(r)) AS r FROM w GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.k AS problem_key, class_id, coalesce(r.r, class_id) AS group_id, coalesce(n.n, 0) AS links FROM m LEFT JOIN r ON r.a = class_id LEFT JOIN n ON n.a = class_id
""",
    "p5_found": f"""
WITH RECURSIVE s AS (SELECT new_id AS k, row_number() OVER (ORDER BY batch_id NULLS LAST, new_id) AS i, {_TOKENS.format("problem_statement")} AS t, {_COMMANDS.format("construction_steps")} AS c FROM new_geometry_problems),
h AS (SELECT {_TOKENS.format("problem_statement")} AS t, {_COMMANDS.format("construction_steps")} AS c FROM problems
      UNION ALL SELECT {_TOKENS.format("problem_statement")}, {_COMMANDS.format("construction_steps")} FROM fewshot_problems),
o AS (SELECT a.i, CAST(NULL AS BIGINT) AS j, {_common("a.t", "b.t")} AS st, len(a.t) AS na, len(b.t) AS nb, {_common("a.c", "b.c")} AS sc, len(a.c) AS ca, len(b.c) AS cb FROM s a, h b
      UNION ALL SELECT a.i, b.i, {_common("a.t", "b.t")}, len(a.t), len(b.t), {_common("a.c", "b.c")}, len(a.c), len(b.c) FROM s a JOIN s b ON b.i < a.i),
e AS MATERIALIZED (SELECT i, bool_or(j IS NULL) AS old, list(j) FILTER (j IS NOT NULL) AS earlier FROM o WHERE {_ALIKE} GROUP BY i),
q AS MATERIALIZED (SELECT s.i, coalesce(e.old, false) AS old, coalesce(e.earlier, CAST([] AS BIGINT[])) AS earlier FROM s LEFT JOIN e USING (i)),
f AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept
      UNION ALL SELECT q.i, CASE WHEN q.old OR list_has_any(f.kept, q.earlier) THEN f.kept ELSE list_append(f.kept, q.i) END FROM f JOIN q ON q.i = f.i + 1),
z AS (SELECT kept FROM f ORDER BY i DESC LIMIT 1)
SELECT k AS new_id FROM s, z WHERE NOT list_contains(z.kept, s.i)
""",
}
