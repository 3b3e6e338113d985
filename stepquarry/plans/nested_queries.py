"""Queries over raw candidate records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepquarry.operators import nested
from stepquarry.plans.registry import query
from stepquarry.sources.tables import table

_OPENED = r"""
WITH RECURSIVE r AS (SELECT line_no, trim(record, E' \t\n\r') AS t FROM raw_candidates),
o AS (SELECT line_no, CAST(t AS JSON) AS j FROM r WHERE t LIKE '{%' AND json_valid(t)),
p AS (SELECT line_no, CASE WHEN json_type(j, '$.problem') = 'OBJECT' THEN json_extract(j, '$.problem') ELSE j END AS j FROM o),
l AS (SELECT line_no, 'step' AS child, json_extract(j, '$.construction_steps') AS v FROM p
      UNION ALL SELECT line_no, 'check', json_extract(j, '$.checks') FROM p),
m AS (SELECT line_no, child, CASE WHEN json_type(v) = 'VARCHAR' AND json_valid(v ->> '$') THEN CAST(v ->> '$' AS JSON) ELSE v END AS v FROM l),
e AS (SELECT m.line_no, m.child, CAST(i.key AS BIGINT) AS pos, i.value AS v
      FROM m, json_each(CASE WHEN json_type(m.v) = 'ARRAY' THEN m.v ELSE CAST('[]' AS JSON) END) AS i
      WHERE json_type(i.value) = 'OBJECT')
"""


@query(
    _OPENED
    + """
SELECT line_no, child, pos, '' AS arg,
       coalesce(CASE WHEN child = 'step' THEN v ->> '$.name' ELSE v ->> '$.type' END, '') AS val FROM e
UNION ALL
SELECT e.line_no, 'arg', e.pos, substr(t.fullkey, 3), t.atom ->> '$'
FROM e, json_tree(e.v) AS t
WHERE e.child = 'check' AND t.type = 'VARCHAR' AND t.fullkey <> '$.type'
"""
)
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.candidate_rows(table(spark, d, "raw_candidates"))


def _or_none(spark: SparkSession, rows: DataFrame | None, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema) if rows is None else rows


_STEP = ("name", "type", "class", "label", "command")
_LINKS = "'{0}[' || pos || ']' AS path, '' AS parent_path, pos"


@query(_OPENED + f"""SELECT line_no, {_LINKS.format("construction_steps")}, v ->> '$.name' AS name, v ->> '$.type' AS "type", v ->> '$.class' AS "class",
       v ->> '$.label' AS label, v ->> '$.command' AS command
FROM e WHERE child = 'step'
""")
def p1_steps(spark: SparkSession, d: str) -> DataFrame:
    """The child table of steps, each with its key within the record, its parent's and its ordinal."""
    rows = nested.members(nested.candidate_tables(table(spark, d, "raw_candidates")), "construction_steps", *_STEP)
    return _or_none(spark, rows, "line_no long, node int, parent int, path string, parent_path string, pos long, " + ", ".join(f"{n} string" for n in _STEP)).drop("node", "parent")


@query(_OPENED + f"""SELECT line_no, {_LINKS.format("checks")}, v ->> '$.type' AS "type", TRY_CAST(v ->> '$.deg' AS DOUBLE) AS deg FROM e WHERE child = 'check'""")
def p1_checks(spark: SparkSession, d: str) -> DataFrame:
    """The child table of checks."""
    rows = nested.members(nested.candidate_tables(table(spark, d, "raw_candidates")), "checks", "type", "deg")
    rows = _or_none(spark, rows, "line_no long, node int, parent int, path string, parent_path string, pos long, type string, deg string")
    return rows.withColumn("deg", F.expr("try_cast(deg as double)")).drop("node", "parent")


@query(_OPENED + r""", a AS (SELECT e.line_no, e.pos, substr(t.fullkey, 3) AS arg, t.atom ->> '$' AS val FROM e, json_tree(e.v) AS t
WHERE e.child = 'check' AND t.type = 'VARCHAR' AND t.fullkey <> '$.type')
SELECT line_no, 'checks[' || pos || ']' || CASE WHEN contains(arg, ']') THEN '.' || regexp_extract(arg, '^(.*\])', 1) ELSE '' END AS path, pos, arg, val FROM a
""")
def p1_args(spark: SparkSession, d: str) -> DataFrame:
    """The child table of check arguments; path is the key of the row that holds the string, within its check at pos."""
    rows = nested.check_arguments(nested.candidate_tables(table(spark, d, "raw_candidates")))
    return _or_none(spark, rows, "line_no long, node int, path string, pos long, arg string, val string").drop("node")


#: Every JSON value of the opened records: its level, the field it is within its row, and its kind.
_VALUES = _OPENED + r"""
, w AS (SELECT p.line_no, json_merge_patch(p.j, coalesce((SELECT json_group_object(CASE m.child WHEN 'step' THEN 'construction_steps' ELSE 'checks' END, m.v) FROM m
          WHERE m.line_no = p.line_no AND json_type(m.v) = 'ARRAY'), '{}')) AS j FROM p),
v AS (SELECT w.line_no, substr(t.fullkey, 2) AS k, t.type, t.value, t.atom FROM w, json_tree(w.j) AS t),
n AS (SELECT *, regexp_matches(k, '\]$') OR k = '' AS own, regexp_extract(k, '^(.*\])', 1) AS rowkey FROM v),
x AS (SELECT line_no, own, rowkey, ltrim(regexp_replace(regexp_replace(rowkey, '\[[0-9]+\]', '[]', 'g'), '\[\](\.|$)', '\1', 'g'), '.') AS "table",
             CASE WHEN own THEN '' ELSE regexp_extract(k, '\]?\.([^\]]*)$', 1) END AS field,
             CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'long' WHEN 'UBIGINT' THEN CASE WHEN CAST(atom ->> '$' AS HUGEINT) < 9223372036854775808 THEN 'long' ELSE 'decimal' END
                  ELSE lower(type) END AS kind FROM n)
"""


@query(_VALUES + """SELECT "table", field, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds, count(*) AS rows FROM x
WHERE NOT own OR kind NOT IN ('array', 'object') GROUP BY "table", field""")
def p1_schema(spark: SparkSession, d: str) -> DataFrame:
    """The merged schema of all records."""
    rows = nested.merged_schema(_nodes(spark, d))
    return rows.select("table", "field", F.array_join("kinds", ",").alias("kinds"), "rows")


@query(_VALUES + r""", rw AS (SELECT *, CASE WHEN rowkey = '' THEN '' ELSE regexp_extract(regexp_replace(rowkey, '\[[0-9]+\]$', ''), '^(.*\])', 1) END AS up,
       CAST(nullif(regexp_extract(rowkey, '\[([0-9]+)\]$', 1), '') AS INTEGER) AS ordinal FROM x WHERE own)
SELECT "table", count(*) AS rows, count(DISTINCT (line_no, up)) AS parents, coalesce(max(ordinal), -1) AS last_ordinal FROM rw GROUP BY "table" """)
def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """Rows and parents of every array level: no child without its parent."""
    nodes = _nodes(spark, d)
    return nodes.groupBy("table").agg(F.count("*").alias("rows"), F.count_distinct("line_no", "parent").alias("parents"), F.max("ordinal").alias("last_ordinal"))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return nested.shred(table(spark, d, "raw_candidates"), "line_no", "record", **nested.RECORD)
