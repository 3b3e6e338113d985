import json

from pyspark.sql import functions as F

from stepquarry.operators import nested as N

SCHEMA = "line_no long, record string, node string, `table` string"


def rows(spark, *records):
    return spark.createDataFrame([(i, r, "clash", "clash") for i, r in enumerate(records)], SCHEMA)


def found(spark, *records):
    return {tuple(r) for r in N.candidate_rows(rows(spark, *records)).collect()}


def test_what_counts_as_a_record(spark):
    step = '{"construction_steps": [{"name": "A"}]}'
    records = [
        None, "", " \n", step, " \t" + step + " \n", "[" + step + "]", step + " trailing", step + step, step[:-1],
        step.replace('"', "'"), '{"construction_steps": [{"name": NaN}]}', '{"problem": ' + step + "}", '{"problem": [1], "construction_steps": [{"name": "B"}]}',
        json.dumps({"construction_steps": json.dumps([{"name": "C"}])}), json.dumps({"construction_steps": "[1,"}), json.dumps({"construction_steps": {"name": "D"}}),
    ]
    assert {(r[0], r[4]) for r in found(spark, *records)} == {(3, "A"), (4, "A"), (11, "A"), (12, "B"), (13, "C")}


def test_positions_names_and_arguments(spark):
    record = {
        "construction_steps": [None, {"name": None}, "x", {"type": "final"}, [{"name": "no"}], {"name": "Z", "style": {"name": "s"}}],
        "checks": [
            {"type": "t", "point": "P", "lines": [["A", "B"], [1, None, "C"]], "k": {"list": [{"key": "v", "type": "inner"}]}, "deg": 3, "flag": True},
            None,
            ["S"],
            {"a": ""},
        ],
    }
    assert found(spark, json.dumps(record)) == {
        (0, "step", 1, "", ""), (0, "step", 3, "", ""), (0, "step", 5, "", "Z"),
        (0, "check", 0, "", "t"), (0, "check", 3, "", ""),
        (0, "arg", 0, "point", "P"), (0, "arg", 0, "lines[0][0]", "A"), (0, "arg", 0, "lines[0][1]", "B"), (0, "arg", 0, "lines[1][2]", "C"),
        (0, "arg", 0, "k.list[0].key", "v"), (0, "arg", 0, "k.list[0].type", "inner"), (0, "arg", 3, "a", ""),
    }


def test_merged_schema_and_child_tables_keep_links(spark):
    records = ['{"a": [{"x": 1, "X": true}, {"x": 2.5, "_key": "k"}], "o": {"p": "q"}}', '{"a": [{"x": null, "b": [[1, 2], ["s"]]}], "o": null}']
    nodes = N.settled_nodes(N.shred(rows(spark, *records), "line_no", "record"))
    kinds = {(r["table"], r["field"]): r["kinds"] for r in N.merged_schema(nodes).collect()}
    assert kinds["", "o"] == ["null", "object"] and kinds["a", "x"] == ["double", "long", "null"] and kinds["a.b[]", ""] == ["long", "string"]
    tables = {k: t.frame for k, t in N.child_tables(nodes, "line_no").items()}
    types = dict(tables["a"].dtypes)
    assert (types["X"], types["x_2"], types["_key_2"], types["_key"]) == ("boolean", "double", "string", "bigint")
    child, parent = tables["a.b[]"], tables["a.b"]
    orphans = child.join(parent, (child["_key"] == parent["_key"]) & (child["_parent"] == parent["_node"]) & (child["_parent_path"] == parent["_path"]), "left_anti")
    assert child.count() == 3 and orphans.count() == 0
    # strings and numbers of one field are kept apart
    assert {(r["value_string"], r["value_number"]) for r in child.collect()} == {(None, 1), (None, 2), ("s", None)}


def test_integers_stay_as_they_are(spark):
    big = ["9007199254740993", "-9223372036854775808", "9223372036854775808", "1" * 30, "1e3", "1" * 50]
    def column(*numbers):
        (t,) = N.child_tables(N.shred(rows(spark, *[f'{{"n": {n}}}' for n in numbers]), "line_no", "record"), "line_no").values()
        return dict(t.frame.dtypes)["n"], sorted(str(r["n"]) for r in t.frame.collect())

    assert column(*big[:2]) == ("bigint", sorted(big[:2])) and column(*big[:4]) == ("decimal(38,0)", sorted(big[:4]))
    assert column(big[0], big[4])[0] == "double" and column(big[5])[0] == "double"


def test_keys_that_are_data_stay_in_a_map(spark):
    step = lambda i: {"name": f"n{i}", f"k{i}": f"v{i}"}
    records = [json.dumps({"construction_steps": [step(i)], "checks": [{"type": "t", "point": "P", f"k{i}": f"v{i}", f"list{i}": ["x"]}]}) for i in range(30)]
    few = {tuple(r) for r in N.candidate_rows(rows(spark, *records), most=6).collect()}
    assert few == found(spark, *records) and len(few) == 30 * 5
    tables = N.candidate_tables(rows(spark, *records), most=6)
    assert "*" in tables and len(tables["checks"].columns) < 6 and tables["*"].frame.count() >= 30


def test_nodes_are_numbered_as_they_stand():
    nodes = list(N.nodes_of(N.strict('{"a": [{"b": [1, 2]}, 3], "c": {"d": [4]}}')))
    assert [(n[0], n[1], n[4], n[5]) for n in nodes] == [(0, -1, "", None), (1, 0, "a[0]", ""), (2, 1, "a[0].b[0]", "a[0]"), (3, 1, "a[0].b[1]", "a[0]"), (4, 0, "a[1]", ""), (5, 0, "c.d[0]", "")]


def test_depth_length_and_emptiness(spark):
    deep = '{"checks": [{"type": "t", "a": ' + "[" * 200 + '"s"' + "]" * 200 + "}]}"
    wide = json.dumps({"construction_steps": [{"name": str(i)} for i in range(50_000)]})
    too_deep = '{"checks": ' + "[" * 100_000 + "]" * 100_000 + "}"
    got = N.candidate_rows(rows(spark, deep, wide, too_deep, '{"construction_steps": [{"name": "\\ud800"}]}')).groupBy("line_no").count().collect()
    assert {r[0]: r[1] for r in got} == {0: 2, 1: 50_000, 3: 1}
    assert N.candidate_rows(rows(spark, None).limit(0)).count() == 0
    assert N.child_tables(N.shred(rows(spark, None), "line_no", "record"), "line_no") == {}


def test_repeated_rows_repeat(spark):
    one = rows(spark, '{"construction_steps": [{"name": "A"}]}')
    assert N.candidate_rows(one.union(one)).where(F.col("val") == "A").count() == 2
