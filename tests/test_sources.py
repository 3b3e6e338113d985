import json

import pytest
from pyspark.sql import functions as F

from stepquarry.sources import jsonl, sinks
from stepquarry.streaming import curation

GOOD = [{"id": 1, "problem_statement": "a", "construction_steps": [{"name": "A"}], "checks": [{"type": "parallel", "a": ["P", "Q"]}]}, {"id": 2, "problem_statement": "é"}]


def lines(tmp_path, *extra):
    p = tmp_path / "in.jsonl"
    p.write_text("\n".join([json.dumps(GOOD[0]), "", "   ", json.dumps(GOOD[1]), *extra]) + "\n")
    return str(p)


def test_strict_and_tolerant_scans(spark, tmp_path):
    assert jsonl.strict(spark, lines(tmp_path)).count() == 2
    bad = lines(tmp_path, '{"id": 3, "problem')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        jsonl.strict(spark, bad).collect()
    assert jsonl.tolerant(spark, bad).select("id").where("id is not null").count() == 2
    assert jsonl.if_there(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_keyed_and_ordered(spark):
    rows = spark.createDataFrame([(1, 5, "x"), (2, 6, "y"), (3, 5, "z")], "line long, id long, v string")
    got = {(r["id"], r["v"], r["first_position"]) for r in jsonl.last_of_each(rows, "id", "line").collect()}
    assert got == {(5, "z", 1), (6, "y", 2)}
    assert [r["id"] for r in jsonl.in_order(rows, "id", [6, 5]).collect()] == [6, 5, 5]
    assert jsonl.in_order(rows, "id", [99], 2, "line").count() == 2


def test_load_error(spark):
    rows = spark.createDataFrame([("{",), ("{}",), ('{"construction_steps": []}',), (None,), (" \n",)], "t string")
    assert [r[0] for r in rows.select(jsonl.load_error(F.col("t"))).collect()] == ["not_json", "no_steps", None, "empty", "empty"]


def test_sinks(spark, tmp_path):
    some = spark.createDataFrame([(2, "b"), (1, "a")], "id long, v string")
    path = str(tmp_path / "out")
    assert sinks.append_accepted(some, path) and not sinks.append_accepted(some.limit(0), path) and sinks.append_accepted(some, path)
    assert spark.read.json(path).count() == 4
    assert not sinks.write_rejects(some.limit(0), path, only_if_any=True) and spark.read.json(path).count() == 4
    assert sinks.write_rejects(some.limit(0), path, only_if_any=False)
    assert not sinks.keep(some, None)
    assert json.loads(sinks.array_report(some, "id").first()["report"]) == [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}]


def test_stream_takes_each_statement_once(spark, tmp_path):
    schema = "new_id long, problem_statement string, construction_steps array<struct<name:string>>, submitted_at timestamp"
    rows = [(1, " a", [("x",)], "2031-01-01 00:00:00"), (2, "a", [("x",)], "2031-01-01 01:00:00"), (3, "b", [], "2031-01-01 00:00:00"), (4, "known", [("x",)], "2031-01-01 00:00:00")]
    inbox = str(tmp_path / "inbox")
    spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("submitted_at", F.col("submitted_at").cast("timestamp")).write.parquet(inbox)
    fresh = curation.novel(curation.candidates(spark, inbox, schema), spark.createDataFrame([("known",)], "problem_statement string"))
    out = str(tmp_path / "out")
    curation.append(fresh.select("new_id"), out, str(tmp_path / "mark")).awaitTermination()
    assert spark.read.schema("new_id long").json(out).count() == 1
