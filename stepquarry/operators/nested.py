"""Deeply nested JSON records to related flat tables.

``shred`` parses every record once and explodes every array level, however deep,
in the same pass: one row for the record and one for each member of each array,
carrying the record's key, a surrogate key, its parent's surrogate key and its
ordinal. ``settled_nodes`` writes these rows once, parted by array level, so that a
later read of one level reads no other. ``merged_schema`` merges what all rows hold
into one schema, and ``child_tables`` lays the rows out as one typed table a level.

Parsing runs in Arrow batches in Python: a record must be strict JSON as a whole
(the JVM's parsers stop at the end of the first value and so accept trailing
text), and a single pass replaces one scan a level. Nothing is shuffled but the
schema's rows, one a (table, field, kind) and task.

Defined results: a null, blank or damaged record and one that is no object give
no row; of a repeated member the last counts; a record nested deeper than the
parser's limit counts as damaged; repeated keys give repeated rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepquarry.plans.runtime import shared_path

NODE = "node int, parent int, table string, ordinal int, path string, parent_path string, kind string, fields map<string,string>, kinds map<string,string>"
_ROWS = 20_000
#: Fields, commonest first, that get columns of their own; where keys are data the others stay in a map, and are not collected.
MOST_FIELDS = 10_000
#: Folders by which settled nodes are parted.
PARTS = 64


class _Integer(str):
    """A JSON number without point and exponent, kept as it was written."""


class _Number(str):
    """Any other JSON number, kept as it was written."""


def _no_constant(name: str) -> None:
    raise ValueError(name)


_decoder = json.JSONDecoder(parse_int=_Integer, parse_float=_Number, parse_constant=_no_constant)


def strict(text: str | None) -> Any:
    """The value of ``text`` if it is one strict JSON value apart from white space around it; else None."""
    if text is None:
        return None
    text = text.strip()
    try:
        value, end = _decoder.raw_decode(text)
    except (ValueError, RecursionError):
        return None
    return value if end == len(text) else None


def kind_of(value: Any) -> str:
    """null, boolean, long, decimal (an integer too large for long), double, string, array or object."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, _Integer):
        return "long" if len(value) < 19 or len(value) < 21 and -(2**63) <= int(value) < 2**63 else "decimal" if len(value.lstrip("-")) <= 38 else "double"
    if isinstance(value, _Number):
        return "double"
    return "string" if isinstance(value, str) else "array" if isinstance(value, list) else "object"


def _text(value: Any) -> str | None:
    if value is None or isinstance(value, (list, dict)):
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    try:
        value.encode()
        return str(value)
    except UnicodeEncodeError:  # half of a surrogate pair
        return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def nodes_of(record: dict) -> Iterator[tuple]:
    """Rows as in NODE, numbered as they stand in the record, parents before children."""
    todo: list[tuple] = [(record, -1, "", -1, "", None)]
    n = -1
    while todo:
        value, parent, table, ordinal, path, above = todo.pop()
        n += 1
        fields: dict[str, str | None] = {}
        kinds: dict[str, str] = {}
        below: list[tuple] = []
        inner = [("", value)]
        while inner:  # the objects directly below are flattened into dotted names
            name, v = inner.pop()
            if name or not isinstance(v, (dict, list)):
                fields[name], kinds[name] = _text(v), kind_of(v)
            if isinstance(v, dict):
                inner += [(f"{name}.{_text(k)}" if name else _text(k), x) for k, x in reversed(v.items())]
            elif isinstance(v, list):
                level = (f"{table}.{name}" if table else name) if name else f"{table}[]"
                at = f"{path}.{name}" if path and name else path or name
                below += [(x, n, level, i, f"{at}[{i}]", path) for i, x in enumerate(v)]
        yield n, parent, table, ordinal, path, above, kind_of(value), list(fields.items()), list(kinds.items())
        todo += reversed(below)


def opened(text: str | None, unwrap: str | None, embedded: Iterable[str]) -> dict | None:
    """The record's object: the member ``unwrap`` in its place if that is an object, and lists held as JSON text in ``embedded`` members opened."""
    record = strict(text)
    if not isinstance(record, dict):
        return None
    if unwrap and isinstance(record.get(unwrap), dict):
        record = record[unwrap]
    for name in embedded:
        if kind_of(record.get(name)) == "string":
            held = strict(record[name])
            if isinstance(held, list):
                record = record | {name: held}
    return record


def shred(records: DataFrame, key: str, text: str, *, unwrap: str | None = None, embedded: tuple[str, ...] = ()) -> DataFrame:
    """(key, NODE columns) of the JSON in column ``text``.

    node numbers the rows of a record from 0, its root, in the order of the record;
    parent is -1 and parent_path null for the root. table names the array level: '' for records, `a` or `a.b` for arrays that are
    members, `a[]` for arrays in arrays. fields and kinds hold the scalar members
    (of objects below too, by dotted names) as text and their kinds; a member that
    is no object has them under ''.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, *[pa.int32()] * 2, pa.string(), pa.int32(), *[pa.string()] * 3, *[pa.map_(pa.string(), pa.string())] * 2]
        names = [key, *[c.split()[0] for c in NODE.split(", ")]]

        def packed(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t or key_type) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            rows: list[tuple] = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                record = opened(t, unwrap, embedded)
                for node in nodes_of(record) if record is not None else ():
                    rows.append((k, *node))
                    if len(rows) >= _ROWS:
                        yield packed(rows, batch.column(0).type)
                        rows = []
            if rows:
                yield packed(rows, batch.column(0).type)

    source = records.select(key, text)
    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, {NODE}")


def settled_nodes(nodes: DataFrame) -> DataFrame:
    """The rows of ``shred``, written once and read back, parted by array level."""
    path = shared_path(nodes.sparkSession, "nodes")
    nodes.withColumn("_part", _part(F.col("table"))).write.partitionBy("_part").parquet(path)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.sparkSession.read.schema(f"{kinds}, _part int").parquet(path)


def _part(table: Column) -> Column:
    return F.pmod(F.xxhash64(table), F.lit(PARTS)).cast("int")


def merged_schema(nodes: DataFrame) -> DataFrame:
    """(table, field, kinds, rows): all kinds that a field has anywhere, sorted, and how many rows have it."""
    return _schema(nodes).where("field is not null")


def _schema(nodes: DataFrame) -> DataFrame:
    """As merged_schema; a level with rows that have no fields has a null field as well."""
    each = nodes.select("table", F.explode_outer("kinds").alias("field", "kind"))
    counts = each.groupBy("table", "field", "kind").agg(F.count("*").alias("n"))
    return counts.groupBy("table", "field").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.sum("n").alias("rows"))


@dataclass
class Table:
    """A child table; ``columns`` are (column, field, kind), kind being string, number or boolean."""

    frame: DataFrame
    columns: list[tuple[str, str, str]]


KEYS = ("_key", "_node", "_parent", "_ordinal", "_path", "_parent_path", "_kind")
_NUMBERS = {"long": "bigint", "decimal": "decimal(38,0)", "double": "double"}


def _typed(kinds: list[str]) -> list[tuple[str, str, list[str]]]:
    """The columns of a field: (kind, type, kinds taken); integers stay integers where all of a field's numbers are."""
    numbers = [k for k in _NUMBERS if k in kinds]
    out = [("string", "string", ["string"])] if "string" in kinds else []
    out += [("number", _NUMBERS[numbers[-1]], numbers)] if numbers else []
    out += [("boolean", "boolean", ["boolean"])] if "boolean" in kinds else []
    # a field that is always null is a string; the content of arrays and objects is in tables and dotted fields
    return out or ([("string", "string", ["string"])] if kinds == ["null"] else [])


def child_tables(nodes: DataFrame, key: str, most: int = MOST_FIELDS) -> dict[str, Table]:
    """One table an array level by the merged schema, of which the ``most`` commonest (table, field) are collected.

    Every table has the columns KEYS, then one for each field: string, boolean,
    bigint, decimal(38,0) or double. A field that holds several of strings, numbers
    and booleans has a column for each, named field_kind, so nothing is cast away.
    Names that differ in case only, or clash, get a number. If there are more fields
    than ``most``, tables have ``_more`` and ``_more_kinds`` as well, maps of those left
    over, and levels without any collected field are in the table ``*`` as they are.
    """
    fields: dict[str, list[tuple[str, list[str]]]] = {}
    rows = _schema(nodes).orderBy(F.desc("rows"), "table", "field").limit(most + 1).collect()
    whole = len(rows) <= most
    for r in sorted(rows[:most], key=lambda r: (r["table"], r["field"] or "")):
        own = fields.setdefault(r["table"], [])
        if r["field"] is not None:
            own.append((r["field"], r["kinds"]))
    out = {}
    for t, found in fields.items():
        columns = [F.col(key).alias("_key"), *[F.col(c[1:]).alias(c) for c in KEYS[1:]]]
        taken, laid = set(KEYS) | {"_more", "_more_kinds"}, []
        for name, kinds in found:
            typed = _typed(kinds)
            for kind, cast, own in typed:
                stem = name or "value"
                stem = f"{stem}_{kind}" if len(typed) > 1 else stem
                alias, n = stem, 1
                while alias.lower() in taken:
                    n += 1
                    alias = f"{stem}_{n}"
                taken.add(alias.lower())
                value = F.col("fields")[name]
                if len(typed) > 1:
                    value = F.when(F.col("kinds")[name].isin(own), value)
                columns.append((value if cast == "string" else value.cast(cast)).alias(alias))
                laid.append((alias, name, kind))
        if not whole:
            rest = lambda m: F.map_filter(m, lambda k, _: ~k.isin([n for n, _ in found]))  # noqa: B023, E731
            columns += [rest("fields").alias("_more"), rest("kinds").alias("_more_kinds")]
        part = F.col("_part") == _part(F.lit(t)) if "_part" in nodes.columns else F.lit(True)
        out[t] = Table(nodes.where(part & (F.col("table") == t)).select(*columns), laid)
    if not whole:
        out["*"] = Table(nodes.where(~F.col("table").isin(list(fields))), [])
    return out


RECORD = {"unwrap": "problem", "embedded": ("construction_steps", "checks")}


def candidate_tables(records: DataFrame, most: int = MOST_FIELDS) -> dict[str, Table]:
    """The child tables of raw candidates (line_no, record): steps, checks, and every array below them."""
    return child_tables(settled_nodes(shred(records, "line_no", "record", **RECORD)), "line_no", most)


def as_text(table: Table, field: str) -> Column:
    """A scalar field as text, whatever its kinds; null where it has none."""
    columns = [F.col(f"`{c}`").cast("string") for c, f, _ in table.columns if f == field]
    if "_more" in table.frame.columns:
        columns.append(F.col("_more")[field])
    return F.coalesce(*columns, F.lit(None).cast("string"))


def members(tables: dict[str, Table], level: str, *fields: str) -> DataFrame | None:
    """(line_no, node, parent, path, parent_path, pos, fields) of the objects of an array of the record; none if no record has it."""
    if level not in tables:
        return None
    t = tables[level]
    rows = t.frame.where("_kind = 'object'")
    return rows.select(F.col("_key").alias("line_no"), F.col("_node").alias("node"), F.col("_parent").alias("parent"), F.col("_path").alias("path"), F.col("_parent_path").alias("parent_path"), F.col("_ordinal").cast("long").alias("pos"), *[as_text(t, f).alias(f) for f in fields])


def check_arguments(tables: dict[str, Table]) -> DataFrame | None:
    """(line_no, node, path, pos, arg, val): each string below a check, which is at pos, but its own type; node and path are of the row that holds it."""
    at = r"^checks\[([0-9]+)\]"
    out = None
    for level, t in tables.items():
        if level != "checks" and not level.startswith("checks.") and level != "*":
            continue
        if level == "*":
            rows = t.frame.where(F.col("table").startswith("checks.")).select(F.col("line_no").alias("_key"), F.col("node").alias("_node"), F.col("path").alias("_path"), F.col("fields").alias("_more"), F.col("kinds").alias("_more_kinds"))
        else:
            rows = t.frame.where("_kind = 'object'") if level == "checks" else t.frame
        held = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{c}`").alias("val")) for c, f, kind in t.columns if kind == "string"]).cast("array<struct<field:string,val:string>>")
        if "_more" in rows.columns:
            more = F.filter(F.map_entries("_more"), lambda e: F.element_at("_more_kinds", e["key"]) == "string")
            held = F.concat(held, F.transform(more, lambda e: F.struct(e["key"].alias("field"), e["value"].alias("val"))))
        rows = rows.select("_key", "_node", "_path", F.explode(F.filter(held, lambda h: h["val"].isNotNull())).alias("h"))
        inside = F.regexp_replace("_path", at + r"\.?", "")
        arg = F.when(inside == "", F.col("h.field")).when(F.col("h.field") == "", inside).otherwise(F.concat(inside, F.lit("."), F.col("h.field")))
        rows = rows.select(F.col("_key").alias("line_no"), F.col("_node").alias("node"), F.col("_path").alias("path"), F.regexp_extract("_path", at, 1).cast("long").alias("pos"), arg.alias("arg"), F.col("h.val").alias("val"))
        rows = rows.where(~F.col("arg").rlike(r"^type($|[\[.])"))
        out = rows if out is None else out.unionByName(rows)
    return out


def candidate_rows(records: DataFrame, most: int = MOST_FIELDS) -> DataFrame:
    """(line_no, child, pos, arg, val) of raw candidates: each step's name, each check's type, each string below a check.

    All come from the child tables. A null or missing name or type gives ''.
    Members of the two lists that are null or no objects count for pos but give no
    rows. A check's own member `type` gives no argument.
    """
    tables = candidate_tables(records, most)
    parts = []
    for level, child, field in (("construction_steps", "step", "name"), ("checks", "check", "type")):
        rows = members(tables, level, field)
        if rows is not None:
            parts.append(rows.select("line_no", F.lit(child).alias("child"), "pos", F.lit("").alias("arg"), F.coalesce(field, F.lit("")).alias("val")))
    args = check_arguments(tables)
    if args is not None:
        parts.append(args.select("line_no", F.lit("arg").alias("child"), "pos", "arg", "val"))
    if not parts:
        key = records.schema["line_no"].dataType.simpleString()
        return records.sparkSession.createDataFrame([], f"line_no {key}, child string, pos long, arg string, val string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
