"""Queries over statements, steps, replies and the corpus made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepquarry.functions import replies as J
from stepquarry.functions import words as W
from stepquarry.operators import corpus as K
from stepquarry.operators import dedup as D
from stepquarry.operators import metrics as M
from stepquarry.plans.figure_queries import STEPS, all_problems
from stepquarry.plans.registry import query
from stepquarry.plans.runtime import settle, shared_path
from stepquarry.sources import jsonl, sinks
from stepquarry.sources.tables import table
from stepquarry.streaming import curation


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_STOP = "[" + ", ".join(map(_q, dict.fromkeys(W.STOP_WORDS))) + "]"
_OBJECTS = "[" + ", ".join(map(_q, W.OBJECT_WORDS)) + "]"
_RUN = "[\\p{L}\\p{N}_]+"


def _words(text: str) -> str:
    found = f"list_distinct(regexp_extract_all(regexp_replace(lower({text}), '[^a-zA-Z ]', ' ', 'g'), '[a-zA-Z]+'))"
    return f"list_filter(coalesce({found}, CAST([] AS VARCHAR[])), lambda w: len(w) > 1 AND NOT list_contains({_STOP}, w))"


def _heads(steps: str) -> str:
    return f"coalesce(list_distinct(flatten([regexp_extract_all(s.command, '([A-Za-z]{_RUN})\\(', 1) for s in {steps} if s.command IS NOT NULL])), CAST([] AS VARCHAR[]))"


def _points(text: str) -> str:
    words = f"regexp_extract_all({text}, '{_RUN}')"
    capitals = f"flatten([string_split(w, '') for w in {words} if regexp_full_match(w, '[A-Z]+')])"
    numbered = f"[w for w in {words} if regexp_full_match(w, '[A-Z][0-9]')]"
    primed = f"regexp_extract_all({text}, '(?:^|[^\\p{{L}}\\p{{N}}_])([A-Z]'')', 1)"
    return f"coalesce(list_sort(list_distinct(list_concat(list_concat({capitals}, {numbered}), {primed}))), CAST([] AS VARCHAR[]))"


def _jac(a: str, b: str) -> str:
    either = f"(len({a}) + len({b}) - len(list_intersect({a}, {b})))"
    return f"(CASE WHEN {either} = 0 THEN 0.0 ELSE CAST(len(list_intersect({a}, {b})) AS DOUBLE) / {either} END)"


@query(f"SELECT problem_key, array_to_string(list_sort({_words('problem_statement')}), ' ') AS words FROM problems")
def token_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "problems")
    return rows.select("problem_key", F.array_join(F.array_sort(W.content_words(F.col("problem_statement"))), " ").alias("words"))


@query(f"SELECT problem_key, array_to_string(list_sort({_heads('construction_steps')}), ' ') AS heads FROM problems")
def signature_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "problems")
    return rows.select("problem_key", F.array_join(F.array_sort(W.command_heads(F.col("construction_steps"))), " ").alias("heads"))


_MATCH = f"""
WITH r AS (SELECT 'fewshot' AS source, id AS k, {_words('problem_statement')} AS w, {_heads('construction_steps')} AS h FROM fewshot_problems
           UNION ALL SELECT 'accepted', problem_key, {_words('problem_statement')}, {_heads('construction_steps')} FROM problems),
n AS (SELECT new_id, {_words('problem_statement')} AS w, {_heads('construction_steps')} AS h FROM new_geometry_problems WHERE id IS DISTINCT FROM 1),
p AS (SELECT n.new_id, r.k AS ref_id, r.source, {_jac('n.w', 'r.w')} AS words_j, {_jac('n.h', 'r.h')} AS heads_j FROM n, r),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY words_j DESC, ref_id) AS rn FROM p) WHERE rn = 1 AND words_j > 0)
"""


def _matches(spark: SparkSession, d: str, least: float = 0.0) -> DataFrame:
    parts = [("fewshot", table(spark, d, "fewshot_problems"), "id"), ("accepted", table(spark, d, "problems"), "problem_key")]
    text, steps = F.col("problem_statement"), F.col("construction_steps")
    refs = [D.features(t, F.col(k), text, steps, name) for name, t, k in parts]
    refs = settle(refs[0].unionByName(refs[1]), "refs")
    # the row with id 1 is a reference problem itself and is not looked at
    rows = table(spark, d, "new_geometry_problems").where("NOT id <=> 1")
    return D.best_match(settle(D.features(rows, F.col("new_id"), text, steps, "new"), "new"), refs, least=least)


@query(_MATCH + "SELECT new_id, ref_id, source, words_j, heads_j FROM b")
def dup_best_match(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d)


@query(_MATCH + "SELECT new_id, ref_id, source, words_j, heads_j, left(g.problem_statement, 70) AS shown FROM b JOIN new_geometry_problems g USING (new_id) WHERE words_j >= 0.5 OR (words_j >= 0.4 AND heads_j >= 0.85)")
def dup_flagged(spark: SparkSession, d: str) -> DataFrame:
    """The likely duplicates, most similar first by two places, else in the order of the rows."""
    shown = table(spark, d, "new_geometry_problems").select("new_id", F.left("problem_statement", F.lit(70)).alias("shown"))
    return D.flagged(_matches(spark, d, D.LIKELY)).join(shown, "new_id").orderBy(F.desc(F.bround("words_j", 2)), "new_id")


_NEW = """
WITH k AS (SELECT DISTINCT trim(coalesce(problem_statement, '')) AS k FROM (SELECT problem_statement FROM problems UNION ALL SELECT problem_statement FROM fewshot_problems)),
n AS (SELECT new_id, id, batch_id, problem_statement, construction_steps, trim(coalesce(problem_statement, '')) AS k, coalesce(len(construction_steps), 0) > 0 AS passes,
             row_number() OVER (ORDER BY batch_id, new_id) AS place FROM new_geometry_problems),
f AS (SELECT *, k IN (SELECT k FROM k) OR coalesce(min(CASE WHEN passes THEN place END) OVER (PARTITION BY k) < place, false) AS is_dup FROM n)
"""


def _checked_new(spark: SparkSession, d: str) -> DataFrame:
    """New rows with is_dup; the gate that a row must pass is that it has steps."""
    new = table(spark, d, "new_geometry_problems").select("new_id", "id", "batch_id", "problem_statement", "construction_steps")
    known = all_problems(spark, d).select("problem_statement")
    return D.new_statements(new, known, ["batch_id", "new_id"], F.size("construction_steps") > 0)


@query(_NEW + "SELECT new_id, is_dup FROM f")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _checked_new(spark, d).select("new_id", "is_dup")


@query("SELECT new_id FROM new_geometry_problems WHERE trim(problem_statement) IN (SELECT trim(problem_statement) FROM problems WHERE problem_statement IS NOT NULL)")
def semijoin_existing(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "problems").select(F.trim("problem_statement").alias("s"))
    return table(spark, d, "new_geometry_problems").withColumn("s", F.trim("problem_statement")).join(known, "s", "left_semi").select("new_id")


@query("SELECT new_id FROM new_geometry_problems n WHERE NOT EXISTS (SELECT 1 FROM problems p WHERE trim(p.problem_statement) = trim(n.problem_statement))")
def antijoin_existing(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "problems").select(F.trim("problem_statement").alias("s"))
    return table(spark, d, "new_geometry_problems").withColumn("s", F.trim("problem_statement")).join(known, "s", "left_anti").select("new_id")


_IDS = _NEW + ", m AS (SELECT greatest(coalesce(max(id), 0), 999) AS m FROM problems), i AS (SELECT *, m + row_number() OVER (ORDER BY place) AS assigned FROM f, m WHERE NOT is_dup AND passes) "


def _accepted_new(spark: SparkSession, d: str) -> DataFrame:
    """Accepted new rows with ids that go on from the greatest known one, 1000 at least, in order of acceptance."""
    fresh = _checked_new(spark, d).where("passes and not is_dup").select(F.col("new_id").alias("row_id"), "batch_id", F.trim("problem_statement").alias("problem_statement"), "construction_steps")
    return K.next_ids(fresh, ["batch_id", "row_id"], table(spark, d, "problems"))


@query(_IDS + "SELECT new_id, assigned FROM i")
def id_continuation(spark: SparkSession, d: str) -> DataFrame:
    return _accepted_new(spark, d).select(F.col("row_id").alias("new_id"), F.col("new_id").alias("assigned"))


def _commands(steps: str = "construction_steps") -> str:
    return f"array_to_string([s.command for s in {steps} if s.command IS NOT NULL], chr(10))"


def _as_commands() -> Column:
    """The commands of a row's steps, a line each, as a text that SQL has as well."""
    return F.array_join(F.transform(F.filter("construction_steps", lambda s: s["command"].isNotNull()), lambda s: s["command"]), "\n")


@query(_IDS + f"SELECT assigned AS id, trim(problem_statement) AS problem_statement, {_commands()} AS commands FROM i")
def accepted_rows(spark: SparkSession, d: str) -> DataFrame:
    """What is kept of an accepted row: its id, stripped statement and steps."""
    return _accepted_new(spark, d).select(F.col("new_id").alias("id"), "problem_statement", _as_commands().alias("commands"))


@query(_NEW + "SELECT new_id, problem_statement, 'no construction_steps' AS _failure FROM f WHERE NOT is_dup AND NOT passes")
def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that failed the gate, as they came, with why."""
    rows = _checked_new(spark, d).where("not passes and not is_dup")
    return rows.select("new_id", "problem_statement", F.lit("no construction_steps").alias("_failure"))


@query("SELECT 'fewshot' AS _source, count(*) AS n FROM fewshot_problems UNION ALL SELECT 'accepted', count(*) FROM problems UNION ALL SELECT 'new', count(*) FROM new_geometry_problems")
def union_tagged(spark: SparkSession, d: str) -> DataFrame:
    text = lambda n: table(spark, d, n).select("problem_statement")
    return M.totals(jsonl.union_tagged(fewshot=text("fewshot_problems"), accepted=text("problems"), new=text("new_geometry_problems")), "_source")


_SPLIT = """
WITH h AS (SELECT problem_key, source, md5(problem_key || '-42') AS h FROM problems),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, problem_key) AS rn, count(*) OVER (PARTITION BY source) AS n FROM h),
e AS (SELECT *, greatest(1, round_even(n * 0.13, 0)) AS held FROM n)
"""


@query(_SPLIT + "SELECT problem_key, source, CASE WHEN rn <= held THEN 'eval' ELSE 'train' END AS split FROM e")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return K.split_by_source(table(spark, d, "problems"), "problem_key")


@query(_SPLIT + "SELECT source, CASE WHEN rn <= held THEN 'eval' ELSE 'train' END AS split, count(*) AS n FROM e GROUP BY 1, 2")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.totals(K.split_by_source(table(spark, d, "problems"), "problem_key"), "source", "split")


def _replaced(text: str, axes: list) -> str:
    for axis in axes:
        for old, new in axis:
            text = f"replace({text}, {_q(old)}, {_q(new)})"
    return text


_ALL = ", ".join(["problem_statement", *[_replaced("problem_statement", [a]) for a in W.PARAPHRASE_AXES], _replaced("problem_statement", W.PARAPHRASE_AXES)])
_VARIANTS = f"""
WITH v AS (SELECT problem_key, [{_ALL}] AS v FROM problems WHERE problem_statement IS NOT NULL),
u AS (SELECT problem_key, list_filter(v, lambda s, i: list_position(v, s) = i)[1:4] AS v FROM v),
x AS (SELECT problem_key, CAST(i - 1 AS INTEGER) AS variant, v[i] AS problem_statement FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM u)
      UNION ALL SELECT problem_key, 0, NULL FROM problems WHERE problem_statement IS NULL)
"""


@query(_VARIANTS + "SELECT problem_key, variant, problem_statement FROM x")
def paraphrase_expand(spark: SparkSession, d: str) -> DataFrame:
    return K.expanded(table(spark, d, "problems").select("problem_key", "problem_statement"))


@query(_VARIANTS + "SELECT variants, count(*) AS n FROM (SELECT problem_key, count(*) AS variants FROM x GROUP BY problem_key) GROUP BY variants")
def paraphrase_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = K.expanded(table(spark, d, "problems").select("problem_key", "problem_statement"))
    return M.totals(M.totals(rows, "problem_key").withColumnRenamed("n", "variants"), "variants")


@query(f"SELECT problem_key, array_to_string({_points('problem_statement')}, ' ') AS names FROM problems")
def point_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "problems").select("problem_key", F.array_join(W.point_names(F.col("problem_statement")), " ").alias("names"))


@query(f"SELECT doc_id, array_to_string(list_filter({_OBJECTS}, lambda w: contains(lower(coalesce(text, '')), w)), ',') AS words FROM documents")
def object_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(W.object_words(F.col("text")), ",").alias("words"))


_SHOWN = f"""WITH {STEPS},
nm AS (SELECT problem_id, {_points('problem_statement')} AS pn, list_filter({_OBJECTS}, lambda w: contains(lower(coalesce(problem_statement, '')), w)) AS ow FROM prob)
SELECT st.problem_id, st.pos, CASE WHEN type = 'construction' AND (CASE WHEN coalesce(class, '') = 'point'
         THEN list_contains(pn, trim(coalesce(label, ''))) OR list_contains(pn, trim(coalesce(name, '')))
         ELSE len(list_filter(ow, lambda w: contains(lower(trim(coalesce(name, '')) || ' ' || trim(coalesce(label, ''))), w))) > 0 END) THEN 'final' ELSE type END AS type
FROM st JOIN nm USING (problem_id)"""


@query(_SHOWN)
def relabel(spark: SparkSession, d: str) -> DataFrame:
    rows = all_problems(spark, d).select("problem_id", F.posexplode(W.shown_steps(F.col("problem_statement"), F.col("construction_steps"))).alias("pos", "s"))
    return rows.where("s is not null").select("problem_id", "pos", "s.type")


@query()
def chat_format(spark: SparkSession, d: str) -> DataFrame:
    """Training rows: the train part, expanded, in turns; the JSON target is written by one Arrow UDF."""
    problems = table(spark, d, "problems")
    train = K.split_by_source(problems, "problem_key").where("split = 'train'").select("problem_key")
    return K.chat(K.expanded(problems.join(train, "problem_key", "left_semi").select("problem_key", "problem_statement", "construction_steps")), ["problem_key", "variant"])


@query(_SPLIT + f"SELECT source, id, problem_statement, {_commands()} AS commands FROM problems WHERE problem_key IN (SELECT problem_key FROM e WHERE rn <= held)")
def eval_projection(spark: SparkSession, d: str) -> DataFrame:
    """Held-out rows with their steps as they were."""
    problems = table(spark, d, "problems")
    held = K.split_by_source(problems, "problem_key").where("split = 'eval'").select("problem_key")
    return problems.join(held, "problem_key", "left_semi").select("source", "id", "problem_statement", _as_commands().alias("commands"))


_LENGTHS = """
WITH v AS (SELECT kind, n_chars, row_number() OVER (PARTITION BY kind ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY kind) AS n FROM documents WHERE n_chars IS NOT NULL)
SELECT kind, n, max(n_chars) AS max, max(n_chars) FILTER (i = least(n - 1, floor(0.5 * n))) AS q50, max(n_chars) FILTER (i = least(n - 1, floor(0.95 * n))) AS q95 FROM v GROUP BY kind, n
"""


@query(_LENGTHS)
def length_stats(spark: SparkSession, d: str) -> DataFrame:
    return K.quantiles(table(spark, d, "documents"), "kind", "n_chars")


@query("SELECT CAST(greatest(1024, 256 * (floor(round_even(max(n_chars) / 3.5, 0) / 256) + 1)) AS BIGINT) AS seq_len FROM documents")
def seq_len_hint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg(F.max("n_chars").alias("m")).select(K.sequence_length(F.col("m")).alias("seq_len"))


_CHATS = """
WITH c AS (SELECT coalesce(list_sum([coalesce(length(m.content), 0) for m in messages]), 0) AS "full", coalesce(length(messages[-1].content), 0) AS completion FROM train),
s AS (SELECT 'full' AS measure, CAST("full" AS BIGINT) AS v FROM c UNION ALL SELECT 'completion', completion FROM c
      UNION ALL SELECT 'steps', len(construction_steps) FROM problems WHERE construction_steps IS NOT NULL),
v AS (SELECT measure, v, row_number() OVER (PARTITION BY measure ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY measure) AS n FROM s)
"""


@query(_CHATS + "SELECT measure, n, max(v) AS max, max(v) FILTER (i = least(n - 1, floor(0.5 * n))) AS q50, max(v) FILTER (i = least(n - 1, floor(0.95 * n))) AS q95 FROM v GROUP BY measure, n")
def chat_length_stats(spark: SparkSession, d: str) -> DataFrame:
    """Characters of whole chat examples and of their completions, and steps of problems."""
    sizes = K.chat_lengths(table(spark, d, "train"))
    steps = table(spark, d, "problems").where("construction_steps is not null").select(F.lit("steps").alias("measure"), F.size("construction_steps").cast("long").alias("v"))
    each = sizes.select(F.explode(F.create_map(F.lit("full"), "full", F.lit("completion"), "completion")).alias("measure", "v"))
    return K.quantiles(each.unionByName(steps), "measure", "v")


@query(_CHATS + 'SELECT CAST(round_even(max("full") / 3.5, 0) AS BIGINT) AS tokens, CAST(greatest(1024, 256 * (floor(round_even(max("full") / 3.5, 0) / 256) + 1)) AS BIGINT) AS seq_len FROM c')
def chat_seq_len(spark: SparkSession, d: str) -> DataFrame:
    longest = K.chat_lengths(table(spark, d, "train")).agg(F.max("full").alias("m"))
    return longest.select(F.bround(F.col("m") / K.CHARS_PER_TOKEN, 0).cast("long").alias("tokens"), K.sequence_length(F.col("m")).alias("seq_len"))


@query("SELECT count(*) AS attempts, count(*) FILTER (ok) AS accepted, CAST(coalesce(sum(length(record)), 0) AS BIGINT) AS characters, count(*) FILTER (ok) / greatest(count(*), 1) AS yield FROM (SELECT record, coalesce(json_valid(record) AND json_type(CAST(CASE WHEN json_valid(record) THEN record END AS JSON), '$.construction_steps') = 'ARRAY', false) AS ok FROM raw_candidates)")
def candidate_yield(spark: SparkSession, d: str) -> DataFrame:
    """How many candidate records can be used, and how much text came in all."""
    rows = table(spark, d, "raw_candidates").withColumn("size", F.char_length("record"))
    return M.yields(rows, jsonl.load_error(F.col("record")).isNull(), characters="size")


_ATTEMPTS = """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY new_id) AS attempt FROM new_geometry_problems),
o AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY new_id) AS number FROM t WHERE attempt <= 40 AND len(construction_steps) > 0)
SELECT batch_id, new_id, attempt, number FROM o WHERE number <= 10
"""


@query(_ATTEMPTS)
def attempt_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first ten rows with steps of each batch, out of its first forty."""
    rows = M.accept_first(table(spark, d, "new_geometry_problems"), ["batch_id"], ["new_id"], F.size("construction_steps") > 0, 10)
    return rows.select("batch_id", "new_id", F.col("attempt").cast("long"), F.col("number").cast("long"))


@query(_NEW + "SELECT CASE WHEN is_dup THEN 'duplicate' WHEN NOT passes THEN 'no_steps' ELSE 'accepted' END AS status, count(*) AS n FROM f GROUP BY 1")
def status_totals(spark: SparkSession, d: str) -> DataFrame:
    return M.totals(_checked_new(spark, d).withColumn("status", F.when(F.col("is_dup"), "duplicate").when(~F.col("passes"), "no_steps").otherwise("accepted")), "status")


@query("SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html FROM documents")
def escape_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", W.escaped(F.col("text")).alias("html"))


@query("SELECT line_no, CASE WHEN trim(coalesce(record, ''), E' \\t\\n\\r') = '' THEN 'empty' WHEN NOT json_valid(record) THEN 'not_json' WHEN coalesce(json_type(CAST(record AS JSON), '$.construction_steps'), '') <> 'ARRAY' THEN 'no_steps' END AS load_error FROM raw_candidates")
def load_errors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_candidates").select("line_no", jsonl.load_error(F.col("record")).alias("load_error"))


@query()
def reply_steps(spark: SparkSession, d: str) -> DataFrame:
    """Steps found in the assistant's messages: strictly, and with repair."""
    rows = table(spark, d, "train").select("ex_id", F.explode(F.filter("messages", lambda m: F.lower(m["role"]) == "assistant")).alias("m"))
    return rows.select("ex_id", J.strict_steps("m.content").alias("strict"), J.lenient_steps("m.content").alias("lenient"))


@query("SELECT ex_id, json_valid(m.content) AS whole FROM (SELECT ex_id, unnest(messages) AS m FROM train) WHERE lower(m.role) = 'assistant' AND m.content IS NOT NULL")
def reply_is_json(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "train").select("ex_id", F.explode(F.filter("messages", lambda m: F.lower(m["role"]) == "assistant")).alias("m"))
    return rows.where("m.content is not null").select("ex_id", F.try_parse_json("m.content").isNotNull().alias("whole"))


_GREEDY = """
WITH a AS (SELECT ex_id, unnest(messages) AS m FROM train),
g AS (SELECT ex_id, regexp_extract(m.content, '\\{.*\\}', 0, 's') AS j FROM a WHERE lower(m.role) = 'assistant' AND m.content IS NOT NULL),
s AS (SELECT ex_id, CASE WHEN j <> '' AND json_valid(j) THEN CASE WHEN json_type(j, '$.construction_steps') = 'ARRAY' THEN CAST(json_extract(j, '$.construction_steps') AS JSON[])
             WHEN json_type(j, '$.construction_steps') IS NULL THEN CAST([] AS JSON[]) END END AS s FROM g)
SELECT ex_id, len(s) AS steps, array_to_string([lower(x ->> '$.class') for x in s if x ->> '$.class' IS NOT NULL], ',') AS classes FROM s
"""


@query(_GREEDY)
def reply_greedy(spark: SparkSession, d: str) -> DataFrame:
    """Steps of what stands between the first and the last brace of each reply, with classes in lower case."""
    rows = table(spark, d, "train").select("ex_id", F.explode(F.filter("messages", lambda m: F.lower(m["role"]) == "assistant")).alias("m")).where("m.content is not null")
    steps = F.from_json(J.greedy_steps("m.content"), "array<struct<class:string>>")
    rows = rows.select("ex_id", steps.alias("s"))
    return rows.select("ex_id", F.when(F.col("s").isNotNull(), F.size("s").cast("long")).alias("steps"), F.array_join(F.transform("s", lambda x: x["class"]), ",").alias("classes"))


_REPAIRED = r"""regexp_replace(regexp_replace(regexp_replace(record, '\}\s*\{', '}, {', 'g'), '"\s+"', '", "', 'g'), ',\s*([}\]])', '\1', 'g')"""


@query(f"SELECT line_no, CASE WHEN json_valid(record) THEN record ELSE {_REPAIRED} END AS record FROM raw_candidates WHERE json_valid(record) OR json_valid({_REPAIRED})")
def json_repair(spark: SparkSession, d: str) -> DataFrame:
    """Candidate records, repaired where they were damaged in the usual ways."""
    rows = table(spark, d, "raw_candidates")
    return rows.select("line_no", J.repaired_json("record").alias("record")).where("record is not null")


@query("SELECT id, problem_statement FROM fewshot_problems WHERE id IN (7, 3, 80, 999)")
def ordered_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Chosen reference problems in the order asked for; ids that aren't there are left out."""
    return jsonl.in_order(table(spark, d, "fewshot_problems"), "id", [7, 3, 80, 999]).select("id", "problem_statement")


@query("""WITH v AS (SELECT line_no, CASE WHEN json_type(j, '$.id') IN ('BIGINT', 'UBIGINT') THEN CAST(j ->> '$.id' AS BIGINT) END AS id
           FROM (SELECT line_no, CAST(CASE WHEN json_valid(record) THEN record END AS JSON) AS j FROM raw_candidates)),
k AS (SELECT id, max(line_no) AS line_no, min(line_no) AS first_position FROM v WHERE id IS NOT NULL GROUP BY id) SELECT id, line_no, first_position FROM k""")
def keyed_scan(spark: SparkSession, d: str) -> DataFrame:
    """Of the records with one id the last, at the place of the first; lines that can't be read, or have no whole id, are left out."""
    value = F.try_variant_get(F.try_parse_json("record"), "$.id", "variant")
    whole = F.schema_of_variant(value) == "BIGINT"
    rows = table(spark, d, "raw_candidates").select("line_no", F.when(whole, F.try_variant_get(value, "$", "bigint")).alias("id")).where("id is not null")
    return jsonl.last_of_each(rows, "id", "line_no").select("id", "line_no", "first_position")


@query("SELECT problem_key, problem_statement FROM problems")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Written as JSON lines over what was there before, and read strictly."""
    path = shared_path(spark, "lines")
    rows = table(spark, d, "problems").select("problem_key", "problem_statement")
    sinks.overwrite(rows.limit(1), path)
    sinks.overwrite(rows, path)
    return jsonl.strict(spark, path, "problem_key long, problem_statement string")


@query("SELECT id, 2 AS n FROM fewshot_problems")
def jsonl_appended(spark: SparkSession, d: str) -> DataFrame:
    """Appended twice, and nothing once, to a file that was not there: each row is there twice."""
    path, rows = shared_path(spark, "lines"), table(spark, d, "fewshot_problems").select("id")
    before = jsonl.if_there(spark, path, "id long")
    for more in (rows, rows.limit(0), rows):
        sinks.append_accepted(more, path)
    return M.totals(before.unionByName(jsonl.strict(spark, path, "id long")), "id")


@query("SELECT 'kept' AS sink, count(*) AS n FROM fewshot_problems UNION ALL SELECT 'rejects', 0 UNION ALL SELECT 'stale', count(*) FROM fewshot_problems")
def guarded_sinks(spark: SparkSession, d: str) -> DataFrame:
    """An empty result leaves old rejects where they are, or replaces them; kept rows are written if there are any."""
    rows, schema = table(spark, d, "fewshot_problems").select("id"), "id long"
    kept, rejects, stale = (shared_path(spark, n) for n in ("kept", "rejects", "stale"))
    for path, only in ((rejects, False), (stale, True)):
        sinks.overwrite(rows, path)
        sinks.write_rejects(rows.limit(0), path, only_if_any=only)
    sinks.keep(rows, kept)
    sinks.keep(rows.limit(0), kept)
    counts = [spark.read.schema(schema).json(p).agg(F.lit(n).alias("sink"), F.count("*").alias("n")) for n, p in (("kept", kept), ("rejects", rejects), ("stale", stale))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT id, problem_statement FROM fewshot_problems")
def report_rows(spark: SparkSession, d: str) -> DataFrame:
    """The fixed reference problems as one JSON array, read back."""
    report = sinks.array_report(table(spark, d, "fewshot_problems").select("id", "problem_statement"), "id")
    return report.select(F.explode(F.from_json("report", "array<struct<id:long,problem_statement:string>>")).alias("r")).select("r.id", "r.problem_statement")


@query("SELECT 'Rules.' || chr(10) || chr(10) || string_agg(to_json({'id': id, 'problem_statement': problem_statement}), chr(10) || chr(10) ORDER BY id) AS prompt FROM fewshot_problems WHERE id IN (3, 7, 80)")
def prompt_text(spark: SparkSession, d: str) -> DataFrame:
    """Rules and chosen examples as one text."""
    return K.prompt("Rules.", table(spark, d, "fewshot_problems").where("id IN (3, 7, 80)").select("id", "problem_statement"), "id")


@query(_NEW + ", a AS (SELECT DISTINCT k FROM f WHERE len(construction_steps) > 0 AND k NOT IN (SELECT k FROM k)) SELECT k AS statement FROM a")
def stream_novel(spark: SparkSession, d: str) -> DataFrame:
    """An extension: the new submissions as a stream, run until all that is there is taken; statements never seen before."""
    source = table(spark, d, "new_geometry_problems")
    inbox, out, mark = (shared_path(spark, n) for n in ("inbox", "outbox", "mark"))
    source.select("new_id", "problem_statement", "construction_steps", "submitted_at").write.parquet(inbox)
    stream = curation.candidates(spark, inbox, spark.read.parquet(inbox).schema)
    fresh = curation.novel(stream, all_problems(spark, d), delay="3650 days")
    curation.append(fresh.select(F.trim(F.coalesce("problem_statement", F.lit(""))).alias("statement")), out, mark).awaitTermination()
    return spark.read.schema("statement string").json(out)


@query("SELECT strftime(date_trunc('hour', submitted_at), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM new_geometry_problems WHERE submitted_at IS NOT NULL GROUP BY 1")
def arrivals_per_hour(spark: SparkSession, d: str) -> DataFrame:
    """The windowed count of the stream, over the table as a batch."""
    rows = table(spark, d, "new_geometry_problems").where("submitted_at is not null")
    return curation.arrivals(rows).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
