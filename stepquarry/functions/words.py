"""Scalar rules over statements, steps and replies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that the duplicate scan leaves out.
STOP_WORDS = (
    "the a an of to in on and or is be it that this with let prove be are as at such so for from its their there be "
    "which point points line lines we show respectively again meet meets where again construct"
).split()

# Words in a statement that name objects other than points.
OBJECT_WORDS = [
    "incircle", "circumcircle", "excircle", "nine-point", "nine point", "circle",
    "median", "altitude", "bisector", "perpendicular", "tangent", "diameter",
    "chord", "midpoint", "centroid", "orthocent", "incent", "circumcent",
    "excent", "midsegment", "diagonal", "axis", "locus", "radius",
]

# Groups of replacements that keep a statement's meaning; a group is applied as a whole.
PARAPHRASE_AXES = [
    [("Prove that", "Show that"), ("prove that", "show that")],
    [("Prove ", "Show "), ("prove ", "show ")],
    [("Draw ", "Construct "), ("draw ", "construct ")],
    [("Determine ", "Find "), ("determine ", "find ")],
    [("centre", "center"), ("Centre", "Center")],
    [("Let ", "Consider ")],
    [("Suppose ", "Assume ")],
]

WORD = r"[\p{L}\p{N}_]+"


def _strings() -> Column:
    return F.array().cast("array<string>")


def content_words(text: Column) -> Column:
    """Distinct ASCII words of two letters or more of the lower-cased text without STOP_WORDS; none for null."""
    found = F.split(F.regexp_replace(F.lower(text), "[^a-zA-Z ]", " "), " +")
    return F.coalesce(F.array_except(F.filter(found, lambda w: F.length(w) > 1), F.array(*map(F.lit, STOP_WORDS))), _strings())


def command_heads(steps: Column) -> Column:
    """Distinct command names of two characters or more that open a bracket anywhere in the steps; none for null."""
    heads = F.flatten(F.transform(steps, lambda s: F.coalesce(F.regexp_extract_all(s["command"], F.lit(r"([A-Za-z][\p{L}\p{N}_]+)\("), F.lit(1)), _strings())))
    return F.coalesce(F.array_distinct(heads), _strings())


def jaccard(a: Column, b: Column) -> Column:
    """Common members over members of either; 0 for two empty arrays of distinct members."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, F.lit(0.0)).otherwise(common / either)


def point_names(statement: Column) -> Column:
    """Point names in a statement, sorted: letters of runs of capitals, lone capitals, capital and digit, capital and prime."""
    words = F.regexp_extract_all(statement, F.lit(WORD), F.lit(0))
    capitals = F.flatten(F.transform(F.filter(words, lambda w: w.rlike("^[A-Z]+$")), lambda w: F.split(w, "")))
    numbered = F.filter(words, lambda w: w.rlike("^[A-Z][0-9]$"))
    primed = F.regexp_extract_all(statement, F.lit(r"(?<![\p{L}\p{N}_])[A-Z]'"), F.lit(0))
    return F.coalesce(F.array_sort(F.array_distinct(F.concat(capitals, numbered, primed))), _strings())


def object_words(statement: Column) -> Column:
    """The OBJECT_WORDS that occur in the lower-cased statement; none for null."""
    low = F.lower(F.coalesce(statement, F.lit("")))
    return F.filter(F.array(*map(F.lit, OBJECT_WORDS)), lambda w: F.contains(low, w))


def shown_steps(statement: Column, steps: Column) -> Column:
    """The steps with type final for those that the statement names; nothing is ever hidden.

    A point is named by its name or label, another object by an object word of the
    statement within its name and label. Null steps stay null.
    """
    names, words = point_names(statement), object_words(statement)
    blank = F.lit("")

    def one(s: Column) -> Column:
        name, label = F.trim(F.coalesce(s["name"], blank)), F.trim(F.coalesce(s["label"], blank))
        as_point = F.array_contains(names, label) | F.array_contains(names, name)
        as_object = F.exists(words, lambda w: F.contains(F.lower(F.concat(name, F.lit(" "), label)), w))
        show = F.when(F.coalesce(s["class"], blank) == "point", as_point).otherwise(as_object)
        return F.when(s.isNotNull(), s.withField("type", F.when((s["type"] == "construction") & show, F.lit("final")).otherwise(s["type"])))

    return F.transform(steps, one)


def _applied(text: Column, axis: list[tuple[str, str]]) -> Column:
    for old, new in axis:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def paraphrases(statement: Column, most_extra: int = 3) -> Column:
    """The statement, then its distinct rewordings by one axis each, then by all; at most 1 + most_extra. Null gives null."""
    by_all = statement
    for axis in PARAPHRASE_AXES:
        by_all = _applied(by_all, axis)
    every = F.array(statement, *[_applied(statement, axis) for axis in PARAPHRASE_AXES], by_all)
    return F.when(statement.isNotNull(), F.slice(F.array_distinct(every), 1, 1 + most_extra))


def path_of_point(command: Column) -> Column:
    """The path of a command Point(path) with one argument; null for coordinates, a given parameter and other commands."""
    c = F.trim(command)
    inner = F.regexp_extract(c, r"^Point\((.*)\)$", 1)
    path = F.trim(inner)
    depth = F.aggregate(
        F.split(inner, ""),
        F.struct(F.lit(0).alias("d"), F.lit(False).alias("cut")),
        lambda acc, ch: F.struct(
            (acc["d"] + F.when(ch == "(", 1).when(ch == ")", -1).otherwise(0)).alias("d"),
            (acc["cut"] | ((ch == ",") & (acc["d"] == 0))).alias("cut"),
        ),
    )
    return F.when(c.rlike(r"^Point\(.*\)$") & (path != "") & ~path.startswith("(") & ~depth["cut"], path)


def split_arguments(inner: Column) -> Column:
    """The parts of an argument list between the commas outside all brackets, without white space around them."""
    cut = F.aggregate(
        F.split(inner, ""),
        F.struct(F.lit(0).alias("depth"), F.array(F.lit("")).alias("parts")),
        lambda acc, ch: F.struct(
            (acc["depth"] + F.when(ch.isin("(", "[", "{"), 1).when(ch.isin(")", "]", "}"), -1).otherwise(0)).alias("depth"),
            F.when((ch == ",") & (acc["depth"] == 0), F.concat(acc["parts"], F.array(F.lit(""))))
            .otherwise(F.concat(F.slice(acc["parts"], 1, F.size(acc["parts"]) - 1), F.array(F.concat(F.element_at(acc["parts"], -1), ch))))
            .alias("parts"),
        ),
    )
    return F.transform(cut["parts"], lambda p: F.trim(p))


def caption(step: Column) -> Column:
    """What a figure writes beside an object: nothing for lines, else its label where that differs from its name, else its name."""
    label = F.trim(F.coalesce(step["label"], F.lit("")))
    return F.when(F.coalesce(step["class"], F.lit("")).isin("line", "segment", "ray"), F.lit(None).cast("string")).otherwise(F.when(label != "", label).otherwise(step["name"]))


def escaped(text: Column) -> Column:
    """The text for HTML."""
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def rounded(x: Column, places: int = 2) -> Column:
    """Rounded to ``places``, halves upward."""
    unit = float(10**places)
    return F.floor(x * unit + 0.5) / unit
