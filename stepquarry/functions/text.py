"""Column expressions over texts and step lists; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with the four separators U+001C to U+001F.
WHITE = r"(?U)[\s\x1c-\x1f]+"
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Distinct maximal runs of letters and digits of the lower-cased text; none for null."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)))
    return F.coalesce(found, F.array().cast("array<string>"))


def squeezed(text: Column) -> Column:
    """The text without any white space."""
    return F.regexp_replace(text, WHITE, "")


def ordered_commands(steps: Column) -> Column:
    """The non-null commands in order, without white space; none for null."""
    kept = F.filter(steps, lambda s: s["command"].isNotNull())
    return F.coalesce(F.transform(kept, lambda s: squeezed(s["command"])), F.array().cast("array<string>"))


def commands(steps: Column) -> Column:
    """The distinct non-null commands without white space; none for null."""
    return F.array_distinct(ordered_commands(steps))


def hashed(items: Column) -> Column:
    """64-bit hashes of the members of an array of distinct strings."""
    return F.transform(items, lambda t: F.xxhash64(t))


def set_key(hashes: Column) -> list[Column]:
    """Two independent 64-bit keys of a set given as an array of hashes: equal sets, equal keys."""
    ordered = F.array_sort(hashes)
    return [F.xxhash64(ordered), F.xxhash64(F.lit(977), ordered)]
