"""JSON in free text: extraction, repair and exact writing, in Arrow batches.

Built-in functions parse JSON but can't find where it starts and ends in a text;
these scans are the one place where rows go through Python.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: What may matter: outside a string its opening quote and braces, inside it the closing quote and escapes.
_OUTSIDE, _INSIDE = re.compile(r'["{}]'), re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def spans(text: str):
    """(start, end) of the balanced span at each opening brace in turn; one that never closes is left out.

    Strings are skipped whole, and only within them a backslash makes the next
    character count for nothing. Each brace is read from anew, so quotes before it
    don't matter to it. One that doesn't close by the end of the text is met once
    for each string state it may be read in, which keeps long broken replies cheap.
    """
    dead: set[int] = set()
    for opening in re.finditer("{", text):
        if opening.start() in dead:
            continue
        at, held, end = opening.start(), [], None
        while end is None and (m := _OUTSIDE.search(text, at)):
            at = m.end()
            if m[0] == "{":
                held.append(m.start())
            elif m[0] == "}":
                held.pop()
                if not held:
                    end = at
            else:
                closing = _INSIDE.match(text, at)
                if closing is None:
                    break
                at = closing.end()
        if end is None:  # nor do the braces within it that were open in the same reading
            dead.update(held)
        else:
            yield opening.start(), end


# The commonest slips and what is meant, in the order they are mended: no comma between objects or
# between strings, a comma before a closing bracket.
SLIPS = [(r"}\s*{", "}, {"), (r'"\s+"', '", "'), (r",\s*([}\]])", r"\1")]


def repaired(text: str) -> str:
    """The text with all SLIPS mended."""
    for slip, meant in SLIPS:
        text = re.sub(slip, meant, text)
    return text


def _loads(text: str):
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def first_object(text: str | None, mend: bool):
    """The first balanced object that parses, or if ``mend`` that parses once repaired; else None.

    Without ``mend`` only the outermost first object counts.
    """
    text = text or ""
    for a, b in spans(text):
        if not mend and a != text.find("{"):
            return None
        found = _loads(text[a:b])
        if found is None and mend:
            found = _loads(repaired(text[a:b]))
        if found is not None:
            return found
        if not mend:
            return None
    return None


def outermost(text: str | None):
    """The value between the first opening and the last closing brace, if that is JSON; else None."""
    text = text or ""
    return _loads(text[text.find("{") : text.rfind("}") + 1]) if "{" in text else None


def _steps_json(obj) -> str | None:
    steps = obj.get("construction_steps") if isinstance(obj, dict) else obj
    return json.dumps(steps, ensure_ascii=False) if isinstance(steps, list) else None


def _arrow(rule: Callable[[object], str | None], column: Column | str) -> Column:
    """The rule on every value, in Arrow batches."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(rule)

    run.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(column)


def strict_steps(replies: Column | str) -> Column:
    """JSON of the steps in the first object of each reply, as it stands; null without."""
    return _arrow(lambda t: _steps_json(first_object(t, False)), replies)


def lenient_steps(replies: Column | str) -> Column:
    """As strict_steps, with repair, and with later objects tried if one does not parse."""
    return _arrow(lambda t: _steps_json(first_object(t, True)), replies)


def greedy_steps(replies: Column | str) -> Column:
    """JSON of the steps of the object between the first and the last brace, with every class in lower case; null without."""

    def rule(text: str | None) -> str | None:
        found = outermost(text)
        steps = found.get("construction_steps", []) if isinstance(found, dict) else None
        if not isinstance(steps, list):
            return None
        lower = lambda s: s | {"class": s["class"].lower()} if isinstance(s, dict) and isinstance(s.get("class"), str) else s
        return json.dumps([lower(s) for s in steps], ensure_ascii=False)

    return _arrow(rule, replies)


def mended(text: str | None) -> str | None:
    if text is None or _loads(text) is not None:
        return text
    return repaired(text) if _loads(repaired(text)) is not None else None


def repaired_json(texts: Column | str) -> Column:
    """Each text repaired if it is no JSON, and null if it is none then either."""
    return _arrow(mended, texts)


_KEYS = ("name", "type", "class", "label", "command")


def written(steps) -> str | None:
    if steps is None:
        return None
    return json.dumps({"construction_steps": [{k: s[k] for k in _KEYS if s[k] is not None} for s in steps if s is not None]}, ensure_ascii=False)


def steps_as_json(steps: Column | str) -> Column:
    """Steps as the JSON of a training target: keys in order, absent ones left out, a blank after each separator."""
    return _arrow(written, steps)
