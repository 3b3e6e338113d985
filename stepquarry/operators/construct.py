"""An evaluator for a documented subset of construction commands.

Builds a figure from its steps, in order, and gives the points' coordinates: a
stand-in where no probed coordinates are at hand. What an object of another
engine would be, above all the order of two intersections and where a parameter
falls on a path, is a convention of that engine; here it is the one below. A
command outside the subset makes its step ``unsupported``, never ok.

Objects are points (x, y), lines (point, direction, from, to) with the range of
the parameter that the object has (segments 0..1, rays 0..inf, lines all), and
circles (centre, radius). Two intersections of a line come in the order of its
direction; those of two circles with the one left of the way from the first to
the second centre first. A parameter runs from a segment's start to its end, and
round a circle counterclockwise from its rightmost point.

Steps are evaluated in Arrow batches, a problem and trial at a time; nothing is
shuffled and nothing outlives a row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = re.compile(r"\s*([A-Za-z]+)\((.*)\)\s*", re.S)
NUMBER = re.compile(r"\s*[-+]?\d+(?:\.\d+)?(?:\s*/\s*\d+)?\s*")


class Unsupported(Exception):
    """A command outside the subset."""


class Impossible(Exception):
    """A command that has no result for these arguments."""


def arguments(text: str) -> list[str]:
    """The parts of an argument list between its outermost commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch in "([{") - (ch in ")]}")
        if ch == "," and not depth:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


def summands(text: str) -> list[tuple[int, str]]:
    """The terms of a sum outside all brackets, with their signs."""
    out, depth, sign, start = [], 0, 1, 0
    for i, ch in enumerate(text):
        depth += (ch in "([{") - (ch in ")]}")
        if not depth and ch in "+-" and text[start:i].strip():
            out.append((sign, text[start:i].strip()))
            sign, start = (1 if ch == "+" else -1), i + 1
    return [*out, (sign, text[start:].strip())]


def _number(text: str) -> float | None:
    text = text.strip()
    angle = text.endswith("°")
    if not NUMBER.fullmatch(text.rstrip("°")):
        return None
    a, _, b = text.rstrip("°").partition("/")
    value = float(a) / float(b) if b else float(a)
    return math.radians(value) if angle else value


def _line(p, q, lo=-math.inf, hi=math.inf):
    d = (q[0] - p[0], q[1] - p[1])
    if math.hypot(*d) < 1e-12:
        raise Impossible
    return ("line", p, d, lo, hi)


def _turned(v, angle):
    c, s = math.cos(angle), math.sin(angle)
    return (v[0] * c - v[1] * s, v[0] * s + v[1] * c)


def _foot(p, line):
    _, a, d, *_ = line
    t = ((p[0] - a[0]) * d[0] + (p[1] - a[1]) * d[1]) / (d[0] ** 2 + d[1] ** 2)
    return (a[0] + t * d[0], a[1] + t * d[1])


def _unit(p, q):
    n = math.hypot(q[0] - p[0], q[1] - p[1])
    if n < 1e-12:
        raise Impossible
    return ((q[0] - p[0]) / n, (q[1] - p[1]) / n)


def _bisector(p, v, q):
    u, w = _unit(v, p), _unit(v, q)
    d = (u[0] + w[0], u[1] + w[1])
    if math.hypot(*d) < 1e-12:
        d = (-u[1], u[0])
    return ("line", v, d, -math.inf, math.inf)


def _through(a, b, c):
    d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
    if abs(d) < 1e-12:
        raise Impossible
    s = [p[0] ** 2 + p[1] ** 2 for p in (a, b, c)]
    o = ((s[0] * (b[1] - c[1]) + s[1] * (c[1] - a[1]) + s[2] * (a[1] - b[1])) / d, (s[0] * (c[0] - b[0]) + s[1] * (a[0] - c[0]) + s[2] * (b[0] - a[0])) / d)
    return ("circle", o, math.dist(o, a))


def _incircle(a, b, c):
    la, lb, lc = math.dist(b, c), math.dist(c, a), math.dist(a, b)
    n = la + lb + lc
    if n < 1e-12:
        raise Impossible
    o = tuple((la * a[i] + lb * b[i] + lc * c[i]) / n for i in (0, 1))
    return ("circle", o, math.dist(o, _foot(o, _line(a, b))))


def meeting(one, two) -> list[tuple[float, float]]:
    """The intersections of two objects in order."""
    if one[0] == "line" and two[0] == "line":
        (_, a, u, *r), (_, b, v, *s) = one, two
        den = u[0] * v[1] - u[1] * v[0]
        if abs(den) < 1e-12:
            return []
        w = (b[0] - a[0], b[1] - a[1])
        t, k = (w[0] * v[1] - w[1] * v[0]) / den, (w[0] * u[1] - w[1] * u[0]) / den
        ok = r[0] - 1e-9 <= t <= r[1] + 1e-9 and s[0] - 1e-9 <= k <= s[1] + 1e-9
        return [(a[0] + t * u[0], a[1] + t * u[1])] if ok else []
    if one[0] == "circle" and two[0] == "line":
        return meeting(two, one)
    if one[0] == "line":
        (_, a, d, lo, hi), (_, o, r) = one, two
        n = math.hypot(*d)
        f = _foot(o, one)
        h = r * r - math.dist(f, o) ** 2
        if h < -1e-9 * max(1.0, r * r):
            return []
        half = math.sqrt(max(h, 0.0)) / n
        t = ((f[0] - a[0]) * d[0] + (f[1] - a[1]) * d[1]) / (n * n)
        return [(a[0] + k * d[0], a[1] + k * d[1]) for k in (t - half, t + half) if lo - 1e-9 <= k <= hi + 1e-9]
    (_, a, r), (_, b, s) = one, two
    d = math.dist(a, b)
    if d < 1e-12 or d > r + s + 1e-9 or d < abs(r - s) - 1e-9:
        return []
    x = (d * d + r * r - s * s) / (2 * d)
    h = math.sqrt(max(r * r - x * x, 0.0))
    u = _unit(a, b)
    m = (a[0] + x * u[0], a[1] + x * u[1])
    return [(m[0] - h * u[1], m[1] + h * u[0]), (m[0] + h * u[1], m[1] - h * u[0])]


def on_path(path, t: float):
    """The point of a path at the parameter t in 0..1."""
    if path[0] == "circle":
        return (path[1][0] + path[2] * math.cos(2 * math.pi * t), path[1][1] + path[2] * math.sin(2 * math.pi * t))
    if path[0] != "line":
        raise Unsupported
    _, a, d, lo, hi = path
    k = t if math.isfinite(hi) else t / (1 - t) if math.isfinite(lo) else math.tan(math.pi * (t - 0.5))
    return (a[0] + k * d[0], a[1] + k * d[1])


class Figure:
    """The objects built so far, by name."""

    def __init__(self, names: set[str], t_of: Callable[[int], float]):
        self.objects: dict[str, object] = {}
        self.names, self.t_of, self.free = names, t_of, 0

    def value(self, text: str):
        text = text.strip()
        if text in self.objects:
            return self.objects[text]
        if text in self.names:  # it could not be made
            raise Impossible
        if (n := _number(text)) is not None:
            return n
        if len(terms := summands(text)) > 1:
            points = [(sign, self.value(a)) for sign, a in terms]
            return tuple(sum(sign * (p[1][i] if p[0] == "vector" else p[i]) for sign, p in points) for i in (0, 1))
        if text[:1] in ("(", "{") and text[-1:] in (")", "}"):
            parts = [self.value(a) for a in arguments(text[1:-1])]
            if text[0] == "{":
                return parts[0] if len(parts) == 1 and isinstance(parts[0], list) else parts
            if len(parts) == 2 and all(isinstance(p, float) for p in parts):
                return (parts[0], parts[1])
        m = STEP.fullmatch(text)
        rule = m and RULES.get(m[1])
        if not rule:
            raise Unsupported
        given = [self.value(a) for a in arguments(m[2])] if m[2].strip() else []
        if any(g is None for g in given):
            raise Impossible
        try:
            return rule(self, *given)
        except TypeError as e:
            raise Unsupported from e


def _pick(found: list, index: float | None):
    if not found:
        raise Impossible
    i = 0 if index is None else int(index) - 1
    if not 0 <= i < len(found):
        raise Impossible
    return found[i]


def _point(f: Figure, path, t=None):
    f.free += 1
    return path if isinstance(path[0], float) else on_path(path, f.t_of(f.free) if t is None else t)


def _circle(f: Figure, a, b, c=None):
    if c is not None:
        return _through(a, b, c)
    return ("circle", a, b if isinstance(b, float) else math.dist(a, b))


def _normal(f: Figure, p, line):
    return ("line", p, (-line[2][1], line[2][0]), -math.inf, math.inf)


def _reflect(f: Figure, p, mirror):
    f_ = mirror if isinstance(mirror[0], float) else _foot(p, mirror)
    return (2 * f_[0] - p[0], 2 * f_[1] - p[1])


def _rotate(f: Figure, p, angle, about=(0.0, 0.0)):
    v = _turned((p[0] - about[0], p[1] - about[1]), angle)
    return (about[0] + v[0], about[1] + v[1])


def _polygon(f: Figure, a, b, *rest):
    if len(rest) == 1 and isinstance(rest[0], float):
        n, pts = int(rest[0]), [a, b]
        if n < 3:
            raise Impossible
        d = (b[0] - a[0], b[1] - a[1])
        for i in range(1, n - 1):
            d = _turned(d, 2 * math.pi / n)
            pts.append((pts[-1][0] + d[0], pts[-1][1] + d[1]))
        return ("polygon", pts)
    return ("polygon", [a, b, *rest])


def _tangents(f: Figure, p, circle):
    _, o, r = circle
    d = math.dist(p, o)
    if d < r - 1e-9:
        raise Impossible
    if d <= r + 1e-9:
        return [("line", p, (-(p[1] - o[1]), p[0] - o[0]), -math.inf, math.inf)]
    mid = ("circle", ((p[0] + o[0]) / 2, (p[1] + o[1]) / 2), d / 2)
    return [_line(p, q) for q in meeting(circle, mid)]


RULES: dict[str, Callable] = {
    "Point": _point,
    "Segment": lambda f, a, b: _line(a, b, 0.0, 1.0),
    "Line": lambda f, a, b: _line(a, b) if isinstance(b[0], float) else ("line", a, b[2], -math.inf, math.inf),
    "Ray": lambda f, a, b: _line(a, b, 0.0),
    "Vector": lambda f, a, b: ("vector", (b[0] - a[0], b[1] - a[1])),
    "Translate": lambda f, p, v: (p[0] + v[1][0], p[1] + v[1][1]),
    "Circle": _circle,
    "Center": lambda f, c: c[1] if c[0] == "circle" else None,
    "Midpoint": lambda f, a, b=None: ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) if b else (a[1][0] + a[2][0] / 2, a[1][1] + a[2][1] / 2),
    "Centroid": lambda f, p: tuple(sum(q[i] for q in p[1]) / len(p[1]) for i in (0, 1)) if len(p[1]) == 3 else None,
    "Polygon": _polygon,
    "Vertex": lambda f, p, i: _pick(p[1], i),
    "Element": lambda f, p, i: _pick(p, i),
    "Intersect": lambda f, a, b, i=None: _pick(meeting(a, b), i),
    "PerpendicularLine": _normal,
    "PerpendicularBisector": lambda f, a, b: ("line", ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2), (a[1] - b[1], b[0] - a[0]), -math.inf, math.inf),
    "AngleBisector": lambda f, p, v, q: _bisector(p, v, q),
    "Incircle": lambda f, a, b, c: _incircle(a, b, c),
    "Reflect": _reflect,
    "Rotate": _rotate,
    "Tangent": _tangents,
}


def built(steps: list[dict], t_of: Callable[[int], float]) -> list[tuple[int, str, str, float | None, float | None]]:
    """(pos, name, status, x, y) of each step; status ok, failed or unsupported; coordinates of points only."""
    figure, out = Figure({s["name"] for s in steps if s is not None}, t_of), []
    for pos, s in enumerate(steps):
        if s is None or s["name"] is None:
            continue
        made, status = None, "ok"
        try:
            made = figure.value(s["command"] or "")
            if made is None:
                status = "failed"
        except Unsupported:
            status = "unsupported"
        except (Impossible, ArithmeticError, ValueError, IndexError, KeyError, RecursionError):
            status = "failed"
        except (TypeError, AttributeError):
            status = "unsupported"
        if made is not None:
            figure.objects[s["name"]] = made
        point = isinstance(made, tuple) and len(made) == 2 and all(isinstance(c, float) for c in made)
        out.append((pos, s["name"], status, *(made if point else (None, None))))
    return out


#: Points nearer than this have collapsed; so many times a figure is built anew to mend indices.
COLLAPSED, PASSES = 1e-6, 3


def other_index(command: str) -> str | None:
    """An Intersect command with its index, the last of three arguments or more, 1 made 2 and any other 1; null if it has none."""
    m = STEP.fullmatch(command)
    parts = arguments(m[2]) if m and m[1] == "Intersect" else []
    if len(parts) < 3 or not (parts[-1].isascii() and parts[-1].isdigit()):
        return None
    return f"Intersect({', '.join([*parts[:-1], '2' if int(parts[-1]) == 1 else '1'])})"


def collapsed(figure: list[tuple]) -> list[int]:
    """Positions of the built points that lie on a point built before."""
    out, grid = [], {}
    for pos, _name, _status, x, y in figure:
        if x is None or not (math.isfinite(x) and math.isfinite(y)):
            continue
        cell = (math.floor(x / COLLAPSED), math.floor(y / COLLAPSED))
        near = (p for i in (-1, 0, 1) for j in (-1, 0, 1) for p in grid.get((cell[0] + i, cell[1] + j), ()))
        if any(math.dist((x, y), p) < COLLAPSED for p in near):
            out.append(pos)
        grid.setdefault(cell, []).append((x, y))
    return out


def with_fixed_indices(steps: list[dict], t_of: Callable[[int], float]) -> list[dict]:
    """The steps with intersection indices changed where their point fell on an earlier point."""
    steps = [None if s is None else dict(s) for s in steps]
    for _ in range(PASSES):
        fixes = {pos: new for pos in collapsed(built(steps, t_of)) if (new := other_index(steps[pos]["command"] or ""))}
        for pos, new in fixes.items():
            steps[pos]["command"] = new
        if not fixes:
            break
    return steps


def _figures(steps: DataFrame, *more: str) -> DataFrame:
    """A row a figure: (problem_id, more, steps), the steps of one problem in order; a figure is as large as its problem."""
    return steps.groupBy("problem_id", *more).agg(F.array_sort(F.collect_list(F.struct("pos", "name", "command"))).alias("steps"))


def _middle(_: int) -> float:
    """Where a point goes that has no parameter because its path is an infinite line."""
    return 0.5


def fixed_indices(steps: DataFrame) -> DataFrame:
    """(problem_id, pos, old, new) of the commands that with_fixed_indices changes, of steps (problem_id, pos, name, command) with their parameters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, items in zip(b["problem_id"], b["steps"]):
                new = with_fixed_indices(list(items), _middle)
                rows += [(k, a["pos"], a["command"], c["command"]) for a, c in zip(items, new) if a["command"] != c["command"]]
            yield pd.DataFrame(rows, columns=["problem_id", "pos", "old", "new"])

    return _figures(steps).mapInPandas(run, "problem_id long, pos int, old string, new string")


def report(evaluated: DataFrame) -> DataFrame:
    """(problem_id, trial, total, failed, unsupported) of evaluated steps."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return evaluated.groupBy("problem_id", "trial").agg(F.count("*").alias("total"), count("failed"), count("unsupported"))


def evaluate(steps: DataFrame) -> DataFrame:
    """(problem_id, trial, pos, name, status, x, y) of steps (problem_id, trial, pos, name, command), built in order.

    Points on paths should have their parameters (params.py); a point left free on
    an infinite line is put at its middle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, trial, items in zip(b["problem_id"], b["trial"], b["steps"]):
                rows += [(k, trial, items[i]["pos"], *r) for i, *r in built(list(items), _middle)]
            yield pd.DataFrame(rows, columns=["problem_id", "trial", "pos", "name", "status", "x", "y"])

    return _figures(steps, "trial").mapInPandas(run, "problem_id long, trial int, pos int, name string, status string, x double, y double")


def as_probes(evaluated: DataFrame) -> DataFrame:
    """The points in the shape of the probes table."""
    points = evaluated.where("status = 'ok' AND x is not null").select("problem_id", "trial", "pos", "name", "x", "y")
    return points.withColumns({"recorded_at": F.lit(None).cast("timestamp"), "loaded_at": F.lit(None).cast("timestamp")})
