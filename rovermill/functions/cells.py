"""JSON sensor cells: depth-first reading of nested samples with interval labels."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field


def _no_constant(_: str) -> None:
    raise ValueError("NaN and Infinity are not JSON")


def load(cell: str | None) -> tuple[bool, object]:
    """(readable, value) of a cell; null and anything that is not valid JSON are unreadable."""
    if cell is None:
        return False, None
    try:
        return True, json.loads(cell, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return False, None


def number(v: object) -> float:
    """A finite number, quoted or not; NaN for anything else (booleans, blanks, text, nested values)."""
    if type(v) in (int, float):
        try:
            f = float(v)
        except OverflowError:
            return math.nan
    elif type(v) is str:
        s = v.strip()
        if not s or s[-1] not in "0123456789." or "_" in s:
            return math.nan
        try:
            f = float(s)
        except ValueError:
            return math.nan
    else:
        return math.nan
    return f if math.isfinite(f) else math.nan


FIELDS = ("x", "y", "z", "timestamp")


def deep(v: object) -> bool:
    return isinstance(v, (list, dict))


KINDS = ("cell", "array", "object", "sample", "field")
CELL, ARRAY, OBJECT, SAMPLE, FIELD = range(5)


@dataclass
class Tree:
    """Nodes of one cell by type. pre and post number them all; a contains b if a.pre < b.pre and b.post < a.post.

    samples: (pre, post, idx, x, y, z, timestamp, temp); others, unless only samples are wanted: (kind, pre, post, idx, name, value).
    An object's unit is its name, a field's text is its value. idx counts the nodes of a type in reading order.
    """

    full: bool = True
    samples: list[tuple] = field(default_factory=list)
    others: list[tuple] = field(default_factory=list)
    pre: int = 0
    post: int = 0
    counts: list[int] = field(default_factory=lambda: [0] * len(KINDS))

    def _in(self, kind: int) -> tuple[int, int]:
        self.pre += 1
        self.counts[kind] += 1
        return self.pre - 1, self.counts[kind] - 1

    def _out(self, kind: int, at: tuple[int, int], name: str | None = None, value: str | None = None) -> None:
        self.post += 1
        if self.full:
            self.others.append((kind, at[0], self.post - 1, at[1], name, value))

    def bare(self, name: str | None, v: object) -> None:
        """A value that is no node with content: a field of its object, or an entry that cannot be used."""
        self._out(FIELD, self._in(FIELD), name, None if v is None else v if isinstance(v, str) else json.dumps(v))

    def sample(self, values: list, fields: list[tuple[str | None, object]], temp: float) -> None:
        at, idx = self._in(SAMPLE)
        for name, v in fields:
            if deep(v) and v:
                self.inside(name, v)
            else:
                self.bare(name, v)
        self.post += 1
        self.samples.append((at, self.post - 1, idx, *(number(v) for v in values), temp))

    def inside(self, name: str | None, v: list | dict) -> None:
        """What a sample holds beyond its fields: nodes without samples of their own."""
        kind = ARRAY if isinstance(v, list) else OBJECT
        at = self._in(kind)
        for k, q in enumerate(v) if kind == ARRAY else v.items():
            key = None if kind == ARRAY else k
            if deep(q) and q:
                self.inside(key, q)
            else:
                self.bare(key, q)
        self._out(kind, at, name)

    def walk(self, v: object, name: str | None = None) -> None:
        """Depth first. A list of bare values is a sample, and so is an object with x, y or z, or without any list or object in it.

        Any other list or object is an inner node, at any depth. An object's samples are in `samples` or `batches`; where it has
        neither, in whatever holds lists, objects or a sample's fields. Its other fields have none.
        """
        if isinstance(v, list):
            if v and not any(deep(q) for q in v):
                self.sample([*v[:4], *[None] * (4 - len(v))][:4], [(None, q) for q in v[4:]], math.nan)
                return
            self.array(v, name)
        elif isinstance(v, dict):
            named = "samples" in v or "batches" in v
            if not named and (any(k in v for k in "xyz") or not any(map(deep, v.values()))):
                self.sample([v.get(k) for k in FIELDS], [(k, q) for k, q in v.items() if k not in FIELDS], number(v.get("temp")))
                return
            at = self._in(OBJECT)
            unit = v.get("unit")
            for k, q in v.items():
                content = k in ("samples", "batches") if named else deep(q) and (any(map(deep, q)) if isinstance(q, list) else any(map(deep, q.values())) or any(f in q for f in FIELDS))
                if content and isinstance(q, dict):
                    self.walk(q, k)
                elif content and isinstance(q, list):
                    self.array(q, k)
                elif deep(q) and q:
                    self.inside(k, q)
                else:
                    self.bare(k, q)
            self._out(OBJECT, at, unit if isinstance(unit, str) else None)

    def array(self, v: list, name: str | None = None) -> None:
        """An inner list: a bare value in it is a sample that cannot be used, an empty list is none."""
        at = self._in(ARRAY)
        for q in v:
            if isinstance(q, list) and not q:
                self.array(q)
            elif deep(q):
                self.walk(q)
            else:
                self.sample([None] * 4, [], math.nan)
        self._out(ARRAY, at, name)


def read_cell(cell: str | None, full: bool = True) -> Tree | None:
    """The nodes of a cell; None if the cell cannot be read. Empty arrays are inner nodes, not samples."""
    ok, v = load(cell)
    if not ok:
        return None
    t = Tree(full)
    at = t._in(CELL)
    if isinstance(v, list) and v and any(not deep(q) for q in v) and any(deep(q) for q in v):
        t.array(v)
    elif deep(v) and v:
        t.walk(v)
    t._out(CELL, at)
    return t


def samples_of(cell: str | None) -> list[tuple[float, float, float, float]]:
    """x, y, z, timestamp of the usable samples of a cell, in reading order."""
    t = read_cell(cell, full=False)
    if t is None:
        return []
    return [s[3:7] for s in t.samples if all(v == v for v in s[3:7])]
