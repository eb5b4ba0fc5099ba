"""Deeply nested records to flat, linked tables, by vectorised structural indexing.

A batch of JSON texts becomes one byte array. Over it, without a loop per byte or record:

1. bitmap of escaped bytes (parity of backslash runs) and of the quotes that aren't escaped
2. bitmap of bytes within strings: parity of the running count of quotes
3. bitmap of brackets, commas and colons outside strings
4. nesting depth: prefix sum of opening minus closing brackets
5. all delimiters sorted by (depth, position) stand in containers' order, so each pair of
   neighbours bounds one element: its span, ordinal, key and container come from array shifts
6. each element that starts with a bracket is linked to the container it opens

The result is an element table: one row for each member of an object or array, with the number of
the element that holds it. :func:`flatten` keeps it as Spark rows; the entries of fields are found by
following links down named paths.

Defined cases: null, blank and broken texts give no rows (they are told from valid ones before
indexing, as the index presumes valid JSON); of repeated keys in an object the last counts; empty
containers have a row of their own, without children; texts of any length and depth are one span each.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of JSON text indexed at once.
BLOCK = 4 << 20

_IS = {c: np.uint8(ord(c)) for c in '"\\{}[],:'}


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


_TOKEN = re.compile(r'[ \t\r\n]*(?:(?P<s>"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(?P<v>-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)|(?P<p>[\[\]{},:]))')


def _deep_json(text: str) -> bool:
    """Whether a text is one JSON value, for texts nested deeper than a recursive parser goes."""
    end, at, open_, want = len(text.rstrip(" \t\r\n")), 0, [], "value"
    while at < end:
        m = _TOKEN.match(text, at)
        if m is None:
            return False
        at, mark = m.end(), m["p"]
        if want == "end":
            return False
        if mark in ("[", "{") and want in ("value", "first"):
            open_.append(mark)
            want = "first" if mark == "[" else "first key"
        elif mark in ("]", "}"):
            if not open_ or open_.pop() != {"]": "[", "}": "{"}[mark] or want not in ("after", "first" if mark == "]" else "first key"):
                return False
            want = "after" if open_ else "end"
        elif mark == "," and want == "after":
            want = "value" if open_[-1] == "[" else "key"
        elif mark == ":" and want == "colon":
            want = "value"
        elif mark is None and want in ("key", "first key") and m["s"]:
            want = "colon"
        elif mark is None and want in ("value", "first"):
            want = "after" if open_ else "end"
        else:
            return False
    return want == "end"


def is_json(text: str | None) -> bool:
    """Whether a text is one valid JSON value (NaN and infinities aren't), of any depth."""
    if not text or text.isspace():
        return False
    try:
        json.loads(text, parse_constant=_refuse)
    except RecursionError:
        return _deep_json(text)
    except ValueError:
        return False
    return True


class Index:
    """Structural index of a block of valid JSON texts.

    Arrays with one entry per element: ``doc``, ``holder`` (number of the element that contains it; -1
    for the top value), ``ordinal``, ``key_start`` and ``key_end`` (-1 in arrays), ``start`` and ``end``.
    """

    def __init__(self, texts: list[bytes]) -> None:
        self.raw = b"\n".join(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_start = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
        self.doc_end = self.doc_start + size
        b = np.frombuffer(self.raw, np.uint8)
        self.bytes = b
        inside, blank = self._strings(b)
        opening = ((b == _IS["{"]) | (b == _IS["["])) & ~inside
        closing = ((b == _IS["}"]) | (b == _IS["]"])) & ~inside
        depth = np.cumsum(opening.astype(np.int32) - closing.astype(np.int32), dtype=np.int32)
        self._elements(b, blank, inside, opening, closing, depth)

    @staticmethod
    def _strings(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the bytes within strings (opening quote included) and of white space."""
        slash = b == _IS["\\"]
        at = np.arange(len(b), dtype=np.int64)
        last_other = np.maximum.accumulate(np.where(slash, -1, at)) if len(b) else at
        run = at - last_other  # length of the run of backslashes that ends here
        escaped = np.zeros(len(b), bool)
        escaped[1:] = (run[:-1] % 2) == 1
        quote = (b == _IS['"']) & ~escaped
        inside = (np.cumsum(quote) % 2).astype(bool)
        blank = (b == 32) | (b == 10) | (b == 13) | (b == 9)
        return inside, blank

    def _elements(self, b: np.ndarray, blank: np.ndarray, inside: np.ndarray, opening: np.ndarray, closing: np.ndarray, depth: np.ndarray) -> None:
        comma = (b == _IS[","]) & ~inside
        colon = np.flatnonzero((b == _IS[":"]) & ~inside)
        marks = np.flatnonzero(opening | closing | comma)
        inner = depth[marks].astype(np.int64) + closing[marks]  # depth within the container a mark belongs to
        n = len(b) + 1
        order = np.argsort(inner * n + marks, kind="stable")
        mark, level = marks[order], inner[order]
        is_open, is_close = opening[mark], closing[mark]
        first = np.flatnonzero(~is_close)  # every opening bracket or comma begins an element
        lo, hi, lev = mark[first] + 1, mark[first + 1] if len(first) else mark[:0], level[first]
        group = np.cumsum(is_open)[first] - 1  # containers in this order
        open_at = mark[is_open]
        # white space around values, by the next and last byte that isn't blank
        at = np.arange(len(b), dtype=np.int64)
        nxt = np.minimum.accumulate(np.where(blank, n, at)[::-1])[::-1] if len(b) else at
        prv = np.maximum.accumulate(np.where(blank, -1, at)) if len(b) else at
        full = nxt[lo] < hi if len(lo) else np.zeros(0, bool)  # an empty container has an empty element
        lo, hi, lev, group = lo[full], hi[full], lev[full], group[full]
        # the colon of a member is the first one of its depth in its span
        colon_key = np.sort(depth[colon].astype(np.int64) * n + colon)
        k = np.searchsorted(colon_key, lev * n + lo)
        at_colon = np.where(k < len(colon_key), colon_key[np.minimum(k, max(len(colon_key) - 1, 0))] - lev * n if len(colon_key) else n, n)
        member = (at_colon < hi) & (at_colon >= lo)
        ks = np.where(member, nxt[lo], -1)
        ke = np.where(member, prv[np.where(member, at_colon - 1, 0)] + 1, -1)
        start = np.where(member, nxt[np.where(member, at_colon + 1, 0)], nxt[lo])
        end = prv[hi - 1] + 1
        # the top values come first
        tops = nxt[self.doc_start] if len(self.doc_start) else self.doc_start
        top_end = prv[self.doc_end - 1] + 1 if len(self.doc_end) else self.doc_end
        d = len(self.doc_start)
        self.start, self.end = np.concatenate([tops, start]), np.concatenate([top_end, end])
        self.key_start, self.key_end = np.concatenate([np.full(d, -1), ks]), np.concatenate([np.full(d, -1), ke])
        by_start = np.argsort(self.start, kind="stable")
        holder_of_open = by_start[np.searchsorted(self.start[by_start], open_at)] if len(open_at) else open_at
        self.holder = np.concatenate([np.full(d, -1), holder_of_open[group]]).astype(np.int64)
        begins = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
        here = np.arange(len(group))
        self.ordinal = np.concatenate([np.zeros(d, np.int64), here - np.maximum.accumulate(np.where(begins, here, 0))]) if len(group) else np.zeros(d, np.int64)
        self.doc = np.searchsorted(self.doc_start, self.start, side="right") - 1

    def kind(self) -> np.ndarray:
        """First byte of each element: { [ " t f n or of a number."""
        return self.bytes[self.start] if len(self.start) else np.zeros(0, np.uint8)

    def members(self, key: str) -> np.ndarray:
        """Elements with this key; of repeated keys of one object the last. A key with escapes is decoded to compare."""
        q = json.dumps(key).encode()
        size = self.key_end - self.key_start
        at = np.flatnonzero((size == len(q)) & (self.key_start >= 0))
        if len(at):
            window = self.bytes[self.key_start[at][:, None] + np.arange(len(q))]
            at = at[(window == np.frombuffer(q, np.uint8)).all(axis=1)]
        odd = np.flatnonzero((size > len(q)) & (self.key_start >= 0))
        if len(odd):  # only a key with a backslash can be longer and equal
            slashes = np.concatenate([[0], np.cumsum(self.bytes == _IS["\\"])])
            odd = odd[slashes[self.key_end[odd]] > slashes[self.key_start[odd]]]
            at = np.sort(np.concatenate([at, [i for i in odd if json.loads(self.raw[self.key_start[i] : self.key_end[i]]) == key]]).astype(np.int64))
        last = dict(zip(self.holder[at].tolist(), at.tolist()))
        return np.fromiter(last.values(), np.int64, len(last))

    def children(self) -> tuple[np.ndarray, np.ndarray]:
        """Elements ordered by (holder, ordinal), and their holders in that order, for searchsorted."""
        order = np.lexsort((self.ordinal, self.holder))
        return order, self.holder[order]

    def text(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]]


def blocks(keys: list, texts: list[str | None]) -> Iterator[tuple[list, Index]]:
    """Indexes of the valid texts, in blocks of about BLOCK bytes, with the keys of each block."""
    ks, bs, size = [], [], 0
    for key, text in zip(keys, texts):
        if not is_json(text):
            continue
        ks.append(key)
        bs.append(text.encode())
        size += len(bs[-1])
        if size >= BLOCK:
            yield ks, Index(bs)
            ks, bs, size = [], [], 0
    if ks:
        yield ks, Index(bs)


def flatten(pages: DataFrame, key: str = "page_id", body: str = "body") -> DataFrame:
    """All elements of all texts as linked rows.

    Columns: the key column, node_id and parent_id (int, unique in a text; the top value is 0, its
    parent null), ordinal, name (key in its object, or null), kind (object, array, string, number,
    boolean, null) and value (decoded text of a scalar, null for containers and JSON null).
    """
    names = {ord("{"): "object", ord("["): "array", ord('"'): "string", ord("t"): "boolean", ord("f"): "boolean", ord("n"): "null"}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ks, x in blocks(frame["k"].tolist(), frame["t"].tolist()):
                order = np.lexsort((x.start, x.doc))
                number = np.empty(len(order), np.int64)
                firsts = np.searchsorted(x.doc[order], np.arange(len(ks)))
                number[order] = np.arange(len(order)) - firsts[x.doc[order]]
                kinds = [names.get(c, "number") for c in x.kind()]
                value = [x.text(i).decode() if k in ("number", "boolean") else json.loads(x.text(i)) if k == "string" else None for i, k in enumerate(kinds)]
                keys = [json.loads(x.raw[a:b]) if a >= 0 else None for a, b in zip(x.key_start, x.key_end)]
                parent = pd.array(np.where(x.holder >= 0, number[x.holder], -1), dtype="Int64")
                parent[x.holder < 0] = pd.NA
                yield pd.DataFrame({"k": [ks[d] for d in x.doc], "node_id": number, "parent_id": parent, "ordinal": x.ordinal, "name": keys, "kind": kinds, "value": value})

    source = pages.select(F.col(key).cast("long").alias("k"), F.col(body).alias("t")).where(F.col("t").isNotNull())
    rows = source.mapInPandas(run, "k long, node_id long, parent_id long, ordinal long, name string, kind string, value string")
    return rows.withColumnRenamed("k", key)


def _read_text(text: str) -> object:
    """What the text of a JSON or Python value stands for; None if it is neither."""
    text = text.strip()
    if text[:1] not in ("[", "{"):
        return None
    for read in (json.loads, ast.literal_eval):
        try:
            return read(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
    return None


def entry_list(value: object, value_key: str) -> list[tuple[object, object]]:
    """(name, value) of each entry of a field, in order: a list, one entry, an object of name: value, or the text of one."""
    if isinstance(value, str):
        value = _read_text(value)
    if isinstance(value, dict):
        if "name" in value:
            value = [value]
        else:
            return list(value.items())
    if not isinstance(value, (list, tuple)):
        return []
    return [(e.get("name"), e.get(value_key)) if isinstance(e, dict) else (None, None) for e in value]


def _value_at(x: Index, i: int, order: np.ndarray, holders: np.ndarray, depth: int = 3) -> object:
    """Value of an element, read from the index down to ``depth`` levels; what is nested deeper is an empty object."""
    kind = x.bytes[x.start[i]]
    if kind not in (ord("{"), ord("[")):
        return json.loads(x.text(i))
    if depth == 0:
        return {}
    inner = order[np.searchsorted(holders, i, "left") : np.searchsorted(holders, i, "right")].tolist()
    values = [_value_at(x, j, order, holders, depth - 1) for j in inner]
    return values if kind == ord("[") else {json.loads(x.raw[x.key_start[j] : x.key_end[j]]): v for j, v in zip(inner, values)}


def _value(x: Index, i: int) -> object:
    """Value of a field: by the parser, or by the index where it is nested deeper than the parser goes (entries have two levels)."""
    try:
        return json.loads(x.text(i))
    except RecursionError:
        return _value_at(x, i, *x.children())


def whole_number(value: object) -> str | None:
    """An amount as digits only: 1,200 or " 1200" or 1200.0 as "1200"; None if it is no number."""
    if value is None or isinstance(value, (bool, list, dict)):
        return None
    try:
        return str(int(Decimal(str(value).strip().replace(",", "").replace("_", "")).to_integral_value()))
    except (ArithmeticError, ValueError):
        return None


def grade(value: object) -> str | None:
    """A grade, trimmed and in upper case."""
    return None if value is None or isinstance(value, (list, dict)) else str(value).strip().upper()


#: Field name to the key of its entries' values and how a value is written.
FIELDS: dict[str, tuple[str, Callable[[object], str | None]]] = {
    "attack": ("amount", whole_number),
    "requiredAttributes": ("amount", whole_number),
    "scalesWith": ("scaling", grade),
}

#: Levels of nesting under an item: each list sits in an object of the level above.
LEVELS = ("data", "variants", "upgrades")


def _levels(x: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For items, variants and upgrades: their elements, docs and (item, variant, upgrade) numbers."""
    kind = x.kind()
    order, holders = x.children()
    above = np.arange(len(x.doc_start))  # the top objects
    numbers = np.full((len(above), 3), -1, np.int64)
    for depth, name in enumerate(LEVELS):
        lists = x.members(name)
        lists = lists[(kind[lists] == ord("[")) & np.isin(x.holder[lists], above)]
        sort = np.argsort(above, kind="stable")
        at = sort[np.searchsorted(above[sort], x.holder[lists])] if len(lists) else lists
        lo, hi = np.searchsorted(holders, lists, "left"), np.searchsorted(holders, lists, "right")
        count = hi - lo
        rep = np.repeat(np.arange(len(lists)), count)
        element = order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)] if count.sum() else np.zeros(0, np.int64)
        nums = numbers[at[rep]].copy() if len(rep) else np.zeros((0, 3), np.int64)
        nums[:, depth] = x.ordinal[element]
        keep = kind[element] == ord("{") if len(element) else np.zeros(0, bool)
        above, numbers = element[keep], nums[keep]
        yield above, x.doc[above], numbers[:, 0], numbers[:, 1], numbers[:, 2]


def entries(pages: DataFrame, key: str = "page_id", body: str = "body") -> DataFrame:
    """The entries of the FIELDS of items, of their variants and of those variants' upgrades.

    Columns: the key column, item_no, variant_no, upgrade_no (-1 where they don't apply),
    field_name, entry_no, entry_name (trimmed, lower case), entry_value. An entry without name or
    value has a number but no row; so has an amount that is no number.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ks, x in blocks(frame["k"].tolist(), frame["t"].tolist()):
                out = []
                fields = {f: x.members(f) for f in FIELDS}
                for above, doc, i, v, u in _levels(x):
                    place = {int(e): n for n, e in enumerate(above)}
                    for field, (value_key, write) in FIELDS.items():
                        for m in fields[field].tolist():
                            n = place.get(int(x.holder[m]))
                            if n is None:
                                continue
                            for e, (name, value) in enumerate(entry_list(_value(x, m), value_key)):
                                if name is None or value is None or not str(name).strip():
                                    continue
                                written = write(value)
                                if written is not None:
                                    out.append((ks[doc[n]], i[n], v[n], u[n], field, e, str(name).strip().lower(), written))
                yield pd.DataFrame(out, columns=["k", "item_no", "variant_no", "upgrade_no", "field_name", "entry_no", "entry_name", "entry_value"])

    schema = "k long, item_no int, variant_no int, upgrade_no int, field_name string, entry_no int, entry_name string, entry_value string"
    source = pages.select(F.col(key).cast("long").alias("k"), F.col(body).alias("t")).where(F.col("t").isNotNull())
    return source.mapInPandas(run, schema).withColumnRenamed("k", key)


def level_rows(pages: DataFrame, level: str, key: str = "page_id", body: str = "body") -> DataFrame:
    """Flat table of the objects of one level (data, variants or upgrades) with their scalar fields.

    Columns: the key column, item_no, variant_no, upgrade_no, fields (map of name to text, nested
    fields left out). Rows of the level below refer to it by the numbers they share.
    """
    depth = LEVELS.index(level)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ks, x in blocks(frame["k"].tolist(), frame["t"].tolist()):
                above, doc, i, v, u = list(_levels(x))[depth]
                kind = x.kind()
                order, holders = x.children()
                lo, hi = np.searchsorted(holders, above, "left"), np.searchsorted(holders, above, "right")
                fields = []
                for a, z in zip(lo, hi):
                    own = [m for m in order[a:z] if kind[m] not in (ord("{"), ord("["), ord("n"))]
                    fields.append({json.loads(x.raw[x.key_start[m] : x.key_end[m]]): json.loads(x.text(m)) if kind[m] == ord('"') else x.text(m).decode() for m in own})
                yield pd.DataFrame({"k": [ks[d] for d in doc], "item_no": i, "variant_no": v, "upgrade_no": u, "fields": fields})

    source = pages.select(F.col(key).cast("long").alias("k"), F.col(body).alias("t")).where(F.col("t").isNotNull())
    return source.mapInPandas(run, "k long, item_no int, variant_no int, upgrade_no int, fields map<string,string>").withColumnRenamed("k", key)
