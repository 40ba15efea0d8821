"""Columnar shredding of nested documents into related flat tables (problem 1).

A document of the recursive shape ``toc > item* > item* ...`` is shredded into one column per leaf path, and nothing but these columns is kept.
The recursion is folded, so a leaf path such as ``item.level`` is one column whatever the depth.  An entry of a column is

* a repetition level: 0 starts a record, ``2 d`` goes on with the list at depth d, ``2 d + 1`` opens the list inside of an item at depth d,
* a definition level: the number of the steps of the path that are there (an item at depth d has d of them), and
* the value, stored only where the definition level says that it is present.

Leaves that repeat themselves (``page`` and ``schuttenummers``) have an entry for each repetition.

The table of each repeated ancestor (items, pages, numbers) is rebuilt from the level sequences of its columns alone: the repetition levels of
a column give the depths of its items, and item i lies in the last earlier one whose depth is one less.  Memory is linear at any
depth, as neither the parsers nor the rebuilding recurse.

Defined results: a null, blank or damaged document has no rows; a repeated delivery of a key counts once, and if deliveries
differ, one is taken as a whole; an item that is a bare value (JSON) is an item without leaves but its title; a level that is no whole number is
-1, such a ``schutte_nr`` 0.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring
from xml.parsers import expat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# leaf paths by the steps they have below their item: one value an item, or repeated ones
LEAVES = ("level", "schutte_nr", "title")
REPEATED = {"schuttenummers": 1, "page.number": 2, "page.source": 2}
_WHOLE = re.compile(r"[+-]?[0-9]+\Z")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_SPACE = re.compile(r"[ \t\n\r]*")
_PARTS = re.compile(r"[\s,;]+")


class Column:
    """Repetition levels, definition levels and present values of one leaf path."""

    __slots__ = ("rep", "defined", "values")

    def __init__(self) -> None:
        self.rep: list[int] = []
        self.defined: list[int] = []
        self.values: list[str] = []

    def put(self, rep: int, defined: int, value: str | None = None) -> None:
        self.rep.append(rep)
        self.defined.append(defined)
        if value is not None:
            self.values.append(value)


class _Builder:
    """Takes items in document order, and their leaves in any; makes the columns."""

    def __init__(self) -> None:
        self.depth: list[int] = []
        self.single: list[dict[str, str]] = []
        self.numbers: list[list[str]] = []
        self.pages: list[list[tuple[str | None, str | None]]] = []

    def open_item(self, depth: int) -> int:
        self.depth.append(depth)
        self.single.append({})
        self.numbers.append([])
        self.pages.append([])
        return len(self.depth) - 1

    def leaf(self, at: int, name: str, value: str | None) -> None:
        """The first value of a leaf counts."""
        if value is not None:
            self.single[at].setdefault(name, value)

    def columns(self) -> dict[str, Column]:
        out = {leaf: Column() for leaf in (*LEAVES, *REPEATED)}
        before = 0
        for d, single, numbers, pages in zip(self.depth, self.single, self.numbers, self.pages):
            rep = 0 if not before else 2 * before + 1 if d > before else 2 * d
            for leaf in LEAVES:
                value = single.get(leaf)
                out[leaf].put(rep, d + (value is not None), value)
            again = 2 * (d + 1)
            for k, value in enumerate(numbers):
                out["schuttenummers"].put(again if k else rep, d + 1, value)
            if not numbers:
                out["schuttenummers"].put(rep, d)
            for name, which in (("page.number", 0), ("page.source", 1)):
                for k, page in enumerate(pages):
                    value = page[which]
                    out[name].put(again if k else rep, d + 1 + (value is not None), value)
                if not pages:
                    out[name].put(rep, d)
            before = d
        return out


def depths(rep: np.ndarray) -> np.ndarray:
    """The depths of the items of a column without repetitions of its own, from its repetition levels."""
    return np.where(rep == 0, 1, (rep + 1) // 2)


def single_values(column: Column) -> tuple[np.ndarray, list[str | None]]:
    """Depth and value (or null) of every item, from the levels of one column."""
    depth = depths(np.asarray(column.rep, dtype=np.int64))
    present = (np.asarray(column.defined, dtype=np.int64) > depth).tolist()
    stored = iter(column.values)
    return depth, [next(stored) if p else None for p in present]


def repeated_values(column: Column, steps: int) -> Iterator[tuple[int, int, str | None]]:
    """Ordinal of the item, position in it (both from 1) and value of every repetition, from the levels of one column."""
    stored = iter(column.values)
    item = depth = pos = 0
    for rep, defined in zip(column.rep, column.defined):
        if rep != 2 * (depth + 1) or not depth:
            item, pos = item + 1, 0
            depth = 1 if not rep else (rep + 1) // 2
        if defined > depth:
            pos += 1
            yield item, pos, next(stored) if defined == depth + steps else None


def parents(item_depth: np.ndarray) -> np.ndarray:
    """Ordinal (from 1) of the item each item lies in, 0 at the top, from the depths in document order."""
    out = np.zeros(len(item_depth), dtype=np.int64)
    at = np.arange(1, len(item_depth) + 1)
    order = np.argsort(item_depth, kind="stable")
    bounds = np.flatnonzero(np.diff(item_depth[order])) + 1
    above: np.ndarray | None = None
    for own in np.split(order, bounds) if len(order) else []:
        if above is not None:
            out[own] = at[above[np.searchsorted(above, own) - 1]]
        above = own
    return out


def shred_xml(text: str) -> dict[str, Column] | None:
    """Shred an XML document; None if it is not well-formed.  Comments and foreign elements hold no items."""
    doc, path, items = _Builder(), [], []
    title: list[str] = []

    def start(tag: str, attrs: dict) -> None:
        if tag == "item" and (len(path) == 1 or path and path[-1] == "item"):
            at = doc.open_item(len(items) + 1)
            items.append(at)
            for leaf in ("level", "schutte_nr"):
                doc.leaf(at, leaf, attrs.get(leaf))
            doc.numbers[at].extend(filter(None, _PARTS.split(attrs.get("schuttenummers", ""))))
        elif items and path and path[-1] == "item":
            if tag == "page":
                doc.pages[items[-1]].append((attrs.get("number"), attrs.get("source")))
            title.clear()
        path.append(tag if tag != "item" or (items and path and (len(path) == 1 or path[-1] == "item")) else "other")

    def end(tag: str) -> None:
        kind = path.pop()
        if kind == "item" and path:
            items.pop()
        elif tag == "title" and items and path[-1] == "item":
            doc.leaf(items[-1], "title", "".join(title))

    def data(chunk: str) -> None:
        if path and path[-1] == "title":
            title.append(chunk)

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
    try:
        parser.Parse(text, True)
    except (expat.ExpatError, UnicodeError):
        return None
    return doc.columns()


def _reject(word: str) -> None:
    raise ValueError(f"{word} is no JSON value")


def parse_json(text: str):
    """Strict JSON; falls back to an explicit stack where nesting is deeper than the interpreter recurses."""
    try:
        return json.loads(text, parse_constant=_reject)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(text: str):
    stack: list[list] = []
    at = _SPACE.match(text, 0).end()
    while True:
        ch = text[at : at + 1]
        if ch in ("{", "["):
            box = {} if ch == "{" else []
            at = _SPACE.match(text, at + 1).end()
            if text[at : at + 1] == ("}" if ch == "{" else "]"):
                value, at = box, at + 1
            else:
                stack.append([box, None])
                if ch == "{":
                    at = _key(text, at, stack[-1])
                continue
        elif ch == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _NUMBER.match(text, at):
            value, at = json.loads(m.group()), m.end()
        else:
            word = next((w for w in ("true", "false", "null") if text.startswith(w, at)), None)
            if word is None:
                raise ValueError(f"no JSON value at {at}")
            value, at = json.loads(word), at + len(word)
        while True:
            at = _SPACE.match(text, at).end()
            if not stack:
                if at != len(text):
                    raise ValueError(f"more text at {at}")
                return value
            box, key = stack[-1]
            if isinstance(box, dict):
                box[key] = value
            else:
                box.append(value)
            if text[at : at + 1] == ",":
                at = _SPACE.match(text, at + 1).end()
                if isinstance(box, dict):
                    at = _key(text, at, stack[-1])
                break
            if text[at : at + 1] != ("}" if isinstance(box, dict) else "]"):
                raise ValueError(f"no end of a list or an object at {at}")
            value, at = box, at + 1
            stack.pop()


def _key(text: str, at: int, top: list) -> int:
    if text[at : at + 1] != '"':
        raise ValueError(f"no key at {at}")
    top[1], at = scanstring(text, at + 1, True)
    at = _SPACE.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(f"no colon at {at}")
    return _SPACE.match(text, at + 1).end()


def _text(value):
    """A scalar as text; of an object its ``text`` member."""
    if isinstance(value, dict):
        value = value.get("text")
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return None if value is None or isinstance(value, (dict, list)) else str(value)


def shred_json(text: str) -> dict[str, Column] | None:
    """Shred a JSON document; None if it is not well-formed.  A single value may stand for a list or an object."""
    try:
        root = parse_json(text)
    except ValueError:
        return None
    doc = _Builder()
    top = root.get("toc") if isinstance(root, dict) else None
    todo: list[tuple[object, int]] = []

    def push(holder, depth: int) -> None:
        for one in reversed(holder if isinstance(holder, list) else [holder]):
            todo.append((one, depth))

    for holder in reversed(top if isinstance(top, list) else [top]):
        if isinstance(holder, dict):
            push(holder.get("item"), 1)
    while todo:
        node, depth = todo.pop()
        if isinstance(node, list):
            push(node, depth)
            continue
        if node is None:
            continue
        at = doc.open_item(depth)
        if not isinstance(node, dict):
            doc.leaf(at, "title", _text(node))
            continue
        for leaf in LEAVES:
            doc.leaf(at, leaf, _text(node.get(leaf)))
        many = node.get("schuttenummers")
        for value in many if isinstance(many, list) else [many]:
            doc.numbers[at].extend(filter(None, _PARTS.split(_text(value) or "")))
        page = node.get("page")
        for one in page if isinstance(page, list) else [page]:
            if isinstance(one, dict):
                doc.pages[at].append((_text(one.get("number")), _text(one.get("source"))))
            elif one is not None:
                doc.pages[at].append((_text(one), None))
        push(node.get("item"), depth + 1)
    return doc.columns()


def shred(text: str | None, kind: str | None) -> dict[str, Column] | None:
    if text is None or not text.strip():
        return None
    if kind not in ("xml", "json"):
        kind = "xml" if text.lstrip().startswith("<") else "json"
    return shred_xml(text) if kind == "xml" else shred_json(text)


def whole(value: str | None, default: int) -> int:
    """The whole number that is written, blanks around it ignored; else the default."""
    if value is not None and _WHOLE.match(value := value.strip()) and -(2**31) <= (n := int(value)) < 2**31:
        return n
    return default


# the tables and their columns beside the key
TABLES = {
    "links": [("item_seq", pa.int32()), ("parent_seq", pa.int32()), ("level", pa.int32()), ("schutte_nr", pa.int32())],
    "items": [("item_seq", pa.int32()), ("parent_seq", pa.int32()), ("depth", pa.int32()), ("level", pa.int32()), ("schutte_nr", pa.int32()), ("schutte_nr_text", pa.string()), ("title", pa.string()), ("n_pages", pa.int32()), ("page_number", pa.string()), ("page_source", pa.string()), ("n_numbers", pa.int32())],
    "pages": [("item_seq", pa.int32()), ("page_pos", pa.int32()), ("number", pa.string()), ("source", pa.string())],
    "numbers": [("item_seq", pa.int32()), ("number_pos", pa.int32()), ("number", pa.string())],
}


def table_rows(columns: dict[str, Column], table: str) -> list[list]:
    """The columns of one table, rebuilt from the levels of the leaf columns it needs."""
    if table == "numbers":
        return [list(c) for c in zip(*repeated_values(columns["schuttenummers"], 1))] or [[], [], []]
    if table == "pages":
        rows = [(item, pos, number, source) for (item, pos, number), (_, _, source) in zip(repeated_values(columns["page.number"], 2), repeated_values(columns["page.source"], 2))]
        return [list(c) for c in zip(*rows)] or [[], [], [], []]
    depth, level = single_values(columns["level"])
    n = len(depth)
    _, nr = single_values(columns["schutte_nr"])
    seq, parent, levels, numbers = list(range(1, n + 1)), parents(depth).tolist(), [whole(v, -1) for v in level], [whole(v, 0) for v in nr]
    if table == "links":
        return [seq, parent, levels, numbers]
    n_pages, n_numbers, page, source = [0] * n, [0] * n, [None] * n, [None] * n
    for item, pos, number, src in zip(*table_rows(columns, "pages")):
        n_pages[item - 1] = pos
        if pos == 1:
            page[item - 1], source[item - 1] = number, src
    for item, pos, _ in zip(*table_rows(columns, "numbers")):
        n_numbers[item - 1] = pos
    return [seq, parent, depth.tolist(), levels, numbers, nr, single_values(columns["title"])[1], n_pages, page, source, n_numbers]


def _batches(it: Iterator[pa.RecordBatch], table: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out: list[list] = [[] for _ in schema]
        for key, delivery, kind, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            columns = shred(text, kind)
            if columns is None or not columns["level"].rep:
                continue
            rows = table_rows(columns, table)
            for column, part in zip(out, ([key] * len(rows[0]), [delivery] * len(rows[0]), *rows)):
                column.extend(part)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, schema)], schema=schema)


def shred_table(docs: DataFrame, table: str, key: str = "toc_id", kind: str = "item_format", text: str = "item") -> DataFrame:
    """One table of every well-formed document: ``links`` (items with their parents), ``items``, ``pages`` or ``numbers``.

    Shredding is a narrow step over the scan.  Re-deliveries are removed from the flat rows, so the shuffle moves a few integers
    an item instead of whole documents.  A document counts by the least fingerprint of its deliveries.
    """
    rest = TABLES[table]
    schema = pa.schema([("_key", pa.int64()), ("_delivery", pa.int64()), *rest])
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string"}
    ddl = ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)
    told = docs.select(F.col(key).cast("bigint").alias("_key"), F.xxhash64(F.col(kind), F.col(text)).alias("_delivery"), F.col(kind).alias("_kind"), F.col(text).alias("_text"))
    chosen = told.where("_text is not null").groupBy("_key").agg(F.min("_delivery").alias("_least"))
    rows = told.where("_text is not null").mapInArrow(lambda it: _batches(it, table, schema), ddl)
    mine = rows.join(chosen.withColumnRenamed("_key", "_own"), F.col("_key").eqNullSafe(F.col("_own")) & (F.col("_delivery") == F.col("_least")), "left_semi")
    return mine.dropDuplicates(["_key", *(name for name, _ in rest[:2])]).select(F.col("_key").alias(key), *(name for name, _ in rest))


def shred_items(docs: DataFrame, key: str = "toc_id", kind: str = "item_format", text: str = "item", wide: bool = False) -> DataFrame:
    """One row per item of every well-formed document, with the link to the item it lies in."""
    return shred_table(docs, "items" if wide else "links", key, kind, text)
