"""Nested records to linked flat tables (problem 3).

`flatten` reads one JSON text a row and emits one row for each item of each relation, with the
keys of its parents. The text is taken apart by the structural index (`structural.build`), a
batch at a time; lists and objects that were delivered as JSON text within a string are
decoded and indexed again as a batch of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fjordfacts.operators import structural as S


@dataclass(frozen=True)
class Relation:
    """A list of items below a record or below the items of another relation.

    name: value of `child`. path: members that lead from the parent to the list.
    key: member that names an item. value: if set, the relation is a map or a list of
    {key, value}; every map entry is an item then. children: relations below each item.
    """

    name: str
    path: tuple[str, ...]
    key: str
    value: str | None = None
    children: tuple[Relation, ...] = field(default=())


#: The lists of a delivered filing record.
FILING = (
    Relation("page", ("manifest", "pages"), "page", children=(Relation("zone", ("zones",), "y0"),)),
    Relation("note", ("noter",), "nr", children=(Relation("amount", ("raw_amounts",), "label", value="value"),)),
    Relation("check", ("validation", "checks"), "field"),
)


@dataclass
class _Frame:
    """Nodes of one index with the row they belong to, the keys above them and the key an enclosing map gave them."""

    index: S.Index
    node: np.ndarray
    row: np.ndarray
    above: np.ndarray
    given: np.ndarray

    def take(self, at: np.ndarray, node: np.ndarray | None = None) -> _Frame:
        return _Frame(self.index, self.node[at] if node is None else node, self.row[at], self.above[at], self.given[at])


def _unwrap(frames: list[_Frame]) -> list[_Frame]:
    """Strings that hold a JSON list or object become that list or object."""
    out = []
    for f in frames:
        texts, at = [], []
        for i in np.flatnonzero(f.index.kind[f.node] == S.QUOTE):
            inner = (f.index.value_text(f.node[i]) or "").strip()
            if inner[:1] in ("[", "{"):
                at.append(i)
                texts.append(inner.encode())
        if not at:
            out.append(f)
            continue
        at = np.array(at)
        index = S.build(texts)
        ok = index.roots >= 0
        stay = np.setdiff1d(np.arange(len(f.node)), at[ok])
        out.append(f.take(stay))
        out += _unwrap([_Frame(index, index.roots[ok], f.row[at[ok]], f.above[at[ok]], f.given[at[ok]])])
    return [f for f in out if len(f.node)]


def _member(frames: list[_Frame], name: str) -> list[_Frame]:
    out = []
    for f in frames:
        at, child = f.index.children(f.node)
        hit = f.index.keys_equal(child, name) & (f.index.kind[f.node[at]] == S.OPEN_OBJECT)
        out.append(f.take(at[hit], child[hit]))
    return _unwrap([f for f in out if len(f.node)])


def _not_null(f: _Frame) -> _Frame:
    kind = f.index.kind[f.node]
    # of the JSON literals only null begins with n
    return f.take(np.flatnonzero(kind != ord("n")))


def _items(frames: list[_Frame], key: str) -> list[_Frame]:
    """List elements; a lone object that has the key is a list of one, any other object maps keys to elements."""
    out = []
    for f in frames:
        kind = f.index.kind[f.node]
        at, child = f.index.children(f.node)
        in_list = kind[at] == S.OPEN_ARRAY
        out.append(f.take(at[in_list], child[in_list]))
        objects = np.flatnonzero(kind == S.OPEN_OBJECT)
        if not len(objects):
            continue
        named = np.zeros(len(f.node), bool)
        hit = f.index.keys_equal(child, key) & ~in_list
        named[at[hit]] = True
        out.append(f.take(objects[named[objects]]))
        entry = np.flatnonzero(~in_list & ~named[at])
        inner = f.take(at[entry], child[entry])
        inner.given = np.array([f.index.key(n) for n in inner.node], object)
        keep = np.isin(inner.index.kind[inner.node], (S.OPEN_OBJECT, S.QUOTE))
        out.append(inner.take(np.flatnonzero(keep)))
    frames = _unwrap([g for g in (_not_null(f) for f in out) if len(g.node)])
    return [g for g in (f.take(np.flatnonzero(f.index.kind[f.node] == S.OPEN_OBJECT)) for f in frames) if len(g.node)]


def _entries(frames: list[_Frame], key: str, value: str) -> list[tuple[_Frame, np.ndarray]]:
    """Entries of a map, or of a list of {key, value} objects: (frame of the parents, keys)."""
    out = []
    for f in frames:
        kind = f.index.kind[f.node]
        at, child = f.index.children(f.node)
        is_map = kind == S.OPEN_OBJECT
        both = np.zeros(len(f.node), int)
        for name in (key, value):
            both[at[f.index.keys_equal(child, name)]] += 1
        single = is_map & (both == 2) & (np.bincount(at, minlength=len(f.node)) == 2)
        entry = np.flatnonzero(is_map[at] & ~single[at])
        g = f.take(at[entry], child[entry])
        out.append((g, np.array([f.index.key(n) for n in g.node], object)))
        elements = _unwrap([_not_null(f.take(at[~is_map[at]], child[~is_map[at]])), f.take(np.flatnonzero(single))])
        for e in elements:
            for named in _member([e.take(np.flatnonzero(e.index.kind[e.node] == S.OPEN_OBJECT))], key):
                out.append((named, _texts(named)))
    return [(f, k) for f, k in out if len(f.node)]


def _texts(f: _Frame) -> np.ndarray:
    out = np.empty(len(f.node), object)
    for i, n in enumerate(f.node):
        text = f.index.value_text(n)
        if text is not None and text.endswith(".0") and f.index.kind[n] != S.QUOTE:
            text = text[:-2]
        out[i] = text
    return out


def _keyed(frames: list[_Frame], key: str) -> list[tuple[_Frame, np.ndarray]]:
    """Each item with its key: the member of that name, else the key of the enclosing map; items without either are left out."""
    out = []
    for f in frames:
        keys = f.given.copy()
        at, child = f.index.children(f.node)
        hit = np.flatnonzero(f.index.keys_equal(child, key))
        found = _texts(f.take(at[hit], child[hit]))
        for i, text in zip(at[hit], found, strict=True):
            if text is not None:
                keys[i] = text
        has = np.array([k is not None for k in keys], bool)
        g = f.take(np.flatnonzero(has))
        if len(g.node):
            out.append((g, keys[has]))
    return out


def _walk(frames: list[_Frame], relations: tuple[Relation, ...], emit: list[tuple]) -> None:
    for rel in relations:
        at = frames
        for name in rel.path:
            at = _member(at, name)
        if rel.value is not None:
            for f, keys in _entries(at, rel.key, rel.value):
                emit.append((f.row, rel.name, f.above, keys))
            continue
        below = []
        for f, keys in _keyed(_items(at, rel.key), rel.key):
            emit.append((f.row, rel.name, f.above, keys))
            below.append(_Frame(f.index, f.node, f.row, keys, np.full(len(keys), None, object)))
        if rel.children and below:
            _walk(below, rel.children, emit)


def flatten_batch(ids: np.ndarray, texts: list[bytes], relations: tuple[Relation, ...]) -> pd.DataFrame:
    index = S.build(texts)
    ok = np.flatnonzero(index.roots >= 0)
    root = _Frame(index, index.roots[ok], ok, np.full(len(ok), "", object), np.full(len(ok), None, object))
    emit: list[tuple] = []
    _walk(_unwrap([root]), relations, emit)
    parts = [pd.DataFrame({"_row": r, "child": c, "parent_key": a, "item_key": k}) for r, c, a, k in emit if len(r)]
    if not parts:
        return pd.DataFrame({"_id": ids[:0], "child": [], "parent_key": [], "item_key": []}).astype({"child": object, "parent_key": object, "item_key": object})
    out = pd.concat(parts, ignore_index=True)
    out.insert(0, "_id", ids[out.pop("_row").to_numpy()])
    return out.dropna(subset=["item_key"]).drop_duplicates()


def flatten(df: DataFrame, id_col: str = "raw_id", json_col: str = "payload", relations: tuple[Relation, ...] = FILING) -> DataFrame:
    """One row (id, child, parent_key, item_key) for each item of each relation, distinct.

    Null, empty or malformed texts and texts whose root is no object give no rows. Null lists,
    null list elements and items without a key are none; a null amount still has its key and is
    a row. Only the two named columns are read, so further columns can't clash. Reading is a
    narrow stage; the one shuffle is that of the distinct result rows, after each batch has
    dropped its own repeats.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t.encode("utf-8", "replace") for t in pdf["_text"]]
            if texts:
                yield flatten_batch(pdf["_id"].to_numpy(), texts, relations)

    rows = df.select(df[id_col].alias("_id"), df[json_col].alias("_text")).where("_id is not null and _text is not null")
    out = rows.mapInPandas(run, f"_id {kind}, child string, parent_key string, item_key string")
    return out.distinct().withColumnRenamed("_id", id_col)
