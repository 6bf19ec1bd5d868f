"""Structural index of JSON text, built with whole-batch array operations.

All texts of a batch lie in one byte array. Bitmaps mark the quotes that are not escaped,
the bytes inside strings and the brackets, commas and colons outside them; a prefix sum over
the brackets gives the depth of each mark; a stable sort by (text, depth) puts the marks of
one container side by side, which yields the spans of its members without any recursion.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

QUOTE, BACKSLASH, COMMA, COLON = 34, 92, 44, 58
OPEN_OBJECT, CLOSE_OBJECT, OPEN_ARRAY, CLOSE_ARRAY = 123, 125, 91, 93
_SPACE = np.zeros(256, bool)
_SPACE[[0, 9, 10, 13, 32]] = True
_MARK = np.zeros(256, bool)
_MARK[[COMMA, COLON, OPEN_OBJECT, CLOSE_OBJECT, OPEN_ARRAY, CLOSE_ARRAY]] = True


@dataclass
class Index:
    """Nodes of all texts of a batch. Spans are half open; keys stand without their quotes."""

    data: bytes
    text: np.ndarray  # number of the text that holds the node
    parent: np.ndarray  # mark that opens the enclosing container, -1 at the root
    own: np.ndarray  # mark that opens the node itself, -1 for scalars
    kind: np.ndarray  # first byte of the value
    key_from: np.ndarray
    key_to: np.ndarray
    value_from: np.ndarray
    value_to: np.ndarray
    roots: np.ndarray  # node number of each text's root, -1 if the text is malformed
    by_parent: np.ndarray  # node numbers ordered by parent
    parents: np.ndarray  # parent[by_parent]

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in `nodes`, child node) for every direct member of the given containers."""
        own = self.own[nodes]
        low, high = np.searchsorted(self.parents, own, "left"), np.searchsorted(self.parents, own, "right")
        count = np.where(own >= 0, high - low, 0)
        at = np.repeat(np.arange(len(nodes)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return at, self.by_parent[np.repeat(low, count) + offset]

    def raw(self, node: int) -> bytes:
        return self.data[self.value_from[node] : self.value_to[node]]

    def key(self, node: int) -> str:
        return unquote(self.data[self.key_from[node] : self.key_to[node]])

    def value_text(self, node: int) -> str | None:
        """A scalar as text: strings decoded, numbers and literals as written, null as None; containers as JSON."""
        kind = self.kind[node]
        if kind == QUOTE:
            return unquote(self.data[self.value_from[node] + 1 : self.value_to[node] - 1])
        found = self.raw(node)
        return None if found == b"null" else found.decode("utf-8", "replace")

    def keys_equal(self, nodes: np.ndarray, name: str) -> np.ndarray:
        """Which of the nodes have this member name (names written with escapes included)."""
        want = name.encode()
        length = self.key_to[nodes] - self.key_from[nodes]
        hit = length == len(want)
        array = np.frombuffer(self.data, np.uint8)
        for i, b in enumerate(want):
            where = np.flatnonzero(hit)
            hit[where] = array[self.key_from[nodes[where]] + i] == b
        for i in np.flatnonzero(~hit & (length > len(want))):
            span = self.data[self.key_from[nodes[i]] : self.key_to[nodes[i]]]
            if b"\\" in span:
                hit[i] = unquote(span) == name
        return hit


def unquote(span: bytes) -> str:
    if b"\\" in span:
        try:
            return json.loads(b'"' + span + b'"')
        except ValueError:
            pass
    return span.decode("utf-8", "replace")


def build(texts: list[bytes]) -> Index:
    """Indexes a batch. A text that isn't one closed JSON value has root -1 and no nodes."""
    data = b"\x00".join(texts) + b"\x00"
    b = np.frombuffer(data, np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths + 1) - (lengths + 1)
    here = np.arange(len(b), dtype=np.int64)
    text_of = np.repeat(np.arange(len(texts)), lengths + 1)

    plain = np.maximum.accumulate(np.where(b != BACKSLASH, here, -1))
    before = np.where(here > 0, plain[here - 1], -1)
    escaped = ((here - 1 - before) & 1).astype(bool)
    quote = (b == QUOTE) & ~escaped
    seen = np.cumsum(quote, dtype=np.int64)
    offset = seen[first] - quote[first]
    inside = ((seen - offset[text_of]) & 1).astype(bool)

    at = np.flatnonzero(_MARK[b] & ~inside & ~quote)
    mark, owner = b[at], text_of[at]
    opens = (mark == OPEN_OBJECT) | (mark == OPEN_ARRAY)
    closes = (mark == CLOSE_OBJECT) | (mark == CLOSE_ARRAY)
    depth = np.cumsum(opens.astype(np.int64) - closes)
    start = np.searchsorted(owner, np.arange(len(texts)), "left")
    end = np.searchsorted(owner, np.arange(len(texts)), "right")
    base = np.where(start > 0, depth[np.maximum(start - 1, 0)], 0) if len(depth) else np.zeros(len(texts), np.int64)
    level = depth - base[owner] + closes
    good = ((seen[first + lengths] - offset) & 1) == 0
    if len(level):
        low = np.zeros(len(texts), bool)
        low[owner[level < 1]] = True
        last = np.where(end > start, depth[np.maximum(end - 1, 0)] - base, 0)
        good &= ~low & (last == 0)

    order = np.lexsort((at, level, owner))
    o_mark, o_at, o_owner, o_opens, o_closes = mark[order], at[order], owner[order], opens[order], closes[order]
    opener = np.maximum.accumulate(np.where(o_opens, np.arange(len(order)), -1)) if len(order) else order
    token = order[opener] if len(order) else order
    pair_ok = np.where(o_closes, o_mark == np.where(mark[token] == OPEN_OBJECT, CLOSE_OBJECT, CLOSE_ARRAY) if len(order) else False, True)
    good[o_owner[~pair_ok]] = False

    next_full = np.minimum.accumulate(np.where(~_SPACE[b], here, len(b))[::-1])[::-1]
    last_full = np.maximum.accumulate(np.where(~_SPACE[b], here, -1))

    i = np.flatnonzero(~o_closes & (o_mark != COLON))
    i = i[i + 1 < len(order)]
    keyed = o_mark[i + 1] == COLON
    keyed &= i + 2 < len(order)
    stop = np.where(keyed, np.minimum(i + 2, len(order) - 1), i + 1)
    v_from = next_full[np.where(keyed, o_at[i + 1], o_at[i]) + 1]
    v_to = last_full[o_at[stop] - 1] + 1
    k_from, k_to = next_full[o_at[i] + 1] + 1, last_full[np.maximum(o_at[i + 1] - 1, 0)]
    k_from, k_to = np.where(keyed, k_from, 0), np.where(keyed, k_to, 0)
    keep = (v_from < v_to) & good[o_owner[i]] & (keyed | (mark[token[i]] == OPEN_ARRAY))
    i, v_from, v_to, k_from, k_to = i[keep], v_from[keep], v_to[keep], k_from[keep], k_to[keep]

    r_from, r_to = next_full[first], last_full[first + lengths] + 1
    root = np.flatnonzero(good & (r_from < first + lengths))
    lone = np.searchsorted(at, r_from[root])
    roots = np.full(len(texts), -1, np.int64)
    roots[root] = np.arange(len(root))

    v_from, v_to = np.concatenate((r_from[root], v_from)), np.concatenate((r_to[root], v_to))
    kind = b[v_from]
    own = np.full(len(v_from), -1, np.int64)
    box = np.flatnonzero((kind == OPEN_OBJECT) | (kind == OPEN_ARRAY))
    own[box] = np.searchsorted(at, v_from[box])
    parent = np.concatenate((np.full(len(root), -1, np.int64), token[i]))
    by_parent = np.argsort(parent, kind="stable")
    del lone
    zero = np.zeros(len(root), np.int64)
    return Index(
        data, np.concatenate((root, o_owner[i])), parent, own, kind, np.concatenate((zero, k_from)),
        np.concatenate((zero, k_to)), v_from, v_to, roots, by_parent, parent[by_parent],
    )


def type_of(kind: int, raw: bytes) -> str | None:
    """JSON type of a value by its first byte; None for null."""
    if kind == QUOTE:
        return "string"
    if kind == OPEN_OBJECT:
        return "object"
    if kind == OPEN_ARRAY:
        return "array"
    if raw in (b"true", b"false"):
        return "boolean"
    return None if raw == b"null" else "number"
