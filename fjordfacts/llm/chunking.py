"""Oversized texts cut into overlapping pieces at natural boundaries (problem 9).

Every edge between pre-tokens is a possible cut. From each the farthest legal end of the next
piece is known at once by binary search: the piece starts `overlap` tokens back and holds at
most `limit` tokens. That gives one successor for each edge; squaring the successor table
doubles the number of cuts taken, so all greedy cuts of all texts of a batch are marked in
log2(pieces) rounds, without walking from cut to cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordfacts.llm import tokens

LIMIT, OVERLAP = 2000, 100
#: A more natural kind of boundary wins over a farther one if the piece is filled to this share.
FILLED = 0.5
KINDS = ("paragraph", "line", "sentence", "word", "token")


def _pretokens(text: str, count: tokens.Counter, most: int) -> list[tuple[str, int]]:
    """Pre-tokens with their exact tokens, 0 for those short enough to be described together. One of more than `most` tokens comes in stretches.

    Stretches end where both a token and a character end. A run of neighbouring tokens of an encoding
    is the encoding of its text, so the stretches' tokens add up to those of the whole.
    """
    found = tokens.split(text)
    if len(text) <= tokens.LONGEST or max(map(len, found)) <= tokens.LONGEST:
        return [(p, 0) for p in found]
    out = []
    for p in found:
        if len(p) <= tokens.LONGEST:
            out.append((p, 0))
            continue
        lengths = count.token_bytes(p)
        out += [(p, len(lengths))] if len(lengths) <= most else _stretches(p, lengths)
    return out


def _stretches(text: str, token_bytes: np.ndarray) -> list[tuple[str, int]]:
    """(stretch, tokens) between all places of the text where a character and a token end together."""
    raw = text.encode()
    ends = np.cumsum(token_bytes)
    leads = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80
    whole = np.r_[leads[ends[:-1]], True]
    cut = np.r_[0, ends[whole]]
    n = np.diff(np.r_[0, np.flatnonzero(whole) + 1])
    return [(raw[x:y].decode(), int(k)) for x, y, k in zip(cut[:-1], cut[1:], n, strict=True)]


def _edges(texts: list[str], count: tokens.Counter, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, token offset, character offset and kind of every edge: the one before each pre-token, and each text's end."""
    split = [_pretokens(t, count, most) for t in texts]
    sizes = np.array([len(s) for s in split])
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    is_end = np.zeros(len(text_of), bool)
    is_end[np.cumsum(sizes + 1) - 1] = True
    flat = list(chain.from_iterable(split))
    own = np.flatnonzero(~is_end)
    n_tokens, n_chars, marks = np.zeros((3, len(text_of)), np.int64)
    n_tokens[own], n_chars[own], marks[own] = count.describe([p for p, n in flat if not n], [(p, n) for p, n in flat if n], np.array([n > 0 for _, n in flat], bool))
    first = np.r_[0, np.flatnonzero(is_end)[:-1] + 1]

    def offsets(sizes_: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(sizes_)[:-1]]
        return total - total[first][text_of]

    space, lines = (marks & tokens.SPACE) > 0, marks // tokens.LINES
    before = np.r_[0, marks[:-1]]
    gap = space & ((before & tokens.SPACE) == 0)
    stop = np.minimum.accumulate(np.where(~space, np.arange(len(text_of)), len(text_of))[::-1])[::-1]
    seen = np.r_[0, np.cumsum(lines)]
    in_gap = seen[stop] - seen[np.arange(len(text_of))]
    plain = np.where((before & tokens.ENDS) > 0, 2, 3)
    kind = np.full(len(text_of), 4)
    kind[gap] = np.where(in_gap > 1, 0, np.where(in_gap == 1, 1, plain))[gap]
    led = ((marks & tokens.LED) > 0) & ((before & tokens.SPACE) == 0)
    kind[led] = plain[led]
    kind[is_end] = 0
    return text_of, offsets(n_tokens), offsets(n_chars), kind


def cuts(text_of: np.ndarray, at: np.ndarray, kind: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Which edges end a piece, and at which edge each such piece starts.

    text_of, at, kind: the text of each edge, its offset in tokens within the text and its kind; edges
    are ordered, each text has one at 0 and one at its end. A next piece starts at the last edge that
    lies at least `overlap` tokens back; edges with one exactly there are taken first, so the overlap
    is exact unless no edge of the window has one.
    """
    n = len(at)
    wide = int(at.max(initial=0)) + limit + overlap + 2
    key = text_of * wide + at
    first = np.flatnonzero(np.r_[True, text_of[1:] != text_of[:-1]])
    begin = np.repeat(first, np.diff(np.r_[first, n]))
    last = np.r_[first[1:], n] - 1
    end = np.repeat(last, np.diff(np.r_[first, n]))

    back = np.searchsorted(key, text_of * wide + np.maximum(at - overlap, 0), "right") - 1
    start = np.maximum(back, begin)
    start[begin == np.arange(n)] = begin[begin == np.arange(n)]
    exact = (at - at[start] == overlap) | (np.arange(n) == end)
    farthest = text_of * wide + at[start] + limit
    successor = np.full(n, -1)
    whole = at[end] - at[start] <= limit
    successor[whole] = end[whole]
    full = at[start] + FILLED * limit
    for must_be_exact in (True, False):
        for k in range(len(KINDS)):
            rows = np.flatnonzero(exact & (kind == k)) if must_be_exact else np.flatnonzero(kind == k)
            if not len(rows):
                continue
            pick = np.searchsorted(key[rows], farthest, "right") - 1
            found = rows[np.maximum(pick, 0)]
            good = (successor < 0) & (pick >= 0) & (text_of[found] == text_of) & (at[found] > at) & (at[found] >= full)
            successor[good] = found[good]
    rest = np.flatnonzero(successor < 0)
    pick = np.searchsorted(key, farthest[rest], "right") - 1
    successor[rest] = np.minimum(np.maximum(pick, rest + 1), end[rest])

    marked = np.zeros(n, bool)
    marked[successor[first]] = True
    jump, frontier = successor.copy(), -1
    while frontier != marked.sum():
        frontier = marked.sum()
        marked[jump[np.flatnonzero(marked)]] = True
        jump = jump[jump]
    ends = np.flatnonzero(marked)
    before = np.r_[-1, ends[:-1]]
    opening = np.r_[True, text_of[ends[1:]] != text_of[ends[:-1]]] if len(ends) else np.zeros(0, bool)
    return ends, np.where(opening, begin[ends], start[np.maximum(before, 0)])


def split_batch(ids: np.ndarray, texts: list[str], limit: int, overlap: int, path: str | None = None) -> pd.DataFrame:
    count = tokens.counter(path)
    columns = ["_id", "piece", "start_token", "n_tokens", "start_char", "end_char", "boundary", "whole"]
    if not texts:
        return pd.DataFrame(columns=columns)
    text_of, at, chars, kinds = _edges(texts, count, max(1, (limit - overlap) // 4))
    total = at[np.r_[np.flatnonzero(text_of[1:] != text_of[:-1]), len(at) - 1]]
    ends, starts = cuts(text_of, at, kinds, limit, overlap)
    owner = text_of[ends]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    number = np.arange(len(ends)) - np.repeat(first, np.diff(np.r_[first, len(ends)]))
    return pd.DataFrame({
        "_id": ids[owner], "piece": number, "start_token": at[starts], "n_tokens": at[ends] - at[starts], "start_char": chars[starts],
        "end_char": chars[ends], "boundary": np.array(KINDS, object)[kinds[ends]], "whole": total[owner] <= limit,
    })


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True, only_cut: bool = False, path: str | None = None) -> DataFrame:
    """id, piece (from 0), start_token, n_tokens, start_char, end_char, boundary and the piece's text.

    Texts within the limit give one piece. Null texts give none, an empty text gives one empty piece.
    With `only_cut`, texts within the limit are left out, and those of at most `limit` bytes, which
    can't have more tokens, stay unread. A pre-token of more than a quarter of the room for new tokens
    may be cut at the edges of its own tokens.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, piece int, start_token bigint, n_tokens bigint, start_char bigint, end_char bigint, boundary string, text string"
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64]
                texts = list(part["_text"])
                out = split_batch(np.arange(len(part)), texts, limit, overlap, path)
                if only_cut:
                    out = out[~out["whole"].astype(bool)]
                row = out["_id"].to_numpy(int)
                out["text"] = [texts[i][a:b] for i, a, b in zip(row, out["start_char"], out["end_char"], strict=True)] if with_text else None
                out["_id"] = part["_id"].to_numpy()[row]
                yield out.drop(columns="whole")

    if only_cut:
        src = src.where(F.octet_length("_text") > limit)
    out = src.mapInPandas(run, schema).withColumnRenamed("_id", id_col)
    return out if with_text else out.drop("text")
