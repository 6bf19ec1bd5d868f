"""Evaluation texts leaking into a training corpus (problem 7).

1. One pass over the corpus turns every whole text into normalised words and keeps them as hashes;
   all blocks of items work on these.
2. Passages: runs of words that the items use; other words, as of scan lines in between, are skipped.
   TF-IDF weighs them by the number of all documents that hold a word.
3. Latent space: a distributed randomised SVD. The range finder multiplies by the passages where
   they are; only matrices of the size items' words x rank are summed up. It is fitted on all passages of
   the items and on at most FIT of the corpus, chosen by a hash; every passage is then embedded.
4. Candidate search: every passage of every document against the index of the items' passages, by cosine.
   Nothing else makes a candidate.
5. Check: the longest common subsequence around a candidate, for many at once in 64-bit words, must
   be long enough for a leak. A local alignment that pays for gaps then must cover `least` running
   words of the item; at least half of the numbers in them, the answers of these texts, must agree:
   items share whole phrases, but not their numbers.

Items are the query side. They are taken in blocks of bounded size, so what is broadcast has a bound.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordfacts.session import cut, spread

#: Items of one block.
BLOCK = 4096
#: Item words of a passage; steps between passages of documents and of items.
PASSAGE, STEP, ITEM_STEP = 28, 14, 7
RANK, OVERSAMPLING, POWER_ROUNDS = 128, 16, 2
#: Most passages of the corpus that the latent space is fitted on. More of them only turn it from what parts the items to what parts the corpus.
FIT = 4096
#: Least cosine of a candidate.
COSINE = 0.55
#: Words around a candidate's passages within which the common subsequence is sought: in the document and in the item (64 together with the passage).
AROUND, ITEM_AROUND = 24, 18
#: Words around a candidate that the alignment sees.
MARGIN = 36
#: Running words of the item that make a leak; gap and mismatch costs of the alignment, least share of matching words.
LEAST, GAP, SHARE = 25, 0.6, 0.7
#: Words of one part of an item; a longer item comes in parts that overlap by OVERLAP words.
PART, OVERLAP = 8192, 256
#: What foreign lines between two words of the item cost at most in a second alignment, and its share: phrases that items have in common can be strung together so, but not this closely.
LEAP, CLOSE = 1.8, 0.85

_WORD = re.compile(r"\w+")
_INVISIBLE = dict.fromkeys([*range(0x200B, 0x2010), 0x2060, 0xFEFF, 0x00AD, 0x180E, *range(0x202A, 0x202F)])
_BROKEN = re.compile(r"[-‐‑­¬][ \t]*\n[ \t]*")
_ODD = frozenset(map(chr, [*_INVISIBLE, *range(0x2100, 0x2150), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F), *range(0x0370, 0x0500), *range(0x0300, 0x0370), *range(0x1D400, 0x1D800)])) | frozenset("ÃÂ&")
_MOJIBAKE = re.compile(r"[ÂÃâ][\u0080-¿ŒœŠšŸŽžƒˆ˜–—‘-„†-•…‰‹›€™]{1,2}")
#: Letters of other scripts that look like Latin ones, and signs that a scan puts for letters.
_ALIKE = str.maketrans("аеорсухіјѕοαεινρı†€|", "aeopcyxijsoaeivpitel")
_SCAN = str.maketrans({"0": "o", "1": "l", "i": "l", "5": "s", "9": "g", "8": "b", "6": "b", "ø": "o", "æ": "a", "å": "a"})


def _repair(found: re.Match) -> str:
    try:
        return found[0].encode("cp1252").decode("utf-8")
    except UnicodeError:
        return found[0]


def plain(text: str) -> str:
    """The text without invisible signs, line-end hyphens, wrong decodings, entities and compatibility forms."""
    odd = _ODD.intersection(text)
    if odd:
        if "&" in odd:
            text = html.unescape(text)
        if odd & {"Ã", "Â"}:
            text = _MOJIBAKE.sub(_repair, text)
        text = unicodedata.normalize("NFKC", text.translate(_INVISIBLE))
    if "\n" in text:
        text = _BROKEN.sub("", text)
    return text


def skeleton(word: str) -> str:
    """What stays of a word in spite of case, accents and scan errors. Numbers stay apart from words."""
    if word.isdigit():
        return word
    w = word.casefold().translate(_ALIKE).translate(_SCAN)
    w = "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
    return w.replace("rn", "m").replace("cl", "d").replace("vv", "w")


class _Hashes(dict):
    """Word -> hash of its skeleton; remembers what it was asked."""

    def __missing__(self, word: str) -> int:
        found = self[word] = zlib.crc32(skeleton(word).encode())
        return found


def words(text: str) -> list[str]:
    return _WORD.findall(plain(text).replace("€", "e").replace("†", "t").replace("|", "l"))


@dataclass
class Items:
    """One block of items: ids, words as indices into the sorted hashes of all their words, and which of those are numbers."""

    ids: list[int]
    sequences: list[np.ndarray]
    hashes: np.ndarray
    numeric: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, str]]) -> Items:
        known, texts = _Hashes(), [words(text) for _, text in rows]
        coded = [np.fromiter(map(known.__getitem__, t), np.uint32, len(t)) for t in texts]
        hashes = np.unique(np.concatenate(coded)) if coded else np.zeros(0, np.uint32)
        parts = [(i, c[a : a + PART]) for (i, _), c in zip(rows, coded, strict=True) for a in range(0, max(1, len(c) - OVERLAP), PART - OVERLAP)]
        numeric = np.zeros(len(hashes), bool)
        numeric[np.searchsorted(hashes, np.array([h for w, h in known.items() if w.isdigit()], np.uint32))] = True
        return Items([i for i, _ in parts], [np.searchsorted(hashes, c) for _, c in parts], hashes, numeric)

    def look_up(self, coded: np.ndarray) -> np.ndarray:
        """Indices of hashed words, -1 for words that no item has."""
        at = np.minimum(np.searchsorted(self.hashes, coded), len(self.hashes) - 1)
        return np.where(self.hashes[at] == coded, at, -1)

    def passages(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Item, first word and words of every passage, in order."""
        found = [(i, w) for i, s in enumerate(self.sequences) if len(s) for w in _windows(len(s))]
        owner, at = (np.array(x, int) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
        return owner, at, [self.sequences[i][w : w + PASSAGE] for i, w in found]

    def padded(self) -> np.ndarray:
        """One row for each item: its words with ITEM_AROUND places before and 64 behind; -2 where there is none."""
        longest = max(map(len, self.sequences), default=0)
        out = np.full((len(self.sequences), longest + ITEM_AROUND + 64), -2, np.int32)
        for r, s in enumerate(self.sequences):
            out[r, ITEM_AROUND : ITEM_AROUND + len(s)] = s
        return out


def _windows(n: int) -> list[int]:
    return [0] if n <= PASSAGE else [*range(0, n - PASSAGE, ITEM_STEP), n - PASSAGE]


def coded(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, w): the hashes of all words of each text, four bytes each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for pdf in batches:
            if len(known) > 400_000:
                known.clear()
            lists = map(words, pdf["_text"])
            yield pd.DataFrame({"doc_id": pdf["_id"], "w": [np.fromiter(map(known.__getitem__, t), np.uint32, len(t)).tobytes() for t in lists]})

    src = documents.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text")).where("_text is not null and _id is not null")
    return spread(src).mapInPandas(run, "doc_id bigint, w binary")


@dataclass
class _Batch:
    """Some texts' words: all in a row, with which of them an item has, and those ones alone, texts parted by AROUND places of -1."""

    ids: np.ndarray
    flat: np.ndarray
    first: np.ndarray
    text_of: np.ndarray
    words: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(items: Items, ids: np.ndarray, texts: list[bytes]) -> _Batch:
        sizes = np.array([len(t) // 4 for t in texts])
        flat = items.look_up(np.frombuffer(b"".join(texts), np.uint32))
        at = np.flatnonzero(flat >= 0)
        return _Batch(ids, flat, np.r_[0, np.cumsum(sizes)], np.repeat(np.arange(len(texts)), sizes)[at], flat[at], at)

    def document_counts(self, v: int) -> np.ndarray:
        return np.bincount(np.unique(self.text_of * v + self.words) % v, minlength=v)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every run of STEP item words of a text: its first word and its text."""
        n = np.bincount(self.text_of, minlength=len(self.ids))
        start = np.cumsum(n) - n
        first = np.flatnonzero((np.arange(len(self.words)) - start[self.text_of]) % STEP == 0)
        return first, self.text_of[first]


def _batches(items: Items, pdfs: Iterator[pd.DataFrame], words_a_batch: int = 1 << 18) -> Iterator[_Batch]:
    for pdf in pdfs:
        ids, texts = pdf["doc_id"].to_numpy(), list(pdf["w"])
        size, a = 0, 0
        for b, t in enumerate(texts):
            size += len(t) // 4
            if size >= words_a_batch or b + 1 == len(texts):
                yield _Batch.of(items, ids[a : b + 1], texts[a : b + 1])
                size, a = 0, b + 1


def _document_counts(coded_texts: DataFrame, shared) -> tuple[np.ndarray, int, int]:  # noqa: ANN001
    """In how many documents each word of the items occurs, documents, and runs of PASSAGE item words, over all documents."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: Items = shared.value
        v = len(items.hashes)
        total = np.zeros(v + 2, np.int64)
        for b in _batches(items, pdfs):
            total[:v] += b.document_counts(v)
            total[v:] += len(b.ids), len(b.blocks()[0]) * STEP // PASSAGE + 1
        yield pd.DataFrame({"n": [total]})

    rows = coded_texts.mapInPandas(run, "n array<bigint>").select(F.posexplode("n").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(shared.value.hashes) + 2, np.int64)
    out[rows["i"].to_numpy(int)] = rows["n"]
    return out[:-2], int(out[-2]), int(out[-1])


def _fit_passages(coded_texts: DataFrame, shared, share: float) -> DataFrame:  # noqa: ANN001
    """(w): disjoint passages of the corpus, chosen by a hash of document and place."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: Items = shared.value
        for b in _batches(items, pdfs):
            first, text = b.blocks()
            even = first[(np.arange(len(first)) - np.searchsorted(text, text)) % 2 == 0]
            mixed = (b.ids[b.text_of[even]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + even.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
            chosen = even[mixed < share * 2**32]
            ends = np.minimum(chosen + PASSAGE, np.searchsorted(b.text_of, b.text_of[chosen], "right"))
            yield pd.DataFrame({"w": pd.Series([b.words[x:y].astype(np.int32) for x, y in zip(chosen, ends, strict=True)], dtype=object)})

    return coded_texts.mapInPandas(run, "w array<int>")


def _tfidf(passages: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages as sparse rows (row, column, value) of length 1; repeated words count with 1 + log."""
    row = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
    col = np.concatenate(passages) if passages else np.zeros(0, np.int64)
    keep = col >= 0
    key, count = np.unique(row[keep].astype(np.int64) * len(idf) + col[keep], return_counts=True)
    row, col = key // len(idf), key % len(idf)
    value = (1 + np.log(count)) * idf[col]
    norm = np.sqrt(np.bincount(row, value**2, len(passages)))
    return row, col, value / np.maximum(norm[row], 1e-12)


def _times(row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int, right: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    out = np.zeros((n, right.shape[1]))
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] = np.add.reduceat(right[col] * value[:, None], first, axis=0)
    return out


def latent_space(passages: DataFrame, own: list[np.ndarray], idf: np.ndarray, rank: int = RANK, seed: int = 42) -> np.ndarray:
    """Basis (words x rank) of the leading right singular space of the TF-IDF passages given and of the items' own."""
    v = len(idf)
    k = min(v, rank + OVERSAMPLING)
    spark = passages.sparkSession
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((v, k)))[0]

    def gram(parts: tuple, n: int, right: np.ndarray) -> np.ndarray:
        row, col, value = parts
        left = _times(row, col, value, n, right)
        out = np.zeros((v, right.shape[1]))
        order = np.argsort(col, kind="stable")
        c = col[order]
        if len(c):
            first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            out[c[first]] = np.add.reduceat(left[row[order]] * value[order][:, None], first, axis=0)
        return out

    for _ in range(POWER_ROUNDS):
        shared = spark.sparkContext.broadcast((basis, idf))

        def partial(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            right, weights = shared.value
            total = np.zeros((len(weights), right.shape[1]))
            for pdf in batches:
                if len(pdf):
                    total += gram(_tfidf([np.asarray(w, np.int64) for w in pdf["w"]], weights), len(pdf), right)
            where = np.flatnonzero(np.abs(total).sum(1) > 0)
            if len(where):
                yield pd.DataFrame({"word": where, "x": [total[i] for i in where]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"word": [pdf["word"].iloc[0]], "x": [np.stack(pdf["x"].to_numpy()).sum(0)]})

        summed = passages.mapInPandas(partial, "word bigint, x array<double>").groupBy("word").applyInPandas(add, "word bigint, x array<double>").toPandas()
        y = gram(_tfidf(own, idf), len(own), basis)
        if len(summed):
            y[summed["word"].to_numpy()] += np.stack(summed["x"].to_numpy())
        u, s, _ = np.linalg.svd(y, full_matrices=False)
        basis = u[:, s > 1e-9 * max(s.max(initial=0), 1e-9)]
        shared.unpersist()
    return basis[:, :rank]


#: Fields of an alignment's state, from the lowest: the item word it starts at, matching numbers, matching words; above them the score in tenths.
_FIELD, _SCORE = 14, 42


def align(docs: list[np.ndarray], items: list[np.ndarray], numeric: np.ndarray, leap_cost: float | None = None) -> np.ndarray:
    """Of each pair the best local alignment: running words of the item it covers, matching words, item numbers covered, numbers matching.

    A common subsequence in which every word left out on either side costs GAP; with
    `leap_cost`, words of the document in one place, such as scan lines, don't cost more than that together.
    The pairs of a batch advance together, one word of all documents at a time. Score and state are one
    integer, so the greater of two ways is also the state that goes on.
    """
    size, n, m = len(docs), max(map(len, docs)), max(map(len, items))
    d, t = np.full((n, size), -1, np.int32), np.full((m, size), -2, np.int32)
    for r in range(size):
        d[: len(docs[r]), r], t[: len(items[r]), r] = docs[r], items[r]
    is_number = np.where(t >= 0, numeric[np.maximum(t, 0)], False).astype(np.int64)
    upto = np.concatenate((np.zeros((1, size), np.int64), np.cumsum(is_number, 0)))
    one = np.int64(1) << _SCORE
    gap, leap = round(10 * GAP) * one, None if leap_cost is None else round(10 * leap_cost) * one
    gain = 10 * one + (np.int64(1) << 2 * _FIELD) + (is_number << _FIELD)
    base = np.arange(m + 1, dtype=np.int64)[:, None]
    steps = base * gap
    state = np.broadcast_to(base, (m + 1, size)).copy()
    far = state - (leap or 0)
    best, best_end = np.zeros(size, np.int64), np.zeros(size, np.int64)
    rows = np.arange(size)
    for i in range(n):
        came = np.where(d[i] == t, gain, -gap)
        came += state[:-1]
        if leap is not None:
            np.maximum(far, state - leap, out=far)
            np.maximum(came, far[1:], out=came)
        np.maximum(came, state[1:] - gap, out=came)
        np.maximum(came, base[1:], out=state[1:])
        state += steps
        np.maximum.accumulate(state, 0, out=state)
        state -= steps
        at = state.argmax(0)
        now = state[at, rows]
        better = now >> _SCORE > best >> _SCORE
        best[better], best_end[better] = now[better], at[better]
    field = (1 << _FIELD) - 1
    start = best & field
    return np.stack((best_end - start, best >> 2 * _FIELD & field, upto[best_end, rows] - upto[start, rows], best >> _FIELD & field), 1)


def densely_shared(docs: np.ndarray, items: np.ndarray, least: int, shares: tuple[float, ...]) -> np.ndarray:
    """Whether each row of `docs` has a common subsequence with `least` or more running words of the same row of `items` (64 words) that fills the share of them; one column for each share.

    One bit stands for each word of the item. Sequences start at every fourth word, so a run that begins
    in between is judged with up to three words more: none that fills the share is lost.
    """
    masks = np.packbits(docs[:, :, None] == items[:, None, :], axis=2, bitorder="little").view(np.uint64)[:, :, 0]
    least = min(least, 60)
    starts = np.arange(0, 65 - least, 4, dtype=np.uint64)
    left = np.full((len(docs), len(starts)), ~np.uint64(0))
    for k in range(docs.shape[1]):
        same = left & masks[:, k, None] >> starts
        left = (left + same) | (left - same)
    out = np.zeros((len(docs), len(shares)), bool)
    for length in range(least, 62):
        common = np.bitwise_count(~left & np.uint64((1 << length + 3) - 1)).max(1)
        for c, share in enumerate(shares):
            out[:, c] |= common >= share * length
    return out


@dataclass
class Index:
    """What a document is searched with: the items, the weighted basis and the items' passages in the latent space."""

    items: Items
    weighted: np.ndarray
    vectors: np.ndarray
    owner: np.ndarray
    at: np.ndarray
    padded: np.ndarray

    @staticmethod
    def of(items: Items, idf: np.ndarray, basis: np.ndarray) -> Index:
        owner, at, own = items.passages()
        # a row of zeros stands for the words that a last passage lacks
        weighted = np.vstack((basis * idf[:, None], np.zeros((1, basis.shape[1])))).astype(np.float32)
        first = np.cumsum([0, *(len(p) for p in own)])[:-1]
        vectors = np.add.reduceat(weighted[np.concatenate(own)], first, axis=0)
        return Index(items, weighted, _unit(vectors), owner, at, items.padded())

    def candidates(self, b: _Batch, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word of the passage, item and first word of its nearest passage, of every pair of a document's passage and an item within the cosine."""
        first, text = b.blocks()
        if not len(first):
            return (np.zeros(0, int),) * 3
        size = np.minimum(np.r_[first[1:], len(b.words)] - first, STEP)
        sums = self.weighted[b.words[first]]
        for k in range(1, STEP):
            sums += self.weighted[np.where(k < size, b.words[np.minimum(first + k, len(b.words) - 1)], -1)]
        follows = np.flatnonzero(text[1:] == text[:-1])
        sums[follows] += sums[follows + 1]
        # the last run of a text is a passage of its own only if there is no other
        whole = np.r_[text[1:] == text[:-1], False] | np.r_[True, text[1:] != text[:-1]]
        first, vectors = first[whole], _unit(sums[whole])
        out = []
        step = max(16, (1 << 22) // len(self.vectors))
        for x in range(0, len(vectors), step):
            close = vectors[x : x + step] @ self.vectors.T
            hit = np.flatnonzero(close >= cosine)
            if not len(hit):
                continue
            row, col = np.divmod(hit, close.shape[1])
            value = close.ravel()[hit]
            item = self.owner[col]
            start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])])
            best = np.maximum.reduceat(value, start)
            top = np.flatnonzero(value == np.repeat(best, np.diff(np.r_[start, len(value)])))
            top = top[np.r_[True, (row[top][1:] != row[top][:-1]) | (item[top][1:] != item[top][:-1])]]
            out.append((first[x + row[top]], item[top], self.at[col[top]]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 3

    def leaks(self, b: _Batch, least: int, cosine: float) -> list[tuple[int, int, int, int]]:
        """(doc_id, item_id, words, matched) of a batch."""
        first, item, at = self.candidates(b, cosine)
        dense = np.zeros((len(first), 2), bool)
        low, high = np.searchsorted(b.text_of, b.text_of[first]), np.searchsorted(b.text_of, b.text_of[first], "right")
        place = np.arange(-AROUND, PASSAGE + AROUND)
        for x in range(0, len(first), 1024):
            part = slice(x, x + 1024)
            where = first[part, None] + place
            inside = (where >= low[part, None]) & (where < high[part, None])
            docs = np.where(inside, b.words[np.clip(where, 0, len(b.words) - 1)], -1).astype(np.int32)
            theirs = self.padded[item[part, None], at[part, None] + np.arange(64)]
            dense[part] = densely_shared(docs, theirs, least, (SHARE, CLOSE))
        if not dense.any():
            return []
        order = np.lexsort((first, item, low))
        order = order[dense[order, 0]]
        first, item, low, high, close = first[order], item[order], low[order], high[order], dense[order, 1]
        # passages of one item that are near each other make one stretch
        new = np.r_[True, (low[1:] != low[:-1]) | (item[1:] != item[:-1]) | (first[1:] - first[:-1] > PASSAGE + 2 * AROUND)]
        start = np.flatnonzero(new)
        end = np.r_[start[1:], len(first)] - 1
        doc = b.text_of[first[start]]
        # words of items next to the stretch belong to it, with MARGIN other words around
        a = b.at[np.maximum(first[start] - AROUND, low[start])]
        z = b.at[np.minimum(first[end] + PASSAGE + AROUND, high[end]) - 1] + 1
        near_a, near_z = b.at[first[start]] - MARGIN, b.at[np.minimum(first[end] + PASSAGE, high[end]) - 1] + 1 + MARGIN
        a, z = np.maximum(np.maximum(a, near_a), b.first[doc]), np.minimum(np.minimum(z, near_z), b.first[doc + 1])
        return self._checked(b, doc, item[start], [b.flat[i:j] for i, j in zip(a, z, strict=True)], np.maximum.reduceat(close, start), least)

    def _checked(self, b: _Batch, doc: np.ndarray, item: np.ndarray, own: list[np.ndarray], close: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
        theirs = [self.items.sequences[i] for i in item]
        found = []
        left = np.argsort([len(w) for w in own], kind="stable")
        for share, leap in ((SHARE, None), (CLOSE, LEAP)):
            left = left if leap is None else left[close[left]]
            done = set()
            for at in range(0, len(left), 256):
                some = left[at : at + 256]
                for r, (covered, matched, numbers, same) in zip(some, align([own[r] for r in some], [theirs[r] for r in some], self.items.numeric, leap), strict=True):
                    if covered >= least and matched >= share * covered and 2 * same >= numbers:
                        found.append((int(b.ids[doc[r]]), self.items.ids[item[r]], int(covered), int(matched)))
                        done.add(r)
            left = np.array([r for r in left if r not in done], int)
        return found


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), np.float32(1e-9))


def leaked(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = LEAST, cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id, words, matched): documents that hold `least` or more running words of an item, and of how many words the best stretch is.

    Null texts on either side give nothing; items of fewer words than `least` can't leak by this
    definition. Repeated documents and items give each pair once. Very long texts are read whole.
    """
    rows = items.where(f"{item_text} is not null and {item_id} is not null").select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).distinct()
    blocks = max(1, -(-rows.count() // BLOCK))
    texts, out = cut(coded(documents, id_col, text_col)), None
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).orderBy("i", "t").toPandas()
        found = _leaked_block(texts, Items.of(list(zip(block["i"], block["t"], strict=True))), least, cosine)
        out = found if out is None else out.unionByName(found)
    best = F.max(F.struct("matched", "words")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.words", "b.matched")


def _leaked_block(texts: DataFrame, items: Items, least: int, cosine: float) -> DataFrame:
    """Pairs of one block of items, from coded texts; a pair may come more than once."""
    spark = texts.sparkSession
    schema = "doc_id bigint, item_id bigint, words int, matched int"
    if not len(items.hashes):
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(items)
    df, n, passages = _document_counts(texts, shared)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    fitted = cut(_fit_passages(texts, shared, FIT / max(passages, 1)))
    index = spark.sparkContext.broadcast(Index.of(items, idf, latent_space(fitted, items.passages()[2], idf)))

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searched: Index = index.value
        for b in _batches(searched.items, pdfs):
            yield pd.DataFrame(searched.leaks(b, least, cosine), columns=["doc_id", "item_id", "words", "matched"])

    return texts.mapInPandas(run, schema)
