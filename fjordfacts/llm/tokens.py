"""Token counts under a public byte-level BPE vocabulary.

A text's merges never cross the edges of its pre-tokens (a word with its blank, a number, a run
of signs), and a pre-token's tokens depend on nothing outside it. So a batch is cut into
pre-tokens once and each distinct one is encoded once where positions matter; the sum is the
length of the encoding of the whole text, which `count` gives directly: both are exact. The vocabulary file is found by a parameter and never copied.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np

from fjordfacts.session import tokenizer_dir

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Distinct pre-tokens remembered by a worker; beyond it the memory starts afresh.
REMEMBERED = 400_000
#: A longer pre-token isn't remembered.
LONGEST = 256
#: Layout of what is remembered of a pre-token: tokens below, characters, then marks: only blanks; begins with one blank; ends a sentence; line ends (0 to 3).
CHARS_AT, MARKS_AT = 20, 40
SPACE, LED, ENDS, LINES = 1, 2, 4, 8
SENTENCE_END = re.compile(r"[.!?][\"\u00bb\u201d')\]]*$")


_LATIN_NUMBERS = "\u00b2\u00b3\u00b9\u00bc\u00bd\u00be"


def _pattern(numbers: str) -> re.Pattern:
    """The public pattern of the rank files in the standard library's syntax, contractions moved behind what can't begin with their sign."""
    return re.compile(rf" ?[^\W_{numbers}]+| ?[{numbers}]+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@lru_cache(1)
def _rare_numbers() -> list[int]:
    """Unicode's number characters beyond the decimal digits and Latin-1."""
    return [c for c in range(0x100, sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nl", "No")]


@lru_cache(1)
def _splitters() -> tuple[frozenset, re.Pattern, re.Pattern]:
    """Characters that need the careful pattern, that pattern, and the faster one for all other texts."""
    rare = _rare_numbers()
    characters = frozenset(chr(c) for c in rare) | frozenset("\x1c\x1d\x1e\x1f")
    escaped = "".join(f"\\U{c:08x}" for c in rare)
    return characters, _pattern(rf"\d{_LATIN_NUMBERS}{escaped}"), _pattern(rf"\d{_LATIN_NUMBERS}")


def split(text: str) -> list[str]:
    """The pre-tokens of a text; joined they are the text. Information separators (U+001C to U+001F) count as blanks here."""
    rare, careful, fast = _splitters()
    return (fast if rare.isdisjoint(set(text)) else careful).findall(text)


@lru_cache(4)
def encoder(path: str):  # noqa: ANN201
    import tiktoken

    with open(f"{path}/{VOCABULARY}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def marks_of(piece: str) -> int:
    space = piece.isspace()
    return space * SPACE | (piece[0] == " " and not space) * LED | (SENTENCE_END.search(piece) is not None) * ENDS | min(piece.count("\n"), 3) * LINES


class Counter:
    """Counts tokens of texts; one for each worker process (see `counter`)."""

    def __init__(self, path: str) -> None:
        found = encoder(path)
        self.encode, self.bytes_of = found.encode_ordinary, found.decode_tokens_bytes
        self.known: dict[str, int] = {}

    def describe(self, short: list[str], long: list[tuple[str, int]], is_long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, characters and marks (see the constants) of pre-tokens in the order of `is_long`: short ones, and long ones whose tokens are known."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for p in set(short).difference(known):
            known[p] = len(self.encode(p)) | len(p) << CHARS_AT | marks_of(p) << MARKS_AT
        out = np.zeros((3, len(is_long)), np.int64)
        code = np.fromiter(map(known.__getitem__, short), np.int64, len(short))
        out[:, ~is_long] = code & (1 << CHARS_AT) - 1, code >> CHARS_AT & (1 << MARKS_AT - CHARS_AT) - 1, code >> MARKS_AT
        if long:
            out[:, is_long] = np.array([(n, len(p), marks_of(p)) for p, n in long]).T
        return out[0], out[1], out[2]

    def token_bytes(self, piece: str) -> np.ndarray:
        """Bytes of each token of a pre-token."""
        return np.fromiter(map(len, self.bytes_of(self.encode(piece))), np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        return np.fromiter((len(self.encode(t)) for t in texts), np.int64, len(texts))


@lru_cache(4)
def counter(path: str | None = None) -> Counter:
    return Counter(path or tokenizer_dir())
