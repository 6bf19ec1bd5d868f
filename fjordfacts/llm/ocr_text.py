"""Noise of scanned pages: words hyphenated over lines, misread characters, page furniture (problem 1).

1. Every page is read once into lines: furniture, the words of each text line, and pairs of word
   halves around a hyphen sign at a line's end (furniture between them skipped).
2. Words are counted over all pages. Frequent words of letters are the vocabulary.
3. Words that are not, are looked up in tries of the vocabulary. The automaton of the word (all
   strings within a number of edits, where taking one character for its look-alike or two for one
   is a single edit) walks the trie, so every candidate is retrieved. Tries hold one length of
   words and one salt each, and so do the words sent to them: no task gets more than TRIE_WORDS of
   either, and nothing that grows with the data is broadcast.
4. A word is misread if it has a candidate that is far more frequent and every edit between them is a look-alike,
   takes a letter foreign to the language, or is a confusion learnt from the corpus: one that parts
   many rare words from frequent ones, but hardly any frequent words from each other and hardly ever
   the other way round, as endings and names do. A word with signs in it that has no candidate is taken for a code.
   Numbers have no vocabulary: letters among digits that a scan takes for digits make them misread.
   Candidates rank by edits, look-alikes first, agreement with the word before, and frequency.
5. `repaired` drops furniture, joins the halves, replaces misread words and reflows the lines into
   paragraphs; table rows stay lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordfacts.session import cores, cut, measured_broadcast, sized_broadcast, tasks

# What scans take for one another.
ALIKE = (
    ("0", "oOøD"), ("1", "liIt"), ("|", "liI"), ("l", "iI"), ("I", "li"), ("!", "li"), ("2", "zZ"), ("3", "E"), ("4", "A"), ("5", "sS"),
    ("6", "bGø"), ("7", "T"), ("8", "BS"), ("9", "gq"), ("€", "eE"), ("†", "tT"), ("$", "sS"), ("£", "E"), ("@", "a"), ("¢", "øc"), ("¤", "oø"), ("‡", "tT"), ("¦", "liI"), ("¥", "YV"), ("©", "oø"), ("®", "oø"), ("°", "oø"),
    ("à", "åa"), ("ä", "åaæ"), ("á", "åa"), ("â", "åa"), ("ã", "åa"), ("ö", "øo"), ("õ", "øo"),
)
PAIRS = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("ce", "æ"))
#: Times a word must be more frequent than another of letters only to be its right form; least count of the vocabulary.
RATIO, LEAST = 10, 5
#: Rare words that make a confusion a learnt one, and how many of them there must be for each pair of words that speaks against it.
LEARNT, AGAINST = 5, 10
#: Letters of Norwegian words; all others are foreign.
LETTERS = "a-zæøåéèêóòôü"
#: Vocabulary words of one trie, and words that walk it in one task.
TRIE_WORDS = 20_000
HYPHENS = "-‐‑­¬"
#: Signs that belong to a word wherever they touch it, and those that do between two letters only; no word has either.
MARKS, INNER = "|€†$£@!¢¤‡¦¥", r"#*~^°§©®¶{}\\"

_FOLD = str.maketrans({"l": "i", "1": "i", "|": "i", "I": "i", "!": "i", "€": "e", "†": "t"})
_D = r"[0-9OoIl|SsBZbgq]"
_FURNITURE = re.compile(
    rf"(?:side|s\.|page|p\.)\s*{_D}{{1,4}}(?:\s*(?:av|of|/)\s*{_D}{{1,4}})?"
    rf"|[-–—]\s*{_D}{{1,4}}\s*[-–—]|\[\s*{_D}{{1,4}}\s*\]|{_D}{{1,3}}\s*/\s*{_D}{{1,3}}"
    r"|(?:[^,;:!?]+\s)?noter\s+tii\s+(?:års)?regnskapet(?:\s+for)?(?:\s+\S{4})?"
    rf"|[^,;:!?]+\s[–—-]\s*(?:års)?regnskap\s+\S{{4}}(?:\s+side\s+{_D}{{1,4}})?"
    r"|konvoiutt-?\s?id:?\s*\S+|signert\s+eiektronisk.*|dokumentnøkkei.*|(?:penneo|docusign)\b.*"
    r"|utskrift(?:sdato)?:?\s+\S{8,10}(?:\s+\S+)?|(?:skrevet\s+ut|printed)\b[^.!?]*",
    re.I,
)
#: What a line of furniture shows at first sight; all others aren't looked at more closely.
_HINT = re.compile(r"[\W\dOIl|SBZ]{1,14}$|s[il1|][dc][ec€]|s\.|p\.|page|konvo|signert|dokument|penneo|docusign|utskrift|skrevet|printed|org|.*regnskap", re.I)
_ORG_LINE = re.compile(r"org\.?\s?nr\.?:?\s*[\dOoIl|SsBZ][\dOoIl|SsBZ  .]{7,12}(?:\s+\S.*)?", re.I)
_CAPS_NAME = re.compile(r"[A-ZÆØÅ0-9|€†][A-ZÆØÅ0-9|€†.&'  -]{3,}\s(?:A[S5]|ASA|ANS|DA|SA|BA|NUF)", re.ASCII)
_BARE = re.compile(rf"{_D}{{1,3}}")
_LABEL = re.compile(r"[A-ZÆØÅ][^\W\d_]*(?: [^\W\d_]+){0,5}")
_ENDING = MARKS.replace("!", "")
#: Java's syntax is the same, with (?U) before it.
WORD = rf"[^\W_]+(?:[{MARKS}][^\W_]+|(?<=[^\W\d_])[{INNER}](?=[^\W\d_])[^\W_]+|[{_ENDING}])*|[{MARKS}]+[^\W_]+"
_WORD = re.compile(WORD)
_ODD_HALF = re.compile(rf"[\d{MARKS}]|rn|cl")
_FOREIGN = re.compile(rf"[\d{MARKS}{INNER}]")
#: A letter, in lower case, that the language doesn't have.
_STRANGE = rf"[^\W\d_{LETTERS}]"
_CELL_NUMBER = re.compile(r"[-−(]?\s?[0-9OoIl|SsBZzGgbqA][0-9OoIl|SsBZzGgbqA    .,]*\)?")
_TRIPLE = re.compile(r"(?<![\w,.])[0-9OoIl|SsBZG]{1,3}(?:[    .][0-9OoIl|SsBZG]{3})+(?:,[0-9OoIl|SsBZG]+)?(?!\w)")
_DECIMAL = re.compile(r"(?<![\w,.])[0-9OoIl|SsBZG]+,[0-9OoIl|SsBZG]+(?!\w)")
_LETTER_IN = re.compile(r"[A-Za-z|]")
#: A digit next to a letter that a scan takes for one: what every misread number has.
_MIXED = re.compile(r"\d[ \u00a0.,]?[OoIl|SsBZzGgbqA]|[OoIl|SsBZzGgbqA][ \u00a0.,]?\d")
#: Digits and letters that a scan takes for them, in lower case.
_NUMBER_LIKE = r"^(?=.*\d)(?=.*[oil|sbzg])[\doil|sbzg]+$"
_CUT = re.compile(rf"([^\W_][\w{MARKS.replace('!', '')}]*)$")


def is_furniture(lines: list[str], name: str | None = None) -> list[bool]:
    """Which lines are only a running header or footer, a stamp or a page number."""
    out, label = [], False
    for raw in lines:
        line = raw.strip()
        hit = False
        if line:
            tab = "\t" in raw
            if len(line) <= 3 and not tab and _BARE.fullmatch(line) and any(c.isdigit() for c in line):
                hit = not label
            else:
                if _HINT.match(line):
                    flat = line.replace("\t", " ") if tab else line
                    hit = bool(_FURNITURE.fullmatch(flat.translate(_FOLD)) or _FURNITURE.fullmatch(flat) or _ORG_LINE.fullmatch(flat))
                hit = hit or bool((not tab and line[:2].isupper() and _CAPS_NAME.fullmatch(line)) or (name and line.casefold() == name.casefold()))
            if not hit:
                label = not tab and _LABEL.fullmatch(line) is not None
        out.append(hit)
    return out


def _numbers_misread(line: str) -> bool:
    """A number with a letter in it: a table cell that is else a number, or a grouped or decimal number of running text."""
    if not _MIXED.search(line):
        return False
    if "\t" in line:
        for cell in line.split("\t")[1:]:
            cell = cell.strip()
            number = re.match(r"[^\s]+(?:[    ][^\s]{3}(?=[\s,]|$))*", cell)
            if not number:
                continue
            if _CELL_NUMBER.fullmatch(number[0]) and any(c.isdigit() for c in number[0]) and _LETTER_IN.search(number[0]):
                return True
    for rx in (_TRIPLE, _DECIMAL):
        for m in rx.finditer(line):
            if _LETTER_IN.search(m[0]) and sum(c.isdigit() for c in m[0]) >= 2:
                return True
    return False


def read_page(text: str, name: str | None = None) -> list[tuple[int, str, list[str], str | None, str | None, bool]]:
    """(line_no, kind, words, left, right, number_misread) of every line that isn't blank; kind is furniture, row or text."""
    lines = text.split("\n")
    flags = is_furniture(lines, name)
    body = [i for i, l in enumerate(lines) if l.strip() and not flags[i]]
    following = dict(zip(body, body[1:], strict=False))
    out, carried, moved = [], None, None
    for i, line in enumerate(lines):
        if not line.strip():
            continue
        if flags[i]:
            out.append((i + 1, "furniture", [], None, None, False))
            continue
        words = _WORD.findall(line)
        left = right = None
        end = line.rstrip()
        after = following.get(i)
        if carried and words and line.lstrip().startswith(carried):
            words = words[1:]
        if moved and words is not None:
            words = [moved, *words]
        carried = moved = None
        if end[-1] in HYPHENS and len(end) > 1 and (m := _CUT.search(end[:-1])) and after is not None and "\t" not in lines[after]:
            nxt = _WORD.match(lines[after].lstrip())
            if nxt:
                left, right, carried = m[1], nxt[0], nxt[0]
                words = words[:-1]
                # the whole word belongs to the line that holds the odd half
                if _ODD_HALF.search(right) and not _ODD_HALF.search(left):
                    moved = left + right
                else:
                    words.append(left + right)
        out.append((i + 1, "row" if "\t" in line else "text", words, left, right, _numbers_misread(line)))
    return out


def pages(noter: DataFrame, generell_info: DataFrame) -> DataFrame:
    """(origin, doc_id, nr, name, text), distinct. Null texts are left out."""
    a = noter.select(F.lit("noter").alias("origin"), "doc_id", F.coalesce("nr", F.lit("")).alias("nr"), F.lit(None).cast("string").alias("name"), F.col("raw_text").alias("text"))
    b = generell_info.select(F.lit("generell_info").alias("origin"), "doc_id", F.lit("").alias("nr"), F.lit(None).cast("string").alias("name"), F.col("_ocr_text").alias("text"))
    both = a.unionByName(b).where("text is not null and doc_id is not null")
    # one shuffle serves the distinct and spreads the reading over all cores
    return both.repartition(tasks(both), "origin", "doc_id", "nr").distinct()


_LINE = "line_id bigint, origin string, doc_id bigint, nr string, line_no int, kind string, words array<string>, left string, right string, number boolean, word string, n bigint, lines array<bigint>"


def lines(page_rows: DataFrame, with_words: bool = False) -> DataFrame:
    """Rows of two kinds: the lines of all pages, and of kind `word` an index of their words. Ids are only the same for both once the rows are cut.

    A line has line_id, origin, doc_id, nr, line_no, kind (furniture, row, text), left, right, number, and its words if asked for. An index row has a word in
    lower case, how often a batch of pages holds it and on which lines, once for each time. Halves around a hyphen count joined.
    """
    columns = [c.split()[0] for c in _LINE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 40
        for pdf in batches:
            found, index = [], {}
            for o, d, n, name, t in zip(*(pdf[c] for c in ("origin", "doc_id", "nr", "name", "text")), strict=True):
                for number, kind, words, left, right, misread in read_page(t, name):
                    found.append((next_id, o, d, n, number, kind, words if with_words else None, left, right, misread, None, None, None))
                    for w in words:
                        w = w.lower()
                        at = index.get(w)
                        if at is None:
                            index[w] = [next_id]
                        else:
                            at.append(next_id)
                    next_id += 1
            yield pd.DataFrame(found, columns=columns)
            if index:
                none = pd.Series([None] * len(index), dtype=object)
                rest = dict.fromkeys(columns[:10], none) | {"kind": "word"}
                yield pd.DataFrame({**rest, "word": list(index), "n": [len(x) for x in index.values()], "lines": pd.Series(list(map(np.array, index.values())), dtype=object)}, columns=columns)

    return page_rows.mapInPandas(run, _LINE)


# ---- automaton and trie ----


class Trie:
    """Words as nested maps; None marks an end."""

    def __init__(self, words: list[str]) -> None:
        self.root: dict = {}
        for w in words:
            at = self.root
            for c in w:
                at = at.setdefault(c, {})
            at[None] = w


_ONE: dict[str, set[str]] = {}
for _seen, _meant in ALIKE:
    for _m in _meant:
        _ONE.setdefault(_m, set()).add(_seen)
_TWO: dict[str, list[str]] = {}
for _seen, _meant in PAIRS:
    _TWO.setdefault(_meant, []).append(_seen)


def retrieve(trie: Trie, word: str, edits: int) -> list[tuple[str, int, bool]]:
    """(candidate, edits, only look-alikes) of every trie word within `edits` edits of the word.

    The automaton is simulated with one bit for each position of the word: `exact[e]` holds the
    positions reached with e edits that were all look-alikes, `any_[e]` those reached with any edits.
    """
    n = len(word)
    full = (1 << n + 1) - 1
    same: dict[str, int] = {}
    for i, c in enumerate(word):
        same[c] = same.get(c, 0) | 1 << i
    alike = {m: sum(same.get(s, 0) for s in seen) for m, seen in _ONE.items() if any(s in same for s in seen)}
    two = {}
    for m, seen in _TWO.items():
        mask = 0
        for pair in seen:
            at = word.find(pair)
            while at >= 0:
                mask |= 1 << at
                at = word.find(pair, at + 1)
        if mask:
            two[m] = mask
    out = []

    def closed(rows: list[int]) -> list[int]:
        for e in range(1, edits + 1):
            rows[e] |= rows[e - 1] << 1 & full
        return rows

    stack = [(trie.root, [1] + [0] * edits, closed([1] + [0] * edits))]
    final = 1 << n
    while stack:
        node, exact, any_ = stack.pop()
        for c, below in node.items():
            if c is None:
                e = next((e for e in range(edits + 1) if any_[e] & final), None)
                if e is not None:
                    x = next((e for e in range(edits + 1) if exact[e] & final), None)
                    out.append((below, x if x is not None else e, x is not None))
                continue
            s, a, t = same.get(c, 0), alike.get(c, 0), two.get(c, 0)
            nx, na = [], []
            for e in range(edits + 1):
                x = (exact[e] & s) << 1
                y = (any_[e] & s) << 1
                if e:
                    x |= (exact[e - 1] & a) << 1 | (exact[e - 1] & t) << 2
                    y |= any_[e - 1] << 1 | any_[e - 1] | (any_[e - 1] & t) << 2
                nx.append(x & full)
                na.append(y & full)
            na = closed(na)
            if any(na):
                stack.append((below, nx, na))
    return out


def edit_path(seen: str, meant: str) -> list[tuple[str, str]]:
    """The edits of a shortest way from one word to the other, look-alikes first: (seen, meant) of each, a pair taken for one letter being one edit."""
    n, m = len(seen), len(meant)
    best: list[list[tuple[float, tuple[int, int]]]] = [[(0.0, (0, 0))] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            ways = [(best[i - 1][j][0] + 1, (1, 0))] if i else []
            if j:
                ways.append((best[i][j - 1][0] + 1, (0, 1)))
            if i and j:
                a, b = seen[i - 1], meant[j - 1]
                ways.append((best[i - 1][j - 1][0] + (0 if a == b else 0.99 if a in _ONE.get(b, ()) else 1), (1, 1)))
                if i > 1 and seen[i - 2 : i] in _TWO.get(b, ()):
                    ways.append((best[i - 2][j - 1][0] + 0.99, (2, 1)))
            best[i][j] = min(ways, key=lambda w: (w[0], -sum(w[1]))) if ways else (0.0, (0, 0))
    out, i, j = [], n, m
    while i or j:
        di, dj = best[i][j][1]
        if seen[i - di : i] != meant[j - dj : j]:
            out.append((seen[i - di : i], meant[j - dj : j]))
        i, j = i - di, j - dj
    return out[::-1]


def _told(seen: str, meant: str) -> bool:
    """Whether an edit is a look-alike or takes a foreign letter or sign."""
    return seen in _ONE.get(meant, ()) or seen in _TWO.get(meant, ()) or bool(seen and re.fullmatch(rf"(?:{_STRANGE}|{_FOREIGN.pattern})+", seen))


def _allowed(word: Column) -> Column:
    """Edits a word may have: one, two from nine letters on, and in any case one for each foreign sign if most of its characters are letters."""
    base, signs = F.when(F.length(word) >= 9, 2).otherwise(1), F.regexp_count(word, F.lit(f"(?U){_FOREIGN.pattern}"))
    return F.when(signs * 2 < F.length(word), F.greatest(base, signs)).otherwise(base)


def _slices(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("len").agg(F.ceil(F.count(F.lit(1)) / F.lit(TRIE_WORDS)).cast("int").alias(name))


def corrections(counts: DataFrame, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """(word, right_word, edits, right_n, n, alike): candidates of each word that isn't vocabulary or is far rarer than one that is.

    counts: (word, n). Single characters and numbers, also those with letters that a scan takes for digits, are no queries.
    """
    plain = F.col("word").rlike(r"^\p{L}+$")
    vocabulary = counts.where(plain & (F.col("n") >= least) & (F.length("word") >= 2)).select("word", "n", F.length("word").alias("len"))
    number = F.col("word").rlike(_NUMBER_LIKE) & (F.regexp_count("word", F.lit(r"\d")) * 2 >= F.length("word"))
    asked = counts.where((F.length("word") >= 2) & F.col("word").rlike(r"\p{L}") & ~number & (F.col("word").rlike(f"(?U){_FOREIGN.pattern}|{_STRANGE}") | (F.length("word") >= 4))).select("word", "n", F.length("word").alias("own"), _allowed(F.col("word")).alias("edits"))
    reach = asked.withColumn("len", F.explode(F.sequence(F.col("own") - F.col("edits") - 1, F.col("own") + F.col("edits"))))
    # a trie is one length and slice of the vocabulary; it meets every slice of the words of that length
    sizes = _slices(vocabulary, "slices").join(_slices(reach, "parts"), "len")
    both = sized_broadcast(sizes)  # a row for each length of word
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    side_a = vocabulary.join(both, "len").select("len", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int").alias("slice"), every("parts").alias("part"), "word", "n")
    side_b = reach.join(both, "len").select("len", F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int").alias("part"), every("slices").alias("slice"), "word", "n", "edits")

    columns, strange = ["word", "right_word", "edits", "right_n", "n", "alike", "enough", "unknown"], re.compile(_STRANGE)

    def look(vocab: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vocab) and len(query):
            trie, n_of = Trie(list(vocab["v_word"])), dict(zip(vocab["v_word"], vocab["v_n"], strict=True))
            for w, n, edits in zip(query["word"], query["n"], query["edits"], strict=True):
                foreign = bool(_FOREIGN.search(w))
                enough = n if foreign or strange.search(w) else ratio * n
                for right, e, only_alike in retrieve(trie, w, int(edits)):
                    if right == w:
                        continue
                    if n_of[right] >= enough and only_alike:
                        found.append((w, right, e, int(n_of[right]), int(n), True, True, []))
                    elif n_of[right] >= enough or (n >= least and n_of[right] * ratio > n):
                        # also pairs of frequent words: they speak against a confusion
                        path = edit_path(w, right)
                        unknown = [f"{a}>{b}" for a, b in path if not _told(a, b)]
                        if n_of[right] >= enough or len(path) == len(unknown) == 1:
                            found.append((w, right, e, int(n_of[right]), int(n), False, n_of[right] >= enough, unknown))
        return pd.DataFrame(found, columns=columns)

    # a cogroup is one trie and a part of the words that reach it, counted once and not by occurrence; the number of tasks is given, since few bytes mean much work
    key, n_tasks = ["len", "slice", "part"], max(cores(counts.sparkSession), tasks(counts, mb=1))
    spread_a = side_a.select(*key, F.col("word").alias("v_word"), F.col("n").alias("v_n")).repartition(n_tasks, *key)
    looked = spread_a.groupBy(*key).cogroup(side_b.repartition(n_tasks, *key).groupBy(*key)).applyInPandas(look, "word string, right_word string, edits int, right_n bigint, n bigint, alike boolean, enough boolean, unknown array<string>")
    looked = cut(looked)
    known = looked.where("enough and size(unknown) = 0")
    doubtful = looked.where("enough and size(unknown) > 0")
    steps = doubtful.select("word", "right_word", F.explode(F.array_distinct("unknown")).alias("step"))
    open_steps = steps.join(measured_broadcast(cut(learnt(looked)), 48), "step", "left_anti").select("word", "right_word").distinct()
    return known.unionByName(doubtful.join(open_steps, ["word", "right_word"], "left_anti")).drop("enough", "unknown")


def learnt(looked: DataFrame) -> DataFrame:
    """(step): single edits, as "seen>meant", that are confusions of the scan by the words they part."""
    single = looked.where("size(unknown) = 1 and edits = 1").select(F.col("unknown")[0].alias("step"), "word", "enough")
    votes = single.groupBy("step").agg(F.count_distinct(F.when(F.col("enough"), F.col("word"))).alias("rare"), F.count_if(~F.col("enough")).alias("natural"))
    back = votes.select(F.concat_ws(">", F.split_part("step", F.lit(">"), F.lit(2)), F.split_part("step", F.lit(">"), F.lit(1))).alias("step"), F.col("rare").alias("reverse"))
    return votes.join(back, "step", "left").where((F.col("rare") >= LEARNT) & (F.col("rare") >= AGAINST * (F.col("natural") + F.coalesce("reverse", F.lit(0))))).select("step")


def word_counts(line_rows: DataFrame) -> DataFrame:
    """(word, n) over all lines, in lower case."""
    return line_rows.where("kind = 'word'").groupBy("word").agg(F.sum("n").alias("n"))


def codes(counts: DataFrame) -> DataFrame:
    """Words of letters and digits that are as they should be: a letter and a number (K12, 3B), frequent with many numbers or as they stand."""
    shape = F.col("word").rlike(r"^(\p{L}\d{1,4}|\d{1,4}\p{L}|\p{Lu}{2,}\d+|m\d|\d+(k?wh|kg|m2|m3))$")
    return counts.where(shape & (F.col("n") >= 3)).select("word")


def found_lines(line_rows: DataFrame) -> DataFrame:
    """(origin, doc_id, nr, line_no, kind), distinct: furniture, hyphen and misread lines. The lines are cut first: their ids must not change while they are read again."""
    line_rows = cut(line_rows)
    where = ["origin", "doc_id", "nr", "line_no"]
    misread = F.lit("misread").alias("kind")
    wrong = cut(misread_words(cut(word_counts(line_rows))).select("word").distinct())
    on_lines = line_rows.where("kind = 'word'").join(measured_broadcast(wrong, 32 + F.length("word")), "word", "left_semi").select(F.explode("lines").alias("line_id")).distinct()
    plain = line_rows.where("kind <> 'word'")
    own = plain.join(measured_broadcast(cut(on_lines), 16), "line_id", "left_semi").select(*where, misread)
    hyphen = hyphenated(plain).select(*where, F.lit("hyphen").alias("kind"))
    return plain.where("kind = 'furniture'").select(*where, "kind").unionByName(hyphen).unionByName(plain.where("number").select(*where, misread)).unionByName(own).distinct()


def bigrams(line_rows: DataFrame) -> DataFrame:
    """(before, word, n): how often a word follows another on a line, in lower case. The lines must have their words."""
    low = F.transform("words", F.lower)
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.struct(F.get(low, i - 1).alias("before"), F.get(low, i).alias("word")))
    rows = line_rows.where("size(words) > 1").select(F.inline(pairs))
    return rows.groupBy("before", "word").agg(F.count(F.lit(1)).alias("n"))


def in_context(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Adds context: how often the candidate follows the words that stand before the misread one."""
    asked = found.select("word", "right_word").join(pairs.select("before", "word", F.col("n").alias("n_wrong")), "word")
    right = pairs.select("before", F.col("word").alias("right_word"), F.col("n").alias("n_right"))
    support = asked.join(right, ["before", "right_word"]).groupBy("word", "right_word").agg(F.sum(F.col("n_wrong") * F.log1p("n_right")).alias("context"))
    return found.join(support, ["word", "right_word"], "left").withColumn("context", F.coalesce("context", F.lit(0.0)))


def misread_words(counts: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(word, right_word): words that hold a wrongly recognised character, with the best candidate.

    Candidates rank by edits, then by the words before them if `pairs` (see `bigrams`) are given, then by frequency.
    """
    found = corrections(counts)
    found = found.withColumn("context", F.lit(0.0)) if pairs is None else in_context(cut(found), pairs)
    best = found.groupBy("word").agg(F.max_by("right_word", F.struct(-F.col("edits"), F.col("alike"), F.col("context"), F.col("right_n"), F.col("right_word"))).alias("right_word"))
    words = best.join(codes(counts), "word", "left_anti")
    # a number with a letter for a digit, far rarer than the number it stands for
    digits = counts.where(F.col("word").rlike(_NUMBER_LIKE)).withColumn("right_word", F.translate("word", "oil|sbzg", "01115829"))
    right = counts.where(F.col("word").rlike(r"^\d+$")).select(F.col("word").alias("right_word"), F.col("n").alias("right_n"))
    numbers = digits.join(right, "right_word").where(F.col("right_n") >= RATIO * F.col("n")).select("word", "right_word")
    return words.join(numbers.select("word"), "word", "left_anti").unionByName(numbers)


def hyphenated(line_rows: DataFrame) -> DataFrame:
    """Lines whose last word is cut and would have no hyphen if written whole.

    Suspended hyphens (Lønns- og) are none, nor are halves of which the second isn't in small letters; a capital abbreviation before the sign (IT-) keeps it.
    """
    cutoff = line_rows.where("left is not null").where(~F.lower("right").isin("og", "eller", "and", "or", "samt", "til"))
    return cutoff.where(~F.col("left").rlike(r"^\p{Lu}{2,}$") & F.col("right").rlike(r"^[\p{Ll}\d|€†¢]"))


def repaired(page_rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """(origin, doc_id, nr, text): furniture dropped, halves joined, misread words replaced, lines reflowed into paragraphs; table rows stay lines."""
    words = page_rows.select("origin", "doc_id", "nr", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"(?U){WORD}"), F.lit(0)))).alias("word"))
    used = words.join(measured_broadcast(fixes.where("right_word is not null"), 64 + F.length("word") + F.length("right_word")), "word").groupBy("origin", "doc_id", "nr").agg(F.map_from_entries(F.collect_set(F.struct("word", "right_word"))).alias("fix"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fixed = [reflow(t, dict(f) if f is not None else {}) for t, f in zip(pdf["text"], pdf["fix"], strict=True)]
            yield pd.DataFrame({"origin": pdf["origin"], "doc_id": pdf["doc_id"], "nr": pdf["nr"], "text": fixed})

    return page_rows.join(used, ["origin", "doc_id", "nr"], "left").mapInPandas(run, "origin string, doc_id bigint, nr string, text string")


def reflow(text: str, fix: dict[str, str]) -> str:
    rows = text.split("\n")
    flags = is_furniture(rows)
    out: list[str] = []
    open_line = False
    for raw, drop in zip(rows, flags, strict=True):
        if drop:
            continue
        line = raw.strip(" ")
        if not line.strip():
            open_line = False
            continue
        if "\t" in raw:
            out.append(raw)
            open_line = False
        elif open_line and out[-1][-1:] in HYPHENS and line[:1].islower() and not re.match(r"(?:og|eller|and|or)\b", line):
            out[-1] = out[-1][:-1] + line
        elif open_line and not (out[-1][-1:] in ".:?!" and line[:1].isupper() and len(out[-1]) < 40):
            out[-1] += " " + line
        else:
            out.append(line)
            open_line = True

    def right(m: re.Match) -> str:
        found = fix.get(m[0].lower())
        if not found:
            return m[0]
        return found.capitalize() if m[0][:1].isupper() else found

    return "\n".join(_WORD.sub(right, line) for line in out)
