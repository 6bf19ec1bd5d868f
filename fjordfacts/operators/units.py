"""Amounts recorded in differing units, brought to one unit per quantity (problem 2).

Each note is one device: its recorded amounts, in order, are the observations. The hidden state of
an entry is the unit its recorded number stands in, told as the factor (power of ten) by which it differs from
the number in the stated unit. Four things speak for a state:

* the printed numbers that may belong to the entry, a noisy observation: the log-value jump from each to the recorded number;
* `scale_inferred`, what the reader noted of the factor;
* the level: the amount that a state implies lies near the one before it, most of all in the same row;
* the state before: a reader seldom switches within a note.

Viterbi decoding finds the most likely course of all entries of a note together, so entries whose
printed number is missing, read wrong or found in several places are settled by the rest. The unit
stated for the entry (row, number or column before note) then gives the exponent still missing.

A note is a single row, so the whole operator is one narrow stage; the notes of a batch are decoded together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Unit spellings by power of ten to the common unit (NOK, kg, kWh, m2, litre, per cent).
MONEY = (
    (9, r"mrd\.?\s*(?:kr(?:oner)?\.?|nok)?|milliard(?:er)?\s*(?:kr(?:oner)?\.?|nok)?|mdnok"),
    (6, r"mnok|mill?\.?\s*(?:kr(?:oner)?\b\.?|nok)|nok\s*mill?\b\.?|millioner(?:\s*(?:kr(?:oner)?\b\.?|nok))?|kroner\s+i\s+mill(?:ioner)?\b\.?|kr\s+i\s+mill(?:ioner)?\b\.?|mill\b\.?|mkr"),
    (3, r"tnok|knok|tkr|tusen(?:er)?\s+(?:kr(?:oner)?\b\.?|nok)|1[ .]?000\s*(?:nok|kr(?:oner)?\b\.?)|(?:nok|kr(?:oner)?\.?)\s*1[ .]?000\b|(?:nok|kr)\s*['’´`]\s?000|kroner\s+i\s+(?:hele\s+)?tusen(?:er)?|hele\s+tusen|tre\s+siffer|tusen(?:er)?\b"),
    (0, r"nok|norske\s+kroner|hele\s+kroner|kroner|kr\b\.?"),
)
QUANTITY = (
    (6, r"tusen\s+tonn|gwh"),
    (4, r"hektar|\bha\b"),
    (3, r"mwh|dekar|\bdaa\b|m[åa]l\b|m³|m3\b|kubikkmeter|tonn"),
    (2, r"hl\b|hektoliter|andel\s+av\s+(?:1|en|én)\b"),
    (0, r"kwh|kg\b|kilo(?:gram)?\b|m²|m2\b|kvm\b|kvadratmeter|liter|%|prosent"),
    (-1, r"promille|‰|\bdl\b|desiliter"),
    (-3, r"gram\b|wh\b|\bml\b|milliliter"),
)
CAPTION_WORDS = r"alle|beløp|beløpene|tall|tallene|mengder|mengdene|verdier|oppgitt|oppstillingen|oppstilling|nedenfor|viser|vises|er|gjengitt|avkortet|angitt|presentert|med|i|hele|norske|og|noten|tabellen"
COUNTED = ("antall aksjer", "antall eiere", "antall ansatte", "antall aksjonærer", "antall årsverk", "årsverk", "antall")
#: Characters that a scan puts in place of a digit.
DIGIT_FOR = str.maketrans({"O": "0", "o": "0", "Q": "0", "D": "0", "I": "1", "l": "1", "|": "1", "i": "1", "!": "1", "S": "5", "s": "5", "B": "8", "Z": "2", "z": "2", "G": "6", "b": "6", "g": "9", "q": "9", "A": "4"})
_NOISE = str.maketrans({"0": "o", "1": "l", "|": "l", "5": "s", "6": "b", "8": "b", "9": "g", "€": "e", "†": "t", "i": "l", "!": "l"})

_UNITS = [(group is MONEY, e, re.compile(rf"(?<!\w)(?:{p})(?!\w)", re.I)) for group in (QUANTITY, MONEY) for e, p in group]
_MONEY_UNITS = [(money, e, rx) for money, e, rx in _UNITS if money]
_BLANKS = " \u00a0\u2009\u202f"
_DIGITS = "0-9OoIl|SsBZzGgbqAQD"
_NUMBER = rf"[-\u2212(]?\s?(?:[{_DIGITS}]{{1,3}}(?:[{_BLANKS}.][{_DIGITS}]{{3}}(?!\w))+|[{_DIGITS}]+)(?:,[{_DIGITS}]+)?\)?"
_YEAR_CELL = re.compile(r"^\s*((?:19|20)\d\d)\b(.*)$")
_KEY_YEAR = re.compile(r"^(.*?)\s+((?:19|20)\d\d)$")
#: Costs: of a switch of factor; the most of a jump that doesn't fit; nearness of a jump that fits; of a factor other than the scale noted.
_SWITCH, _FAR, _EXACT, _STATED = 1.2, 6.0, 0.004, 0.4
#: Costs a decade of distance between the levels of successive entries: of one row, of one kind of quantity; the most decades that count.
_ROW_LEVEL, _KIND_LEVEL, _LEVEL_MOST = 0.45, 0.05, 4.0
#: Exponents of the units of one kind of quantity, with what tells the kind in a unit's spelling.
KINDS = (
    (frozenset({2, 0, -1}), re.compile(r"andel|%|prosent|promille|‰", re.I)),
    (frozenset({4, 3, 0}), re.compile(r"hektar|ha\b|dekar|daa|m[åa]l\b|m²|m2|kvm|kvadratmeter", re.I)),
    (frozenset({3, 2, 0, -1, -3}), re.compile(r"m³|m3|kubikkmeter|hl\b|liter|dl\b|ml\b", re.I)),
    (frozenset({6, 3, 0, -3}), re.compile(r"tonn|kg|kilo|gram|wh\b", re.I)),
)
_MONEY_KIND = frozenset(e for e, _ in MONEY)
#: Factors a reader may have applied: those of a whole note, then all other ways from a unit to another of its kind, which count only where they are just that.
_WHOLE_NOTE = (0, 3, 6, -3, -6)
STATES = (0, 3, 6, 2, 4, -3, -6, *sorted({a - b for kind in (_MONEY_KIND, *(k for k, _ in KINDS)) for a in kind for b in kind} - {2, 4, *_WHOLE_NOTE}, key=lambda s: (abs(s), s)))

_STATE = np.array(STATES, float)
_PRIOR = 0.01 * np.abs(_STATE) + 0.02 * (_STATE < 0)
_PLACE = {s: i for i, s in enumerate(STATES)}
_MOVE = np.where(np.eye(len(STATES), dtype=bool), 0.0, _SWITCH)


class Unit(int):
    """An exponent that knows the exponents of all units of its kind."""

    kind: frozenset = frozenset({0})

    @staticmethod
    def of(e: int, spelling: str, money: bool) -> "Unit":
        out = Unit(e)
        out.kind = _MONEY_KIND if money else next((k for k, rx in KINDS if rx.search(spelling)), Unit.kind)
        return out


@lru_cache(256)
def _far(unit: int, kind: frozenset) -> np.ndarray:
    """Cost of each state for an entry of the unit: rare states only lead to the common unit or another of its kind."""
    return np.array([0.0 if s in _WHOLE_NOTE or s == unit or unit - s in kind else 2 * _FAR for s in STATES])


def parse_printed(text: str) -> float | None:
    """A printed number: blanks or points group thousands, the comma is decimal; look-alike letters count as digits."""
    t = re.sub(rf"[{_BLANKS}]", " ", text.strip())
    negative = t.startswith(("-", "\u2212", "(")) or t.endswith("-")
    t = t.strip("()-\u2212 ").translate(DIGIT_FOR).replace(" ", "")
    if "," in t and "." in t and t.rindex(".") > t.rindex(","):
        t = t.replace(",", "")
    else:
        head, comma, tail = t.rpartition(",")
        if comma and not head.count(","):
            t = head.replace(".", "") + "." + tail
        elif comma:
            t = t.replace(",", "").replace(".", "")
        elif re.fullmatch(r"\d{1,3}(\.\d{3})+", t):
            t = t.replace(".", "")
    try:
        value = float(t)
    except ValueError:
        return None
    return -value if negative else value


@lru_cache(65536)
def unit_of(text: str, money_only: bool = False) -> int | None:
    """Exponent of the first unit that the text names; of several at one place the longest."""
    best = None
    for money, e, rx in _MONEY_UNITS if money_only else _UNITS:
        m = rx.search(text)
        if m and (best is None or (m.start(), -m.end()) < best[0]):
            best = ((m.start(), -m.end()), e, m[0], money)
    return None if best is None else Unit.of(*best[1:])


_CAPTION_ONLY = re.compile(rf"(?<!\w)(?:{CAPTION_WORDS})(?!\w)|[\s.:()\[\]*;-]", re.I)
_ALL_UNITS = re.compile("|".join(rf"(?<!\w)(?:{p})(?!\w)" for group in (QUANTITY, MONEY) for _, p in group), re.I)


_CAPTION_START = re.compile(rf"\W*(?:{_ALL_UNITS.pattern}|(?:{CAPTION_WORDS})(?!\w))", re.I)


def caption_unit(line: str) -> int | None:
    """Exponent of a line that says nothing but the unit of the note; None for any other line."""
    if "\t" in line or not _CAPTION_START.match(line):
        return None
    e = unit_of(line)
    if e is None:
        return None
    rest = _CAPTION_ONLY.sub("", _ALL_UNITS.sub(" ", line))
    return e if not rest else None


@lru_cache(65536)
def _fold(text: str) -> str:
    return re.sub(r"\s+", " ", text.lower().translate(_NOISE).replace("rn", "m")).strip()


@lru_cache(65536)
def _label_unit(label: str) -> int | None:
    """A unit set off in the label: in brackets, or after 'i' at its end."""
    for inner in reversed(re.findall(r"[(\[]([^()\[\]]*)[)\]]", label)):
        e = unit_of(inner)
        if e is not None:
            return e
    m = re.search(r"(?:,|\bi)\s+(.{1,20})$", label)
    if m:
        e = unit_of(m[1])
        if e is not None and not re.sub(r"[\s.]", "", _ALL_UNITS.sub("", m[1])):
            return e
    return None


def _tables(lines: list[str]) -> list[tuple[str, dict[str, tuple[str, int | None]]]]:
    """(folded label, {year: (cell, exponent of the column)}) of each table row, with the label's own text first."""
    out, columns = [], []
    for line in lines:
        if "\t" not in line:
            continue
        cells = line.rstrip().split("\t")
        heads = [_YEAR_CELL.match(c.translate(DIGIT_FOR) if c.strip()[:4].translate(DIGIT_FOR).isdigit() and len(c.strip()) == 4 else c) for c in cells[1:]]
        if not cells[0].strip() and heads and all(heads):
            columns = [(m[1], unit_of(m[2])) for m in heads]
        elif columns and cells[0].strip():
            out.append((cells[0].strip(), {y: (c, e) for (y, e), c in zip(columns, cells[1:], strict=False)}))
    return out


def _prose(text: str) -> str:
    text = re.sub(r"[-\u2010\u00ad\u00ac]\n", "", text)
    return re.sub(r"\s+", " ", text)


_AFTER = re.compile(
    rf"(?P<before>(?:mnok|tnok|knok|nok|kr\.?|mill\.?\s*kr|mkr|tkr)\s*)?(?P<n>{_NUMBER})\s*(?P<after>(?:tusen|millioner|mill\.?|milliarder|mrd\.?|mnok|tnok|knok|nok|kroner|kr|mkr|tkr)(?:\s*(?:kroner|kr|nok))?)?",
    re.I,
)


_LINK = re.compile(r"\s*(?::|utgjorde|utgjør|er ført med|var|er|på)?\s*")


def _in_prose(name: str, flat: str, folded: str) -> list[tuple[float, int | None]]:
    """The numbers that follow the name wherever it stands in running text, each with its own unit (money, None if none is stated)."""
    out: list[tuple[float, int | None]] = []
    name = name.lower()
    at = folded.find(name) if name else -1
    while at >= 0:
        m = _AFTER.match(flat, _LINK.match(flat, at + len(name)).end())
        if m and any(c.isdigit() for c in m["n"]):
            value = parse_printed(m["n"])
            if value is not None:
                reading = (value, unit_of(f"{m['before'] or ''} {m['after'] or ''}", True))
                if reading not in out:
                    out.append(reading)
        at = folded.find(name, at + 1)
    return out


Reading = tuple[float | None, int]


def read_entries(tittel: str | None, raw_text: str | None, amounts: list[tuple[str, float | None]] | None) -> list[tuple[str, float, str, list[Reading]]]:
    """(key, recorded, row label, [(printed number or None, exponent of the stated unit)]) of every non-null entry that isn't a count; one reading at least."""
    if not amounts:
        return []
    text = raw_text or ""
    lines = text.split("\n")
    note_unit = next((e for e in map(caption_unit, lines) if e is not None), None)
    if note_unit is None:
        for inner in re.findall(r"\((.*)\)", tittel or ""):
            note_unit = unit_of(inner)
    rows = _tables(lines)
    folded = [_fold(label) for label, _ in rows]
    flat = low = None
    out = []

    def settled(e: int | None) -> int:
        return e if e is not None else note_unit if note_unit is not None else 0

    for key, value in amounts:
        if value is None or value != value or key.lower().startswith(COUNTED):
            continue
        m = _KEY_YEAR.match(key)
        label, year = (m[1], m[2]) if m else (key, None)
        unit, readings = _label_unit(label), []
        if year is not None:
            want = _fold(label)
            at = next((i for i, f in enumerate(folded) if f == want), None)
            if at is None and folded:
                near = [(sum(a != b for a, b in zip(f, want, strict=False)) + abs(len(f) - len(want)), i) for i, f in enumerate(folded)]
                best = min(near)
                at = best[1] if best[0] <= max(1, len(want) // 6) else None
            if at is not None and year in rows[at][1]:
                cell, column = rows[at][1][year]
                stated = re.sub(_NUMBER, " ", cell, count=1) if re.search(r"[A-Za-zÆØÅæøå%²³]{2,}|%", cell) else ""
                own = unit_of(stated) if stated.strip() else None
                unit = own if own is not None else unit if unit is not None else column
                n = re.search(_NUMBER, cell)
                readings.append((parse_printed(n[0]) if n else None, settled(unit)))
        else:
            if flat is None:
                flat = _prose(text)
                low = flat.lower()
            readings += [(printed, settled(e if e is not None else unit)) for printed, e in _in_prose(key, flat, low if len(low) == len(flat) else flat)]
        out.append((key, float(value), label, readings or [(None, settled(unit))]))
    return out


def decode(notes: list[list[tuple[str, float, str, list[Reading]]]], scales: list[float | None]) -> list[list[int]]:
    """Exponents to the common unit of every entry of every note: Viterbi over all notes at once, entry by entry."""
    k = len(STATES)
    sizes = np.array([len(n) for n in notes], int)
    total = int(sizes.sum())
    if not total:
        return [[] for _ in notes]
    flat = [e for n in notes for e in n]
    many = np.array([len(e[3]) for e in flat])
    first = np.cumsum(many) - many
    readings = [r for e in flat for r in e[3]]
    with np.errstate(divide="ignore", invalid="ignore"):
        recorded = np.log10(np.abs(np.array([e[1] for e in flat])))
        printed = np.log10(np.abs(np.array([np.nan if p is None else p for p, _ in readings], float)))
    recorded[~np.isfinite(recorded)] = np.nan
    printed[~np.isfinite(printed)] = np.nan
    jump = np.repeat(recorded, many) - printed
    units = np.array([int(u) for _, u in readings])
    far = np.stack([_far(int(u), getattr(u, "kind", Unit.kind)) for _, u in readings])
    # a jump that is just the way between two units of the kind outweighs a switch to and fro
    way = np.round(np.nan_to_num(jump))
    at = np.array([_PLACE.get(int(w), 0) for w in way])
    sure = (np.abs(jump - way) < _EXACT) & (way == _STATE[at]) & ~np.isin(way, _WHOLE_NOTE) & (far[np.arange(len(far)), at] == 0)
    cost = far + np.where(np.isnan(jump)[:, None], 0.0, np.minimum(np.abs(jump[:, None] - _STATE) * np.where(sure, 4, 2)[:, None], _FAR))
    # of several readings each state takes the one that suits it best
    emission = np.minimum.reduceat(cost, first, axis=0)
    unit = np.repeat(units[first][:, None], k, axis=1)
    for i in np.flatnonzero(many > 1):
        unit[i] = units[first[i] + cost[first[i] : first[i] + many[i]].argmin(0)]
    note = np.repeat(np.arange(len(notes)), sizes)
    noted = np.array([round(math.log10(s)) if s is not None and 0 < s < math.inf else 99 for s in scales])[note]
    emission += np.where((noted[:, None] != _STATE) & (noted != 99)[:, None], _STATED, 0.0)
    level = np.nan_to_num(recorded)[:, None] + unit - _STATE
    kinds = [getattr(e[3][0][1], "kind", Unit.kind) for e in flat]
    weight = np.zeros(total)
    for i in range(1, total):
        if note[i] == note[i - 1] and recorded[i] == recorded[i] and recorded[i - 1] == recorded[i - 1]:
            weight[i] = _ROW_LEVEL if flat[i][2] == flat[i - 1][2] else _KIND_LEVEL if kinds[i] == kinds[i - 1] else 0.0

    begin = np.cumsum(sizes) - sizes
    state = np.zeros(total, int)
    order = np.argsort(-sizes, kind="stable")
    for x in range(0, len(notes), 256):
        some = order[x : x + 256]
        some = some[sizes[some] > 0]
        if not len(some):
            continue
        longest = int(sizes[some[0]])
        back = np.zeros((longest, len(some), k), np.int8)
        sums = _PRIOR + emission[begin[some]]
        for i in range(1, longest):
            live = int((sizes[some] > i).sum())  # notes come longest first
            e = begin[some[:live]] + i
            apart = np.minimum(np.abs(level[e][:, None, :] - level[e - 1][:, :, None]), _LEVEL_MOST)
            ways = sums[:live, :, None] + _MOVE + weight[e][:, None, None] * apart
            back[i, :live] = ways.argmin(1)
            sums[:live] = ways.min(1) + emission[e]
        now = sums.argmin(1)
        for i in range(longest - 1, -1, -1):
            live = int((sizes[some] > i).sum())
            state[begin[some[:live]] + i] = now[:live]
            if i:
                now[:live] = back[i, np.arange(live), now[:live]]
    exponents = unit[np.arange(total), state] - _STATE[state].astype(int)
    return [exponents[a : a + n].tolist() for a, n in zip(begin, sizes, strict=True)]


def entry_exponents(tittel: str | None, raw_text: str | None, amounts: list[tuple[str, float | None]] | None, scale: float | None = None) -> list[tuple[str, int]]:
    """(key, exponent still missing) for every non-null entry of one note, exponent 0 included."""
    entries = read_entries(tittel, raw_text, amounts)
    return [(key, e) for (key, *_), e in zip(entries, decode([entries], [scale])[0], strict=True)]


def missing_exponents(noter: DataFrame) -> DataFrame:
    """(doc_id, nr, amount_key, exp10) of every non-null entry, exponent 0 included, distinct.

    Null titles, texts, maps and null entries give nothing; an entry of value 0 has the
    exponent its neighbours and its unit give it. Further columns of the input are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            notes = [read_entries(t, x, list(zip(ks, vs, strict=True))) for t, x, ks, vs in zip(pdf["tittel"], pdf["raw_text"], pdf["ks"], pdf["vs"], strict=True)]
            decoded = decode(notes, [None if s != s else s for s in pdf["scale"]])
            out = [(doc, nr, key, e) for doc, nr, note, es in zip(pdf["doc_id"], pdf["nr"], notes, decoded, strict=True) for (key, *_), e in zip(note, es, strict=True)]
            yield pd.DataFrame(out, columns=["doc_id", "nr", "amount_key", "exp10"])

    scale = F.col("scale_inferred") if "scale_inferred" in noter.columns else F.lit(None).cast("double")
    rows = noter.where("doc_id is not null and size(raw_amounts) > 0").select("doc_id", "nr", "tittel", "raw_text", scale.alias("scale"), F.map_keys("raw_amounts").alias("ks"), F.map_values("raw_amounts").alias("vs"))
    return rows.mapInPandas(run, "doc_id bigint, nr string, amount_key string, exp10 int").distinct()


def common_amounts(noter: DataFrame) -> DataFrame:
    """(doc_id, nr, amount_key, recorded, exp10, amount): every entry in its common unit."""
    entries = noter.select("doc_id", "nr", F.explode("raw_amounts").alias("amount_key", "recorded")).where("recorded is not null").distinct()
    joined = entries.join(missing_exponents(noter), ["doc_id", "nr", "amount_key"], "left").withColumn("exp10", F.coalesce("exp10", F.lit(0)))
    return joined.withColumn("amount", F.col("recorded") * F.pow(F.lit(10.0), F.col("exp10")))
