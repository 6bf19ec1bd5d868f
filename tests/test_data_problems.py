"""The general data problems on small fixtures, against brute force where there is one."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fjordfacts.operators import drift, nested, setdiff, structural, units

JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=8), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=5), x, max_size=4), max_leaves=20)


def _rebuild(ix, node):
    if ix.kind[node] == structural.OPEN_ARRAY:
        return [_rebuild(ix, c) for c in ix.children(np.array([node]))[1]]
    if ix.kind[node] == structural.OPEN_OBJECT:
        return {ix.key(c): _rebuild(ix, c) for c in ix.children(np.array([node]))[1]}
    return json.loads(ix.raw(node))


@settings(max_examples=60, deadline=None)
@given(st.lists(JSON, min_size=1, max_size=5), st.sampled_from([None, 1]), st.booleans())
def test_structural_index_round_trip(values, indent, ascii_only):
    ix = structural.build([json.dumps(v, indent=indent, ensure_ascii=ascii_only).encode() for v in values])
    assert [_rebuild(ix, r) for r in ix.roots] == values


def test_structural_index_rejects_malformed():
    ix = structural.build([b"{", b'{"a": [1, 2}', b"", b'"open', b'{"a": "\\\\"}'])
    assert (ix.roots >= 0).tolist() == [False, False, False, False, True]


def test_flatten_shapes(spark):
    rows = [
        (1, '{"manifest": {"pages": [{"page": 1, "zones": {"y0": 5}}, null, {"page": 2.0, "zones": "[{\\"y0\\": 7}]"}]}, "noter": {"3": {"raw_amounts": {"A": null, "B": 2}}}, "validation": {"checks": {"field": "f"}}}'),
        (2, '{"noter": {"nr": "1", "raw_amounts": [{"label": "L", "value": null}, null]}, "manifest": null, "validation": "{\\"checks\\": [{\\"field\\": \\"g\\"}, {}]}"}'),
        (3, None), (4, ""), (5, "[1"), (6, "[]"), (2, '{"noter": {"nr": "1"}}'),
    ]
    df = spark.createDataFrame(rows, "raw_id long, payload string").selectExpr("*", "'x' as child", "1 as _id", "2 as _text")
    got = {tuple(r) for r in nested.flatten(df).collect()}
    assert got == {
        (1, "page", "", "1"), (1, "page", "", "2"), (1, "zone", "1", "5"), (1, "zone", "2", "7"), (1, "note", "", "3"), (1, "amount", "3", "A"), (1, "amount", "3", "B"), (1, "check", "", "f"),
        (2, "note", "", "1"), (2, "amount", "1", "L"), (2, "check", "", "g"),
    }
    assert nested.flatten(df.limit(0)).count() == 0


def test_drift(spark):
    r = random.Random(1)
    rows = []
    for i in range(30):
        rows.append(("r", 1, i, json.dumps({"model": "m1", "year": 2000 + i, "gone": "x", "extraction_meta": {"h": f"{r.getrandbits(64):016x}", "dpi": 300}})))
        rows.append(("r", 3, i, json.dumps({"engine": "m1", "year": str(2000 + i), "fresh": [1], "extraction_meta": {"hash": f"{r.getrandbits(64):016x}", "dpi": 300}})))
    rows += [("r", 1, 99, None), ("r", 1, 98, "{bad"), (None, 1, 97, "{}")]
    df = spark.createDataFrame(rows, "run_tag string, file_seq int, raw_id long, payload string")
    got = {tuple(x) for x in drift.changes(drift.profiles(drift.members(df))).collect()}
    assert got == {("r", 3, "renamed", "model", "engine"), ("r", 3, "renamed", "extraction_meta.h", "extraction_meta.hash"), ("r", 3, "removed", "gone", ""), ("r", 3, "added", "", "fresh"), ("r", 3, "type_changed", "year", "year")}
    wide = {x.raw: json.loads(x.fields) for x in drift.unified(drift.members(df, keep="raw_id"), drift.changes(drift.profiles(drift.members(df)))).where("file_seq = 3").withColumnRenamed("id", "raw").collect()}
    assert wide[0]["model"] == "m1" and "engine" not in wide[0]


def test_unified_names_and_types(spark):
    r = random.Random(2)
    rows = []
    for i in range(30):
        code = f"{r.getrandbits(64):016x}"
        rows.append(("r", 1, i, json.dumps({"kode": code, "year": 2000 + i, "ok": True, "liste": [1, {"a": "x"}], "navn": 'a"b'})))
        rows.append(("r", 2, 100 + i, json.dumps({"kode_ny": code, "year": str(2000 + i), "ok": False, "liste": [], "navn": "c", "null": None})))
    rows += [("r", 2, 200, json.dumps({"kode_ny": "1", "kode": "2", "year": "5"}))]
    df = spark.createDataFrame(rows, "run_tag string, file_seq int, raw_id long, payload string")
    found = drift.changes(drift.profiles(drift.members(df.where("raw_id < 200"))))
    assert ("r", 2, "renamed", "kode", "kode_ny") in {tuple(x) for x in found.collect()}
    got = {x.id: (json.loads(x.fields), x.clashes) for x in drift.unified(drift.members(df, keep="raw_id"), found).collect()}
    assert got[3][0]["year"] == "2003" and got[103][0]["year"] == "2003" and got[3][0]["kode"] == got[103][0]["kode"]
    assert got[3][0]["liste"] == [1, {"a": "x"}] and got[103][0]["ok"] is False and got[3][0]["navn"] == 'a"b' and "null" not in got[103][0] and got[3][1] == []
    assert got[200] == ({"kode": "2", "year": "5"}, ["kode"])


def test_matching_is_optimal():
    from itertools import permutations

    rng = np.random.default_rng(0)
    for n, m in ((3, 3), (2, 4), (4, 2)):
        w = rng.random((n, m)) * (rng.random((n, m)) > 0.3)
        k = max(n, m)
        full = np.zeros((k, k))
        full[:n, :m] = w
        best = max(sum(full[i, p[i]] for i in range(k)) for p in permutations(range(k)))
        assert sum(w[i, j] for i, j in drift.match(w)) == pytest.approx(best)


def test_field_arithmetic():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, setdiff.P, 500).astype(np.uint64) for _ in range(2))
    assert (setdiff.mul(a, b) == np.array([int(x) * int(y) % setdiff.P for x, y in zip(a, b, strict=True)], np.uint64)).all()
    assert (setdiff.mul(a, setdiff.inverse(a)) == 1).all()


def test_set_differences(spark):
    rng = random.Random(3)
    a = {i: (rng.randrange(50), rng.choice([None, "x", "y"])) for i in range(400)}
    b = {i: v for i, v in a.items() if i % 9}
    b |= {i: (v[0] + 1, v[1]) for i, v in b.items() if i % 10 == 0} | {i: (1, "z") for i in range(1000, 1100)}
    make = lambda t: spark.createDataFrame([(k, *v) for k, v in t.items()], "k long, p int, q string")
    got = {tuple(r) for r in setdiff.field_differences(make(a), make(b), ["k"], ["p", "q"], ("a", "b"), first_bound=4).collect()}
    expected = {(k, "missing_in_b") for k in a.keys() - b.keys()} | {(k, "missing_in_a") for k in b.keys() - a.keys()}
    expected |= {(k, c) for k in a.keys() & b.keys() for i, c in enumerate("pq") if a[k][i] != b[k][i]}
    assert got == expected
    assert setdiff.field_differences(make(a), make(a), ["k"], ["p", "q"], ("a", "b")).count() == 0
    empty = spark.createDataFrame([], "k long, p int, q string")
    assert setdiff.field_differences(empty, empty, ["k"], ["p", "q"], ("a", "b")).count() == 0
    assert setdiff.field_differences(make({1: (1, None)}), empty, ["k"], ["p", "q"], ("a", "b")).collect()[0].what == "missing_in_b"


def test_plain_number(spark):
    from pyspark.sql import functions as F

    cases = [("1.358278E6", 1358278.0), ("71.068,00", 71068.0), ("kr 273 684", 273684.0), ("(10 119)", -10119.0), ("-10 273 kr", -10273.0), ("584 258", 584258.0), (" 604883 ", 604883.0), ("678627.0", 678627.0), ("x", None), (None, None), ("", None)]
    df = spark.createDataFrame(cases, "t string, e double").withColumn("g", setdiff.plain_number(F.col("t")))
    assert [(r.t, r.g) for r in df.collect() if r.g != r.e] == []


NOTE = "Beløp i TNOK\n\t2020\t2019\nLønn\t1 200\t(300)\nPensjon (MNOK)\t2,5\t1,0\nHusleie\t70\t60\n"


def test_units():
    keys = [("Lønn 2020", 1200000.0), ("Lønn 2019", -300.0), ("Pensjon (MNOK) 2020", 2.5), ("Husleie 2020", 70.0), ("Husleie 2019", None), ("Antall eiere 2020", 5.0)]
    got = dict(units.entry_exponents("x", NOTE, keys))
    assert got == {"Lønn 2020": 0, "Lønn 2019": 3, "Pensjon (MNOK) 2020": 6, "Husleie 2020": 3}
    assert units.entry_exponents(None, None, None) == [] and dict(units.entry_exponents(None, None, [("a", 1.0)])) == {"a": 0}
    assert dict(units.entry_exponents("Areal (hektar)", "\t2020\nTomt\t12,5\n", [("Tomt 2020", 12.5)])) == {"Tomt 2020": 4}
    assert dict(units.entry_exponents("x", "Garantiramme: MNOK 3,6", [("Garantiramme", 3.6)])) == {"Garantiramme": 6}


def test_units_settle_a_lost_number_by_its_neighbours():
    text = "Tall i hele tusen\n\t2020\nA\t10\nB\t2O\nC\t30\n"
    assert dict(units.entry_exponents("x", text, [("A 2020", 10000.0), ("Borte 2020", 5.0), ("C 2020", 30000.0)])) == {"A 2020": 0, "Borte 2020": 0, "C 2020": 0}


def test_units_take_a_way_within_a_kind_of_quantity():
    keys = lambda *values: [(f"{k} 2020", v) for k, v in zip("ABC", values, strict=True)]
    text = "\t2020\nA (%)\t23,9\nB (%)\t11,0\nC (%)\t34,0\n"
    shares = [(f"{k} (%) 2020", v) for k, v in (("A", 0.239), ("B", 0.11), ("C", 0.34))]
    assert dict(units.entry_exponents("x", text, shares)) == {k: 2 for k, _ in shares}
    assert dict(units.entry_exponents("x", text, [shares[0], (shares[1][0], 11.0), shares[2]])) == {shares[0][0]: 2, shares[1][0]: 0, shares[2][0]: 2}
    lines = "\t2020\nA\t25,0\nB\t30,0\nC\t40,0\n"
    assert dict(units.entry_exponents("Andeler (promille)", lines, keys(25.0, 3.0, 40.0))) == {"A 2020": -1, "B 2020": 0, "C 2020": -1}
    assert dict(units.entry_exponents("Beløp (milliarder kroner)", lines, keys(25e9, 30e9, 40e9))) == {"A 2020": 0, "B 2020": 0, "C 2020": 0}
    assert dict(units.entry_exponents("Areal (m2)", lines, keys(0.0025, 0.003, 0.004))) == {"A 2020": 4, "B 2020": 4, "C 2020": 4}
    # no unit of money is a tenth or a hundredth of another: such a jump is a misread number
    assert dict(units.entry_exponents("Beløp (kroner)", lines, keys(25.0, 300.0, 40.0))) == {"A 2020": 0, "B 2020": 0, "C 2020": 0}


def test_units_take_the_recorded_scale_where_nothing_else_tells():
    lost = [("Borte 2020", 5000.0)]
    assert dict(units.entry_exponents("Tall (TNOK)", "uleselig", lost, 1000.0)) == {"Borte 2020": 0}
    assert dict(units.entry_exponents("Tall (TNOK)", "uleselig", lost, 1.0)) == dict(units.entry_exponents("Tall (TNOK)", "uleselig", lost)) == {"Borte 2020": 3}
    text = "\t2020\nA\t10\n"
    assert dict(units.entry_exponents("Tall (TNOK)", text, [("A 2020", 10.0), *lost], 1000.0)) == {"A 2020": 3, "Borte 2020": 3}


def test_units_tell_a_switch_by_the_level():
    text = "Tall i hele kroner\n\t2020\t2019\nA\t5 000\t\nB\t\t\n"
    # the second year's number isn't printed: only the row's level tells that it was recorded in thousands more
    assert dict(units.entry_exponents("x", text, [("A 2020", 5000.0), ("A 2019", 5_200_000.0)])) == {"A 2020": 0, "A 2019": -3}
    assert dict(units.entry_exponents("x", text, [("A 2020", 5000.0), ("A 2019", 9000.0)])) == {"A 2020": 0, "A 2019": 0}


def test_units_need_the_neighbours_where_numbers_are_missing():
    r = random.Random(4)
    notes, scales, truth = [], [], []
    for _ in range(200):
        factor, note, true = r.choice([0, 3, 6]), [], []
        for k in range(6):
            printed = 10 ** r.uniform(1, 6)
            note.append((f"R{k} 2020", printed * 10**factor, f"R{k}", [(None if r.random() < 0.4 else printed, 3)]))
            true.append(3 - factor)
        notes.append(note)
        scales.append(None)
        truth.append(true)
    right = lambda found: np.mean([a == b for f, t in zip(found, truth, strict=True) for a, b in zip(f, t, strict=True)])
    together = units.decode(notes, scales)
    alone = [[units.decode([[e]], [None])[0][0] for e in n] for n in notes]
    assert right(together) > 0.99 and right(alone) < 0.8


def test_units_choose_among_several_printed_numbers():
    text = "Garantiramme på 15 665 er nevnt her.\nGarantiramme står på egen konto. Garantiramme utgjorde TNOK -678 ved årets slutt."
    assert dict(units.entry_exponents("x", text, [("Garantiramme", -678.0)])) == {"Garantiramme": 3}
    assert dict(units.entry_exponents("x", text, [("Garantiramme", 15665.0)])) == {"Garantiramme": 0}
    assert units.caption_unit("Alle tallene i oppstillingen nedenfor og alle beløpene i noten er angitt og presentert i TNOK") == 3


def test_units_query(spark):
    rows = [(1, "1", None, None, {"a": 1.0}), (1, "1", None, None, {"a": 1.0}), (2, "1", "t", "", None), (3, "2", "x", NOTE, {"Husleie 2020": 70.0, "Z": None})]
    df = spark.createDataFrame(rows, "doc_id long, nr string, tittel string, raw_text string, raw_amounts map<string,double>").selectExpr("*", "'e' as exp10", "1 as ks")
    assert {tuple(r) for r in units.missing_exponents(df).collect()} == {(1, "1", "a", 0), (3, "2", "Husleie 2020", 3)}
    assert {(r.doc_id, r.amount) for r in units.common_amounts(df).collect()} == {(1, 1.0), (3, 70000.0)}
