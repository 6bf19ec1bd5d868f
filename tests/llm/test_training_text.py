"""The problems on training text on small fixtures, against brute force where there is one."""

import random
from collections import Counter

import numpy as np
import pytest

from fjordfacts.llm import chunking, leaks, mixing, ocr_text, survivors, tokens

WORDS = "hund katt løper over veien mens bilen står stille ved sjøen under broen der folk venter på båten som aldri kommer fram til byen før kvelden faller".split()


def _text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# ---- tokens and pieces ----


def test_pretokens_join_and_count():
    rng = random.Random(0)
    encode = tokens.encoder("/opt/tokenizers").encode_ordinary
    texts = ["", "   ", "a\n\n b_c m² ½ 三 Ⅷ it's 'S    q", "🙂🙂 é ǅ", *(_text(rng, 50) + rng.choice(["\n\n", " 12 345,6\t7", "!?"]) for _ in range(20))]
    for t in texts:
        parts = tokens.split(t)
        assert "".join(parts) == t
        assert sum(len(encode(p)) for p in parts) == len(encode(t))


def test_pieces_keep_limit_overlap_and_text():
    rng = random.Random(1)
    texts = ["\n\n".join(". ".join(_text(rng, 9) for _ in range(4)) for _ in range(k)) for k in (1, 10, 40)] + ["", "x" * 3000, "ø" * 1500 + " slutt"]
    encode = tokens.encoder("/opt/tokenizers").encode_ordinary
    out = chunking.split_batch(np.arange(len(texts)), texts, 200, 20)
    for i, t in enumerate(texts):
        own = out[out["_id"] == i].sort_values("piece")
        assert own["start_char"].iloc[0] == 0 and own["end_char"].iloc[-1] == len(t)
        assert (len(own) > 1) == (len(encode(t)) > 200)
        for a, b in zip(own.to_dict("records"), own.to_dict("records")[1:], strict=False):
            assert b["start_char"] <= a["end_char"] < b["end_char"]
            if not t.startswith(("x", "ø")):
                assert a["start_token"] + a["n_tokens"] - b["start_token"] == 20
        assert all(len(encode(t[a:b])) <= 200 for a, b in zip(own["start_char"], own["end_char"], strict=True))


def test_tokens_are_exact_whatever_the_runs():
    encode = tokens.encoder("/opt/tokenizers").encode_ordinary
    texts = ["\n".join(["linje og tall " + "-" * 70] * 60), "\n".join(["Lønn " + "." * 80 + " 12"] * 50), ("=" * 67 + "\n") * 40, "x" * 3000, "ab三🙂" * 900, " " * 5000 + "a", "æ" * 400 + "\n" * 300 + "1" * 999]
    out = chunking.split_batch(np.arange(len(texts)), texts, 200, 20)
    for i, t in enumerate(texts):
        own = out[out["_id"] == i].sort_values("piece")
        assert own["start_token"].iloc[-1] + own["n_tokens"].iloc[-1] == len(encode(t)) == tokens.counter("/opt/tokenizers").count([t])[0]
        assert own["start_char"].iloc[0] == 0 and own["end_char"].iloc[-1] == len(t) and (own["n_tokens"] <= 200).all()
        assert [len(encode(t[a:b])) for a, b in zip(own["start_char"], own["end_char"], strict=True)] == list(own["n_tokens"])
    assert len(chunking.split_batch(np.arange(1), ["\n".join(["-" * 70] * 60)], 2000, 100)) == 1


def test_cuts_equal_the_greedy_walk():
    rng = np.random.default_rng(2)
    at = np.r_[0, np.cumsum(rng.integers(1, 4, 500))]
    kind = rng.integers(0, 5, len(at))
    kind[-1] = 0
    text_of = np.zeros(len(at), int)
    ends, starts = chunking.cuts(text_of, at, kind, 60, 10)
    assert ends[-1] == len(at) - 1 and (at[ends] - at[starts] <= 60).all() and (np.diff(ends) > 0).all()


def test_pieces_query(spark):
    df = spark.createDataFrame([(1, "kort"), (2, None), (3, ""), (4, "ord " * 3000), (4, "ord " * 3000)], "doc_id long, text string").selectExpr("*", "'c' as piece", "1 as _id")
    got = Counter(r.doc_id for r in chunking.pieces(df).collect())
    assert got[1] == 1 and got[2] == 0 and got[3] == 1 and got[4] >= 4
    assert chunking.pieces(df.limit(0)).count() == 0


# ---- mixing ----


def test_fit_is_the_best_subset_sum():
    rng = random.Random(5)
    for _ in range(30):
        sizes = np.array(sorted(rng.sample(range(1, 40), 4)))
        counts = np.array([rng.randrange(1, 4) for _ in sizes])
        budget = rng.randrange(0, int((sizes * counts).sum()) + 20)
        reach = {0}
        for s, c in zip(sizes, counts, strict=True):
            reach = {r + k * s for r in reach for k in range(c + 1)}
        take = mixing.fit(sizes, counts, budget)
        assert ((take >= 0) & (take <= counts)).all()
        total = int((sizes * take).sum())
        assert total <= budget
        assert total == max(r for r in reach if r <= budget)
    # a small window grows until the sum is the best there is
    sizes, counts = np.array([6, 10, 15]), np.array([40, 3, 2])
    for budget in range(1, 290):
        best = max(6 * a + 10 * b + 15 * c for a in range(41) for b in range(4) for c in range(3) if 6 * a + 10 * b + 15 * c <= budget)
        assert int((sizes * mixing.fit(sizes, counts, budget, window=8)).sum()) == best


def test_mixture(spark):
    rng = random.Random(6)
    docs = [(i, _text(rng, rng.randrange(5, 30)), rng.choice(["A", " a ", "B"]) if i % 50 else None) for i in range(300)]
    docs += [(1000 + i, "samme tekst", "B") for i in range(150)] + [(5000, None, "A"), (5001, "", "A")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as n_tokens", "2 as uses")
    mix = spark.createDataFrame([("a", 0.3, 2), ("b", 0.65, 3), ("c", 0.05, 2)], "source string, target_share double, max_repeats int")
    measured = mixing.lengths(df).cache()
    counts = mixing.histogram(measured)
    planned = mixing.plan(counts, mix).cache()
    got = mixing.mixture(measured, planned).collect()
    assert len({r.doc_id for r in got}) == len(got) and all(1 <= r.uses <= 3 for r in got)
    used = Counter()
    for r in got:
        used[r.source] += r.uses * r.n_tokens
    stated = {r.source: r for r in mixing.shares(planned, counts, mix).collect()}
    assert used["a"] == stated["a"].mixed_tokens and used["b"] == stated["b"].mixed_tokens
    total = sum(r.n_tokens for r in measured.collect())
    assert 0 <= 0.3 * total - used["a"] < 30 and 0 <= 0.65 * total - used["b"] < 30
    assert [r.source for r in mixing.short_sources(planned, counts, mix).collect()] == ["c"]
    assert sorted(map(tuple, mixing.mixture(measured, planned).collect())) == sorted(map(tuple, got))
    assert mixing.histogram(mixing.lengths(df, keep_ids=False)).count() == counts.count()


# ---- survivors ----


def test_survivors_and_truth(spark):
    records = [(1, "NO 912 345 678 MVA", 2020, None, "A ", "2020-01-01"), (2, "912345678", None, "2020-12-31", "b", None), (3, "912345678", 2020, None, "b", "2021-01-01"), (3, "912345678", 2020, None, "b", "2021-01-01"), (4, "1", 2020, None, "a", None), (5, "999999999", 2020, None, "a", None)]
    r = spark.createDataFrame(records, "doc_id long, orgnr string, year int, regnskapsperiode_til string, prompt_name string, at string").selectExpr("*", "cast(at as timestamp_ntz) as extracted_at", "1 as value")
    n = spark.createDataFrame([(1, "1", {"k": None, "m": 1.0}), (2, "1", {"k": 5.0, "m": 2.0}), (3, "1", {"k": 6.0, "m": 2.0}), (5, "1", {"k": 1.0}), (1, "2", None)], "doc_id long, nr string, raw_amounts map<string,double>")
    k = spark.createDataFrame([("a", 1), ("b", 2)], "prompt_name string, trust_rank int")
    claims = survivors.claims(r, n, k)
    got = {(x.nr, x.amount_key): (x.doc_id, x.value) for x in survivors.survivors(claims).collect()}
    assert got == {("1", "k"): (3, 6.0), ("1", "m"): (1, 1.0)}
    truth = {x.amount_key: (x.value, x.n_claims) for x in survivors.discover(claims)[0].collect()}
    assert truth["m"] == (2.0, 3)
    assert survivors.survivors(survivors.claims(r.limit(0), n, k)).count() == 0


def test_truth_discovery_finds_the_reliable_source(spark):
    rng = random.Random(7)
    rows = []
    for g in range(60):
        for s, wrong in (("good", 0.05), ("fair", 0.3), ("bad1", 0.7), ("bad2", 0.7)):
            rows.append(("o", g, "1", "k", g * 10, s, 1, float(g) if rng.random() > wrong else float(1000 + rng.randrange(5))))
    df = spark.createDataFrame(rows, "orgnr string, year int, nr string, amount_key string, doc_id long, source string, trust_rank int, value double").selectExpr("*", "cast(null as timestamp_ntz) as extracted_at")
    truths, reliability = survivors.discover(df)
    found = {r.source: r.reliability for r in reliability.collect()}
    assert found["good"] > found["fair"] > max(found["bad1"], found["bad2"])
    assert sum(r.value == r.year for r in truths.collect()) >= 54


def test_truth_discovery_says_if_it_does_not_converge(spark):
    rows = [("o", g, "1", "k", g * 10, s, 1, float(g if s == "a" or g % 3 else -g)) for g in range(1, 30) for s in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "orgnr string, year int, nr string, amount_key string, doc_id long, source string, trust_rank int, value double").selectExpr("*", "cast(null as timestamp_ntz) as extracted_at")
    with pytest.raises(RuntimeError):
        survivors.discover(df, rounds=1)


# ---- leaks ----


def test_plain_undoes_encoding_and_layout():
    assert leaks.words("fyl​ke-\nts BrÃ¸nnøysund &oslash;l ｆｕｌｌ") == ["fylkets", "Brønnøysund", "øl", "full"]
    assert leaks.skeleton("bere9net") == leaks.skeleton("beregnet") and leaks.skeleton("BÅTEN") == leaks.skeleton("båten")
    assert leaks.skeleton("аvtale") == leaks.skeleton("avtale") and leaks.skeleton("10") != leaks.skeleton("lo")


def test_align_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        item, doc = rng.integers(0, 12, 30), rng.integers(0, 12, 40)
        doc[10:22] = item[5:17]
        covered, matched, *_ = leaks.align([doc, doc[5:]], [item, item[::-1]], np.zeros(12, bool))[0]
        score = np.zeros((41, 31))
        for i in range(1, 41):
            for j in range(1, 31):
                score[i, j] = max(0, score[i - 1, j] - leaks.GAP, score[i, j - 1] - leaks.GAP, score[i - 1, j - 1] + (1 if doc[i - 1] == item[j - 1] else -leaks.GAP))
        assert matched >= score.max() - 1e-4 and covered >= 12


def _common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_dense_common_words_lose_no_run():
    rng = np.random.default_rng(4)
    docs, items = rng.integers(0, 40, (60, 76)), rng.integers(0, 40, (60, 64))
    for r in range(0, 60, 2):
        n, a = rng.integers(25, 40), rng.integers(0, 24)
        run = items[r, a : a + n].copy()
        run[rng.random(n) < rng.choice([0.1, 0.25, 0.35])] = 99
        docs[r, 20 : 20 + n] = run
    got = leaks.densely_shared(docs.astype(np.int32), items.astype(np.int32), 25, (0.7, 0.85))
    for r in range(60):
        for c, share in enumerate((0.7, 0.85)):
            if any(_common(docs[r], items[r, a : a + n]) >= share * n for n in (25, 30, 38) for a in range(0, 64 - n)):
                assert got[r, c]
    assert not got[1::2, 1].any()


def _paraphrased(rng, words):
    """Two words out of three stay at least, none of them next to more than one other."""
    out = []
    for k in range(0, len(words), 2):
        pair = list(words[k : k + 2])
        if rng.random() < 0.25:
            pair[rng.randrange(len(pair))] = rng.choice(WORDS)
        out += [*pair, rng.choice(WORDS), rng.choice(WORDS)]
    return out


def test_paraphrases_come_through_the_latent_space(spark):
    rng = random.Random(12)
    vocabulary = [f"{a}{b}" for a in ("brun", "stor", "lys", "tung", "kald", "varm", "rund", "flat", "ny", "gammel") for b in ("båt", "vei", "fjell", "elv", "skog", "hus", "mark", "strand", "bru")]
    items = [(i, [rng.choice(vocabulary) for _ in range(70)]) for i in range(30)]
    docs = []
    for d in range(300):
        own = items[d % 30][1]
        a = rng.randrange(0, 30)
        docs.append((d, [*(rng.choice(WORDS + vocabulary) for _ in range(80)), *_paraphrased(rng, own[a : a + 32]), *(rng.choice(WORDS + vocabulary) for _ in range(60))]))
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    it = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked(d, it).collect()}
    # brute force: the check itself on every pair
    known = leaks.Items.of([(i, " ".join(w)) for i, w in items])
    brute = set()
    for i, w in docs:
        own = known.look_up(np.array([leaks._Hashes()[x] for x in w], np.uint32))
        for r, (covered, matched, numbers, same) in enumerate(leaks.align([own] * 30, known.sequences, known.numeric)):
            if covered >= 25 and matched >= leaks.SHARE * covered and 2 * same >= numbers:
                brute.add((i, r))
    assert len(brute) > 150 and len(got & brute) >= 0.9 * len(brute)
    # no other way leads to a pair
    assert len(leaks.leaked(d, it, cosine=0.9).collect()) < len(got) / 2


def test_long_items_come_in_parts():
    text = " ".join(f"ord{k}" for k in range(20_000))
    known = leaks.Items.of([(7, text)])
    assert known.ids == [7, 7, 7] and max(map(len, known.sequences)) == leaks.PART and known.sequences[0][-leaks.OVERLAP] == known.sequences[1][0]


def test_leaks(spark):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in ("brun", "stor", "lys", "tung", "kald", "varm", "rund", "flat") for b in ("båt", "vei", "fjell", "elv", "skog", "hus", "mark", "strand")]
    items = [(i, " ".join(rng.choice(vocabulary) if k % 6 else str(rng.randrange(1000)) for k in range(80))) for i in range(12)]
    words = [t.split() for _, t in items]
    filler = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    changed = [w if k % 8 else "byttet" for k, w in enumerate(words[2][10:50])]
    docs = [
        (1, filler(200) + " " + " ".join(words[0]) + " " + filler(50)), (2, filler(30) + " " + " ".join(words[1][20:50]).upper() + " " + filler(20)), (3, filler(300) + "\n" + "\n".join(changed) + "\n" + filler(10)),
        (4, filler(100) + " " + " ".join(words[3][5:17]) + " " + filler(40)), (5, filler(500)), (6, None), (7, ""), (8, " ".join(words[4][:18]) + "\nSide 4 av 9\nRegnskap for alle\n" + " ".join(words[4][18:40])), (8, " ".join(words[4][:40])),
        (9, filler(20000) + " " + " ".join(words[5][30:70])),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as w", "'x' as kind")
    it = spark.createDataFrame([*items, (99, None), (98, ""), (0, items[0][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked(d, it).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (8, 4), (9, 5)}
    assert leaks.leaked(d.limit(0), it).count() == 0 and leaks.leaked(d, it.limit(0)).count() == 0


def test_leaks_with_foreign_lines_between(spark):
    rng = random.Random(10)
    vocabulary = [f"{a}{b}" for a in ("brun", "stor", "lys", "tung", "kald", "varm", "rund", "flat") for b in ("båt", "vei", "fjell", "elv", "skog", "hus", "mark", "strand")]
    items = [(i, [rng.choice(vocabulary) if k % 6 else str(rng.randrange(1000)) for k in range(60)]) for i in range(6)]
    filler = lambda n: [rng.choice(WORDS) for _ in range(n)]
    docs, expected = [], set()
    for n in (25, 30):
        for inserted in (10, 14, 20):
            for at in range(2, n - 1):
                i, a = rng.randrange(6), rng.randrange(60 - n)
                own = items[i][1][a : a + n]
                docs.append((len(docs), " ".join(filler(60) + own[:at] + filler(inserted) + own[at:] + filler(60))))
                expected.add((len(docs) - 1, i))
    # shorter ones with such lines are none
    for at in (4, 9, 14):
        own = items[0][1][10:28]
        docs.append((len(docs), " ".join(filler(60) + own[:at] + filler(14) + own[at:] + filler(60))))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked(d, it).collect()}
    assert got == expected


# ---- scanned pages ----


def test_furniture():
    lines = ["Side 3 av 40", "Slde 9 av 40", "- 12 -", "[25]", "14", "Gjennomsnittlig antall årsverk", "107", "Noter til regnskapet for 2012", "Vrangeidet Eiendom AS – Årsregnskap 2012\tside 18", "VRANGEIDET EIENDOM AS", "Konvolutt-ID: 56E980EBEC14", "Org.nr. 700 260 651\tPjaltrudet Transport AS", "Lønn\t100\t90", "Årsregnskapet bygger på lovens krav og vanlig skikk.", "s. 19", "\t2011", "mars."]
    assert ocr_text.is_furniture(lines) == [True, True, True, True, True, False, False, True, True, True, True, True, False, False, True, False, False]


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_retrieves_every_candidate():
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(2, 7))) for _ in range(300)})
    trie = ocr_text.Trie(words)
    for _ in range(60):
        q = "".join(rng.choice("abcd") for _ in range(rng.randrange(2, 7)))
        for k in (1, 2):
            assert {w for w, *_ in ocr_text.retrieve(trie, q, k)} >= {w for w in words if _edits(q, w) <= k}
    only = {w: (e, alike) for w, e, alike in ocr_text.retrieve(ocr_text.Trie(["generalforsamlingen", "beregnet", "fordi"]), "generalforsarnlingen", 2)}
    assert only == {"generalforsamlingen": (1, True)}
    assert ocr_text.retrieve(ocr_text.Trie(["beregnet"]), "bere9net", 1) == [("beregnet", 1, True)]


def test_noise_found_and_repaired(spark):
    clean = "Generalforsamlingen regner med at tap på en enkelt kunde vil prege også neste periode og avdelingen."
    rows = [(i, "1", clean) for i in range(40)] + [
        (100, "1", "Genera1forsamlingen regner\nmed at tap på en en-\nkelt kunde vil\nSide 9 av 40\n\nprege også neste peri¬\node og avdelingen."), (101, "1", "Lønns-\nog pensjon\n\tA\nRåvarer\t485\t3S\nGeneralforsarnlingen regner"), (102, "1", None), (103, "1", ""), (104, None, "Side 3"),
    ]
    noter = spark.createDataFrame([*rows, rows[40]], "doc_id long, nr string, raw_text string").selectExpr("*", "'k' as kind", "1 as line_no")
    info = spark.createDataFrame([(7, "VRANGEIDET EIENDOM AS\nForetaksnavn: X")], "doc_id long, _ocr_text string")
    pages = ocr_text.pages(noter, info).cache()
    got = {tuple(r) for r in ocr_text.found_lines(ocr_text.lines(pages)).collect()}
    assert got == {
        ("noter", 100, "1", 1, "misread"), ("noter", 100, "1", 2, "hyphen"), ("noter", 100, "1", 4, "furniture"), ("noter", 100, "1", 6, "hyphen"), ("noter", 101, "1", 4, "misread"), ("noter", 101, "1", 5, "misread"),
        ("noter", 104, "", 1, "furniture"), ("generell_info", 7, "", 1, "furniture"),
    }
    fixes = ocr_text.misread_words(ocr_text.word_counts(ocr_text.lines(pages)))
    text = {r.doc_id: r.text for r in ocr_text.repaired(pages, fixes).collect()}
    assert text[100].replace("\n", " ") == clean
    assert "Råvarer\t485\t3S" in text[101].split("\n")


def test_words_with_a_foreign_sign_are_misread(spark):
    clean = "Tørkeanlegget ble løpet av hørere og årsregnskapet viser beløp for strømforbruk."
    rows = [(i, "1", clean) for i in range(40)] + [(100 + k, "1", clean.replace(w, wrong)) for k, (w, wrong) in enumerate([("Tørkeanlegget", "T¢rkeanlegget"), ("hørere", "h¢rere"), ("beløp", "bel¢p"), ("strømforbruk", "str¢mforbruk"), ("årsregnskapet", "årsr€gnskapet"), ("løpet", "l©pet"), ("beløp", "be*øp")])]
    noter = spark.createDataFrame([*rows, (200, "1", "Se * og § 3 a, R&D, 20°C, beløp* og # 2.")], "doc_id long, nr string, raw_text string")
    pages = ocr_text.pages(noter, spark.createDataFrame([], "doc_id long, _ocr_text string")).cache()
    lines = ocr_text.lines(pages).cache()
    assert {r.doc_id for r in ocr_text.found_lines(lines).collect()} == set(range(100, 107))
    text = {r.doc_id: r.text for r in ocr_text.repaired(pages, ocr_text.misread_words(ocr_text.word_counts(lines))).collect()}
    assert all(text[100 + k] == clean for k in range(6))


def test_misread_letters_are_found_beyond_the_tables(spark):
    clean = "Vilkåret inngår i fraværet med særlig stor forskjell for avdelingen, henvisningen, hovedsaken, behandlingen, hensynet og hele huset på kunden."
    wrong = [("Vilkåret", "Vilkàret"), ("inngår", "inngär"), ("fraværet", "fravceret"), ("særlig", "scerlig"), ("fraværet", "fraværęt"), ("på", "pà")]
    # h is read as b again and again; n and r after kunde- are endings
    learnt = [(w, w.replace("h", "b", 1)) for w in ("henvisningen", "hovedsaken", "behandlingen", "hensynet", "hele", "huset")]
    wrong += learnt
    rows = [(i, "1", clean) for i in range(60)] + [(100 + k, "1", clean.replace(a, b)) for k, (a, b) in enumerate(wrong)]
    rows += [(300 + i, "1", f"kunde{e}") for e in ("r", "s", "ns", "") for i in range(3)] + [(400, "1", "Håvard Hansen og huser og kander")]
    noter = spark.createDataFrame(rows, "doc_id long, nr string, raw_text string")
    pages = ocr_text.pages(noter, spark.createDataFrame([], "doc_id long, _ocr_text string")).cache()
    lines = ocr_text.lines(pages).cache()
    changed = {100 + k for k in range(len(wrong))}
    assert {r.doc_id for r in ocr_text.found_lines(lines).collect()} == changed
    text = {r.doc_id: r.text for r in ocr_text.repaired(pages, ocr_text.misread_words(ocr_text.word_counts(lines))).collect()}
    assert all(text[d] == clean for d in changed)


def test_candidates_decide_what_is_misread(spark, monkeypatch):
    clean = "Generalforsamlingen vurderer strømforbruket og årsregnskapet for kontrakten."
    rows = [("noter", i, "1", None, clean) for i in range(30)]
    wrong = ["Genera1forsam1ingen", "strømfor6ruket", "årsr€gnskap€t", "kontrakten", "Kaifelt", "K12", "3B", "M40x", "kon†rak†en"]
    rows += [("noter", 100 + i, "1", None, clean.replace("kontrakten", w)) for i, w in enumerate(wrong)]
    lines = ocr_text.lines(spark.createDataFrame(rows, "origin string, doc_id long, nr string, name string, text string")).cache()
    assert {r.doc_id for r in ocr_text.found_lines(lines).where("kind = 'misread'").collect()} == {100, 101, 102, 108}
    # a small trie size makes many slices and parts; the words found are the same
    counts = ocr_text.word_counts(lines)
    whole = {tuple(r) for r in ocr_text.misread_words(counts).collect()}
    monkeypatch.setattr(ocr_text, "TRIE_WORDS", 2)
    assert {tuple(r) for r in ocr_text.misread_words(counts).collect()} == whole


def test_furniture_of_any_length():
    name = "SAMVIRKELAGET FOR FISKEOPPDRETT OG LANDBASERT FOREDLING AV SJØMAT I INDRE NORDLAND OG OMEGN MED DATTERSELSKAPER AS"
    lines = [name, f"{name.title()} – Årsregnskap 2012\tside 18", "Dokumentnøkkel: " + "A1B2-" * 40, "Selskapet, som vist i fjor, har egne noter til regnskapet for 2012"]
    assert ocr_text.is_furniture(lines) == [True, True, True, False]


def test_context_decides_between_candidates(spark):
    rows = [(i, "stor hest løper fort") for i in range(30)] + [(100 + i, "liten best vinner sakte") for i in range(40)] + [(200 + i, "rød fest og glede") for i in range(20)] + [(300, "rød ƒest"), (301, "stor 6est løper")]
    lines = ocr_text.lines(spark.createDataFrame([("noter", i, "1", None, t) for i, t in rows], "origin string, doc_id long, nr string, name string, text string"), with_words=True).cache()
    found = spark.createDataFrame([("6est", "hest", 1, 30, 1), ("6est", "best", 1, 40, 1)], "word string, right_word string, edits int, right_n long, n long")
    got = {r.right_word: r.context for r in ocr_text.in_context(found, ocr_text.bigrams(lines)).collect()}
    assert got["hest"] > 0 and got["best"] == 0


@pytest.mark.parametrize("word", ["a" * 200, "ø1" * 50])
def test_very_long_words_pass(word):
    assert ocr_text.retrieve(ocr_text.Trie(["abc"]), word, 2) == []
