import base64
import hashlib
import random
import re
from collections import Counter

import pytest

from lodemark.llm import jaccard, langid, quality, spans
from lodemark.llm.components import components
from lodemark.sources.scans import Scratch

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
DOCS = "doc_id long, text string, lang string, row string"


SYLLABLES = sorted({w[k:k + 2] for w in WORDS for k in range(len(w) - 1)} | {w[:3] for w in WORDS})


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(n))


# ---- compression bands


def brute_force_base(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = Counter(tuple(found[k:k + 3]) for k in range(len(found) - 2))
    hit = {k + j for k in range(len(found) - 2) if triples[tuple(found[k:k + 3])] > 1 for j in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(hit) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), failed


TEXTS = [None, "", " \n\t ", "é # <b>|", "a b c a b c", "one\ntwo\none\none\n\n \n \nthree", "x y z " * 40, prose(1, 400), " a b " + prose(2, 60),
         prose(3, 80) + "\n" + prose(3, 80), "".join(hashlib.sha256(bytes([k])).hexdigest() + " " for k in range(200)), prose(4, 30_000)]


def test_base_rules_match_brute_force(spark):
    df = spark.createDataFrame([(k, t, None, "r") for k, t in enumerate(TEXTS)], DOCS).repartition(3)
    rows = {r.doc_id: r for r in quality.compression_bands(df, "text").collect()}
    for k, text in enumerate(TEXTS):
        r = rows[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_force_base(text), text
        assert r.row == "r" and r.text == text and not (r.base_failed and r.kept)
    assert rows[7].kept and rows[11].kept and not rows[9].kept


def test_bands_reject_repetition_and_noise(spark):
    random_text = " ".join(base64.b85encode(random.Random(k).randbytes(60)).decode() for k in range(120))
    half_chunks = prose(5, 900) + ("la la la lo " * 400)
    long_copy = "".join(f"{prose(6, 60)} {k}. " for k in range(40))
    df = spark.createDataFrame([(k, t, None, "r") for k, t in enumerate([random_text, half_chunks, long_copy, prose(8, 3000)])], DOCS)
    kept = {r.doc_id: r.kept for r in quality.compression_bands(df, "text", carry=["doc_id"]).collect()}
    assert kept == {0: False, 1: False, 2: False, 3: True}


def test_the_tail_is_a_chunk_too(spark):
    clean = prose("tail", 2000)[:4095]
    noise = "".join(map(chr, random.Random(7).choices(range(33, 127), k=4096)))
    texts = [clean + noise, noise + clean, prose("tail", 2000)[:8097], prose("tail", 4000)[:8192]]
    df = spark.createDataFrame([(k, t, None, "r") for k, t in enumerate(texts)], DOCS)
    rows = {r.doc_id: r for r in quality.compression_bands(df, "text", carry=["doc_id"]).collect()}
    assert [(rows[k].n_chunks, rows[k].kept) for k in range(4)] == [(2, False), (2, False), (2, True), (2, True)]


def test_bands_of_an_empty_table(spark):
    assert quality.compression_bands(spark.createDataFrame([], DOCS), "text").collect() == []


# ---- language


def speech(lang, seed, n=60):
    parts = {"aa": ["zor", "mek", "tal", "vin"], "bb": ["ou", "eau", "ille", "que"], "cc": ["sch", "ung", "keit", "ver"]}[lang]
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(k, speech(lang, f"{lang}{k}"), lang, None) for lang in ("aa", "bb", "cc") for k in range(30)] + [(99, None, "aa", None), (98, "zor", None, None)]
    return langid.learn(spark.createDataFrame(rows, DOCS), "text", "lang")


def test_held_out_accuracy_and_mixtures(spark, languages):
    assert languages.names == ("aa", "bb", "cc")
    texts = [(k, speech(lang, f"new{lang}{k}", 8), lang, "r") for lang in ("aa", "bb", "cc") for k in range(20)]
    mixed = speech("aa", 7, 120) + " " + speech("bb", 8, 60)
    df = spark.createDataFrame([*texts, (100, mixed, None, "r")], DOCS)
    rows = langid.infer(df, "text", languages).collect()
    assert all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in rows if r.doc_id < 100)
    both = next(r for r in rows if r.doc_id == 100)
    assert both.lang_pred == "aa" and set(both.lang_shares) == {"aa", "bb"} and 0.5 < both.score < 0.85


def test_texts_without_letters(spark, languages):
    df = spark.createDataFrame([(k, t, None, "r") for k, t in enumerate([None, "", " ", "12 34 !?", "e"])], DOCS)
    rows = {r.doc_id: r for r in langid.infer(df, "text", languages).collect()}
    assert [rows[k].lang_pred for k in range(4)] == ["und"] * 4 and all(rows[k].score == 0 for k in range(4))
    assert rows[4].lang_pred in languages.names
    nothing = langid.learn(df.limit(0), "text", "lang")
    assert {r.lang_pred for r in langid.infer(df, "text", nothing).collect()} == {"und"}


# ---- sentence spans


def brute_force_spans(rows, min_words=20, lone=40):
    """Cleaned text per (id, text), comparing runs as plain text."""
    cut, places = {}, {}
    for key in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        parts = spans.sentences(key[1] or "")
        cut[key] = (parts, set())
        n = [len(w) for w, _ in parts]
        for k in range(len(parts)):
            for j in range(k, len(parts)):
                if sum(n[k:j + 1]) >= lone or (j > k and sum(n[k:j + 1]) >= min_words):
                    run = b" ".join(w for p in parts[k:j + 1] for w in p[0])
                    if run in places:
                        cut[key][1].update(range(k, j + 1))
                    places.setdefault(run, key)
                    break
    return {key: "".join(p for k, (_, p) in enumerate(parts) if k not in gone) if key[1] is not None else None for key, (parts, gone) in cut.items()}


def passage(seed, n):
    return " ".join(f"{prose(f'{seed}.{k}', 9)}." for k in range(n))


def test_spans_match_brute_force(spark):
    shared, lone = passage("p", 5), prose("one", 55) + "."
    rows = [(1, f"{passage(1, 3)} {shared} {passage(11, 2)}"), (2, f"{passage(2, 4)}\n{shared}\n{passage(12, 1)}"), (3, f"{shared} {shared}"), (4, lone + " " + passage(4, 2)),
            (5, passage(5, 2) + " " + lone), (6, None), (7, ""), (8, " \n "), (9, passage(9, 9)), (10, passage(9, 9)), (None, passage(9, 2)), (11, "Ok. Ok. Ok. Ok."), (12, "Ok. Ok. Ok. Ok.")]
    df = spark.createDataFrame([(a, b, None, "r") for a, b in rows] + [(9, rows[8][1], "again", "r")], DOCS).repartition(4)
    out = spans.drop_repeated_spans(df, "doc_id", "text").collect()
    assert len(out) == len(rows) + 1 and all(r.row == "r" for r in out)
    expected = brute_force_spans(rows)
    got = {r.doc_id: r.text for r in out}
    assert got == {key[0]: text for key, text in expected.items()}
    assert shared not in got[2] and shared in got[1] and got[10].strip() == "" and got[12] == rows[12][1]


def every_repeated_run(rows, min_words=20, lone=40):
    """Cleaned text per id: sentences under any run of enough words that occurred before, short or long."""
    first, out = {}, {}
    for key, text in rows:
        parts, gone = spans.sentences(text), set()
        n = [len(w) for w, _ in parts]
        for k in range(len(parts)):
            for j in range(k, len(parts)):
                if sum(n[k:j + 1]) >= lone or (j > k and sum(n[k:j + 1]) >= min_words):
                    run = b" ".join(w for p in parts[k:j + 1] for w in p[0])
                    if first.setdefault(run, (key, k)) != (key, k):
                        gone.update(range(k, j + 1))
        out[key] = "".join(p for k, (_, p) in enumerate(parts) if k not in gone)
    return out


@pytest.mark.parametrize("lengths", [[15, 10, 5], [19, 10, 2], [41, 11], [5, 10, 15], [2, 41, 3, 1], [9, 9, 9, 1, 1], [45]])
def test_runs_from_both_ends_cover_every_repeated_run(spark, lengths):
    shared = " ".join(f"{prose(f'{lengths}{k}', n)}." for k, n in enumerate(lengths))
    rows = [(k, f"{prose(f'a{k}', 12)}. {prose(f'b{k}', 7)}. {shared} {prose(f'c{k}', 4)}. {prose(f'd{k}', 30)}.") for k in range(3)]
    df = spark.createDataFrame([(a, b, None, "r") for a, b in rows], DOCS)
    out = spans.drop_repeated_spans(df, "doc_id", "text", both_ends=True).collect()
    assert {r.doc_id: r.text for r in out} == every_repeated_run(rows)
    assert all(r.n_removed == (len(lengths) if r.doc_id else 0) for r in out)


def test_sentences_join_to_the_text():
    for text in ("  a. b?! c\n\n d", "...", "\n \n", "x", "a.b 3.14!"):
        assert "".join(p for _, p in spans.sentences(text)) == text


def test_spans_of_an_empty_table(spark):
    assert spans.drop_repeated_spans(spark.createDataFrame([], DOCS), "doc_id", "text").collect() == []


# ---- Jaccard groups


def brute_force_groups(rows, percent=75):
    def shingles(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if None not in (i, j) and a and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    lowest = {}
    for i in parent:
        lowest[root(i)] = min(i, lowest.get(root(i), i))
    return {(i, len(s), None if i is None else lowest[root(i)]) for i, s in sets}


def edited(text, seed, n):
    draw, found = random.Random(seed), text.split()
    for _ in range(n):
        found[draw.randrange(len(found))] = draw.choice(WORDS)
    return " ".join(found)


def test_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_TOKENS", 5_000)
    rows = []
    for base in range(8):
        text = prose(f"base{base}", 15 + 40 * base)
        rows += [text] + [edited(text, (base, k).__hash__(), 1 + k % 4) for k in range(8)] + [text[: int(len(text) * (0.7 + 0.05 * k))] for k in range(6)]
    common = prose("common", 60)
    rows += [common + " " + prose(f"own{k}", 90) for k in range(40)] + [common] * 3 + [edited(common, k, 1) for k in range(60)]
    rows += ["a b c", "A B  C", "a b", "a b c d e", "a b c d e f", None, "", " \n", "x"] + ["q w e r t y"] * 3
    rows = [(k * 3 % 1009, t) for k, t in enumerate(rows)] + [(None, "a b c"), (5000, rows[0]), (5000, rows[20]), (3, rows[1])]
    df = spark.createDataFrame([(i, t, None, "r") for i, t in rows], DOCS).repartition(5)
    got = {(r.id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(df, "doc_id", "text").collect()}
    assert got == brute_force_groups(rows)


def test_groups_of_an_empty_table(spark):
    assert jaccard.similar_groups(spark.createDataFrame([], DOCS), "doc_id", "text").collect() == []


def test_boundary_grows_with_list_length():
    sizes = {n: 100 for n in range(1, 100)}
    assert 0 <= jaccard.boundary(sizes, 75, 0.0) < jaccard.boundary(sizes, 75, 50.0) <= jaccard.MAX_BOUNDARY


def test_prefixes_are_long_enough():
    for a in range(1, 120):
        for b in range(a, 160):
            need = -(-75 * (a + b) // 175)
            if need <= a:
                assert jaccard.prefix(a, 75) >= a - need + 1 and jaccard.prefix(b, 75) >= b - need + 1
                assert min(a, jaccard.prefix(a, 75, 2)) >= min(a, a - need + 2)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (-5, 300)]
    out = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    assert {r.node: r.component for r in out} == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200, -5: -5, 300: -5}
