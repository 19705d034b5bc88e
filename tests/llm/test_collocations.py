import random
import re
from collections import Counter, defaultdict

import pytest

from lodemark.llm import collocations
from lodemark.sources.scans import Scratch

DOCS = "doc_id long, text string, lang string, phrase string, rank string"


def brute_force(rows, min_count=10, cover=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            totals[lang or "und"] += len(w)
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        longer = [g for g, n in f.items() if len(g) == 3 and n >= min_count]
        most = Counter()
        for g in longer:
            for pair in (g[:2], g[1:]):
                most[pair] = max(most[pair], f[g])
        found = []
        for g, a in f.items():
            if len(g) == 1 or a < min_count or len(g) == 2 and most[g] and 100 * most[g] >= cover * a:
                continue
            cuts = [(10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def sample(seed, n):
    draw = random.Random(seed)
    words = ["the", "of", "New", "new", "york", "city", "é", "x y", "a-b"] + [f"w{k}" for k in range(30)]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(draw.randint(1, 6)):
            text += " ".join(draw.choices(words, weights=[12, 8] + [2] * (len(words) - 2), k=draw.randint(1, 9)))
            text += draw.choice([". ", ", ", "\n", " new york city hall ", "\t", "! the end of all days. ", "\r"])
        out.append((text, draw.choice(["en", "en", "de", None, "und"])))
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(k, t, lang, "p", "r") for k, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    return sorted(map(tuple, collocations.collocations(df, "text", "lang", **options).collect()))


@pytest.fixture(params=["as set", "small chunks and everything hot"])
def sizes(request, monkeypatch):
    if request.param != "as set":
        monkeypatch.setattr(collocations, "CHUNK_WORDS", 50)
        monkeypatch.setattr(collocations, "PIECE_WORDS", 3)
        monkeypatch.setattr(collocations, "HOT_SHARE", 100_000)


def test_collocations_equal_brute_force(spark, sizes):
    rows = sample(1, 400) + [(None, "en"), ("", None), (" .. \t", "fr"), ("solo", "fr")] + [("same text again and again", "en")] * 40
    want = brute_force(rows)
    assert len({r[0] for r in want}) >= 3
    assert mined(spark, rows) == want


def test_long_pieces_and_the_cut_at_top(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PIECE_WORDS", 1_000)
    draw = random.Random(3)
    rows = [(" ".join(draw.choices([f"v{k}" for k in range(12)], k=n)), "en") for n in (999, 1_000, 1_001, 1_002, 1_003, 2_002, 2_003, 60_000)]
    assert mined(spark, rows, top=50) == brute_force(rows, top=50)


def test_paths_are_maximal_and_hold_every_edge(spark):
    rows = [("a b c d e f", "en")] * 12 + [("x c d y", "en")] * 11 + [("r s t r s t r s", "en")] * 10 + [("p q r2 s2 t2", "de")] * 15
    df = spark.createDataFrame([(k, t, lang, "p", "r") for k, (t, lang) in enumerate(rows)], DOCS)
    scratch = Scratch(spark)
    grams = scratch.write(collocations.graph(df, "text", "lang", 10))
    paths = {(r.lang, " ".join(r.words), r.f, r.n_edges) for r in collocations.compact(grams, scratch).collect()}
    assert ("de", "p q r2 s2 t2", 15, 3) in paths
    edges = [(r.lang, r.w1, r.w2, r.w3) for r in grams.where("w3 is not null").collect()]
    held = [(lang, *w.split()[k:k + 3]) for lang, w, _, n in paths for k in range(n)]
    assert sorted(edges) == sorted(held)


def test_a_ring_of_unary_nodes_stays_single(spark):
    edges = [("en", "a", "b", "a", 20), ("en", "b", "a", "b", 20), ("en", "a", "b", None, 20), ("en", "b", "a", None, 20)]
    grams = spark.createDataFrame(edges, "lang string, w1 string, w2 string, w3 string, f long")
    paths = collocations.compact(grams, Scratch(spark)).collect()
    assert sorted(" ".join(r.words) for r in paths) == ["a b a", "b a b"]


def test_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000
    grams = [("en", "a", None, None, big), ("en", "b", None, None, big), ("en", "a", "b", None, big - 1), ("en", None, None, None, 3 * big)]
    frame = spark.createDataFrame(grams, "lang string, w1 string, w2 string, w3 string, f long")
    row = collocations.scored(frame, collocations.candidates(frame, collocations.compact(frame, Scratch(spark)))).first()
    assert row.score == 10**6 * (big - 1)**2 // big**2


def test_no_texts(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("a b c", "en")]) == []
