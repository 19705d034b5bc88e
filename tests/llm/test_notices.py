import random
import re

from lodemark.llm import notices
from lodemark.llm.notices import NOTICES, PHRASES, Notice, errors_allowed

DOCS = "doc_id long, text string, labels string, row string"
LETTERS = "abcdefghijklmnopqrstuvwxyz 0123456789"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute_force_base(text):
    found = words_of(text)
    places = [(k, label) for phrase, label in PHRASES.items() for k in range(len(found))
              if found[k:k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def edits_to_ends(body, words):
    """Edits between the body and the best part of words that starts after a space, for each end."""
    row = [10_000]
    for j in range(1, len(words) + 1):
        row.append(0 if words[j - 1:j] == b" " else row[-1] + 1)
    for c in body:
        now = [row[0] + 1]
        for j, d in enumerate(words, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != d)))
        row = now
    return row


def brute_force_labels(text):
    words = b" " + " ".join(words_of(text)).encode() + b" "
    out = set()
    for n in NOTICES:
        tail = (b" " + n.tail.encode() if n.tail else b"") + b" "
        ends = edits_to_ends(n.body.encode(), words)
        if any(e <= errors_allowed(n) and words[j:j + len(tail)] == tail for j, e in enumerate(ends)):
            out.add(n.label)
    return out


def spoiled(text, draw, n):
    for _ in range(n):
        k = draw.randrange(len(text))
        text = draw.choice([text[:k] + text[k + 1:], text[:k] + draw.choice(LETTERS) + text[k:], text[:k] + draw.choice(LETTERS) + text[k + 1:]])
    return text


def samples():
    draw = random.Random(12)
    plain = ["the under license mit gnu public", "version 2", "Wörter über alles", "cc by nd", "under the mpl license", "x" * 30]
    out = [None, "", "...", "Under the MIT-License; under the mit license under the MIT\nLicense", "Apache License, Version 2.0 cc by-nc 4.0",
           "under the mpl license", "cc by nd", "gnu general public license version 4", "under themit license", "a" * 50_000 + " undar the mit license " + "b c " * 30_000]
    for n in NOTICES:
        for errors in range(errors_allowed(n) + 3):
            for _ in range(4):
                out.append(" ".join([draw.choice(plain), spoiled(n.body, draw, errors), n.tail, draw.choice(plain)]))
    return out


def test_scan_matches_brute_force(spark):
    texts = samples()
    df = spark.createDataFrame([(k, t, "old", "r") for k, t in enumerate(texts)], DOCS).repartition(4)
    rows = {r.doc_id: r for r in notices.license_scan(df, "text").collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        r = rows[k]
        base = brute_force_base(text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base, text
        assert r.row == "r" and r.text == text
        if len(text or "") < 10_000:
            want = brute_force_labels(text) | set(filter(None, base[4].split(",")))
            assert r.labels == ",".join(sorted(want)), text
        assert (r.score == 0.0) == (r.labels == "") and 0 <= r.score <= 1 and (r.score == 1.0 or not r.n_base)
    assert rows[9].labels == "mit" and [(s["first"], s["last"], s["errors"]) for s in rows[9].spans] == [(1, 4, 1)]
    assert rows[5].labels == rows[6].labels == rows[7].labels == ""


def test_spans_hold_the_notice_with_the_stated_edits(spark):
    texts = [t for t in samples() if t and len(t) < 10_000]
    df = spark.createDataFrame([(k, t, None, "r") for k, t in enumerate(texts)], DOCS)
    by_label = {}
    for n in NOTICES:
        by_label.setdefault(n.label, []).append(n)
    seen = 0
    for r in notices.license_scan(df, "text", carry=["doc_id"]).collect():
        found = words_of(texts[r.doc_id])
        for s in r.spans:
            part = b" " + " ".join(found[s["first"]:s["last"] + 1]).encode() + b" "
            tails = [(n, (b" " + n.tail.encode() if n.tail else b"") + b" ") for n in by_label[s["label"]]]
            assert any(part.endswith(t) and whole(n.body.encode(), part[1:len(part) - len(t)]) <= s["errors"] <= errors_allowed(n) for n, t in tails)
            seen += 1
    assert seen > 40


def whole(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        now = [i]
        for j, d in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != d)))
        row = now
    return row[-1]


def test_own_notices_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "All rights are reserfed by the author of this work", None, "r")] * 2, DOCS)
    own = (Notice("reserved", "all rights are reserved by the author", "of"),)
    rows = notices.license_scan(df, "text", phrases={}, notices=own).collect()
    assert [(r.labels, r.n_base, r.first_word) for r in rows] == [("reserved", 0, None)] * 2
    assert notices.license_scan(spark.createDataFrame([], DOCS), "text").collect() == []
