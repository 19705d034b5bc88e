import hashlib
import io
import struct
import zipfile

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lodemark.llm import neighbours, pieces, preference, warc
from lodemark.llm.queries import MODEL
from lodemark.sources.scans import Scratch

# ---- archives

PAGES = "page_id long, url string, html string, path string"


def round_trip(spark, rows, **more):
    folder = f"{Scratch(spark).root}/archives"
    archives = warc.write_archives(spark.createDataFrame(rows, PAGES), folder, **more)
    return archives, warc.read_records(warc.read_index(archives)).collect()


def test_archives_round_trip(spark):
    body = "<p>é</p>" * 40
    rows = [(5, "http://a", body, None), (3, "http://b", body, None), (9, None, body, None), (1, "u", "tiny", None), (2, "u", "tiny", None), (4, "x\r\ny", None, None),
            (6, "e", "", None), (None, "n", body, None), (7, "big", "z\r\n\r\n" * 300_000, None), (8, "w", "w" * 100, None), (3, "http://b", body, None)]
    archives, out = round_trip(spark, rows, archive_bytes=2000)
    assert archives.count() > 3 and len(out) == len(rows)
    by = {r.page_id: r for r in out}
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        r = by[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    assert {k: (r.record_type, r.refers_to) for k, r in by.items() if r.record_type == "revisit"} == {5: ("revisit", 3), 9: ("revisit", 3), None: ("revisit", 3)}


def test_no_pages(spark):
    archives, out = round_trip(spark, [])
    assert archives.count() == 0 and out == []


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def zipped(wide):
    buffer = Bytes()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, data in (("archive/data.warc.gz", b"abc" * 50), ("indexes/index.cdxj", b"{}\n"), ("é.txt", b"")):
            with archive.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as member:
                member.write(data)
        archive.comment = b"PK"
    return buffer


@pytest.mark.parametrize("wide", [False, True])
def test_directory_of_plain_and_wide_members(wide, monkeypatch):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    file = zipped(wide)
    assert not wide or warc.END64 in file.getvalue()
    members = warc.directory(file)
    assert [m.name for m in members] == ["archive/data.warc.gz", "indexes/index.cdxj", "é.txt"]
    at = warc.stored_at(file, members[0])
    assert file.getvalue()[at:at + members[0].size] == b"abc" * 50


def test_markers_are_replaced_by_wide_values():
    extra = struct.pack("<HHH", 9, 2, 7) + struct.pack("<HHQQ", 1, 16, 1 << 40, 1 << 41)
    assert warc._wide(extra, warc.MARK32, 12, warc.MARK32) == (1 << 40, 12, 1 << 41)


def test_damage_is_noticed():
    good = warc.record(1, "u", b"hello" * 30, hashlib.sha256(b"hello" * 30).hexdigest(), None, 3)
    assert warc.parsed(good)[2] == b"hello" * 30
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(warc.record(1, "u", b"hello" * 30, hashlib.sha256(b"other").hexdigest(), None, 3))
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.directory(Bytes(b"nothing"))


# ---- preference pairs

TURNS = "conv_id long, turn long, role string, text string, chosen string"


def pairs(spark, rows):
    talks = preference.conversations(spark.createDataFrame(rows, TURNS), "conv_id", "turn", "role", "text")
    return {r.conv_id: r for r in preference.format_pairs(preference.swapped_replies(talks)).collect()}


def test_shared_turns_are_the_prompt(spark):
    rows = [(0, 0, "user", "hi", None), (0, 1, "assistant", "yes", None), (0, 2, "user", "more", None), (0, 3, "assistant", "good <|im_end|>", None),
            (1, 0, "user", "q", None), (1, 1, "assistant", "bad", None), (2, 0, "user", "alone", None), (4, 0, "user", None, None), (4, 1, "assistant", "same", None),
            (5, 0, "user", "z", None), (5, 1, "assistant", "same", None)]
    out = pairs(spark, rows)
    r = out[0]
    assert r.n_shared == 3 and r.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert r.chosen_completion == "<|im_start|>assistant\ngood < |im_end|><|im_end|>\n" and r.rejected_completion == "<|im_start|>assistant\nbad<|im_end|>\n"
    for text, mask, learned in ((r.chosen_completion, r.chosen_mask, "good < |im_end|><|im_end|>\n"), (r.rejected_completion, r.rejected_mask, "bad<|im_end|>\n")):
        assert [text[m.start:m.end] for m in mask] == [learned]
    assert out[2].n_shared == 1 and out[2].chosen_completion == out[2].rejected_completion == ""
    assert out[4].n_shared == 2 and out[4].chosen_mask == []


def test_preference_edges(spark):
    rows = [(None, None, None, None, None), (None, 1, "assistant", "", None), (6, 0, "assistant", "x" * 100_000, None), (6, 0, "assistant", "x" * 100_000, None), (7, None, "system", "s", None)]
    out = pairs(spark, rows)
    assert set(out) == {None, 6, 7} and out[6].n_shared == 1 and out[6].rejected_completion == "" and len(out[6].chosen_mask) == 1
    assert pairs(spark, []) == {}
    own = spark.createDataFrame([(None, [("user", "a")], "keep"), ([("user", "b")], [("user", "a")], "keep")],
                                "chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    out = preference.format_pairs(own).collect()
    assert [(r.n_shared, r.prompt) for r in out] == [(0, ""), (0, "")] and out[0].chosen_completion == ""


# ---- pieces

TEXTS = [None, "", "a", " ", "  a  b ", "a ", "\n\n x", "<s> hi </s>", "▁x ▁▁y", "日本語 😀 é", "a\x00b \x00c", "\t\ta", "x" * 3000, "<0x41>", "The quick brown fox. " * 2000]


def test_codec_parity_and_round_trip(spark):
    df = spark.createDataFrame([(k, t, "r") for k, t in enumerate(TEXTS)], "doc_id long, text string, row string")
    rows = pieces.decode(pieces.encode(df, "text", MODEL, check=True), "ids", MODEL).collect()
    other = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in rows:
        text = TEXTS[r.doc_id]
        assert r.row == "r" and r.text == text
        if text is None:
            assert r.ids is None and r.decoded is None and r.parity is None
        else:
            assert r.ids == other.encode(text) and r.decoded == other.decode(r.ids) and r.parity
    assert pieces.encode(df.limit(0), "text", MODEL).collect() == []


def varint(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def message(*items):
    out = b""
    for number, value in items:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_model(trim):
    parts = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{k:02X}>", 0.0, 6) for k in range(256)]]
    parts += [(p, -(float(k + 1) ** 1.31), 1) for k, p in enumerate(["▁", "▁a", "b", "ab", "▁ab", "c", "a", "bc", "abc", "▁the", "th", "e", "t", "h"])]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in parts)
    return body + message((2, message((3, 1), (35, 1))), (3, message((1, b"identity"), (3, 1), (4, int(trim)), (5, 1))))


@pytest.mark.parametrize("trim", [False, True])
def test_unigram_scores_and_byte_fallback(tmp_path, trim):
    path = tmp_path / "unigram.model"
    path.write_bytes(unigram_model(trim))
    codec, other = pieces.Codec(str(path), 1, check=True), sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["abc the ab", "zabc é", "a  b", " the ", "c", "thethe abcab", "", "  "]
    for text, (ids, same) in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(ids, np.int32).tolist()
        assert ids == other.encode(text) and same, text
        assert codec.decode(ids) == other.decode(ids)
        assert ids == (codec.whole.encode(text, add_special_tokens=False).ids if text.strip() or not trim and text else [])


# ---- neighbours

VECTORS = "vec_id long, embedding array<float>, score string"


def brute_force(rows, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == 6 and None not in v
              and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, a in usable:
        if q % 5 == 0:
            near = sorted((-(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)), i) for i, b in usable if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def vectors(n, seed=0):
    draw = np.random.default_rng(seed)
    return [(k, draw.normal(size=6).tolist()) for k in range(n)]


def test_nearest_on_a_small_table_is_exact(spark):
    same = [1.0, 2.0, 0.5, -1.0, 0.0, 3.0]
    rows = vectors(60) + [(k, same) for k in range(100, 130)] + [(200, None), (205, [0.0] * 6), (210, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (215, [float("nan")] * 6),
                                                                (220, [float("inf")] + [1.0] * 5), (225, [1.0, 2.0]), (None, same)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS).repartition(4)
    small = neighbours.Settings(degree=8, leaf=40, beam=120, rounds=1)
    out = neighbours.nearest(df, "vec_id", "embedding", F.col("vec_id") % 5 == 0, 5, small).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.id, r.score))
    expected = brute_force(rows, 5)
    assert got.keys() == expected.keys()
    for q, near in expected.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near] and np.allclose([s for _, s in got[q]], [s for _, s in near], atol=1e-12)


def test_recall_on_a_larger_table(spark):
    rows = vectors(3000, 1)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)
    out = neighbours.nearest(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5, neighbours.Settings(degree=12, leaf=128, beam=64)).collect()
    expected = {q: {i for i, _ in near} for q, near in brute_force(rows, 5).items() if q % 50 == 0}
    assert sum(r.id in expected[r.query_id] for r in out) >= 0.9 * 5 * len(expected)


def test_too_few_vectors(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0], "x"), (5, [1.0, 1.0], "x")], VECTORS)
    out = neighbours.nearest(two, "vec_id", "embedding", F.col("vec_id") % 5 == 0).collect()
    assert sorted((r.query_id, r.id, r.rank) for r in out) == [(0, 5, 1), (5, 0, 1)]
    assert neighbours.nearest(two.limit(0), "vec_id", "embedding", F.col("vec_id") % 5 == 0).collect() == []


def recall_of_tight_group(spark, n, tight, size, spread):
    """Recall at 5 of every 25th row of a tight group of `tight` rows among n, by cosines in double precision."""
    draw = np.random.default_rng(3)
    rows = draw.normal(size=(n, size))
    rows[:tight] = rows[0] / np.linalg.norm(rows[0]) + spread / np.sqrt(size) * draw.normal(size=(tight, size))
    rows = rows.astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist(), "x") for k, v in enumerate(rows)], VECTORS)
    out = neighbours.nearest(df, "vec_id", "embedding", (F.col("vec_id") % 25 == 0) & (F.col("vec_id") < tight)).collect()
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    asked = range(0, tight, 25)
    near = {q: set(np.argsort(-np.where(np.arange(n) == q, -9, unit @ unit[q]))[:5].tolist()) for q in asked}
    return sum(r.id in near[r.query_id] for r in out) / (5 * len(asked))


def test_recall_within_a_tight_group(spark):
    assert recall_of_tight_group(spark, 9000, 3000, 64, 0.02) >= 0.9


def test_effort_grows_with_the_nodes():
    small, large = (neighbours.Settings().grown(n) for n in (10_000, 300_000))
    assert small == neighbours.Settings() and small.degree < large.degree and small.trees < large.trees and small.beam < large.beam


def test_vectors_that_met_are_not_compared_again():
    """Each vector's nearest among those that one of the two is new to; without a new one there is no pair."""
    draw = np.random.default_rng(2)
    unit = draw.normal(size=(9, 4)).astype(np.float32)
    ids, fresh = np.arange(9), np.arange(9) % 4 == 0
    a, b, _ = neighbours._within(ids, unit, 8, None, fresh)
    assert {*zip(a.tolist(), b.tolist())} == {(x, y) for x in range(9) for y in range(9) if x != y and (fresh[x] or fresh[y])}
    assert len(neighbours._within(ids, unit, 8, None, np.zeros(9, bool))[0]) == 0
    whole = neighbours._within(ids, unit, 3)
    assert all(np.array_equal(p, q) for p, q in zip(whole, neighbours._within(ids, unit, 3, None, np.ones(9, bool))))
