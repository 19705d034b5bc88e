"""Sliding sentence spans: sentences covered by a run that occurred before, in any text, are removed."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import packed, unpacked
from lodemark.sources.scans import Scratch

SENTENCE = r"[^.!?\n]+[.!?\n]*[\x09-\x0D\x20]*|[.!?\n]+[\x09-\x0D\x20]*"
_SENTENCE = re.compile(SENTENCE)
MIN_WORDS, LONE_WORDS = 20, 40


def sentences(text: str) -> list[tuple[list[bytes], str]]:
    """Words and exact text of each sentence; the texts joined are the whole text.

    A sentence ends with full stops, exclamation or question marks or line feeds, and the white space after them. White
    space without a word belongs to the sentence before it, at the start of a text to the one after it.
    """
    out: list[tuple[list[bytes], str]] = []
    waiting = ""
    for piece in _SENTENCE.findall(text):
        found = piece.encode("utf-8", "surrogatepass").split()
        if found:
            out.append((found, waiting + piece))
            waiting = ""
        elif out:
            out[-1] = (out[-1][0], out[-1][1] + piece)
        else:
            waiting += piece
    return out or ([([], waiting)] if waiting else [])


def runs(lengths: np.ndarray, min_words: int, lone_words: int, both_ends: bool = False) -> list[tuple[int, int]]:
    """First and last sentence of each run: from every sentence on, the shortest run of two or more sentences with min_words
    words, or of one or more with lone_words. Near the end of a text a sentence may start no run. With both_ends also the
    shortest such run up to every sentence: then every sentence of a repeated passage with enough words lies under one."""
    ends = np.cumsum(lengths)
    before = ends - lengths
    two = np.maximum(np.searchsorted(ends, before + min_words), np.arange(len(ends)) + 1)
    last = np.minimum(two, np.searchsorted(ends, before + lone_words))
    found = [(k, int(j)) for k, j in enumerate(last) if j < len(ends)]
    if both_ends:
        end = len(ends) - 1
        found = sorted({*found, *((end - j, end - k) for k, j in runs(lengths[::-1], min_words, lone_words))})
    return found


def drop_repeated_spans(df: DataFrame, id_col: str, text_col: str, min_words: int = MIN_WORDS, lone_words: int = LONE_WORDS,
                        both_ends: bool = False) -> DataFrame:
    """Every row of df with the text cleaned in place, and n_sentences, n_removed and removed (numbers of removed sentences).

    A run of several consecutive sentences (`runs`) is hashed to 128 bits over its words. The first occurrence of a run is
    the one with the smallest (id, text digest, position); all sentences under any other occurrence are removed. Runs may
    overlap, and a text may repeat its own runs. Sentences are compared by their words, with case and punctuation.

    Counting the runs combines on the map side, and only repeated ones are joined back to their places. The counts are
    written first, so that both sides of the join are dealt out anew and AQE splits a run that a third of all texts hold. A text's marks are gathered per text, never per run.

    A null text stays null, a text without words stays as it is. Fully repeated rows (equal id and text) are one occurrence
    and stay equal; a null id sorts first. An empty table gives an empty one. Input columns with the name of an output are
    replaced.
    """
    scratch = Scratch(df.sparkSession)
    key = [F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("digest")]
    text = F.col(f"`{text_col}`").cast("string").alias("text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, texts = (c.to_pylist() for c in batch.columns)
            rows: list[tuple] = []
            for own, digest, value in zip(ids, digests, texts):
                parts = [w for w, _ in sentences(value)]
                for k, j in runs(np.fromiter(map(len, parts), np.int64, len(parts)), min_words, lone_words, both_ends):
                    name = hashlib.blake2b(b" ".join([b" ".join(p) for p in parts[k:j + 1]]), digest_size=16).digest()
                    rows.append((name[:8], name[8:], own, digest, k, j))
            columns = list(zip(*rows)) or [()] * 6
            names = [pa.array(np.frombuffer(b"".join(c), np.int64)) for c in columns[:2]]
            yield pa.RecordBatch.from_arrays([*names, pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()),
                                              pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.int32())], names=["h1", "h2", "id", "digest", "first", "last"])

    found = df.where(F.col(f"`{text_col}`").isNotNull()).select(*key, text)
    spans = scratch.write(found.mapInArrow(hashed, "h1 long, h2 long, id long, digest long, first int, last int"))
    repeated = scratch.write(spans.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"))
    hits = scratch.write(spans.join(repeated, ["h1", "h2"]))
    scratch.drop(spans)
    place = F.struct("id", "digest", "first")
    origin = scratch.write(hits.groupBy("h1", "h2").agg(F.min(place).alias("origin")))
    later = hits.join(origin, ["h1", "h2"]).where(~place.eqNullSafe(F.col("origin")))
    marks = later.groupBy("id", "digest").agg(F.collect_set(F.struct("first", "last")).alias("marks"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, spans_now in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = sentences(value or "")
                covered = np.zeros(len(parts) + 1, np.int64)
                for span in spans_now or []:
                    covered[span["first"]] += 1
                    covered[span["last"] + 1] -= 1
                gone = np.cumsum(covered)[:-1] > 0
                kept = value if not gone.any() else "".join(p for (_, p), g in zip(parts, gone) if not g)
                out.append((kept, sum(bool(w) for w, _ in parts), int(gone.sum()), np.flatnonzero(gone).tolist()))
            columns = list(zip(*out)) or [()] * 4
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                                             names=["row", "cleaned", "n_sentences", "n_removed", "removed"])

    others = [c for c in df.columns if c != text_col]
    rows = df.select(packed(others or [id_col]), text, *[k.alias(f"_{n}") for k, n in zip(key, ("id", "digest"))])
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_digest") == F.col("digest"))
    rows = rows.join(marks, same, "left").select("row", "text", "marks")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, cleaned string, n_sentences int, n_removed int, removed array<int>"
    outputs = {text_col: F.col("cleaned"), **{n: F.col(n) for n in ("n_sentences", "n_removed", "removed")}}
    return unpacked(rows.mapInArrow(clean, schema), others, **outputs)
