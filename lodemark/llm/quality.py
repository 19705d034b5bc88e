"""Compression bands: zstandard ratios of whole documents and of fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import packed, unpacked

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Texts of up to `max_bytes` pass with compressed size / size from `low` (below: repetitive) to `high` (above: noise)."""

    max_bytes: float
    low: float
    high: float


# Short texts compress less, so both limits fall with length. A natural text lies well inside each band.
BANDS = (Band(512, 0.38, 0.95), Band(1024, 0.35, 0.90), Band(4096, 0.31, 0.82), Band(16384, 0.27, 0.74),
         Band(65536, 0.25, 0.68), Band(float("inf"), 0.23, 0.66))
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, doc_ratio double, n_chunks int, n_bad_chunks int, base_failed boolean, kept boolean"
TYPES = [{"long": pa.int64(), "double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_()}[f.split()[1]] for f in MEASURES.split(", ")]
EMPTY = (0, 0, 0, 0, 0, None, 0, 0, True, False)


def _band(size: int, bands: Sequence[Band]) -> Band:
    return next(b for b in bands if size <= b.max_bytes)


def repeated_words(found: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(found) < 4:
        return 0
    _, codes = np.unique(np.fromiter(map(hash, found), np.int64, len(found)), return_inverse=True)
    codes = codes.astype(np.int64)
    windows = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:] if len(found) < 1 << 21 else None
    if windows is None:
        _, pairs = np.unique(codes[:-1] * len(found) + codes[1:], return_inverse=True)
        windows = pairs[:-1].astype(np.int64) * len(found) + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    hit = np.zeros(len(found), bool)
    repeats = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        hit[repeats + k] = True
    return int(hit.sum())


def measured(text: str | None, compressor: zstandard.ZstdCompressor, bands: Sequence[Band], chunk_bytes: int, bad_share: float) -> tuple:
    """The row of MEASURES of one text. A null text has no words and fails."""
    if not text:
        return EMPTY
    data = text.encode("utf-8", "surrogatepass")
    found = data.split()
    seen: set[bytes] = set()
    n_dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            n_dup += 1
        elif line.strip():
            seen.add(line)
    n_repeat = repeated_words(found)
    word_chars = len(text) - (len(data) - len(data.translate(None, SPACES)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    ratio = len(compressor.compress(data)) / len(data)
    band = _band(len(data), bands)
    good = band.low <= ratio <= band.high
    starts = [*range(0, len(data) - chunk_bytes, chunk_bytes), len(data) - chunk_bytes] if len(data) > chunk_bytes else []
    chunks = [data[k:k + chunk_bytes] for k in starts]
    limits = _band(chunk_bytes, bands)
    bad = sum(not limits.low <= len(compressor.compress(c)) / chunk_bytes <= limits.high for c in chunks)
    failed = len(found) < 50 or 100 * n_repeat > 50 * len(found)
    kept = not failed and good and bad <= bad_share * len(chunks)
    return len(found), word_chars, n_symbols, n_dup, n_repeat, ratio, len(chunks), bad, failed, kept


def compression_bands(df: DataFrame, text_col: str, bands: Sequence[Band] = BANDS, chunk_bytes: int = 4096,
                      bad_share: float = 0.25, level: int = 3, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of df (its columns `carry`, by default all) with its measures and `kept`.

    The whole text is compressed once, and so is each full chunk of chunk_bytes of a text longer than that. The last chunk ends
    at the last byte and overlaps the one before where the length is no multiple of chunk_bytes. A text is kept if
    it passes the base rule (50 words, at most half of them in repeated three-word windows), its own ratio lies in the band
    of its length, and at most bad_share of its chunks lie outside the band of the chunk length.

    A null, empty or blank text has no words and is not kept. Every row is judged by itself, so ties, repeated rows and empty
    tables need no rule; input columns with the name of a measure are replaced.
    """
    settings = (tuple(bands), chunk_bytes, bad_share)
    names = [f.split()[0] for f in MEASURES.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level, write_content_size=False)
        for batch in batches:
            rows = [measured(t.as_py(), compressor, *settings) for t in batch.column(1)]
            columns = list(zip(*rows)) or [()] * len(names)
            arrays = [pa.array(c, type=t) for c, t in zip(columns, TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["row", *names])

    carry = df.columns if carry is None else carry
    rows = df.select(packed(carry), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, {MEASURES}"
    return unpacked(rows.mapInArrow(judge, schema), carry, **{n: F.col(n) for n in names})
