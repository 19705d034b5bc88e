"""Multilingual mixture inference: which languages a text holds, and how much of each."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import packed, unpacked
from lodemark.sources.scans import Scratch

BITS = 15
CHUNK_CHARS = 2_000_000
MAX_LANGUAGES = 512  # 128 KB of probabilities each in every task
UNDETERMINED = "und"


@dataclass(frozen=True)
class Languages:
    """Trigram probabilities: one row per language, one column per trigram bucket."""

    names: tuple[str, ...]
    share: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts in a row, and how many each text has.

    Texts are lower-cased; every run of characters that are not letters is one space, and a space stands at both ends.
    """
    joined = "".join(f"\x00{t.lower()}\x00" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t.lower()) + 2 for t in texts), np.int64, len(texts))
    doc = np.repeat(np.arange(len(texts)), lengths)
    letter = _letters()[points]
    first = np.zeros(len(points), bool)
    first[np.cumsum(lengths) - lengths] = True
    keep = letter | first
    keep[1:] |= letter[:-1]
    points, doc = np.where(letter, points, 32)[keep].astype(np.uint32), doc[keep]
    if len(points) < 3:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    mixed = points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA77) ^ points[2:] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    inside = doc[:-2] == doc[2:]
    return (mixed >> np.uint32(32 - BITS)).astype(np.int64)[inside], np.bincount(doc[:-2][inside], minlength=len(texts))


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > CHUNK_CHARS:
            yield start, k
            start, size = k, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def learn(labeled: DataFrame, text_col: str, lang_col: str, max_languages: int = MAX_LANGUAGES, smoothing: float = 0.2) -> Languages:
    """Trigram counts per language over all rows with a text and a language.

    Each task adds up its own counts and emits at most 2^15 of them a language; Spark sums these. The driver receives the table
    of max_languages languages at most, those with the most trigrams (ties to the smaller name); texts in any other one are
    given to the likeliest that was learned. Rows with a null text or language teach nothing.
    """
    rows = labeled.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for lang in dict.fromkeys(langs):
                mine = [texts[k] for k in np.flatnonzero(langs == lang)]
                for a, b in _chunks(mine):
                    found = np.bincount(trigrams(mine[a:b])[0], minlength=1 << BITS)
                    sums[lang] = sums[lang] + found if lang in sums else found
            if len(sums) > max_languages:
                yield from sent(sums)
                sums = {}
        yield from sent(sums)

    def sent(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])

    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = Scratch(labeled.sparkSession).write(counts)
    largest = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    seen = [r[0] for r in largest.collect()]
    found = counts.where(F.col("lang").isin(seen)).toArrow() if seen else counts.limit(0).toArrow()
    names = tuple(sorted(seen))
    share = np.full((len(names), 1 << BITS), smoothing)
    if names:
        at = {n: k for k, n in enumerate(names)}
        np.add.at(share, (np.array([at[x] for x in found["lang"].to_pylist()], int), found["bucket"].to_numpy()), found["n"].to_numpy())
    return Languages(names, (share / share.sum(axis=1, keepdims=True)).astype(np.float32))


def mixture(share: np.ndarray, found: np.ndarray, start: int, gradient: np.ndarray, penalty: float, rounds: int = 25) -> np.ndarray:
    """Language proportions of one text, by expectation-maximisation over a set of languages that grows while it pays.

    The language with the steepest gradient joins the set; it stays if the log-likelihood gains more than the penalty.
    """
    pi = np.zeros(len(share))
    pi[start] = 1.0
    chances = share[:, found].astype(np.float64)
    best = np.log(chances[start]).sum()
    while True:
        steep = np.where(pi > 0, -np.inf, gradient)
        new = int(np.argmax(steep))
        if steep[new] - len(found) <= penalty:
            return pi
        members = np.append(np.flatnonzero(pi > 0), new)
        trial = np.append(pi[members[:-1]] * 0.9, 0.1)
        own = chances[members]
        for _ in range(rounds):
            weights = trial[:, None] * own
            trial = (weights / weights.sum(axis=0)).sum(axis=1) / len(found)
        total = trial @ own
        value = np.log(total).sum()
        if value - best <= penalty:
            return pi
        best, pi = value, np.zeros(len(share))
        pi[members] = trial
        gradient = (chances / total).sum(axis=1)


def proportions(texts: list[str], share: np.ndarray, weight: float) -> np.ndarray:
    """One row of language proportions per text; all zero where a text has no letter.

    A text starts from its most likely single language. The log-likelihood is concave in the proportions, so no mixture gains
    more than (largest gradient - trigrams); where that is within the penalty, expectation-maximisation is not needed.
    """
    out = np.zeros((len(texts), len(share)))
    logs = np.log(share)
    for a, b in _chunks(texts):
        found, n = trigrams(texts[a:b])
        some = np.flatnonzero(n)
        if not len(some):
            continue
        starts = (np.cumsum(n) - n)[some]
        scores = np.stack([np.add.reduceat(row[found], starts, dtype=np.float64) for row in logs], axis=1)
        start = scores.argmax(axis=1)
        own = np.repeat(start, n[some])
        base = share[own, found]
        gradients = np.stack([np.add.reduceat(row[found] / base, starts, dtype=np.float64) for row in share], axis=1)
        for k, doc in enumerate(some):
            penalty = weight * math.log(n[doc] + 1)
            if gradients[k].max() - n[doc] <= penalty:
                out[a + doc, start[k]] = 1.0
            else:
                out[a + doc] = mixture(share, found[starts[k]:starts[k] + n[doc]], start[k], gradients[k], penalty)
    return out


def infer(df: DataFrame, text_col: str, languages: Languages, weight: float = 4.0, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of df (its columns `carry`, by default all) with `lang_pred`, `score` and `lang_shares` (the proportions of all languages found in the text).

    lang_pred is the language with the largest share (ties: the first name) and score that share. A text that is null, empty
    or has no letter, and every text if no language was learned, is `und` with score 0. Texts are judged whole and each by
    itself; repeated rows get equal results. Input columns with the name of an output are replaced.
    """
    names, share = languages.names, languages.share

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            pi = proportions(texts, share, weight) if names else np.zeros((len(texts), 1))
            best, top = pi.argmax(axis=1), pi.max(axis=1)
            pred = [names[k] if s > 0 else UNDETERMINED for k, s in zip(best, top)]
            shares = [[(names[k], float(p[k])) for k in np.flatnonzero(p)] for p in pi]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(np.minimum(top, 1.0), pa.float64()),
                 pa.array(shares, pa.map_(pa.string(), pa.float64()))], names=["row", "lang_pred", "score", "lang_shares"])

    carry = df.columns if carry is None else carry
    rows = df.select(packed(carry), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, lang_shares map<string,double>"
    return unpacked(rows.mapInArrow(judge, schema), carry, **{c: F.col(c) for c in ("lang_pred", "score", "lang_shares")})


def fold(id_col: str) -> Column:
    """Remainder by three of the CRC-32 of an id written as text; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3, F.lit(0))
