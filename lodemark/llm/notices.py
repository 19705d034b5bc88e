"""License scans: short notices found in spite of typing errors, from exact seeds and bounded-error matching."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import packed, unpacked


class Notice(NamedTuple):
    """`body` may hold errors, one per LETTERS_PER_ERROR bytes; `tail`, which tells versions and kinds apart, may not."""
    label: str
    body: str
    tail: str = ""


LETTERS_PER_ERROR = 16

# The phrases of the contract and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Words of public license notices, lower-cased, without punctuation.
NOTICES = (
    Notice("apache-2", "licensed under the apache license version", "2"),
    Notice("apache-2", "apache license version", "2"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("cc-by-nc", "licensed under cc by", "nc"),
    Notice("cc-by-nc", "creative commons attribution noncommercial"),
    Notice("gpl-2", "gnu general public license version", "2"),
    Notice("gpl-3", "gnu general public license version", "3"),
    Notice("lgpl-3", "gnu lesser general public license version", "3"),
    Notice("mit", "released under the mit license"),
    Notice("mit", "under the mit license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Notice("mpl-2", "mozilla public license version", "2"),
)

# ASCII letters in lower case and digits stay, bytes above 0x7F too; all other bytes part words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def folded(data: bytes) -> bytes:
    """The words of a text in UTF-8, one space before each and after the last; nothing if there is no word."""
    found = data.translate(_FOLD).split()
    return b" " + b" ".join(found) + b" " if found else b""


def errors_allowed(notice: Notice) -> int:
    return len(notice.body.encode()) // LETTERS_PER_ERROR


class Seeker:
    """One notice: its body cut into one seed more than it may have errors, so that one of them stands unharmed, and its pattern."""

    def __init__(self, notice: Notice):
        body = notice.body.encode()
        k = errors_allowed(notice)
        cuts = [len(body) * j // (k + 1) for j in range(k + 2)]
        self.label, self.k, self.length = notice.label, k, len(body)
        self.seeds = [(body[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.tail = b" " + notice.tail.encode() if notice.tail else b""
        self.pattern = regex.compile(rb"(?e) (?:%s){e<=%d}%s(?= )" % (regex.escape(body, literal_spaces=True), k, regex.escape(self.tail, literal_spaces=True)))

    def windows(self, words: bytes) -> list[list[int]]:
        """Where a match can lie, by its seeds; overlapping windows are one."""
        hits = []
        for seed, offset in self.seeds:
            at = words.find(seed)
            while at >= 0:
                hits.append(at - offset)
                at = words.find(seed, at + 1)
        out: list[list[int]] = []
        reach = self.length + 2 * self.k + len(self.tail) + 2
        for start in sorted(hits):
            low, high = max(0, start - self.k - 1), start + reach
            if out and low <= out[-1][1]:
                out[-1][1] = high
            else:
                out.append([low, high])
        return out

    def spans(self, words: bytes) -> Iterator[tuple[int, int, int]]:
        """Place of the space before the match, place of the space after it, and edits."""
        for low, high in self.windows(words):
            for m in self.pattern.finditer(words[low:high]):
                yield low + m.start(), low + m.end(), sum(m.fuzzy_counts)


def _word_numbers(words: bytes, places: Sequence[int]) -> dict[int, int]:
    """Number of the word after each of these spaces."""
    out, at, n = {}, 0, 0
    for place in sorted(set(places)):
        n += words.count(b" ", at, place)
        at = place
        out[place] = n
    return out


def scanned(data: bytes | None, phrases: Sequence[tuple[bytes, str]], seekers: Sequence[Seeker]) -> tuple:
    """The row of MEASURES of one text."""
    words = folded(data or b"")
    base: list[tuple[int, str]] = []
    for phrase, label in phrases:
        at = words.find(phrase)
        while at >= 0:
            base.append((at, label))
            at = words.find(phrase, at + 1)
    found = [(start, end, errors, s) for s in seekers for start, end, errors in s.spans(words)]
    at = _word_numbers(words, [p for p, _ in base] + [p for start, end, *_ in found for p in (start, end)])
    starts = [at[p] for p, _ in base]
    spans = sorted({(at[start], at[end] - 1, s.label, errors) for start, end, errors, s in found})
    labels = {label for _, label in base}
    score = max([1.0] * bool(base) + [1.0 - errors / (s.length + len(s.tail)) for *_, errors, s in found], default=0.0)
    return (max(words.count(b" ") - 1, 0), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {s[2] for s in spans})), score,
            [{"first": a, "last": b, "label": label, "errors": errors} for a, b, label, errors in spans])


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("errors", pa.int32())]))
MEASURES = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
            "spans array<struct<first:bigint,last:bigint,label:string,errors:int>>")
TYPES = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), SPANS]


def license_scan(df: DataFrame, text_col: str, phrases: Mapping[str, str] = PHRASES, notices: Sequence[Notice] = NOTICES,
                 carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of df (its columns `carry`, by default all) with its places of the phrases and its fuzzy notices.

    A text is folded to words: A-Z lower-cased, cut at all ASCII characters but letters and digits. Phrases count wherever
    their words stand one after another, overlaps included. A notice is found where its body stands between word
    boundaries with at most one edit per LETTERS_PER_ERROR bytes (an inserted, lost or changed byte of UTF-8, spaces
    included), followed by its tail without any. A body with k errors holds at least one of its k + 1 seeds unharmed, so only windows
    around seeds are matched and none is missed. `spans` has the first and last word of each match, counted from 0, its label and
    its edits; matches of one notice do not overlap, those of several may. `score` is 1 with a phrase, else the best
    share of unharmed bytes of a notice, else 0.

    The work is one pass over each row by itself, without a shuffle: ties, repeated rows, hot sources and empty tables need
    no rule. A null or empty text has no words, no labels and no places. A text of any length is scanned whole; its memory is a
    few times its bytes. Input columns with the name of a measure are replaced.
    """
    wanted = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
    names = [f.split()[0] for f in MEASURES.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seekers = [Seeker(n) for n in notices]
        for batch in batches:
            rows = [scanned(t.as_py(), wanted, seekers) for t in batch.column(1)]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, type=t) for c, t in zip(columns, TYPES)]], names=["row", *names])

    carry = df.columns if carry is None else carry
    rows = df.select(packed(carry), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, {MEASURES}"
    return unpacked(rows.mapInArrow(scan, schema), carry, **{n: F.col(n) for n in names})
