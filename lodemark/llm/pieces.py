"""SentencePiece encoding and decoding through the tokenizers library, rebuilt from the model file's own protocol buffer."""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from lodemark.llm.common import packed, unpacked

SPACE = "▁"
# Fixed values of the model format: piece kinds, model kinds, and the field numbers read below.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        if wire not in (1, 2, 5):
            raise ValueError(f"unknown wire type {wire}")
        size = varint() if wire == 2 else 8 if wire == 1 else 4
        yield key >> 3, data[at:at + size]
        at += size


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        inner = dict(fields(value)) if number in (1, 2, 3) else {}
        if number == 1:
            model.pieces.append((inner.get(1, b"").decode("utf-8"), struct.unpack("<f", inner.get(2, b"\0\0\0\0"))[0], inner.get(3, NORMAL)))
        elif number == 2:
            model.kind, model.byte_fallback = inner.get(3, UNIGRAM), bool(inner.get(35, 0))
        elif number == 3:
            model.charsmap = inner.get(2, b"")
            model.dummy_prefix, model.trim_spaces, model.escape_spaces = (bool(inner.get(k, 1)) for k in (3, 4, 5))
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs whose union is a piece, best union first: the order in which the model joins neighbours."""
    scores = {p: (-s, k) for k, (p, s, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = [(scores[p], scores[p[:k]][1], p[:k], p[k:]) for p in scores for k in range(1, len(p)) if p[:k] in scores and p[k:] in scores]
    return [(a, b) for _, _, a, b in sorted(found)]


def words_apart(model: Model) -> bool:
    """Whether no piece goes on into a space marker, so that a text can be cut before each run of markers and encoded in parts."""
    return model.escape_spaces and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, kind in model.pieces if kind in (NORMAL, USER))


def core(model: Model) -> models.Model:
    """Piece scores (unigram) or merges (BPE) with byte fallback; ids are the model's."""
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    unknown = next((k for k, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        return models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    return models.BPE({p: k for k, (p, _, _) in enumerate(model.pieces)}, merges(model), fuse_unk=True, byte_fallback=model.byte_fallback,
                      unk_token=None if unknown is None else model.pieces[unknown][0])


def build(model: Model) -> Tokenizer:
    """The whole tokenizer: normaliser, space marker, pieces, byte fallback and decoder."""
    tokenizer = Tokenizer(core(model))
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if words_apart(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    steps = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return tokenizer


_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Codec:
    """Encodes and decodes batches. Each distinct part of a text is given to the library once and remembered.

    With `check`, every part's ids are compared with those of the sentencepiece library; differing parts are kept in `wrong`.
    """

    MEMORY = 1_000_000

    def __init__(self, path: str, threads: int, check: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = ("true" if threads > 1 else "false"), str(threads)
        with open(path, "rb") as file:
            self.model = parse(file.read())
        self.apart = words_apart(self.model)
        self.charsmap = normalizers.Precompiled(self.model.charsmap) if self.model.charsmap else None
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path) if check else None
        self.simple = self.apart and self.charsmap is None and self.model.dummy_prefix and not self.model.trim_spaces
        self.known: dict[str | tuple[str], bytes] = {}
        self.wrong: set[str | tuple[str]] = set()
        self.marked = np.array([p.startswith(SPACE) for p, _, _ in self.model.pieces])
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in self.model.pieces]

    @cached_property
    def whole(self) -> Tokenizer:
        return build(self.model)

    @cached_property
    def parts(self) -> Tokenizer:
        return Tokenizer(core(self.model))

    def normal(self, text: str) -> str:
        model = self.model
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if model.trim_spaces:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if model.dummy_prefix and text:
            text = SPACE + text
        return text.replace(" ", SPACE) if model.escape_spaces else text

    def _cut(self, text: str) -> list[str | tuple[str]]:
        """Parts of a text without their first marker; a part without one is a tuple of itself. Texts with single spaces only, by far the most, are cut by a split."""
        if self.simple and text and text[0] != " " and "  " not in text and SPACE not in text:
            return text.split(" ")
        text = self.normal(text)
        if not text:
            return []
        return [p[1:] if p[0] == SPACE else (p,) for p in (_PARTS.findall(text) if self.apart else [text])]

    def _learn(self, parts: list[str | tuple[str]]) -> None:
        """Encodes parts seen for the first time: those with one marker by hundreds in a sequence, any others one by one."""
        plain = [p for p in parts if isinstance(p, str) and SPACE not in p]
        for at in range(0, len(plain), 4096):
            chunk = plain[at:at + 4096]
            words = [SPACE + p for p in chunk]
            found = self.parts.encode_batch_fast([words[k:k + 512] for k in range(0, len(words), 512)], is_pretokenized=True, add_special_tokens=False)
            ids = np.concatenate([np.array(f.ids, np.int32) for f in found])
            starts = np.flatnonzero(self.marked[ids])   # only a part's first piece begins with a marker
            if len(starts) != len(chunk):
                self._learn_singly(chunk)
                continue
            data, ends = ids.tobytes(), [*(starts[1:] * 4).tolist(), len(ids) * 4]
            self.known.update((p, data[x:y]) for p, x, y in zip(chunk, [0, *ends], ends))
            if self.processor and not np.array_equal(np.fromiter(chain.from_iterable(self._other(chunk)), np.int32), ids):
                self._compare(chunk)
        self._learn_singly([p for p in parts if not isinstance(p, str) or SPACE in p])

    def _learn_singly(self, parts: list[str | tuple[str]]) -> None:
        full = [p[0] if isinstance(p, tuple) else SPACE + p for p in parts]
        for part, found in zip(parts, self.parts.encode_batch_fast(full, add_special_tokens=False)):
            self.known[part] = array("i", found.ids).tobytes()
        if self.processor:
            self._compare(parts)

    def _other(self, parts: list[str | tuple[str]]) -> list[list[int]]:
        """Ids of the other library. An empty text has none there, so a lone marker is compared with its piece."""
        prefix = SPACE if self.model.dummy_prefix else ""
        texts = [p[0] if isinstance(p, tuple) else (SPACE + p).removeprefix(prefix) for p in parts]
        found = self.processor.encode([t.replace(SPACE, " ") for t in texts], num_threads=1)
        return [ids if t else [self.processor.piece_to_id(SPACE)] for t, ids in zip(texts, found)]

    def _compare(self, parts: list[str | tuple[str]]) -> None:
        self.wrong |= {p for p, ids in zip(parts, self._other(parts)) if array("i", ids).tobytes() != self.known[p]}

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Ids as 32-bit integers, and whether all parts agree with the other library."""
        cut = [self._cut(t) for t in texts]
        met = set().union(*cut)
        new = met - self.known.keys()
        if len(self.known) + len(new) > self.MEMORY:
            self.known.clear()
            new = met
        self._learn(list(new))
        return [(b"".join(map(self.known.__getitem__, parts)), not self.wrong or self.wrong.isdisjoint(parts)) for parts in cut]

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.bytes[k] for k in ids])
        try:
            text = data.decode("utf-8")
        except UnicodeDecodeError:
            return self.whole.decode(ids, skip_special_tokens=False)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


@lru_cache(maxsize=4)
def loaded(path: str, threads: int, check: bool = False) -> Codec:
    return Codec(path, threads, check)


def _over(df: DataFrame, column: str, kind: str, work, carry: Sequence[str] | None, **outputs: str) -> DataFrame:
    carry = df.columns if carry is None else carry
    rows = df.withColumn(column, F.col(f"`{column}`").cast(kind)).select(packed(list(dict.fromkeys([*carry, column]))))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{n} {t}" for n, t in outputs.items())
    return unpacked(rows.mapInArrow(work, schema), carry, **{n: F.col(n) for n in outputs})


def encode(df: DataFrame, text_col: str, model_path: str, threads: int = 2, check: bool = False, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of df (its columns `carry`, by default all) with `ids`, the token ids of the whole text, and `parity`.

    model_path is a SentencePiece model file, present on every executor. Marker strings of the model in a text are ordinary
    text. New parts of a batch are encoded by `threads` threads of a task. With `check`, parity tells whether the
    sentencepiece library encodes every part of the text alike; without, it is null. A null text has null ids and an empty
    text none. Each row is encoded by itself, so repeated rows and empty tables need no rule; input columns named ids or
    parity are replaced.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(model_path, threads, check)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = rows.column(0).field(text_col).to_pylist()
                found = codec.encode([t or "" for t in texts])
                ends = np.cumsum([0, *(len(b) // 4 for b, _ in found)])
                mask = pa.array([t is None for t in texts], pa.bool_())
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(b for b, _ in found), np.int32)), mask=mask)
                same = pa.array([ok if check and t is not None else None for (_, ok), t in zip(found, texts)], pa.bool_())
                yield pa.RecordBatch.from_arrays([rows.column(0), ids, same], names=["row", "ids", "parity"])

    return _over(df, text_col, "string", work, carry, ids="array<int>", parity="boolean")


def decode(df: DataFrame, ids_col: str, model_path: str, threads: int = 2, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of df with `decoded`, the text of its token ids; null for null ids. An input column named decoded is replaced.

    Byte pieces in a row are joined to characters; bytes that are not UTF-8 become U+FFFD.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(model_path, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [None if i is None else codec.decode(i) for i in rows.column(0).field(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], names=["row", "decoded"])

    return _over(df, ids_col, "array<int>", work, carry, decoded="string")
