"""Phrase collocations from a weighted de Bruijn graph: edges are the longest grams, nodes the grams that they overlap in."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodemark.sources.scans import Scratch

CHUNK_WORDS = 1_500_000  # words whose edges are summed in a task before they are sent
PIECE_WORDS = 400_000  # longer pieces are read in parts that overlap by two words
SAMPLE_ROWS, HOT_SHARE, SALTS = 20_000, 1_000, 256
UNKNOWN = "und"
_FOLD = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
LIST_EDGES = 1_000
EDGE = "lang string, w1 string, salt int, rest string"
GRAM = ["w1", "w2", "w3"]


class _Chunk:
    """Numbered words of some texts: pieces end with 0, parts of a piece that goes on with -1."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = lambda: len(self.numbers) + 1
        self.by_lang: dict[str, list[int]] = defaultdict(list)
        self.n = 0

    def add(self, lang: str, words: list[bytes], ends: bool) -> None:
        codes = self.by_lang[lang]
        codes.extend(map(self.numbers.__getitem__, words))
        codes.append(0 if ends else -1)
        self.n += len(words)

    def edges(self, hot_words: set, hot_pairs: set) -> Iterator[pa.RecordBatch]:
        """Distinct (word, next word, word after it) with their counts; none where the piece has ended."""
        vocabulary = [b"", *self.numbers]
        crc = np.fromiter(map(zlib.crc32, vocabulary), np.int64, len(vocabulary))
        names = pa.array(vocabulary, pa.binary()).view(pa.string())
        size = len(vocabulary)
        for lang, codes in self.by_lang.items():
            line = np.array([*codes, 0, 0], np.int64)
            a, b, c = line[:-2], line[1:-1], line[2:]
            c = np.where(b == 0, 0, c)
            whole = (a > 0) & (b >= 0) & (c >= 0)
            if not whole.any():
                continue
            keys, counts = np.unique((a[whole] * size + b[whole]) * size + c[whole], return_counts=True)
            pair, c = np.divmod(keys, size)
            a, b = np.divmod(pair, size)
            hot = [self.numbers[w] for tongue, w in hot_words if tongue == lang and w in self.numbers]
            salt = np.where(np.isin(a, hot), 1 + crc[b] % SALTS, 0)
            hot = [self.numbers[v] * size + self.numbers[w] for tongue, v, w in hot_pairs if tongue == lang and v in self.numbers and w in self.numbers]
            salt = np.where(np.isin(pair, hot), 1 + SALTS + (crc[b] + crc[c]) % SALTS, salt)
            order = np.lexsort((salt, a))
            a, b, c, salt, counts = a[order], b[order], c[order], salt[order], counts[order]
            edge = np.arange(len(keys))
            new = np.r_[True, (a[1:] != a[:-1]) | (salt[1:] != salt[:-1])]
            new |= (edge - np.maximum.accumulate(np.where(new, edge, 0))) % LIST_EDGES == 0
            first = np.flatnonzero(new)
            bounds = pa.array(np.r_[first, len(keys)].astype(np.int32))
            rest = pc.binary_join_element_wise(names.take(pa.array(b)), names.take(pa.array(c)), pa.array(counts).cast(pa.string()), " ")
            columns = [pa.array(np.full(len(first), lang, object), pa.string()), names.take(pa.array(a[first])), pa.array(salt[first].astype(np.int32)),
                       pc.binary_join(pa.ListArray.from_arrays(bounds, rest), "\n")]
            yield from pa.table(columns, names=["lang", "w1", "salt", "rest"]).to_batches(max_chunksize=5_000)


def edges(df: DataFrame, text_col: str, lang_col: str, hot_words: set = frozenset(), hot_pairs: set = frozenset()) -> DataFrame:
    """Counts of every word with its two successors in the piece, summed within chunks of a task, as lists by first word."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece in text.as_py().translate(_FOLD).split(b"\n"):
                    words = piece.split()
                    start = 0
                    while len(words) > start + PIECE_WORDS + 2:
                        chunk.add(lang, words[start:start + PIECE_WORDS + 2], ends=False)
                        start += PIECE_WORDS
                    if words:
                        chunk.add(lang, words[start:], ends=True)
                    if chunk.n >= CHUNK_WORDS:
                        yield from chunk.edges(hot_words, hot_pairs)
                        chunk = _Chunk()
        if chunk.n:
            yield from chunk.edges(hot_words, hot_pairs)

    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = df.select(lang, F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).where("text IS NOT NULL")
    return texts.mapInArrow(cut, EDGE)


def unlisted(lists: DataFrame) -> DataFrame:
    """The lists as rows: a line holds second word, third word and count; words hold neither spaces nor line feeds."""
    def word(text: Column) -> Column:
        return F.when(text != "", text)

    line = F.col("line")
    lines = lists.select("lang", "w1", "salt", F.explode(F.split("rest", "\n")).alias("line"))
    return lines.select("lang", "w1", "salt", word(F.substring_index(line, " ", 1)).alias("w2"),
                        word(F.substring_index(F.substring_index(line, " ", 2), " ", -1)).alias("w3"), F.substring_index(line, " ", -1).cast("long").alias("f"))


def hot_grams(df: DataFrame, text_col: str, lang_col: str) -> tuple[set, set]:
    """Words and pairs of words with at least one of HOT_SHARE words of a sample of about SAMPLE_ROWS texts: at most HOT_SHARE
    of each. They only decide how rows are dealt to tasks, never what is counted."""
    share = max(1, df.count() // SAMPLE_ROWS)
    text = F.col(f"`{text_col}`").cast("string")
    found = unlisted(edges(df.where(F.pmod(F.xxhash64(text), F.lit(share)) == 0), text_col, lang_col))
    pairs = found.groupBy("lang", "w1", "w2").agg(F.sum("f").alias("f")).persist()
    least = (pairs.agg(F.sum("f")).first()[0] or 0) / HOT_SHARE + 1
    words = pairs.groupBy("lang", "w1").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("lang", F.col("w1").cast("binary")).collect()
    both = pairs.where((F.col("f") >= least) & F.col("w2").isNotNull()).select("lang", F.col("w1").cast("binary"), F.col("w2").cast("binary")).collect()
    pairs.unpersist()
    return {(r[0], bytes(r[1])) for r in words}, {(r[0], bytes(r[1]), bytes(r[2])) for r in both}


def graph(df: DataFrame, text_col: str, lang_col: str, min_count: int) -> DataFrame:
    """`lang`, `w1`, `w2`, `w3`, `f`: all grams of one to three words with at least min_count occurrences, and per language one
    row without words, which counts all of them.

    Every word occurrence is one longest gram: it and its two successors, fewer where its piece ends. Only these are
    counted from texts and dealt out once, by first word. A pair's count is the flow through its node, the edges that leave it and the
    pieces that end with it; a word's count is the flow of its pairs and the pieces that end with it. Hot words are dealt by their
    second word too, hot pairs by their third, and the shares of those few are added in the end.
    """
    sent = unlisted(edges(df, text_col, lang_col, *hot_grams(df, text_col, lang_col)).repartition("lang", "w1", "salt"))
    key = ["lang", "w1", "salt"]

    def flow(grams: DataFrame, to: Column) -> DataFrame:
        """Sums over grams and over the shorter grams that each passes its count on to; `to` is an array of (w1, w2, w3)."""
        passed = grams.select("lang", "salt", "f", F.col("w1").alias("at"), F.explode(to).alias("g"))
        return passed.select("lang", F.col("at").alias("w1"), "salt", "f", F.col("g.w2").alias("w2"), F.col("g.w3").alias("w3")) \
            .groupBy(*key, "w2", "w3").agg(F.sum("f").alias("f"))

    def gram(w2: Column, w3: Column) -> Column:
        return F.struct(w2.cast("string").alias("w2"), w3.cast("string").alias("w3"))

    none, enough = F.lit(None), F.col("f") >= min_count
    own, pair, word = gram(F.col("w2"), F.col("w3")), gram(F.col("w2"), none), gram(none, none)
    triples = sent.groupBy(*key, "w2", "w3").agg(F.sum("f").alias("f"))
    pairs = flow(triples, F.when(enough & F.col("w3").isNotNull(), F.array(own, pair)).otherwise(F.array(pair)))
    kept = F.col("w2").isNotNull() & (enough | (F.col("salt") > SALTS))
    words = flow(pairs, F.when(F.col("w3").isNotNull(), F.array(own)).when(kept, F.array(pair, word)).otherwise(F.array(word)))
    lone = F.col("w2").isNull()
    first = F.when(~lone, F.array("w1")).when(enough | (F.col("salt") > 0), F.array(F.col("w1"), none.cast("string"))).otherwise(F.array(none.cast("string")))
    counts = words.select("lang", "w2", "w3", "f", F.explode(first).alias("w1")).groupBy("lang", *GRAM).agg(F.sum("f").alias("f"))
    return counts.where(enough | F.col("w1").isNull())


def compact(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """Maximal unary paths of the graph of frequent triples: `lang`, `words`, `f`, `n_edges`.

    A node is unary if all its occurrences come in by one edge and leave by one, both of its own count: then no piece starts or
    ends in it. Each edge points to the one before it over a unary node; pointers are doubled until none moves, so the number
    of joins follows the logarithm of the longest path. Edges of a ring of unary nodes have no first one and stay paths of
    their own. Every frequent edge lies in exactly one path.
    """
    edge = grams.where("w3 IS NOT NULL").select("lang", *GRAM, "f")
    nodes = grams.where("w2 IS NOT NULL AND w3 IS NULL").select("lang", "w1", "w2", F.col("f").alias("flow"))
    into = edge.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f", F.col("w1").alias("before"))
    entry = into.join(nodes, ["lang", "w1", "w2"]).where("f = flow").select("lang", "w1", "w2", F.col("before"))
    unary = edge.join(nodes, ["lang", "w1", "w2"]).where("f = flow").join(entry, ["lang", "w1", "w2"]).select(
        "lang", *GRAM, F.struct(F.col("before").alias("w1"), F.col("w1").alias("w2"), F.col("w2").alias("w3")).alias("head"))
    own = F.struct(*GRAM)
    steps = edge.join(unary, ["lang", *GRAM], "left").select(
        "lang", own.alias("edge"), "f", F.coalesce("head", own).alias("head"), F.when(F.col("head").isNull(), 0).otherwise(1).alias("back"), F.col("head").isNull().alias("done"))
    steps, open_before = scratch.write(steps), -1
    while True:
        left = steps.where("NOT done").count()
        if left == 0 or left == open_before:
            break
        open_before = left
        ahead = steps.select("lang", F.col("edge").alias("head"), F.col("head").alias("to"), F.col("back").alias("more"), F.col("done").alias("there"))
        moved = steps.where("NOT done").join(ahead, ["lang", "head"]).select("lang", "edge", "f", F.col("to").alias("head"), (F.col("back") + F.col("more")).alias("back"), F.col("there").alias("done"))
        after = scratch.write(steps.where("done").unionByName(moved))
        scratch.drop(steps)
        steps = after
    ring = ~F.col("done")
    steps = steps.withColumn("head", F.when(ring, F.col("edge")).otherwise(F.col("head"))).withColumn("back", F.when(ring, 0).otherwise(F.col("back")))
    joined = steps.groupBy("lang", "head").agg(F.min("f").alias("f"), F.count("*").alias("n_edges"),
                                               F.sort_array(F.collect_list(F.struct("back", F.col("edge.w3").alias("w")))).alias("rest"))
    return joined.select("lang", F.concat(F.array("head.w1", "head.w2"), F.transform("rest", lambda r: r["w"])).alias("words"), "f", "n_edges")


def candidates(grams: DataFrame, paths: DataFrame, cover_percent: int = 50) -> DataFrame:
    """Frequent triples, and frequent pairs that no frequent triple around them covers to cover_percent.

    Inside a path each pair is as frequent as the path, so it is covered; other pairs meet only the first or last edge of paths.
    """
    triples = grams.where("w3 IS NOT NULL")
    pairs = grams.where("w2 IS NOT NULL AND w3 IS NULL")
    size = F.size("words")
    inner = F.when(size > 3, F.transform(F.sequence(F.lit(2), size - 2), lambda k: F.struct(
        F.element_at("words", k).alias("w1"), F.element_at("words", k + 1).alias("w2")))).otherwise(F.array())
    inside = paths.select("lang", F.explode(inner).alias("n")).select("lang", "n.w1", "n.w2")
    tips = F.array(F.struct(F.element_at("words", 1).alias("w1"), F.element_at("words", 2).alias("w2")),
                   F.struct(F.element_at("words", -2).alias("w1"), F.element_at("words", -1).alias("w2")))
    around = paths.select("lang", "f", F.explode(tips).alias("n")).groupBy("lang", "n.w1", "n.w2").agg(F.max("f").alias("most"))
    open_pairs = pairs.join(inside, ["lang", "w1", "w2"], "left_anti").join(around, ["lang", "w1", "w2"], "left")
    free = open_pairs.where(F.col("most").isNull() | (100 * F.col("most") < cover_percent * F.col("f")))
    return triples.select("lang", *GRAM, "f").unionByName(free.select("lang", *GRAM, "f"))


def scored(grams: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases with their counts, the counts of the parts at the cut that scores least, and that score."""
    counted = grams.where("w1 IS NOT NULL AND w3 IS NULL")

    def with_count(rows: DataFrame, first: str, second: str | None, name: str) -> DataFrame:
        """The count of the gram (first, second) of each row; null where the row has none."""
        part = counted.where("w2 IS NULL" if second is None else "w2 IS NOT NULL")
        keys = [first] if second is None else [first, second]
        part = part.select("lang", *[F.col(w).alias(k) for w, k in zip(("w1", "w2"), keys)], F.col("f").alias(name))
        return rows.join(part, ["lang", *keys], "left")

    rows = with_count(with_count(with_count(phrases, "w1", None, "f1"), "w2", None, "f2"), "w3", None, "f3")
    rows = with_count(with_count(rows, "w1", "w2", "f12"), "w2", "w3", "f23")
    total = grams.where("w1 IS NULL").select("lang", F.col("f").alias("n"))

    def score(left: str, right: str) -> Column:
        return F.expr(f"(cast(f AS decimal(19, 0)) * cast(f AS decimal(19, 0)) * 1000000BD) div (cast({left} AS decimal(19, 0)) * cast({right} AS decimal(19, 0)))")

    pair = F.col("w3").isNull()
    rows = rows.join(total, "lang").withColumn("s1", F.when(pair, score("f1", "f2")).otherwise(score("f1", "f23")))
    rows = rows.withColumn("s2", F.when(~pair, score("f12", "f3")))
    second = F.col("s2") < F.col("s1")
    return rows.select(
        "lang", F.concat_ws(" ", *GRAM).alias("phrase"), F.col("f").alias("a"),
        F.when(second, F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(second, F.col("f3")).when(pair, F.col("f2")).otherwise(F.col("f23")).alias("r"), "n",
        F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))


def collocations(df: DataFrame, text_col: str, lang_col: str, min_count: int = 10, cover_percent: int = 50, top: int = 2_000) -> DataFrame:
    """The `top` phrases of two or three words of each language with `rank`, `a`, `l`, `r`, `n` and `score`.

    Texts are lower-cased in A-Z, cut into pieces at . , ; : ! ? and line breaks, and pieces into words at spaces and tabs. A
    phrase with a >= min_count occurrences scores floor(10^6 a^2 / (l r)) for the cut into parts with l and r occurrences that
    scores least, the first of equals; the product is exact while it has at most 38 digits. Pairs go where a frequent triple around
    them has at least cover_percent of their occurrences. Ranks follow score, then a, then the phrase in byte order, so they have no ties.

    A null language is `und`; a null or empty text has no words; repeated rows count again; an empty table gives no
    phrases. A text of any length is counted whole. Only frequent grams are joined; see `graph` for hot words.
    """
    scratch = Scratch(df.sparkSession)
    grams = scratch.write(graph(df, text_col, lang_col, min_count))
    found = candidates(grams, compact(grams, scratch), cover_percent)
    rows = scored(grams, found)
    # Two steps: a language may hold most of all phrases.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
