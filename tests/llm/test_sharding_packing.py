from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodemark.llm import packing, sharding

DOCS = "doc_id long, source string, shard string"


def shards(df, n=4):
    return sharding.interleave(df, "doc_id", "source", n).collect()


def test_mixture_counts_and_slots(spark):
    df = spark.createDataFrame([(k, "hot" if k % 3 == 0 else f"s{k % 7}", "x") for k in range(1003)], DOCS)
    rows = shards(df, 16)
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == 1003 and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(16))
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    total = Counter(r.source for r in rows)
    for shard in sizes:
        mine = Counter(r.source for r in rows if r.shard == shard)
        assert all(abs(mine[s] - total[s] / 16) < 3 for s in total)


def test_many_buckets_rank_as_one(spark, monkeypatch):
    monkeypatch.setattr(sharding.gapless_rank, "__defaults__", (7, None))
    df = spark.createDataFrame([(k, f"s{k % 2}", None) for k in range(200)], DOCS)
    many = {r.doc_id: (r.shard, r.slot) for r in shards(df)}
    monkeypatch.undo()
    assert many == {r.doc_id: (r.shard, r.slot) for r in shards(df)}


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, None, "a"), (None, None, "a"), (1, None, None), (1, "s", "b"), (1, "s", "b")]
    out = shards(spark.createDataFrame(rows, DOCS), 2)
    assert len(out) == 5 and out[0].asDict().keys() == {"doc_id", "source", "shard", "slot"}
    assert sorted(Counter(r.shard for r in out).values()) == [2, 3]


def test_empty_table(spark):
    assert shards(spark.createDataFrame([], DOCS)) == []


def brute_force_fit(items, capacity):
    """Scans all bins for the tightest compatible one."""
    bins, out = [], []
    for length, source, cluster in items:
        open_bins = [(b["free"], k) for k, b in enumerate(bins) if b["free"] >= length and source not in b["sources"] and cluster not in b["clusters"] and b["free"] > 0]
        if open_bins:
            _, k = min(open_bins)
        else:
            bins.append({"free": capacity, "sources": set(), "clusters": set()})
            k = len(bins) - 1
        out.append((k, capacity - bins[k]["free"]))
        bins[k]["free"] -= length
        bins[k]["sources"].add(source)
        bins[k]["clusters"].add(cluster)
    return out


def test_best_fit_equals_a_full_scan():
    items = [((k * 37) % 90 + 1, f"s{k % 5}", k % 11) for k in range(300)]
    assert packing.best_fit(*map(list, zip(*items)), 100) == brute_force_fit(items, 100)


PACK = "doc_id long, n long, source string, cluster string, bin string"


def packed(df, capacity=10, **more):
    return packing.pack(df, "doc_id", F.col("n"), "source", F.col("cluster"), capacity, **more).collect()


@pytest.mark.parametrize("block_rows", [4096, 20])
def test_bins_hold_whole_rows_without_conflicts(spark, block_rows):
    df = spark.createDataFrame([(k, k % 37, "hot" if k % 3 == 0 else f"s{k % 9}", str(k % 13), "x") for k in range(200)], PACK)
    rows = packed(df, block_rows=block_rows)
    lengths = Counter()
    bins = {}
    for r in rows:
        lengths[r.doc_id] += r.piece_length
        if r.piece_length:
            bins.setdefault((r.bin_block, r.bin), []).append(r)
    assert lengths == Counter({k: k % 37 for k in range(200)}) and {r.doc_id for r in rows} == set(range(200))
    for held in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.piece_length) for r in held)
        assert spans[0][0] == 0 and spans[-1][1] <= 10 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert len({r.source for r in held}) == len(held) and len({r.cluster for r in held}) == len(held)


def test_packing_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, 0, "a", "c", "x"), (2, 4, "a", None, "x"), (2, 4, "a", None, "x"), (3, 4, None, None, "x"), (4, 4, None, "c", "x")], PACK)
    rows = packed(df)
    assert [(r.bin, r.piece_length) for r in rows if r.doc_id in (None, 1)] == [(None, 0)] * 2
    assert len({r.bin for r in rows if r.doc_id == 2}) == 2 and len({r.bin for r in rows if r.source is None and r.piece_length}) == 2
    assert packed(df.limit(0)) == []
