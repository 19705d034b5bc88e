import hashlib
import math
import random
import zlib

import pytest

from lodemark.llm import trie

TURNS = "conv_id long, turn long, role string, text string, depth string, key string"


@pytest.fixture
def tiny_blocks(spark, monkeypatch):
    """Blocks of two conversations over many tasks, so that almost every node lies in several."""
    monkeypatch.setattr(trie, "TURNS_PER_TASK", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def rebuilt(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    def place(t):
        return t[:2], hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()
    own = {c: [t[2:] for t in sorted(turns, key=place)] for c, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = own.get(conv - int(math.fmod(conv, 5)), [])[:h] + turns[h:]
    return out


def brute_force(talks):
    members = {}
    for conv, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members}
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    rows = []
    for p, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(talks[c]) == len(p))))
        rows.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children[p]), leaves[p], saved[p],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def built(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], TURNS).repartition(5)
    talks = trie.conversations(df, "conv_id", "turn", "role", "text")
    found = trie.prefix_nodes(trie.borrow_openings(talks))
    assert found.columns == trie.RESULT
    return sorted(map(tuple, found.collect()), key=str)


def sample(seed, n):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(n * 2), n):
        turns = [draw.choice(["hé", "b", "", "long " * 3]) for _ in range(draw.choice([1, 2, 3, 3, 5, 12]))]
        rows += [(conv, k, draw.choice(["user", "user", None]), t) for k, t in enumerate(turns)]
    return rows


def test_trie_equals_brute_force_over_many_blocks(spark, tiny_blocks):
    rows = sample(1, 120)
    rows += [(1000 + k, t, "user", "same") for k in range(60) for t in range(3)]  # a large group of equal conversations
    rows += [(2000 + k, t, "user", "same" if t < 40 else str(k)) for k in range(6) for t in range(45)]  # a long shared opening
    assert built(spark, rows) == brute_force(rebuilt(rows))


def test_trie_with_one_block(spark):
    rows = sample(2, 60)
    assert built(spark, rows) == brute_force(rebuilt(rows))


def test_nulls_ties_repeats_and_negative_ids(spark, tiny_blocks):
    rows = [(None, 0, "user", "nobody"), (0, None, "user", "first"), (0, 0, None, None), (0, 0, "user", "tie"), (0, 0, "user", "tie"),
            (1, 5, "user", "own"), (7, 1, "a", "bc"), (8, 1, "ab", "c"), (-3, 0, "user", "below"), (-5, 0, "user", "lender"), (9, 0, "", "x" * 1_500_000)]
    assert built(spark, rows) == brute_force(rebuilt(rows))


def test_turnless_conversations_belong_to_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 5)]
    want = brute_force(rebuilt(rows))
    assert built(spark, rows) == want and want[0][1] == 0


def test_no_conversation_no_node(spark):
    assert built(spark, []) == [] and built(spark, [(None, 0, "user", "x")]) == []
