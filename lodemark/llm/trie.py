"""Conversation prefix trie by truncation peeling: what common openings hold, and what sharing them would save."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodemark.sources.scans import Scratch

TURNS_PER_TASK = 200_000
ROOT = bytes(16)
NODE = ("key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, ended string, last_bytes long, border boolean, block long, on_first boolean, on_last boolean")
TYPES = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_()]
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One row per conversation: `id` and `turns`, each turn with a digest of its role and text and the bytes of its text.

    Turns follow by turn number, null first; equal numbers by digest, so their order does not depend on the row order. A null
    role or text is empty, a row with a null id belongs to no conversation, repeated rows are turns of their own. Texts
    are digested before they are gathered, so a conversation gathers about 30 bytes a turn, however long its texts are.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), turn.alias("t")).where("id IS NOT NULL")
    gathered = rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return gathered.select("id", F.transform("t", lambda t: F.struct(t["digest"], t["n_bytes"])).alias("turns"))


def borrow_openings(talks: DataFrame, group: int = 5, lengths: int = 9) -> DataFrame:
    """Every conversation with its first h turns replaced by those of conversation id - id % group (the remainder has the sign of
    the id); h is crc32(id) % lengths.

    Where the lender has fewer turns all of them are taken, none where it is absent; what a conversation has after its own
    first h turns follows. The result may be without turns.
    """
    lent = talks.where(F.col("id") % group == 0).select(F.col("id").alias("lender"), F.slice("turns", 1, lengths).alias("lent"))
    joined = talks.withColumn("lender", F.col("id") - F.col("id") % group).join(lent, "lender", "left")
    h = (F.crc32(F.col("id").cast("string")) % lengths).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    none = F.array().cast(talks.schema["turns"].dataType)
    return joined.select("id", F.concat(F.slice(F.coalesce("lent", none), F.lit(1), h), own).alias("turns"))


def _chains(paths: list[list[bytes]]) -> list[list[bytes]]:
    """Names of all prefixes of each path, the root's first. Neighbours in sorted order share the names of what they share."""
    out: list[list[bytes]] = []
    last, names = [], [ROOT]
    for path in paths:
        same = 0
        for a, b in zip(last, path):
            if a != b:
                break
            same += 1
        names = names[:same + 1]
        for digest in path[same:]:
            names.append(hashlib.md5(names[-1] + digest).digest())
        out.append(names)
        last = path
    return out


def _sha(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def peel(ids: list[int], paths: list[list[bytes]], sizes: list[list[int]], block: int) -> list[tuple]:
    """The nodes over one block of sorted conversations, as rows of NODE.

    From the deepest level up, the nodes that survive from below are merged with the conversations that end here; then the
    last turn is stripped and what is left is grouped anew. Only nodes on the path of the block's first or last conversation
    can also lie in another block: those rows are `border` rows and hold this block's share.
    """
    chains = _chains(paths)
    ended: dict[int, list[int]] = {}
    for k, path in enumerate(paths):
        ended.setdefault(len(path), []).append(k)
    first, last = set(chains[0]), set(chains[-1])
    rows: list[list] = []  # [key, depth, smallest id, members, children, leaves, saved, ended ids, member's number, parent's place]

    def node(level: dict[bytes, list], k: int, depth: int) -> list:
        found = level.get(chains[k][depth])
        if found is None:
            found = level[chains[k][depth]] = [chains[k][depth], depth, ids[k], 0, 0, 0, 0, [], k, None]
            rows.append(found)
        return found

    alive: dict[bytes, list] = {}
    for depth in range(max(ended), -1, -1):
        for k in ended.get(depth, ()):
            found = node(alive, k, depth)
            found[2] = min(found[2], ids[k])
            found[3] += 1
            found[7].append(ids[k])
        above: dict[bytes, list] = {}
        for found in alive.values():
            k = found[8]
            found[5] = found[5] or 1
            if depth:
                found[6] += (found[3] - 1) * sizes[k][depth - 1]
                parent = found[9] = node(above, k, depth - 1)
                parent[2] = min(parent[2], found[2])
                parent[3] += found[3]
                parent[4] += 1
                parent[5] += found[5]
                parent[6] += found[6]
        alive = above
    out = []
    for key, depth, least, n, children, leaves, saved, own, k, parent in rows:
        at_first, at_last = key in first, key in last
        border = at_first or at_last
        known = parent is not None and not (parent[0] in first or parent[0] in last)
        out.append((key, parent[0] if parent else None, depth, least, parent[2] if known else None, n, children, leaves, saved,
                    None if border else _sha(own), ",".join(map(str, own)) if border and own else None,
                    sizes[k][depth - 1] if depth else 0, border, block if border else None, at_first, at_last))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        if batch.num_rows:
            columns = list(zip(*peel(*(c.to_pylist() for c in batch.columns), block=(part << 32) | number)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=[f.split()[0] for f in NODE.split(", ")])


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of id lists, sorted by node and block, to one SHA-256 per node. Only one piece is held at a time."""
    key, sha, done = None, None, []
    for batch in batches:
        for now, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if now != key:
                if key is not None:
                    done.append((key, sha.hexdigest()))
                key, sha = now, hashlib.sha256(piece.encode())
            else:
                sha.update(b"," + piece.encode())
        keys, found = list(zip(*done)) or ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
        done = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])


def prefix_nodes(talks: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of `talks` (id, turns: digest, n_bytes), as RESULT says; see `peel` for the method.

    Conversations are sorted by their turns and then their id over all tasks, which cuts any common opening and any
    group of equal conversations into blocks of bounded size. Each block is peeled from its deepest level up, so the number
    of Spark jobs does not depend on the depth. A node that lies inside a block is whole there. The others lie on the paths of
    first and last conversations, two paths a block: their shares are summed, and what blocks counted twice is taken
    off all ancestors by one suffix sum along each path.

    saved_tokens sums, over a node's subtree, (members - 1) times the bytes of the last text. ends_sha256 is of the ascending
    ids that end in the node, joined by commas; SHA-256 is serial, so the ids that end in one node stream through one task, as
    pieces made by many. Conversations without turns belong to the root; an empty table has no node. Ids are expected once.
    """
    scratch = Scratch(talks.sparkSession)
    turns = F.col("turns")
    rows = scratch.write(talks.select("id", turns["digest"].alias("path"), turns["n_bytes"].alias("sizes")))
    total = rows.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    spread = rows.repartitionByRange(total // TURNS_PER_TASK + 1, "path", "id").sortWithinPartitions("path", "id")
    nodes = scratch.write(spread.mapInArrow(_blocks, NODE))
    scratch.drop(rows)

    border = nodes.where("border").select("*", (F.col("block") * 2 + F.when(F.col("on_first"), 0).otherwise(1)).alias("edge"))
    merged = scratch.write(border.groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.min("edge").alias("edge"), (F.count("*") - 1).alias("extra"),
        (F.count_if(F.col("n_children") == 0) - F.when(F.sum("n_children") == 0, 1).otherwise(0)).alias("false_leaves"),
        ((F.count("*") - 1) * F.min("last_bytes")).alias("unsaved")))
    # Each node is corrected on one path only, whose higher nodes are all its ancestors.
    sides = F.array_compact(F.array(F.when(F.col("on_first"), F.col("block") * 2), F.when(F.col("on_last"), F.col("block") * 2 + 1)))
    paths = border.select(F.explode(sides).alias("edge"), "depth", "key")
    fixes = paths.join(merged.select("key", "edge", "false_leaves", "unsaved"), ["key", "edge"], "left")
    below = Window.partitionBy("edge").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    fixes = fixes.select("key", F.sum("false_leaves").over(below).alias("false_leaves"), F.sum("unsaved").over(below).alias("unsaved"))
    fixes = fixes.groupBy("key").agg(F.sum("false_leaves").alias("less_leaves"), F.sum("unsaved").alias("more_saved"))
    twice = merged.groupBy(F.col("parent_key").alias("key")).agg(F.sum("extra").alias("less_children"))
    pieces = border.where("ended IS NOT NULL").select("key", "ended", "block").repartition("key").sortWithinPartitions("key", "block")
    ends = pieces.select("key", "ended").mapInArrow(_digest_runs, "key binary, ends_sha256 string")
    zero = F.lit(0)
    whole = merged.join(fixes, "key", "left").join(twice, "key", "left").join(ends, "key", "left").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", (F.col("n_children") - F.coalesce("less_children", zero)).alias("n_children"),
        (F.col("n_leaves") - F.coalesce("less_leaves", zero)).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_sha([]))).alias("ends_sha256"))
    whole = scratch.write(whole)
    parents = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.where("NOT border")
    top = inner.where("parent_conv_id IS NULL").drop("parent_conv_id").join(parents, "parent_key").select(RESULT)
    return inner.where("parent_conv_id IS NOT NULL").select(RESULT).unionAll(top).unionAll(
        whole.join(parents, "parent_key", "left").select(RESULT))
