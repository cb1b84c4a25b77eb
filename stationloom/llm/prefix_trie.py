"""The trie of conversation prefixes: one node per distinct sequence of first turns, with what sharing it would save.

Turns become ids (64-bit hashes of role and text), a conversation a row of ids. Rows are range-sharded by their ids and
conv_id, so a shard holds a stretch of the sorted trie, and a sequence that very many conversations share is split over
shards by conv_id. In a shard, blocks of padded turn-id matrices are lexsorted in numpy, change masks of the columns are OR-ed
from left to right to mark where nodes start, and ``reduceat`` aggregates every depth, downwards for members, upwards for
what a subtree holds. Only nodes on the paths of a shard's first and last row can go on in other shards: their parts are
merged by a hash of the prefix, and as there are at most two paths per shard, one task adds up the tree of these boundary
nodes. The rows of a matrix block are those that reach it, so one very long conversation does not widen the others' rows.

Shards hold about ``TURNS_PER_SHARD`` turns, so their number grows with the input. The conversations that end at a node of
several shards are hashed from one sorted stream of id lists, never held together.

Defined results: turns are ordered by turn (NULL first), equal ones by a hash of role and text; NULL role or text is
empty; rows without conv_id belong to no conversation and are left out; a conversation without turns is a member of the
root alone; no conversations give no nodes. Repeated rows are turns of their own. Other columns of the input play no part.
A conversation is one row of ids (8 bytes a turn) and is not split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationloom.llm.shared_files import partition_number
from stationloom.storage import materialize

TURNS_PER_SHARD = 1 << 20
#: Columns of one padded matrix.
BLOCK = 16
#: Conversations of one list of ids, where the ids of a node are hashed in parts.
IDS_TOGETHER = 1 << 15
PAD = np.iinfo(np.int64).min
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
_SCHEMA = pa.schema(
    [("kind", pa.string()), *((c, pa.int64()) for c in _NODE), ("parent_conv_id", pa.int64()), ("key", pa.binary()),
     ("parent_key", pa.binary()), ("last_length", pa.int64()), ("place", pa.int64()), ("ends_sha256", pa.string())]
)
_SCHEMA_TEXT = (
    "kind string, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "parent_conv_id long, key binary, parent_key binary, last_length long, place long, ends_sha256 string"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# --- rows of turn ids --------------------------------------------------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, lengths): every conversation's turns in order, as ids and code points of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the least id stands for padding
    turn = F.struct("turn", F.greatest(F.xxhash64(role, text), F.lit(int(PAD) + 1)).alias("id"), F.length(text).alias("n"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.col("t.id").alias("ids"), F.col("t.n").alias("lengths"))


def rebuilt(rows: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation's first turns replaced by those of the conversation that leads its ``every`` ids.

    How many is the crc32 of its decimal id modulo ``most``. Negative ids belong to the multiple of ``every`` below them.
    """
    head = F.lit(most - 1)
    lead = rows.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("l_id"), F.slice("ids", F.lit(1), head).alias("l_ids"), F.slice("lengths", F.lit(1), head).alias("l_lengths")
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    rows = rows.withColumn("h", h.cast("int"))
    both = rows.join(lead, F.col("conv_id") - F.pmod("conv_id", F.lit(every)) == F.col("l_id"), "left")

    def put(own: str, led: str):
        first = F.coalesce(F.slice(led, F.lit(1), F.col("h")), F.array().cast(f"array<{'long' if own == 'ids' else 'int'}>"))
        return F.concat(first, F.slice(own, F.col("h") + 1, F.size(own))).alias(own)

    return both.select("conv_id", put("ids", "l_ids"), put("lengths", "l_lengths"))


# --- one shard ---------------------------------------------------------------------------------------------


class Rows:
    """Sequences as flat arrays, sorted by their ids, then by conv_id."""

    def __init__(self, conv: np.ndarray, offsets: np.ndarray, ids: np.ndarray, lengths: np.ndarray):
        order = _sorted(conv, offsets, ids)
        self.conv, self.start, self.n = conv[order], offsets[:-1][order], np.diff(offsets)[order]
        self.ids, self.lengths = ids, lengths


def _matrix(start: np.ndarray, n: np.ndarray, ids: np.ndarray, first: int) -> np.ndarray:
    """Columns ``first`` to ``first + BLOCK`` of the rows, padded."""
    columns = np.arange(first, first + BLOCK)
    inside = columns < n[:, None]
    at = np.where(inside, start[:, None] + columns, 0)
    return np.where(inside, ids[at], PAD) if len(ids) else np.full(inside.shape, PAD)


def _sorted(conv: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Order of the rows: blocks of columns are ranked from the last to the first, each with the rank of what follows."""
    start, n = offsets[:-1], np.diff(offsets)
    rank = np.empty(len(n), dtype=np.int64)
    rank[np.argsort(conv, kind="stable")] = np.arange(len(n))
    last = max(int(n.max(initial=0)) - 1, 0) // BLOCK
    for block in range(last, -1, -1):
        reach = np.flatnonzero(n > block * BLOCK) if block else np.arange(len(n))
        m = _matrix(start[reach], n[reach], ids, block * BLOCK)
        # rows that end inside this block have pads here, so the rank by conv_id decides only among equals
        order = np.lexsort((rank[reach], *m.T[::-1]))
        if not block:
            return order
        rank[reach[order]] = np.arange(len(reach))
    return np.arange(len(n))


def _levels(rows: Rows) -> list[dict[str, np.ndarray]]:
    """Per depth the nodes in sorted order: first row, rows, smallest member, parent's place on the level above, ends."""
    count = len(rows.conv)
    changed = np.zeros(count, dtype=bool)
    changed[0] = True
    active = np.arange(count)
    of_row = np.zeros(count, dtype=np.int64)
    levels = [
        {"row": np.zeros(1, np.int64), "n": np.array([count]), "least": rows.conv.min(keepdims=True),
         "parent": np.zeros(1, np.int64), "ends": np.array([np.count_nonzero(rows.n == 0)])}
    ]
    depth, matrix, first, where = 0, None, 0, np.zeros(count, np.int64)
    while True:
        depth += 1
        active = active[rows.n[active] >= depth]
        if not len(active):
            return levels
        if (depth - 1) % BLOCK == 0:
            first = depth - 1
            matrix = _matrix(rows.start[active], rows.n[active], rows.ids, first)
            where[active] = np.arange(len(active))
        column = matrix[where[active], depth - 1 - first]
        # the row before one of these may have ended: then a node starts here, whatever it was
        follows = np.diff(active, prepend=-2) == 1
        differs = np.ones(len(active), dtype=bool)
        differs[1:] = column[1:] != column[:-1]
        changed[active] |= differs | ~follows
        starts = np.flatnonzero(changed[active])
        row = active[starts]
        parent = of_row[row]
        n = np.diff(starts, append=len(active))
        of_row[active] = np.repeat(np.arange(len(starts)), n)
        levels.append(
            {"row": row, "n": n, "least": np.minimum.reduceat(rows.conv[active], starts), "parent": parent,
             "ends": np.add.reduceat((rows.n[active] == depth).astype(np.int64), starts)}
        )


def _children(level: dict, below: dict | None, values: np.ndarray | None) -> np.ndarray:
    """Sums of the level below per node; a node's children stand together."""
    out = np.zeros(len(level["row"]), dtype=np.int64)
    if below is not None:
        starts = np.flatnonzero(np.diff(below["parent"], prepend=-1))
        out[below["parent"][starts]] = np.add.reduceat(values, starts)
    return out


def shard_nodes(rows: Rows, shard: int) -> Iterator[dict[str, list]]:
    """Whole nodes of a shard, parts of those that may go on in others, and the id lists of those.

    Each part holds what the nodes inside it add to it; its children on a boundary path are added when parts are merged.
    """
    levels, count = _levels(rows), len(rows.conv)
    keys = {r: _path_keys(rows, r) for r in (0, count - 1)}
    below = leaves = saved = open_below = None
    for depth in range(len(levels) - 1, -1, -1):
        x = levels[depth]
        stop = x["row"] + x["n"]
        is_open = (x["row"] == 0) | (stop == count)
        inner = ~open_below if below is not None else None
        n_children = _children(x, below, inner.astype(np.int64) if below is not None else None)
        n_leaves = _children(x, below, leaves * inner if below is not None else None)
        kept = _children(x, below, saved * inner if below is not None else None)
        length = rows.lengths[rows.start[x["row"]] + depth - 1] if depth else np.zeros(1, np.int64)
        whole = ~is_open
        n_leaves[whole & (n_children == 0)] = 1
        kept[whole] += ((x["n"] - 1) * length)[whole]
        above = levels[depth - 1] if depth else None
        parent = above["least"][x["parent"]] if depth else np.zeros(1, np.int64)
        parent_open = ((above["row"] == 0) | (above["row"] + above["n"] == count))[x["parent"]] if depth else np.zeros(1, bool)

        def ids(i: int) -> list[int]:
            return rows.conv[x["row"][i] : x["row"][i] + x["ends"][i]].tolist()

        def key(i: int, d: int) -> bytes:
            return keys[0 if x["row"][i] == 0 else count - 1][d] if d == depth else _key_of(rows, x["row"][i], d, keys, count)

        at = np.flatnonzero(whole)
        if len(at):
            yield {
                "kind": ["node"] * len(at), "depth": [depth] * len(at), "conv_id": x["least"][at], "n_convs": x["n"][at],
                "n_children": n_children[at], "n_leaves": n_leaves[at], "saved_tokens": kept[at],
                "parent_conv_id": [None if o else p for p, o in zip(parent[at].tolist(), parent_open[at].tolist())],
                "parent_key": [key(i, depth - 1) if o else None for i, o in zip(at.tolist(), parent_open[at].tolist())],
                "ends_sha256": [_digest(ids(i)) if e else NO_ENDS for i, e in zip(at.tolist(), x["ends"][at].tolist())],
            }
        at = np.flatnonzero(is_open).tolist()
        yield {
            "kind": ["part"] * len(at), "depth": [depth] * len(at), "conv_id": x["least"][at], "n_convs": x["n"][at],
            "n_children": n_children[at], "n_leaves": n_leaves[at], "saved_tokens": kept[at],
            "key": [key(i, depth) for i in at], "parent_key": [key(i, depth - 1) if depth else None for i in at],
            "last_length": length[at],
        }
        for i in at:
            found = ids(i)
            lists = [",".join(map(str, found[j : j + IDS_TOGETHER])) for j in range(0, len(found), IDS_TOGETHER)]
            if lists:
                n = len(lists)
                yield {"kind": ["ends"] * n, "key": [key(i, depth)] * n, "place": [(shard << 32) + j for j in range(n)], "ends_sha256": lists}
        below, leaves, saved, open_below = x, n_leaves, kept, is_open


def _path_keys(rows: Rows, r: int) -> list[bytes]:
    """Hashes of the prefixes of one row, from the empty one on."""
    h, out = hashlib.blake2b(digest_size=16), []
    out.append(h.digest())
    for i in rows.ids[rows.start[r] : rows.start[r] + rows.n[r]].tolist():
        h.update(i.to_bytes(8, "little", signed=True))
        out.append(h.digest())
    return out


def _key_of(rows: Rows, row: int, depth: int, keys: dict, count: int) -> bytes:
    """The key of the boundary node of this depth that a row is below: its first ids are those of one of the two paths."""
    mine = rows.ids[rows.start[row] : rows.start[row] + depth]
    if rows.n[0] >= depth and np.array_equal(rows.ids[rows.start[0] : rows.start[0] + depth], mine):
        return keys[0][depth]
    return keys[count - 1][depth]


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# --- Spark -------------------------------------------------------------------------------------------------


def _sharded(rows: DataFrame) -> DataFrame:
    """Parts of all shards; rows are (conv_id, ids, lengths)."""
    spark = rows.sparkSession
    turns = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS_PER_SHARD))
    ranged = rows.repartitionByRange(n, "ids", "conv_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        t = pa.Table.from_batches(found).combine_chunks()
        ids, lengths = (t[c].combine_chunks() for c in ("ids", "lengths"))
        ids, lengths = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (ids, lengths))
        offsets = ids.offsets.to_numpy().astype(np.int64)
        held = Rows(
            t["conv_id"].to_numpy(), offsets - offsets[0], ids.flatten().to_numpy(zero_copy_only=False),
            lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        )
        for x in shard_nodes(held, partition_number()):
            n = len(x["kind"])
            yield pa.record_batch(
                [pa.array(x[f.name], f.type) if f.name in x else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA
            )

    return ranged.mapInArrow(work, _SCHEMA_TEXT)


def _boundary(parts: DataFrame) -> DataFrame:
    """Whole boundary nodes from their parts: at most two paths per shard, added up from the deepest on."""
    merged = parts.where("kind = 'part'").groupBy("key", "parent_key", "depth", "last_length").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    )

    def add_up(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: -r["depth"])
        by_key = {r["key"]: r for r in rows}
        for r in rows:
            if not r["n_children"]:
                r["n_leaves"] = 1
            r["saved_tokens"] += (r["n_convs"] - 1) * r["last_length"]
            up = by_key.get(r["parent_key"])
            r["parent_conv_id"] = up["conv_id"] if up else None
            if up:
                up["n_children"] += 1
                up["n_leaves"] += r["n_leaves"]
                up["saved_tokens"] += r["saved_tokens"]
        return pa.Table.from_pylist([{n: r[n] for n in out.names} for r in rows], schema=out)

    out = pa.schema([*((c, pa.int64()) for c in (*_NODE, "parent_conv_id")), ("key", pa.binary())])
    schema = ", ".join(f"{c} long" for c in (*_NODE, "parent_conv_id")) + ", key binary"
    return merged.groupBy().applyInArrow(add_up, schema)


def _boundary_ends(parts: DataFrame) -> DataFrame:
    """(e_key, ends): digests over the sorted stream of id lists of each boundary node."""
    lists = parts.where("kind = 'ends'").select("key", "place", "ends_sha256")
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            return pa.record_batch([pa.array([now], pa.binary()), pa.array([h.hexdigest()])], names=["e_key", "ends"])

        for b in batches:
            for key, ids in zip(b.column(0), b.column(2)):
                if key.as_py() != now:
                    if now is not None:
                        yield row()
                    now, h = key.as_py(), hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.as_buffer())
        if now is not None:
            yield row()

    return lists.repartition(n, "key").sortWithinPartitions("key", "place").mapInArrow(work, "e_key binary, ends string")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie over rows of (conv_id, ids, lengths), root included: the columns of ``RESULT``."""
    rows = materialize(rows.select("conv_id", "ids", "lengths"), "turn-rows")
    parts = materialize(_sharded(rows), "trie-parts")
    boundary = materialize(_boundary(parts), "trie-boundary")
    ends = _boundary_ends(parts)
    whole = boundary.join(ends, F.col("key") == F.col("e_key"), "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    inner = parts.where("kind = 'node'").select(*RESULT, "parent_key")
    above = boundary.select(F.col("key").alias("a_key"), F.col("conv_id").alias("a_conv_id"))
    inner = inner.join(above, F.col("parent_key") == F.col("a_key"), "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "a_conv_id"))
    return inner.select(*RESULT).unionByName(whole.select(*RESULT))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each with the first turns of the one that leads its hundred."""
    return trie(rebuilt(turn_rows(conversations)))
