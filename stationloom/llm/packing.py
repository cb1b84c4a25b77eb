"""Harmonic packing of token sequences into bins of a fixed capacity.

Lengths fall into classes by reciprocals of the capacity: class ``k`` holds pieces of which ``k`` fit a bin, and a bin of
class ``k`` gets exactly ``k`` of them. Documents are cut into pieces of exactly ``capacity // k`` ids, each the largest
that fits what is left, down to a tail of at most ``TAIL`` ids, which goes whole into the class of its own length. Every
bin is then full but for the rest of that division (``capacity % k`` ids or fewer, below 1.6 %).

Each task fills the bins of every class by itself, counting as it goes. What is left over in a task (fewer than ``k``
pieces a class) is numbered across tasks from the tasks' counts alone and fills further bins of the class; pieces that
remain even then are fewer than ``k`` a class whatever the input, and first-fit decreasing packs this rest.

Sequence ids are unique, not dense: stage, task, class and bin are packed into one long.

Defined results: a NULL text has no ids but the end id; no documents give no pieces; rows with one doc_id (or none) are
packed apart, each with its own pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationloom.llm.shared_files import partition_number
from stationloom.llm.tokens import encoder, with_end
from stationloom.storage import materialize

CAPACITY = 4096
TAIL = 64
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, worker long, slot long, offset long"
)
_RESULT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def cuts(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[tuple[int, int]]:
    """(length, class) of the pieces of ``n`` ids, in order."""
    out = []
    while n > tail:
        k = -(-capacity // n)
        out.append((capacity // k, k))
        n -= capacity // k
    if n:
        out.append((n, capacity // n))
    return out


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents: class, the task that made them, and the place among its pieces of that class."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_all, worker = encoder(tokenizer_path).encode_all, partition_number()
        slots: dict[int, int] = {}
        filled: dict[int, int] = {}
        for batch in batches:
            found = []
            for doc_id, found_ids in zip(batch["doc_id"], encode_all(batch["text"])):
                ids = with_end(found_ids, end_id)
                raw, at = ids.tobytes(), 0
                for n, k in cuts(len(ids), capacity):
                    slot = slots.get(k, 0)
                    offset = filled.get(k, 0) if slot % k else 0
                    slots[k], filled[k] = slot + 1, offset + n
                    crc = zlib.crc32(raw[4 * at : 4 * (at + n)])
                    found.append((doc_id, at, n, crc, len(ids), k, worker, slot, offset))
                    at += n
            out = pd.DataFrame(found, columns=[x.split()[0] for x in PIECE_SCHEMA.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return rows.mapInPandas(pieces, PIECE_SCHEMA)


def _sequence(stage: int, worker, k, bin_) -> F.Column:
    """2 bits of stage, 20 of task, 13 of class, 28 of bin."""
    return F.lit(stage << 61) + F.shiftleft(worker.cast("long"), 41) + F.shiftleft(k.cast("long"), 28) + bin_


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every piece and its place."""
    pieces = materialize(tokenized_pieces(docs, tokenizer_path, end_id, capacity), "pieces")
    k = F.col("k")
    # full bins of a task: all but the last slots % k pieces of a class
    counts = pieces.groupBy("worker", "k").agg(F.count("*").alias("n"))
    order = W.partitionBy("k").orderBy("worker").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("left", F.col("n") % k).withColumn("full", F.col("n") - F.col("left"))
    counts = materialize(
        counts.withColumns(
            {
                "before": F.coalesce(F.sum("left").over(order), F.lit(0)),
                "all_left": F.sum("left").over(W.partitionBy("k")),
            }
        ),
        "piece-counts",
    ).select(F.col("worker").alias("c_worker"), F.col("k").alias("c_k"), "full", "before", "all_left")
    rows = pieces.join(counts, (F.col("worker") == F.col("c_worker")) & (k == F.col("c_k")))
    own = rows.where(F.col("slot") < F.col("full")).withColumn(
        "sequence_id", _sequence(0, F.col("worker"), k, F.floor(F.col("slot") / k))
    )
    over = rows.where(F.col("slot") >= F.col("full")).withColumn("i", F.col("before") + F.col("slot") - F.col("full"))
    over = over.withColumn("bin", F.floor(F.col("i") / k))
    shared = over.where(F.col("bin") < F.floor(F.col("all_left") / k))
    inside = W.partitionBy("k", "bin").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    shared = shared.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).withColumn(
        "sequence_id", _sequence(1, F.lit(0), k, F.col("bin"))
    )
    # fewer than k pieces of each class: at most a few ten thousand rows for any input
    rest = over.where(F.col("bin") >= F.floor(F.col("all_left") / k))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def first_fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "k", "i"], ascending=[False, True, True])
        room: list[int] = []
        places = []
        first_open = 0
        for n in part["length"].tolist():
            b = next((b for b in range(first_open, len(room)) if room[b] >= n), len(room))
            if b == len(room):
                room.append(capacity)
            places.append((b, capacity - room[b]))
            room[b] -= n
            while first_open < len(room) and not room[first_open]:
                first_open += 1
        part["sequence_id"] = [(2 << 61) - (1 << 60) + b for b, _ in places]
        part["offset"] = [o for _, o in places]
        out = part[list(_RESULT)].copy()
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    last = rest.select(*[c for c in _RESULT if c not in ("sequence_id", "offset")], "k", "i").groupBy().applyInPandas(
        first_fit, schema
    )
    return own.select(*_RESULT).unionByName(shared.select(*_RESULT)).unionByName(last)
