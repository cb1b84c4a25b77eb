"""Token ids in files of directly addressable codes.

An id is cut into chunks of some bits, lowest first. Level 0 holds the first chunk of every id, level 1 the second chunk
of those ids that need one, and so on. A bitmap per level says which ids go on, and a rank directory holds the number of
ones before every block of 512 bits, so the place of id ``i`` on the next level is one directory entry and the bits of one
block away. Any id of a file is read by its place: a few bytes per level, no block of ids is decoded. Chunk widths are
chosen per file from its ids so that the file is smallest.

File layout, little-endian: header of unsigned 64-bit integers (magic, documents, ids, levels, then per level its width,
number of chunks and the offsets of chunks, bitmap and directory, then the offset of the index), the sections, and the index (doc_id as
int64, NULL flag as a byte, number of ids as uint32 per document). The last level has neither bitmap nor directory.

Writing sorts documents by range over tasks; each task writes files of at most ``ids_per_file`` ids, but for a document
that is longer. The returned table lists the files of successful attempts with the number of ids before each, from sums per
partition, so a repeated attempt leaves a file that nothing names. Documents without text have no ids but the end id;
documents without doc_id come first; rows with one doc_id come in the order of a hash of their text.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationloom.llm.shared_files import attempt_name, open_fs, partition_number, write_file
from stationloom.llm.tokens import encoder, with_end
from stationloom.storage import materialize, scratch_path

MAGIC = int.from_bytes(b"ADDRCODE", "little")
BLOCK = 512
MAX_LEVELS = 3
IDS_PER_FILE = 1 << 21
FILE_SCHEMA = "part int, seq int, path string, n_docs long, n_ids long"


# --- one file --------------------------------------------------------------------------------------


def chunk_widths(ids: np.ndarray) -> list[int]:
    """Bits of each level so that chunks and bitmaps take least room."""
    if not len(ids):
        return [1]
    _, bits = np.frexp(ids.astype(np.float64))
    counts = np.bincount(np.maximum(bits, 1), minlength=33)
    longest = int(np.nonzero(counts)[0][-1])
    over = counts.sum() - np.cumsum(counts)  # over[b]: ids of more than b bits

    def room(cuts: tuple[int, ...]) -> int:
        at = (0, *cuts, longest)
        each = [len(ids), *(int(over[c]) for c in cuts)]
        last = len(each) - 1
        return sum(n * (at[i + 1] - at[i] + (i < last)) for i, n in enumerate(each))

    best = min((c for k in range(MAX_LEVELS) for c in combinations(range(1, longest), k)), key=room)
    at = (0, *best, longest)
    return [b - a for a, b in zip(at, at[1:])]


def _pack(values: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    out, step = [], 1 << 16  # a multiple of 8 values fills whole bytes
    shifts = np.arange(width, dtype=np.uint32)
    for i in range(0, len(values), step):
        bits = (values[i : i + step, None] >> shifts) & np.uint32(1)
        out.append(np.packbits(bits.astype(np.uint8), bitorder="little").tobytes())
    return b"".join(out)


def _unpack(data: memoryview, width: int, n: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=n).astype(np.uint32)
    out, step = np.zeros(n, dtype=np.uint32), 1 << 16
    raw = np.frombuffer(data, dtype=np.uint8)
    for i in range(0, n, step):
        m = min(step, n - i)
        part = raw[i * width // 8 : (i * width + m * width + 7) // 8]
        bits = np.unpackbits(part, bitorder="little", count=m * width).reshape(m, width)
        for k in range(width):
            out[i : i + m] |= bits[:, k].astype(np.uint32) << np.uint32(k)
    return out


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> list[bytes]:
    """The bytes of one file, in parts."""
    widths, rest, levels, sections = chunk_widths(ids), ids.astype(np.uint32), [], []
    at = 8 * (4 + 5 * len(widths) + 1)

    def put(data: bytes) -> int:
        nonlocal at
        sections.append(data)
        at += len(data)
        return at - len(data)

    for k, width in enumerate(widths):
        chunk = rest & np.uint32((1 << width) - 1)
        where = put(_pack(chunk, width))
        bitmap = directory = 0
        n = len(rest)
        if k < len(widths) - 1:
            rest = rest >> np.uint32(width)
            goes_on = rest > 0
            packed = np.packbits(goes_on, bitorder="little")
            ones = np.add.reduceat(goes_on, np.arange(0, n, BLOCK), dtype=np.int64) if n else np.zeros(0, np.int64)
            bitmap = put(packed.tobytes())
            directory = put(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4").tobytes() if n else b"")
            rest = rest[goes_on]
        levels += [width, n, where, bitmap, directory]
    index = at
    sections.append(np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes())
    sections.append(np.array([d is None for d in doc_ids], dtype="u1").tobytes())
    sections.append(np.array(lengths, dtype="<u4").tobytes())
    head = struct.pack(f"<{4 + len(levels) + 1}Q", MAGIC, len(doc_ids), len(ids), len(widths), *levels, index)
    return [head, *sections]


class CodeFile:
    """Reads one file: single ids by place, the index of documents, or everything."""

    def __init__(self, path: str):
        system, at = open_fs(path)
        self._file = system.open_input_file(at)
        magic, self.n_docs, self.n_ids, n = struct.unpack("<4Q", self._read(0, 32))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a file of directly addressable codes")
        *flat, self._index = struct.unpack(f"<{5 * n + 1}Q", self._read(32, 8 * (5 * n + 1)))
        self.levels = [tuple(flat[5 * i : 5 * i + 5]) for i in range(n)]

    def _read(self, at: int, n: int) -> bytes:
        self._file.seek(at)
        return self._file.read(n)

    def close(self) -> None:
        self._file.close()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for k, (width, _, chunks, bitmap, directory) in enumerate(self.levels):
            bit = i * width
            raw = int.from_bytes(self._read(chunks + bit // 8, (bit % 8 + width + 7) // 8), "little")
            value |= (raw >> (bit % 8) & ((1 << width) - 1)) << shift
            shift += width
            if k == len(self.levels) - 1:
                break
            block = i // BLOCK
            bits = int.from_bytes(self._read(bitmap + block * (BLOCK // 8), BLOCK // 8), "little")
            inside = i % BLOCK
            if not bits >> inside & 1:
                break
            (before,) = struct.unpack("<I", self._read(directory + 4 * block, 4))
            i = before + (bits & ((1 << inside) - 1)).bit_count()
        return value

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        raw = self._read(self._index, 13 * self.n_docs)
        ids = np.frombuffer(raw, "<i8", self.n_docs)
        null = np.frombuffer(raw, "u1", self.n_docs, 8 * self.n_docs)
        lengths = np.frombuffer(raw, "<u4", self.n_docs, 9 * self.n_docs)
        return [None if x else int(d) for d, x in zip(ids, null)], lengths

    def all_ids(self) -> np.ndarray:
        values, place, shift = np.zeros(self.n_ids, dtype=np.uint32), None, 0
        for k, (width, n, chunks, bitmap, _) in enumerate(self.levels):
            part = _unpack(memoryview(self._read(chunks, (n * width + 7) // 8)), width, n) << np.uint32(shift)
            if place is None:
                values |= part
            else:
                values[place] |= part
            shift += width
            if k < len(self.levels) - 1:
                bits = np.unpackbits(np.frombuffer(self._read(bitmap, (n + 7) // 8), np.uint8), bitorder="little", count=n)
                on = np.nonzero(bits)[0]
                place = on if place is None else place[on]
        return values


# --- tables of files ---------------------------------------------------------------------------------


def write_codes(
    docs: DataFrame, tokenizer_path: str, end_id: int, ids_per_file: int = IDS_PER_FILE, folder: str | None = None
) -> DataFrame:
    """Encode ``text`` of every row and write files in ascending ``doc_id`` order.

    Returns (part, seq, path, n_docs, n_ids, start): the files in order, with the number of ids before each.
    """
    folder = folder or scratch_path(docs.sparkSession, "codes")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_all, seq = encoder(tokenizer_path).encode_all, 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pd.DataFrame:
            nonlocal seq, held
            data = encode_file(doc_ids, [len(p) for p in parts], np.concatenate(parts))
            path = write_file(folder, f"{attempt_name()}-{seq:06d}.codes", data)
            row = (partition_number(), seq, path, len(doc_ids), held)
            seq, held = seq + 1, 0
            doc_ids.clear()
            parts.clear()
            return pd.DataFrame([row], columns=["part", "seq", "path", "n_docs", "n_ids"])

        for batch in batches:
            for key, found in zip(batch["doc_id"].tolist(), encode_all(batch["text"].tolist())):
                ids = with_end(found, end_id)
                if held and held + len(ids) > ids_per_file:
                    yield flush()
                doc_ids.append(None if pd.isna(key) else int(key))
                parts.append(ids)
                held += len(ids)
        if doc_ids:
            yield flush()

    files = materialize(rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(write, FILE_SCHEMA), "code-files")
    # as many rows as partitions go through one window, then the files of a partition through another
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return files.join(parts, "part").withColumn("start", start).drop("part_start")


def read_codes(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the files, ids as little-endian unsigned 32-bit integers."""
    schema = "doc_id long, start long, n_tokens long, ids binary"
    return _per_document(spark, files, schema, lambda x: x)


def documents_in_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), from the files."""
    return _per_document(spark, files, "doc_id long, start long, n_tokens long, ids_crc32 long", zlib.crc32)


def _per_document(spark: SparkSession, files: DataFrame, schema: str, of) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]
    # a given number of partitions, as the size of this table says nothing about the work in its rows
    spread = files.select("path", "start").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                f = CodeFile(path)
                doc_ids, lengths = f.documents()
                raw = f.all_ids().astype("<u4").tobytes()
                f.close()
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                last = [of(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [pd.array(doc_ids, dtype="Int64"), begins + int(start), lengths.astype("int64"), last]
                yield pd.DataFrame(dict(zip(names, columns)))

    return spread.mapInPandas(read, schema)
