"""Near-duplicate documents by circulant MinHash, links confirmed on full shingle sets.

A document is the set of its five-word shingles. Two permutations of the 32-bit numbers give all coordinates of its
signature: the first scatters the shingles, the second, shifted circularly by ``k``, gives coordinate ``k`` as a minimum.
Coordinates are banded; documents that share a band are candidates, and a link is set only by the exact Jaccard
similarity of two full sets. With 32 bands of 4, a pair at the threshold itself meets in some band but for a chance of 5e-6.

No bucket of candidates is paired with itself:

1. Copies with the same words are one vertex (their smallest doc_id) from the start.
2. Every bucket is a star. Its centre is the member whose buckets are largest, in a family of copies one near the
   original; every other member is compared with the centres of its buckets.
3. Components of the links found so far settle every bucket whose members have one component.
4. In the others, gathered by centre, a member stays open only if at least three quarters of its shingles occur in some
   other member there; without that no link is possible. This drops copies with many changes of their own, exactly.
5. What is still open is compared in blocks: members of a centre's largest component with the others, and the others with
   each other, block against block, without the pairs being written as rows. No candidate is left out.

Defined results: documents without words or text have an empty set, are linked with nothing and kept; fewer than five words
are one shingle; rows without a doc_id are linked with nothing and kept, with a NULL component; rows that repeat a doc_id
are one vertex; an empty table gives an empty result. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationloom.llm.components import components
from stationloom.llm.text import packed, unpacked
from stationloom.storage import materialize

SHINGLE = 5
BANDS = 32
ROWS = 4
#: A link needs ``NUM * union <= DEN * intersection``.
NUM, DEN = 3, 4
#: Members of a block in the exact comparison of what the stars leave open.
BLOCK = 256

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return x ^ (x >> np.uint32(15))


def _shifted(x: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The second permutation, shifted circularly by each of ``shifts``: a row per shift."""
    y = x[None, :] - shifts[:, None]
    y ^= y >> np.uint32(16)
    y *= np.uint32(0x7FEB352D)
    y ^= y >> np.uint32(15)
    y *= np.uint32(0x846CA68B)
    y ^= y >> np.uint32(16)
    return y


def text_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; bytes split exactly at the six ASCII white space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = _mix64((out * _M1) ^ h[j : j + n])
    return np.unique(out)


def band_keys(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, of the circulant signature."""
    x = _scatter((shingles >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(bands * rows, dtype=np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, _shifted(x[i : i + 512], shifts).min(1), out=least)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        keys = _mix64((keys * _M1) ^ column.astype(np.uint64))
    return keys.astype(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, words_key, n_shingles, bands) of every row; no key and bands for texts without words."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                words = text_words(text)
                s = shingle_set(words)
                key = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
                found.append((key, len(s), band_keys(s) if words else None))
            out = pd.DataFrame(found, columns=["words_key", "n_shingles", "bands"])
            out.insert(0, "doc_id", pd.array([None if pd.isna(d) else int(d) for d in batch["doc_id"]], dtype="Int64"))
            yield out

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(sign, "doc_id long, words_key binary, n_shingles long, bands array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, set) of the documents named in ``ids``."""

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text_words(t)).astype(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"].astype("int64"), "set": sets})

    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi")
    return rows.mapInPandas(collect, "id long, set array<long>")


def _similar(n_a, n_b, both):
    return DEN * both >= NUM * (n_a + n_b - both)


def _star_links(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, centre) of every bucket, and the links (a, b) between members and centres."""
    weight = members.groupBy("id").agg(F.sum("size").alias("weight"))
    ranked = members.join(weight, "id")
    best = F.max(F.struct("weight", (-F.col("id")).alias("minus_id")))
    centres = ranked.groupBy("bucket").agg((-best["minus_id"]).alias("centre"))
    centres = materialize(centres, "centres")
    pairs = members.join(centres, "bucket").where("id <> centre").select("centre", "id").distinct()
    a = sets.select("id", F.col("set").alias("a"))
    b = sets.select(F.col("id").alias("centre"), F.col("set").alias("b"))
    both = pairs.join(a, "id").join(b, "centre")
    # as only a fitting size can reach the threshold, the others are not intersected
    n_a, n_b = F.size("a"), F.size("b")
    fits = (DEN * n_a >= NUM * n_b) & (DEN * n_b >= NUM * n_a)
    hit = both.where(fits).where(_similar(n_a, n_b, F.size(F.array_intersect("a", "b"))))
    return centres, hit.select(F.col("id").alias("a"), F.col("centre").alias("b"))


def _open_members(members: DataFrame, centres: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(centre, id, label) of members that may have a link which the stars did not show."""
    own = members.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id"))
    own = materialize(own.select("id", "bucket", "label"), "labelled")
    mixed = own.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    left = own.join(mixed.select("bucket"), "bucket").join(centres, "bucket").select("centre", "id", "label").distinct()
    left = materialize(left, "open-members")
    # a shingle that one member of the centre has alone cannot be part of a link
    each = left.join(sets, "id").select("centre", "id", F.size("set").alias("n"), F.explode("set").alias("shingle"))
    alone = each.groupBy("centre", "shingle").agg(F.count("*").alias("k"), F.first("id").alias("id"), F.first("n").alias("n"))
    alone = alone.where("k = 1").groupBy("centre", "id").agg(F.count("*").alias("alone"), F.first("n").alias("n"))
    hopeless = alone.where(DEN * (F.col("n") - F.col("alone")) < NUM * F.col("n")).select("centre", "id")
    return materialize(left.join(hopeless, ["centre", "id"], "left_anti"), "still-open")


def _block_links(still: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of different labels, by comparing blocks with blocks."""
    sizes = still.groupBy("centre", "label").agg(F.count("*").alias("k"))
    main = sizes.groupBy("centre").agg(
        F.max(F.struct("k", "label")).alias("main"), F.sum("k").alias("all"), F.count("*").alias("labels")
    ).where("labels > 1").select(
        "centre", F.col("main.label").alias("main"),
        F.ceil(F.col("main.k") / BLOCK).alias("m_blocks"), F.ceil((F.col("all") - F.col("main.k")) / BLOCK).alias("o_blocks"),
    )
    # stored, so that the join is not tied to the partitions of the counts and a large centre can be split
    rows = still.join(materialize(main, "open-centres"), "centre")
    is_main = F.col("label") == F.col("main")
    block = F.pmod(F.xxhash64("id"), F.when(is_main, F.col("m_blocks")).otherwise(F.col("o_blocks")))
    rows = rows.withColumn("block", block).withColumn("is_main", is_main)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    with_others = F.transform(upto(F.col("o_blocks")), lambda j: F.struct(F.lit(True).alias("m"), F.col("block").alias("i"), j.alias("j")))
    with_main = F.transform(upto(F.col("m_blocks")), lambda i: F.struct(F.lit(True).alias("m"), i.alias("i"), F.col("block").alias("j")))
    among = F.transform(
        upto(F.col("o_blocks")),
        lambda j: F.struct(F.lit(False).alias("m"), F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")),
    )
    to = F.when(F.col("is_main"), with_others).otherwise(F.concat(with_main, among))
    dealt = rows.select("centre", "id", "label", "is_main", F.explode(to).alias("to")).join(sets, "id")
    dealt = dealt.select("centre", "to.*", "id", "label", "is_main", "set")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        hits = _links_in_block(part["id"].to_numpy(), part["label"].to_numpy(), list(part["set"]))
        return pd.DataFrame(hits, columns=["a", "b"]).astype("int64")

    return dealt.groupBy("centre", "m", "i", "j").applyInPandas(compare, "a long, b long")


def _links_in_block(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between members of a block whose labels differ, by exact intersection counts."""
    n, sizes = len(ids), np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets) if n else np.zeros(0, np.int64), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both, step = np.zeros((n, n), np.float64), 2048
    for c in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(column, [c, c + step])
        dense = np.zeros((n, step), np.float32)
        dense[owner[lo:hi], column[lo:hi] - c] = 1
        both += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - both
    link = (DEN * both >= NUM * union) & (labels[:, None] != labels[None, :])
    a, b = np.nonzero(np.triu(link, 1))
    return list(zip(ids[a].tolist(), ids[b].tolist()))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    signed = materialize(signatures(docs), "signatures")
    worded = signed.where("doc_id is not null and words_key is not null")
    same = materialize(worded.groupBy("words_key").agg(F.min("doc_id").alias("id")), "same-words")
    # a vertex per distinct sequence of words
    vertex = worded.join(same.withColumnRenamed("words_key", "k"), (F.col("words_key") == F.col("k")) & (F.col("doc_id") == F.col("id")))
    each = vertex.select("id", F.explode("bands").alias("bucket")).distinct()
    buckets = materialize(each.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = materialize(each.join(buckets, "bucket"), "members")
    sets = materialize(shingle_sets(docs, members.select("id").distinct()), "shingle-sets")
    centres, links = _star_links(members, sets)
    links = materialize(links, "star-links")
    labels = materialize(components(links), "labels")
    still = _open_members(members, centres, labels, sets)
    rest = materialize(_block_links(still, sets), "block-links")
    labels = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
    # rows with one doc_id and different words are one document: their sequences are linked through it
    both = worded.groupBy("doc_id").agg(F.min("words_key").alias("x"), F.max("words_key").alias("y")).where("x <> y").select("doc_id")
    through = worded.select("doc_id", "words_key").distinct().join(both, "doc_id").join(same, "words_key")
    through = through.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b")
    final = materialize(components(labels.unionByName(rest).unionByName(through)), "final-labels")
    named = same.join(final, "id", "left").select(F.col("words_key").alias("k"), F.coalesce("component", "id").alias("component_id"))
    out = signed.join(named, F.col("words_key") == F.col("k"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every group of near copies: that of the smallest doc_id, of its texts one.

    Here a document is a doc_id with a text, so that no text goes that nothing which stays is a copy of, also where rows of
    one doc_id have different texts. Rows without a doc_id stay.
    """
    rows = packed(docs).withColumn("id", F.xxhash64(F.col("doc.doc_id"), F.coalesce("doc.text", F.lit(""))))
    named = rows.where("doc.doc_id IS NOT NULL")
    found = near_duplicates(named.select(F.col("id").alias("doc_id"), F.col("doc.text").alias("text")))
    found = found.select(F.col("doc_id").alias("f_id"), "component_id").distinct()
    ids = named.select("id", F.col("doc.doc_id").alias("doc_id")).distinct()
    best = F.min(F.struct("doc_id", "id"))["id"].alias("kept_id")
    kept = ids.join(found, F.col("id") == F.col("f_id")).groupBy("component_id").agg(best)
    kept = materialize(kept.select("kept_id"), "kept")
    one = named.join(kept, F.col("id") == F.col("kept_id"), "left_semi").dropDuplicates(["id"])
    return unpacked(one.unionByName(rows.where("doc.doc_id IS NULL")), docs)
