"""Capped water-filling: how much of each source a mixture takes, and a seeded sample of whole and part repetitions.

Every source has a weight and may be repeated ``max_epochs`` times at most. The level at which all weights together give
the wanted total is found in closed form: sources are ordered by cap over weight, and those below the level are clamped
at their cap while the others share what is left by weight. Each document is then taken as often as its source is passed
through completely; for the rest of a pass, documents are taken in the order of a seeded hash until the target is met, and
the document on the edge gives its first words only. A source therefore meets its target to the word.

The running sum over a source is never held by one task: sizes are summed by hash bucket first, and only the bucket on the
edge, one of ``BUCKETS`` of a source, is ordered document by document.

Defined results: a NULL text has size 0; a NULL source is a source of its own, ordered last; no documents give no rows; a
source without words has target 0; repeated rows are separate rows, ordered by size where their doc_id is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationloom.llm.text import n_words, packed, unpacked, words
from stationloom.storage import materialize

#: Hash buckets of a source: three hexadecimal digits.
BUCKET_DIGITS = 3
BUCKETS = 16**BUCKET_DIGITS


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), max_epochs: int = 2
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Weights repeat over the sources in code point order, NULL last. All targets together are ``share`` (a fraction) of all
    sizes, and none is above ``max_epochs`` times its source's size.
    """
    # one row per source from here on; the windows over all of them see as many rows as there are sources
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    by_level = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    s = s.withColumns(
        {
            "clamped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "all_sizes": F.sum("source_size").over(everything),
        }
    )
    # the level if this source and all after it are not clamped; the first source it does not clamp has the right one
    num = F.col("all_sizes") * share[0] - F.col("clamped") * share[1]
    s = s.withColumn("level", num / (F.col("weights_left") * share[1]))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level")))
    s = s.withColumn("at", level.over(everything)["level"])
    target = F.when(F.col("at").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("at") * F.col("weight"))
    )
    return s.select("source", "source_size", target.alias("target"))


def _order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """The place of a document in its source; without a doc_id it goes by the text, so that such rows do not share one."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))


def mix(
    docs: DataFrame, seed: int = 7, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), max_epochs: int = 2
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, row): the words that the mixture takes of every row of ``docs``."""
    key = _order_key(F.col("doc_id"), F.col("text"), seed).alias("key")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key)
    sized = materialize(sized, "sizes")
    return _taken(sized, weights, share, max_epochs)


def _taken(sized: DataFrame, weights: Sequence[int], share: tuple[int, int], max_epochs: int) -> DataFrame:
    """Adds source_size, target and taken to rows of (source, size, key); other columns are carried along."""
    targets = source_targets(sized, weights, share, max_epochs)
    goal = F.round("target").cast("long")
    targets = targets.withColumns(
        {
            "passes": F.when(F.col("source_size") > 0, F.floor(goal / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0),
        }
    ).withColumn("rest", goal - F.col("passes") * F.col("source_size"))
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size"))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(upto), F.lit(0)))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "passes", "rest")
    plan = sums.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    # by source: one row for what holds everywhere, with the bucket on the edge and where it starts
    edge = F.max(F.when(F.col("start") <= F.col("rest"), F.struct("bucket", "start")))
    edges = plan.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.first("passes").alias("passes"), F.first("rest").alias("rest"), edge.alias("edge"),
    )
    edges = materialize(edges.withColumnRenamed("source", "e_source"), "mix-edges")
    rows = sized.withColumn("bucket", bucket).join(edges, F.col("source").eqNullSafe(F.col("e_source")))
    on_edge = F.col("bucket") == F.col("edge.bucket")
    inside = W.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    whole = rows.where(~on_edge).withColumn(
        "extra", F.when(F.col("bucket") < F.col("edge.bucket"), F.col("size")).otherwise(F.lit(0))
    )
    before = F.col("edge.start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = rows.where(on_edge).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before)))
    out = whole.unionByName(part).withColumn("taken", (F.col("passes") * F.col("size") + F.col("extra")).cast("long"))
    return out.drop("bucket", "e_source", "passes", "rest", "edge", "extra", "key")


def mixed_documents(docs: DataFrame, seed: int = 7, length: str = "n_chars", **how) -> DataFrame:
    """The mixture itself: every document as often as it is taken, the last time perhaps its first words only.

    Columns as in ``docs``; ``length``, if there is such a column, follows the text.
    """
    text = F.col("doc.text")
    sized = packed(docs).withColumns(
        {"size": n_words(text), "key": _order_key(F.col("doc.doc_id"), text, seed), "source": F.col("doc.source")}
    )
    narrow = materialize(sized.select("source", "size", "key"), "sizes")
    how = {"weights": (5, 2, 1), "share": (3, 2), "max_epochs": 2} | how
    # documents that differ only in text share a key, so they are told apart by size; equal sizes are taken alike
    taken = _taken(narrow.withColumn("k", F.col("key")), **how).groupBy(
        F.col("k").alias("m_key"), F.col("source").alias("m_source"), F.col("size").alias("m_size")
    ).agg(F.count("*").alias("rows"), F.min("taken").alias("least"), F.max("taken").alias("most"), F.sum("taken").alias("sum"))
    mine = (F.col("key") == F.col("m_key")) & F.col("source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size"))
    rows = sized.join(taken, mine)
    # of rows alike in all that, one at most is taken in part, those before it with the most and those after it with the least
    same = W.partitionBy("key", "source", "size").orderBy(F.xxhash64(text))
    gain = F.greatest(F.col("most") - F.col("least"), F.lit(1))
    place, over = F.row_number().over(same), F.col("sum") - F.col("least") * F.col("rows")
    share = F.least(gain, F.greatest(F.lit(0), over - (place - 1) * gain))
    one = rows.where("rows = 1").withColumn("taken", F.col("most"))
    more = rows.where("rows > 1").withColumn("taken", F.col("least") + share)
    rows = one.unionByName(more)
    full = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))).otherwise(0)
    rest = F.col("taken") - full * F.col("size")
    copies = F.concat(
        F.array_repeat(text, full.cast("int")),
        F.when(rest > 0, F.array(F.array_join(F.slice(words(text), 1, rest.cast("int")), " "))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    out = rows.select("doc", F.explode(copies).alias("copy"))
    return unpacked(out, docs, {"text": F.col("copy"), length: F.length("copy").cast("long")})
