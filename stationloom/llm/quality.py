"""Cross-document line frequency: which lines many documents of a host share, and what is left without them.

A document's lines are normalised (lower case, digit runs as 0, white space as one space) and hashed. For each host the
distinct documents with a line are counted. A line found in more than ``max_documents`` documents of a host, or in more than
``max_share`` of them and more than ``min_documents``, is over the limits, so hosts of any size are judged alike; it is
removed from every document of that host but the one with the smallest doc_id of those with a row that has the line and passes
the base rules, so that of many copies of a text one stays whole. A document left with less than ``min_left`` of its
words is depleted and rejected.

``quality_rules`` judges by that rule alone, as its SQL does. ``clean_documents`` makes the corpus, so there a rejected document
keeps nothing: a line stays with the smallest doc_id that passes the base rules, and goes to another document where that one
is depleted (see ``kept_lines``).

Everything is built-in SQL functions. The text is read once, into a stored table of line hashes (some bytes a line), which
the count and the look-up read. Counting aggregates before it shuffles, so a line in a third of all documents costs one row
a task; the look-up joins the few lines over the limits, whose stored size lets Spark choose broadcast or a skew-split
sort merge join.

Defined results: a NULL text has no words (and fails the base rules); an empty table gives an empty result; rows with the
same doc_id count as one document and all stay in the result; rows without a doc_id count as one document; a NULL host is
a host of its own; columns other than those named are ignored. 64-bit hashes stand for lines and five-word windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.llm.text import WHITE, let, packed, unpacked, words
from stationloom.storage import materialize

SYMBOLS = "#*$%&|<>"
_NO_ID = -(2**63)


@dataclass(frozen=True)
class LineLimits:
    """When a line is over the limits, and when a document is depleted."""

    max_share: float = 0.05
    max_documents: int = 20
    min_left: float = 0.3
    min_documents: int = 5


def normalised_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def _n_repeat_words(w: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the text, the first occurrence included."""

    def covered(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def twin(k: Column) -> Column:
                h = F.get(s, k)["h"]
                same = lambda j: F.coalesce(F.get(s, j)["h"] == h, F.lit(False))
                return same(k - 1) | same(k + 1)

            hits = F.filter(F.transform(s, lambda x, k: F.when(twin(k), x["i"])), lambda i: i.isNotNull())
            return F.sort_array(hits)

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda i, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - i, F.lit(5))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(pairs, starts), total)

    def repeats(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(covered(grams))

    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - 4), lambda i: F.xxhash64(F.slice(w, i, 5)))
        return F.when(F.size(w) < 5, F.lit(0)).otherwise(let(grams, repeats))

    return let(w, of).cast("long")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """A row per document: base counts, and the hashes and word counts of its lines in order."""
    t = F.coalesce(F.col(text), F.lit(""))
    one = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), t.alias("text"))
    one = one.withColumns({"w": words(F.col("text")), "raw": F.split("text", "\n")})
    has_word = lambda x: F.length(_without(x, WHITE)) > 0
    one = one.withColumn("lines", F.filter("raw", has_word))
    norm = F.transform("lines", normalised_line)
    hashed = lambda line: F.struct(
        F.xxhash64(line).alias("h"), (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).alias("n")
    )
    return one.select(
        "doc_id", "host", F.xxhash64("text").alias("text_key"), F.size("w").cast("long").alias("n_words"),
        F.length(_without(F.col("text"), WHITE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _n_repeat_words(F.col("w")).alias("n_repeat_words"),
        F.transform(norm, hashed).alias("lines"),
    )


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def frequent_lines(lines: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """(host, h, first_id): the lines over the limits and the document that keeps each, NULL if all of them fail the base rules."""
    key = F.coalesce(F.col("doc_id"), F.lit(_NO_ID))
    each = lines.select(
        key.alias("id"), F.when(~_base_failed(), key).alias("keeper"), "host",
        F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"),
    )
    counts = each.groupBy("host", "h").agg(F.count_distinct("id").alias("n"), F.min("keeper").alias("first_id"))
    hosts = lines.groupBy("host").agg(F.count_distinct(key).alias("documents")).withColumnRenamed("host", "of")
    many = counts.where(F.col("n") > min(limits.max_documents, limits.min_documents))
    over = many.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    share = (F.col("n") > limits.min_documents) & (F.col("n") > F.lit(limits.max_share) * F.col("documents"))
    return over.where((F.col("n") > limits.max_documents) | share).select("host", "h", "first_id")


def removed_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(id, removed): by document, the hashes of the lines it loses."""
    key = F.coalesce(F.col("doc_id"), F.lit(_NO_ID))
    each = lines.select(
        key.alias("id"), "host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h")
    )
    f = frequent.select(F.col("host").alias("f_host"), F.col("h").alias("f_h"), "first_id")
    hit = (F.col("h") == F.col("f_h")) & F.col("host").eqNullSafe(F.col("f_host")) & (F.col("id") != F.col("first_id"))
    return each.join(f, hit).groupBy("id").agg(F.collect_set("h").alias("removed"))


def kept_lines(lines: DataFrame, frequent: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """(id, text_key, host, n_words, h, w, keeper): the lines over the limits in rows that pass the base rules.

    ``w`` are the words of all copies of the line in the row, ``keeper`` is the id that keeps it. First that is the smallest id.
    Where it is depleted, the line goes to the smallest id of a row that stays. Lines that no row has that stays are given, all
    at once, to rejected rows that stay with them, those with most words of such lines first, until there are no such rows.
    """
    row = ["id", "text_key", "host", "n_words"]
    each = lines.where(~_base_failed()).withColumn("id", F.coalesce(F.col("doc_id"), F.lit(_NO_ID)))
    each = each.select(*row, F.posexplode("lines").alias("at", "x")).select(*row, "at", "x.*")
    f = frequent.select(F.col("host").alias("f_host"), F.col("h").alias("f_h"))
    each = each.join(f, (F.col("h") == F.col("f_h")) & F.col("host").eqNullSafe(F.col("f_host"))).drop("f_host", "f_h")
    # rows that are the same in all count once
    found = each.groupBy(*row, "h").agg((F.count_distinct("at") * F.max("n")).alias("w"))
    found = materialize(found, "frequent-in-rows")

    def with_keeper(found: DataFrame, keepers: DataFrame) -> DataFrame:
        k = keepers.withColumnsRenamed({"host": "k_host", "h": "k_h"})
        same = (F.col("h") == F.col("k_h")) & F.col("host").eqNullSafe(F.col("k_host"))
        return found.drop("keeper").join(k, same).drop("k_host", "k_h")

    def with_rows(found: DataFrame, *sums: Column) -> DataFrame:
        r = found.groupBy(*row).agg(*sums).withColumnsRenamed({"id": "r_id", "text_key": "r_key", "host": "r_host"}).drop("n_words")
        same = (F.col("id") == F.col("r_id")) & (F.col("text_key") == F.col("r_key")) & F.col("host").eqNullSafe(F.col("r_host"))
        return found.join(r, same).drop("r_id", "r_key", "r_host")

    own = F.coalesce(F.col("keeper") == F.col("id"), F.lit(False))
    words_of = lambda which: F.sum(F.when(which, F.col("w")).otherwise(0))
    stays = lambda lost: F.col("n_words") - F.col(lost) >= F.lit(limits.min_left) * F.col("n_words")
    first = found.groupBy("host", "h").agg(F.min("id").alias("keeper"))
    found = materialize(with_keeper(found, first), "kept-lines")
    while True:
        now = with_rows(found, words_of(~own).alias("lost")).withColumn("stays", stays("lost"))
        here = F.min(F.when(F.col("stays") & own, F.col("id")))
        next_ = now.groupBy("host", "h").agg(F.coalesce(here, F.min(F.when(F.col("stays"), F.col("id")))).alias("keeper"))
        found = materialize(with_keeper(found, next_), "kept-lines")
        free = F.col("keeper").isNull()
        saved = with_rows(found, words_of(~own & ~free).alias("lost"), words_of(free).alias("gain")).where(free & stays("lost"))
        best = F.min(F.struct((-F.col("gain")).alias("gain"), "id"))["id"]
        saved = materialize(saved.groupBy("host", "h").agg(best.alias("saver")), "saved-lines")
        if saved.isEmpty():
            return found
        s = saved.withColumnsRenamed({"host": "s_host", "h": "s_h"})
        same = (F.col("h") == F.col("s_h")) & F.col("host").eqNullSafe(F.col("s_host"))
        found = found.join(s, same, "left").withColumn("keeper", F.coalesce("keeper", "saver")).drop("s_host", "s_h", "saver")
        found = materialize(found, "kept-lines")


def judged(lines: DataFrame, removed: DataFrame, limits: LineLimits) -> DataFrame:
    """The base counts with ``removed`` hashes, ``removed_words``, ``base_failed`` and ``kept``."""
    found = lines.withColumn("id", F.coalesce(F.col("doc_id"), F.lit(_NO_ID))).join(removed, "id", "left")
    lost = F.filter("lines", lambda x: F.array_contains(F.col("removed"), x["h"]))
    n_lost = F.when(F.col("removed").isNull(), F.lit(0)).otherwise(
        F.aggregate(lost, F.lit(0), lambda a, x: a + x["n"])
    )
    failed = _base_failed()
    left = F.col("n_words") - F.col("removed_words")
    return found.withColumn("removed_words", n_lost.cast("long")).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (left >= F.lit(limits.min_left) * F.col("n_words"))
    )


def _stored(docs: DataFrame, limits: LineLimits, **names: str) -> tuple[DataFrame, DataFrame]:
    lines = materialize(line_table(docs, **names), "lines")
    return lines, materialize(frequent_lines(lines, limits), "frequent-lines")


def quality_rules(docs: DataFrame, limits: LineLimits = LineLimits(), **names: str) -> DataFrame:
    """The verdict on every row of ``docs``: counts, ``base_failed``, ``removed_words`` and ``kept``.

    ``names`` may give other column names for ``doc_id``, ``text`` and ``host``.
    """
    lines, frequent = _stored(docs, limits, **names)
    return judged(lines, removed_lines(lines, frequent), limits).drop("id", "text_key", "lines", "removed")


def clean_documents(docs: DataFrame, limits: LineLimits = LineLimits(), length: str = "n_chars") -> DataFrame:
    """The kept documents, all their columns, with the lines over the limits taken out of ``text``.

    ``length``, if there is such a column, is set to the code points of what is left.
    """
    lines, frequent = _stored(docs, limits)
    # rows with one doc_id may have different texts, so a verdict goes by both
    row = ["id", "text_key", "host"]
    lost = kept_lines(lines, frequent, limits).where(F.col("keeper").isNull() | (F.col("keeper") != F.col("id")))
    lost = lost.groupBy(*row).agg(F.sum("w").alias("lost"), F.collect_set("h").alias("removed"))
    lost = lost.withColumnsRenamed({"id": "l_id", "text_key": "l_key", "host": "l_host"})
    same = (F.col("id") == F.col("l_id")) & (F.col("text_key") == F.col("l_key")) & F.col("host").eqNullSafe(F.col("l_host"))
    rows = lines.where(~_base_failed()).select(F.coalesce(F.col("doc_id"), F.lit(_NO_ID)).alias("id"), "text_key", "host", "n_words")
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    verdict = rows.distinct().join(lost, same, "left").where(left >= F.lit(limits.min_left) * F.col("n_words")).select(
        "id", "text_key", "host", "removed"
    )
    id_ = F.coalesce(F.col("doc.doc_id"), F.lit(_NO_ID))
    key = F.xxhash64(F.coalesce(F.col("doc.text"), F.lit("")))
    of_row = (id_ == F.col("id")) & (key == F.col("text_key")) & F.col("doc.source").eqNullSafe(F.col("host"))
    out = packed(docs).join(verdict, of_row)
    stays = F.filter(
        F.split("doc.text", "\n"), lambda x: ~F.array_contains(F.col("removed"), F.xxhash64(normalised_line(x)))
    )
    out = out.withColumn("left", F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.array_join(stays, "\n")))
    changed = {"text": F.col("left")}
    if length in docs.columns:
        changed[length] = F.when(F.col("removed").isNull(), F.col("doc")[length]).otherwise(F.length("left").cast("long"))
    return unpacked(out, docs, changed)
