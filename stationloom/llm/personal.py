"""Personal data in texts: fixed patterns, and identifiers found through the phrases that stand before known ones.

The fixed patterns give e-mail addresses, IP addresses, card numbers and phone numbers. Those are the seeds of the second
part. An *identifier* is a run of letters, digits and ``@._%+/#-`` with an ``@`` or three digits, of at least five characters
(or groups of digits, or a phone number with its brackets); its *phrases* are the one and the two words before it, lower
case, up to the identifier before. The graph of phrases and identifiers is scored in ``ROUNDS`` rounds:

* a phrase is a pattern of a kind if identifiers of that kind follow it in at least ``CONFIDENCE`` of *all* places of the
  corpus where the phrase stands, with whatever follows, and at least ``SUPPORT`` different ones do (a phrase stands at
  least as often as identifiers follow it, also where the rest of a word is one of its words);
* an identifier that is no seed gets, for a kind, the mean over its places of the confidence of the better pattern there, and
  counts with that score, for the kind that scores highest, in the next round once it reaches ``ACCEPTED``.

What is reported: every place where an accepted identifier follows a pattern of its kind, as ``found_<kind>``. Scores are whole
millionths, so that sums do not depend on their order. SQL functions only.

How it scales: the texts are read for identifiers with their phrases (a small table), and once a round for the number of
places of phrases that could be patterns by the identifiers after them alone and were not counted before; a round without such
phrases reads nothing. Words are joined with the last words of those phrases and counted on the map side. The graph holds one row per
identifier and pair of phrases; copies only raise its counts. Spans are a function of the text, so found ones come
back to the rows by a hash of 64 bits of the text, one list per distinct text.

Defined results: a NULL text is empty; empty texts have no spans; rows that repeat a doc_id, or have none, are judged
each by its text. No documents give no rows. Other columns of the input play no part. Offsets are code points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.llm.text import let
from stationloom.storage import materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 5
CONFIDENCE = 600_000
ACCEPTED = 500_000
#: Code points before an identifier in which its phrases are looked for.
REACH = 96

# A match starts where a run of its characters starts, or where the match before ended: the leftmost place all the same, but
# found without trying every place of a long run. Possessive parts cannot match otherwise.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its kind to be looked for.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?+"
_IP = rf"^(?=[0-9]){_PART}(?:\.(?=[0-9]){_PART}){{3}}$"
_T = r"[\p{L}0-9@._%+/#-]"
IDENTIFIER = (
    rf"{PATTERNS['phone']}|(?<!{_T})[0-9]{{2,}}+(?:[\x20-][0-9]{{2,}}+){{2,}}+(?!{_T})|"
    rf"(?<!{_T})(?=[\p{{L}}._%+/#-]*+[0-9@]){_T}*[\p{{L}}0-9]"
)
_BLOCK = 64


# --- matches with their places -----------------------------------------------------------------------------


def places(text: Column, pattern: str) -> Column:
    """All matches as (before, start, stop, value): the text since the match before, code point offsets, the match.

    Offsets are running sums over blocks of matches, so that a text with very many costs little more than its length.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def located(found: Column) -> Column:
        pairs = F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found,
            lambda g, v: F.struct(g.alias("before"), F.length(g).alias("g"), F.length(v).alias("n"), v.alias("value")),
        )
        return let(pairs, lambda p: F.when(F.size(p) <= _BLOCK, _run(p)["out"]).otherwise(_blocks(p)))

    return F.when(F.size(hits) == 0, _none()).otherwise(let(hits, located))


def _none() -> Column:
    return F.array().cast("array<struct<before:string,start:int,stop:int,value:string>>")


def _run(pairs: Column) -> Column:
    """(at, out): total length and the places of some matches, counted from their first gap."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        place = F.struct(x["before"], start.alias("start"), (start + x["n"]).alias("stop"), x["value"])
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(place)).alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), _none().alias("out")), step)


def _blocks(pairs: Column) -> Column:
    each = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _BLOCK).cast("int")),
        lambda k: _run(F.slice(pairs, k * _BLOCK + 1, F.lit(_BLOCK))),
    )

    def joined(blocks: Column) -> Column:
        starts = F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
            lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        )["all"]
        return F.flatten(
            F.zip_with(
                blocks, starts,
                lambda b, s: F.transform(
                    b["out"], lambda x: F.struct(x["before"], (x["start"] + s).alias("start"), (x["stop"] + s).alias("stop"), x["value"])
                ),
            )
        )

    return let(each, joined)


# --- kinds -------------------------------------------------------------------------------------------------


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), x.cast("int") + 1)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the pattern of a kind is one."""
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def spans(text: Column, kind: str) -> Column:
    """(start, stop) of all valid matches of a kind."""
    found = F.when(text.rlike(_HINT[kind]), places(text, PATTERNS[kind])).otherwise(_none())
    found = F.filter(found, lambda x: valid(kind, x["value"])) if kind != "email" else found
    return F.transform(found, lambda x: F.struct(x["start"], x["stop"]))


def seed_kind(value: Column) -> Column:
    """The kind of an identifier that is a seed, else NULL."""
    out = F.lit(None).cast("string")
    for k in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[k]})$") & valid(k, value), F.lit(k)).otherwise(out)
    return out


# --- the graph ---------------------------------------------------------------------------------------------


def _phrase(before: Column) -> Column:
    """The last words before an identifier, one space between them; a word cut by the reach is none."""
    near = F.right(before, F.lit(REACH))
    near = F.when(F.length(before) > REACH, F.regexp_replace(near, r"^[^\x20\x09-\x0D]+", "")).otherwise(near)
    return F.trim(F.regexp_replace(F.lower(near), r"[\x20\x09-\x0D]+", " "))


def identifiers(text: Column) -> Column:
    """(start, stop, value, glued, one, two): identifiers with the phrases of one and of two words before them."""
    found = F.when(text.rlike("[0-9@]"), places(text, IDENTIFIER)).otherwise(_none())
    found = F.filter(
        found, lambda x: (F.length(x["value"]) >= 5) & (F.contains(x["value"], F.lit("@")) | (F.length(_digits(x["value"])) >= 3))
    )

    def with_phrases(x: Column) -> Column:
        words = _phrase(x["before"])
        one, two = F.regexp_extract(words, "[^ ]+$", 0), F.regexp_extract(words, "[^ ]+ [^ ]+$", 0)
        return F.struct(
            x["start"], x["stop"], x["value"], (~x["before"].rlike(r"[\x20\x09-\x0D]$")).alias("glued"),
            F.nullif(one, F.lit("")).alias("one"), F.nullif(two, F.lit("")).alias("two"),
        )

    return F.transform(found, with_phrases)


def looked_at(docs: DataFrame) -> DataFrame:
    """(doc_id, h, email, ip, card, phone, ids): what one pass over the texts finds in each row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.xxhash64(text).alias("h"), *[spans(text, k).alias(k) for k in KINDS], identifiers(text).alias("ids")
    )


def graph(found: DataFrame) -> DataFrame:
    """(value, seed, one, two, n, n_glued): identifiers between phrases, with the number of places."""
    rows = found.select(F.explode("ids").alias("x")).select("x.value", "x.one", "x.two", "x.glued")
    rows = rows.groupBy("value", "one", "two").agg(F.count("*").alias("n"), F.count_if("glued").alias("n_glued"))
    return rows.withColumn("seed", seed_kind(F.col("value")))


def _by_phrase(edges: DataFrame, *columns: str) -> DataFrame:
    """A row for each phrase of an edge."""
    phrases = F.filter(F.array("one", "two"), lambda p: p.isNotNull())
    return edges.select(F.explode(phrases).alias("phrase"), *columns)


def phrases_of(edges: DataFrame) -> DataFrame:
    """(phrase, n_after, n_glued): places of identifiers after each phrase that stands before ``SUPPORT`` different ones."""
    each = _by_phrase(edges, "value", "n", "n_glued").groupBy("phrase", "value").agg(F.sum("n").alias("n"), F.sum("n_glued").alias("n_glued"))
    each = each.groupBy("phrase").agg(F.count("*").alias("support"), F.sum("n").alias("n_after"), F.sum("n_glued").alias("n_glued"))
    return each.where(F.col("support") >= SUPPORT).drop("support")


def possible_patterns(edges: DataFrame, scores: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, kind, w, n_after, n_glued) of what could be a pattern, if nothing else followed the phrase anywhere."""
    known = edges.join(scores, F.col("value") == F.col("s_value"))
    each = _by_phrase(known, "kind", "value", "n", "score")
    each = each.groupBy("phrase", "kind", "value").agg(F.sum(F.col("n") * F.col("score")).alias("w"))
    each = each.groupBy("phrase", "kind").agg(F.sum("w").alias("w"), F.count("*").alias("support"))
    each = each.where(F.col("support") >= SUPPORT).drop("support")
    both = each.join(phrases.withColumnRenamed("phrase", "a_phrase"), F.col("phrase") == F.col("a_phrase")).drop("a_phrase")
    return both.where(F.expr("w div n_after") >= CONFIDENCE)


def phrase_places(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, places): how often each of these phrases stands in the texts as whole words."""
    words = F.split(F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))), " ")
    before = F.slice(F.concat(F.array(F.lit(None).cast("string")), F.col("w")), F.lit(1), F.size("w"))
    both = F.zip_with("w", before, lambda b, a: F.struct(a.alias("a"), b.alias("b")))
    near = docs.select(words.alias("w")).select(F.explode(both).alias("x")).select("x.a", "x.b")
    # joined by the last word; the rest of the phrase is part of the condition, so that only its places leave the join
    said = phrases.select(F.col("phrase").alias("said"), F.substring_index("phrase", " ", -1).alias("last"))
    whole = (F.col("said") == F.col("b")) | (F.col("said") == F.concat_ws(" ", "a", "b"))
    near = near.join(said, (F.col("b") == F.col("last")) & whole)
    counted = near.groupBy("said").agg(F.count("*").alias("places"))
    found = phrases.join(counted, F.col("phrase") == F.col("said"), "left")
    return found.select("phrase", F.coalesce("places", F.lit(0).cast("long")).alias("places"))


def patterns_of(possible: DataFrame, total: DataFrame) -> DataFrame:
    """(phrase, kind, confidence) of the patterns."""
    both = possible.join(total.withColumnRenamed("phrase", "t_phrase"), F.col("phrase") == F.col("t_phrase"))
    confidence = F.expr("w div greatest(places + n_glued, n_after)")
    return both.select("phrase", "kind", confidence.alias("confidence")).where(F.col("confidence") >= CONFIDENCE)


def _matched(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """Rows with (kind, confidence) of the better pattern at their place; of equal ones the longer phrase's."""
    for name in ("one", "two"):
        p = patterns.select(
            F.col("phrase").alias(f"p_{name}"), F.struct("confidence", "kind").alias(f"of_{name}")
        )
        rows = rows.join(p, F.col(name) == F.col(f"p_{name}"), "left")
    longer = F.coalesce(F.col("of_two")["confidence"] >= F.col("of_one")["confidence"], F.col("of_two").isNotNull())
    return rows.withColumn("of", F.when(longer, F.col("of_two")).otherwise(F.col("of_one"))).select(
        *[c for c in rows.columns if c not in ("p_one", "p_two", "of_one", "of_two")],
        F.col("of.kind").alias("kind"), F.col("of.confidence").alias("confidence"),
    )


def scores_of(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """(s_value, kind, score) of accepted identifiers that are no seeds."""
    rows = _matched(edges.where("seed IS NULL").select("value", "one", "two", "n"), patterns)
    each = rows.groupBy("value", "kind").agg(F.sum(F.col("n") * F.coalesce("confidence", F.lit(0))).alias("w"), F.sum("n").alias("n"))
    best = F.max(F.when(F.col("kind").isNotNull(), F.struct("w", "kind"))).alias("best")
    each = each.groupBy("value").agg(best, F.sum("n").alias("n"))
    each = each.select(F.col("value").alias("s_value"), F.col("best.kind").alias("kind"), F.expr("best.w div n").alias("score"))
    return each.where(F.col("score") >= ACCEPTED)


def bootstrap(docs: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patterns, scores) after all rounds."""
    phrases = materialize(phrases_of(edges), "phrases")
    seeds = edges.where("seed IS NOT NULL").select(F.col("value").alias("s_value"), F.col("seed").alias("kind")).distinct()
    known = seeds = seeds.withColumn("score", F.lit(1_000_000).cast("long"))
    total = None
    for _ in range(ROUNDS):
        possible = materialize(possible_patterns(edges, known, phrases), "possible-patterns")
        new = possible.select("phrase").distinct()
        if total is not None:
            new = new.join(total.select("phrase"), "phrase", "left_anti")
        if total is None or not new.isEmpty():
            new = materialize(new, "new-phrases")
            places = materialize(phrase_places(docs, new), "phrase-places")
            total = places if total is None else total.unionByName(places)
        patterns = materialize(patterns_of(possible, total), "patterns")
        scores = materialize(scores_of(edges, patterns), "identifier-scores")
        known = seeds.unionByName(scores)
    return patterns, scores


# --- results -----------------------------------------------------------------------------------------------


def _said(kind: str, found: Column) -> Column:
    return F.transform(found, lambda x: F.concat(F.lit(f"{kind}:"), x["start"], F.lit(":"), x["stop"]))


def discovered(found: DataFrame, patterns: DataFrame, scores: DataFrame) -> DataFrame:
    """(f_h, more): found identifiers of each distinct text, by kind as listed, then start."""
    rows = found.select("h", F.explode("ids").alias("x")).select("h", "x.start", "x.stop", "x.value", "x.one", "x.two")
    known = scores.select("s_value", F.col("kind").alias("s_kind"))
    rows = _matched(rows, patterns).where("kind IS NOT NULL")
    rows = rows.join(known, (F.col("value") == F.col("s_value")) & (F.col("kind") == F.col("s_kind")))
    rows = rows.select("h", "kind", "start", "stop").distinct()
    order = reduce(lambda e, k: F.when(F.col("kind") == k, KINDS.index(k)).otherwise(e), KINDS, F.lit(len(KINDS)))
    rows = rows.groupBy("h").agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "start", "stop", "kind"))).alias("more"))
    more = F.transform("more", lambda x: F.concat(F.lit("found_"), x["kind"], F.lit(":"), x["start"], F.lit(":"), x["stop"]))
    return rows.select(F.col("h").alias("f_h"), more.alias("more"))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, counts per kind, ``base`` (spans of the fixed patterns) and ``more`` (found ones)."""
    found = materialize(looked_at(docs), "personal")
    edges = materialize(graph(found), "identifier-graph")
    patterns, scores = bootstrap(docs, edges)
    more = materialize(discovered(found, patterns, scores), "discovered")
    rows = found.join(more, F.col("h") == F.col("f_h"), "left")
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.concat(*[_said(k, F.col(k)) for k in KINDS]).alias("base"),
        F.coalesce("more", F.array().cast("array<string>")).alias("more"),
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the fixed patterns' spans, and all spans as text."""
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join(F.concat("base", "more"), ",").alias("spans"),
    )
