"""Personal data: fixed patterns against plain Python, the bootstrapped part against SQL on planted phrases."""

import hashlib
import random
import re

import duckdb
import pytest

from check import differences
from stationloom.llm import personal, sql

SCHEMA = "doc_id long, text string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_valid(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        twice = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and twice % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [
        [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if is_valid(k, m[0])] for k, p in PLAIN.items()
    ]


def expected(doc_id, text):
    each = plain_spans(text)
    said = ",".join(x for k in each for x in k)
    return (doc_id, *map(len, each), hashlib.sha256(said.encode()).hexdigest(), said)


def as_rows(df):
    return sorted((tuple(r) for r in personal.digest(df).collect()), key=str)


def odd_texts():
    rng = random.Random(5)
    parts = ["a", "b.", "@", "x@y.z", "_", "%", "+", "1", "12", ".", " ", "-", "(", ")", "4111111111111111", "192.168.0.1",
             "256.1.1.1", "+1 (555) 010-9999", "\n", "é", "010.0.0.255", "0000255", ":", "𝄞", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8",
             "4111-1111 1111-1111", "--"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 10, 40, 300]))) for _ in range(300)]
    return [*texts, None, "", "a.b@c.de " * 300, "7 " * 5000, "x" * 4_000, "1" * 4_000 + ".", "." * 3_000 + "@" + "." * 3_000]


def test_fixed_patterns_equal_plain_python(spark):
    rows = list(enumerate(odd_texts()))
    rows += [rows[3], rows[3], (None, rows[5][1]), (7, "other 10.0.0.1")]
    got = as_rows(personal.personal_data(spark.createDataFrame(rows, SCHEMA)))
    assert [r[:6] for r in got] == sorted([expected(*r)[:6] for r in rows], key=str)


def planted():
    """Phrases before seeds that also stand before identifiers of other forms; phrases that stand before anything."""
    rows = [f"Ring me, phone number: +1 (555) 010-{1000 + i} ok" for i in range(12)]
    rows += ["Ring me, phone number: 555-0199 ok", "phone number: 555-0199", "new phone number: 020-7946-0018."]
    rows += [f"see page{i} the user{i}@mail.example.org then" for i in range(30)] + ["see the house and the tree and the 12345 end"] * 60
    rows += [f"Mail an: person{i}@firma.example.de\nEnde" for i in range(300)] + ["Mail an: kollege@intern heute"]
    # the second round: identifiers found after "an:" make a pattern of what else stands before them
    rows += [f"Mail an: u{i}@intern heute" for i in range(9)] * 4 + [f"schreib hin: u{i}@intern" for i in range(9)]
    rows += ["schreib hin: v7@intern"] + [f"build {i:05d}a passed" for i in range(9)] + ["", None]
    return [(i, t) for i, t in enumerate(rows)]


def test_phrases_find_unseen_identifiers_as_sql_does(spark):
    con = duckdb.connect()
    rows = planted()
    docs = spark.createDataFrame(rows, SCHEMA)
    con.register("documents", docs.toPandas())
    found = personal.digest(personal.personal_data(docs))
    assert differences(found, con, sql.OP11) == []
    texts = dict(rows)
    said = {r.doc_id: r.spans for r in found.collect()}
    values = {
        (k, texts[d][int(a) : int(b)])
        for d, x in said.items() for k, a, b in (y.split(":") for y in x.split(",") if y.startswith("found_"))
    }
    expected_values = {("found_phone", "555-0199"), ("found_phone", "020-7946-0018"), ("found_email", "kollege@intern"),
                       ("found_email", "v7@intern")} | {("found_email", f"u{i}@intern") for i in range(9)}
    assert values == expected_values


def test_copies_alone_make_no_pattern(spark):
    rows = [(i, "my code: +1 (555) 010-1234 and") for i in range(40)] + [(99, "my code: 77-1234-9 and")]
    got = personal.personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert not any(r.more for r in got)


def test_empty_table_and_extra_columns(spark):
    assert as_rows(personal.personal_data(spark.createDataFrame([], SCHEMA))) == []
    odd = spark.createDataFrame([(1, "mail a@b.cd", "x", 5, "y")], "doc_id long, text string, h string, value int, kind string")
    assert as_rows(personal.personal_data(odd)) == [expected(1, "mail a@b.cd")]


def test_many_matches_keep_their_places(spark):
    text = " ".join(f"u{i}@h{i}.example.org" for i in range(5000))
    got = personal.personal_data(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert got.base == plain_spans(text)[0]


def test_query_is_native(spark):
    docs = spark.createDataFrame(planted(), SCHEMA)
    for df in (personal.looked_at(docs), personal.digest(personal.personal_data(docs))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow") if x in plan]


@pytest.mark.parametrize("value, kind", [
    ("a@b.cd", "email"), ("10.0.0.1", "ip"), ("10.0.0.256", None), ("4111111111111111", "card"), ("4111111111111112", None),
    ("+1 (555) 010-9999", "phone"), ("+1234", None), ("AB12345", None),
])
def test_seed_kind(spark, value, kind):
    from pyspark.sql import functions as F

    assert spark.range(1).select(personal.seed_kind(F.lit(value)).alias("k")).first().k == kind
