"""The registered queries on the given tables: against SQL, or against a brute-force version."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from check import connect, differences
from stationloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_quality_rules_are_native(spark):
    plan = QUERIES["op1_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow") if x in plan]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(spark, name):
    from stationloom.llm.tokens import PieceEncoder

    texts = [r[0] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["a  b", " a b ", "x\n\ny", "x \ny", "x\n y", "", "\n", " ", "don't  we'll\tgo", "a b c", "é ́x", "a\x1c b\x85c"]
    e = PieceEncoder(public_tokenizers.path(name))
    want = e.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(e.encode(t), "<u4").tolist() for t in texts] == [w.ids for w in want]


def test_pipeline_against_brute_force(spark):
    """The rows of the last stage from those of the one before, and what each stage owes its input."""
    from tokenizers import Tokenizer

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).toPandas()
        seen.append((name, docs.toPandas(), out))
        if name != "packing":
            assert list(out.columns) == columns
            docs = spark.createDataFrame(out, docs.schema)
    _, before, after = seen[0]
    few = before.text.fillna("").map(lambda t: len(t.encode().split()) < 10)
    assert not set(after.doc_id) & set(before.doc_id[few]) and len(after) > 0.8 * len(before)
    _, before, after = seen[1]
    words = before.set_index("doc_id").text.map(lambda t: tuple(t.encode().lower().split()))
    assert set(words) == set(words[after.doc_id]) | set(words[~words.index.isin(after.doc_id)]) and after.doc_id.is_unique
    _, before, after = seen[2]
    assert sorted(after.doc_id) == sorted(before.doc_id) and not after.text.str.contains("password=[0-9a-f]{6}").any()
    _, before, after = seen[3]
    size = lambda d: d.text.map(lambda t: len(t.encode().split())).groupby(d.source).sum()
    assert abs(size(after).sum() - 1.5 * size(before).sum()) <= len(size(before)) and (size(after) <= 2 * size(before)).all()
    _, before, after = seen[4]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(len(t.encode(x, add_special_tokens=False).ids) + 1 for x in before.text)
    assert after.length.sum() == sum(want) and (after.groupby("sequence_id").length.sum() <= 4096).all()
    assert all(0 <= c < 2**32 for c in after.ids_crc32) and zlib.crc32(b"") == 0
