"""Token alignment against a plain version that encodes whole texts with both libraries."""

import hashlib
import json
import os
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stationloom.llm import alignment
from stationloom.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SCHEMA = "doc_id long, text string"


def plain(rows):
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    byte_of = alignment.byte_alphabet()

    def tokens(text):
        a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
        spelt_a = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
        spelt_b = [
            bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = (" " + text).encode()
        return (a, spelt_a, b, spelt_b) if text and b"".join(spelt_a) == b"".join(spelt_b) == whole else None

    def groups(a, spelt_a, b, spelt_b):
        out, i, j, at_a, at_b, ga, gb = [], 0, 0, 0, 0, [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b and i < len(a):
                ga.append(a[i])
                at_a += len(spelt_a[i])
                i += 1
            else:
                gb.append(b[j])
                at_b += len(spelt_b[j])
                j += 1
            if at_a == at_b and ga and gb:
                out.append((ga, gb))
                ga, gb = [], []
        return out

    found, counts = [], Counter()
    for doc_id, text in rows:
        t = tokens(text or "")
        g = groups(*t) if t else []
        links = Counter((x, y) for ga, gb in g for x in ga for y in gb)
        counts.update(links.keys())
        found.append((doc_id, t, g, links))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for doc_id, t, g, links in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            doc_id, len(t[0]) if t else 0, len(t[2]) if t else 0, len(g), sum(links.values()),
            sum(n for k, n in links.items() if counts[k] == top[k[0]]), sum(n * counts[k] for k, n in links.items()),
            hashlib.sha256(said.encode()).hexdigest() if t else "",
        ))
    return sorted(out, key=str)


def aligned(df):
    return sorted((tuple(r) for r in alignment.align(df, A, B).select("doc_id", *COLUMNS).collect()), key=str)


ODD = [
    None, "", " ", "\n", "  two  spaces ", " lead", "\nbreak\n\nbreak ", "tab\tand\r\nline", "mark ▁ in", "a <|endoftext|> b <s> c</s> <unk>",
    "don't we'll I'm", "日本語のテキスト と 漢字", "emoji 👩‍👩‍👧 flags 🇩🇪", "é è ñ ß ü", "nbsp here  wide　x", "\x1cfs \x85nel", "x" * 3000,
    "=" * 200 + " " + "-" * 77, "a\nb c\n d", "nul\x00in", "1234567 89.01", "ends with space ", "copy me", "copy me", "copy me", "\n x", " \n x", "  \n x",
]


def test_odd_texts(spark):
    rows = [*enumerate(ODD), (None, "copy me"), (3, "another text of 3")]
    assert aligned(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_small_chunks_give_the_same(spark, monkeypatch):
    rows = [(i, f"word{i % 7} shared words {i % 13} and more{i % 5}.") for i in range(60)] + [*enumerate(ODD)]
    whole = aligned(spark.createDataFrame(rows, SCHEMA))
    for name, value in (("MAX_PIECES", 5), ("TOGETHER", 40)):
        monkeypatch.setattr(alignment, name, value)
    assert aligned(spark.createDataFrame(rows, SCHEMA)) == whole == plain(rows)


def test_empty_table_and_extra_columns(spark):
    assert aligned(spark.createDataFrame([], SCHEMA)) == []
    odd = spark.createDataFrame([(1, "some text", "s", 4, 5)], "doc_id long, text string, sha string, copies int, chunk int")
    assert aligned(odd) == plain([(1, "some text")])


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_query_on_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"](spark, SF).select("doc_id", *COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_every_entry_encodes_to_itself():
    """What makes merging by rank and merging by rule the same."""
    with open(A, encoding="utf-8") as f:
        said = json.load(f)
    model = Tokenizer.from_file(A).model
    special = {x["content"] for x in said["added_tokens"]}
    assert [t for t, i in said["model"]["vocab"].items() if t not in special and [x.id for x in model.tokenize(t)] != [i]] == []
