"""Encoding, spans and decoding against the sentencepiece library; normalisation against the library's normaliser."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_pb2

from leaksafe.llm import piece_codec, queries
from tests.llm.cases import SCHEMA, edge_rows

SF = "/root/testdata/sf0.01"
ODD = [*"abcABC xyz  ▁▁\t\n\r\x00\x0eé東京𝔘😀ﬁＡ‍﻿́̈㍿ﷺ´‗　ガｶﾞ각각 ½…™<s>0x41'\"12345-_=+{}[]();:", "é", "ガ", "www"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(piece_codec.MODEL)))


@pytest.fixture(scope="module")
def model():
    return piece_codec.model(str(public_tokenizers.path(piece_codec.MODEL)))


def odd_texts(n: int, seed: int = 1) -> list[str]:
    r = random.Random(seed)
    fixed = ["", " ", "  ", " a", "a  b ", "▁a", "a▁b", "x" * 5000, " " * 777, "▁" * 99, "1" * 300, "⁇ �", "ab" * 400, "日本語" * 300]
    return fixed + ["".join(r.choices(ODD, k=r.randint(1, 60))) for _ in range(n)]


def spans(library, text: str) -> tuple[list[int], list[int], list[int]]:
    """The library's ids and byte spans, and the end id at the text's end."""
    out, size = sentencepiece_pb2.SentencePieceText(), len(text.encode())
    out.ParseFromString(library.encode(text, out_type="serialized_proto"))
    return [p.id for p in out.pieces] + [2], [p.begin for p in out.pieces] + [size], [p.end for p in out.pieces] + [size]


def round_trip(library, doc_id, text):
    ids = library.encode(text or "", add_eos=True)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))


def test_whole_table(spark, library):
    got = queries.QUERIES["op11_piece_codec"](spark, SF).drop("spans_xxhash64").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert Counter(tuple(r) for r in got) == Counter(round_trip(library, r.doc_id, r.text) for r in docs)


@pytest.mark.parametrize("block", [piece_codec.BLOCK, 7])
def test_ids_and_spans(block, library, model, monkeypatch):
    monkeypatch.setattr(piece_codec, "BLOCK", block)
    for text in odd_texts(1500):
        ids, begins, ends = (x.tolist() for x in model.encode(text))
        assert (ids, begins, ends) == spans(library, text)
        assert model.decode(ids) == library.decode(ids)


def test_both_ways_of_merging(model):
    for text in odd_texts(300, 5):
        assert [p for p in model._merge_short(text)] == model._merge_long(text)


def test_any_ids_decode(library, model):
    r = random.Random(3)
    for _ in range(4000):
        ids = [r.randrange(32000) if r.random() < 0.5 else r.randrange(300) for _ in range(r.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc_cf"])
def test_normalisation_through_the_compiled_map(rule):
    texts = odd_texts(150, 2) + [" ", "\x0e", "▁", "\n\x0e  \n ", "　　", "▁　\x0e"]
    for flags in (0, 3, 5, 6, 7):
        prefix, extra, escape = (bool(flags >> k & 1) for k in range(3))
        library = sentencepiece.SentencePieceNormalizer(
            rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=extra, escape_whitespaces=escape
        )
        spec = dict(piece_codec.fields(dict(piece_codec.fields(library.serialized_model_proto()))[3]))
        own = piece_codec.Normalizer(spec.get(2, b""), prefix, extra, escape)
        for text in texts:
            normal, places = library.normalize(text, with_offsets=True)
            got, source = own(text)
            assert (got, source.tolist()) == (normal, list(places))


def test_edges(spark, library):
    """Nulls, empty and long texts, repeated rows, clashing column names, an empty table."""
    rows = edge_rows() + [(200 + i, t, *[None] * 7) for i, t in enumerate(odd_texts(40))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"lang": "ids", "source": "begins", "value": "decoded", "__row": "__ids"})
    got = piece_codec.round_trip(docs.repartition(3)).drop("spans_xxhash64").collect()
    assert Counter(tuple(r) for r in got) == Counter(round_trip(library, r[0], r[1]) for r in rows)
    found = Counter((r.doc_id, *map(tuple, r[1:])) for r in piece_codec.encode(docs).collect())
    assert found == Counter((r[0], *map(tuple, spans(library, r[1] or ""))) for r in rows)
    assert piece_codec.round_trip(docs.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [tuple(r) for r in piece_codec.decode(nothing, ["k"]).collect()] == [(1, ""), (2, "")]


def test_other_models_are_refused(model):
    with pytest.raises(ValueError):
        piece_codec.Model(b"")
