"""Fill-in-middle against plain Python: whole table, edge rows, pieces of every size."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leaksafe.llm import fill_in_middle, queries
from tests.llm.cases import SCHEMA, edge_rows, words

SF = "/root/testdata/sf0.01"


def plain_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def plain_digests(doc_id, text):
    *head, output = plain_middle(doc_id, text)
    return (*head, *(hashlib.sha256(x.encode()).hexdigest() for x in (output, text or "")))


def odd_texts():
    tricky = ["<P", "a<S", "<<P>", "<P >", "<M<", "S>", "<P>x", "x<M>", "<S>", "é<é", "<P<S<M" * 50, "東京<", "\n\r\n<\x00>", "a" * 9000]
    return [(100 + i, t) for i, t in enumerate(tricky * 12)] + [(-1, "id below zero " * 9), (2**62, "a large id, <S, " * 9)]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES["op13_fill_in_middle"](spark, SF).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_digests(r.doc_id, r.text) for r in docs.collect())
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("chunk, most", [(fill_in_middle.CHUNK, fill_in_middle.MOST_BYTES), (1, 4), (7, 64)])
def test_pieces_of_every_size(chunk, most, monkeypatch):
    """Markers across pieces, cut letter runs and sections of any size give the same output and text."""
    monkeypatch.setattr(fill_in_middle, "CHUNK", chunk)
    monkeypatch.setattr(fill_in_middle, "MOST_BYTES", most)
    for doc_id, text in [*odd_texts(), *[(i, words(i, 40) + "😀é" * 5) for i in range(40)]]:
        head, output = fill_in_middle.pieces_of(doc_id, text.encode(), fill_in_middle.SALT)
        pieces = [*output]
        assert (*head, b"".join(pieces).decode()) == plain_middle(doc_id, text)
        if chunk == 1:
            assert max(map(len, pieces), default=0) <= 4
        for again in (pieces, [bytes([b]) for b in b"".join(pieces)]):
            parts = sorted(((place, k), part) for k, (place, part) in enumerate(fill_in_middle.sections(iter(again), head[2])))
            assert b"".join(part for _, part in parts) == text.encode()


def test_edges(spark):
    """Nulls, empty and long texts, ties, repeated rows within and across partitions, clashing column names."""
    rows = edge_rows() + [(i, t, None, None, None, None, None, None, None) for i, t in odd_texts()]
    docs = spark.createDataFrame(rows + rows[:30], SCHEMA).withColumnsRenamed({"lang": "n", "source": "form", "value": "output"})
    want = Counter(plain_digests(r[0], r[1]) for r in rows + rows[:30])
    for parts in (1, 5):
        assert Counter(tuple(r) for r in fill_in_middle.digests(docs.repartition(parts)).collect()) == want
    out = fill_in_middle.transform(docs)
    assert Counter(tuple(r) for r in out.collect()) == Counter(plain_middle(r[0], r[1]) for r in rows + rows[:30])
    back = out.select("doc_id", fill_in_middle.restore(F.col("output"), F.col("form")))
    assert Counter(tuple(r) for r in back.collect()) == Counter((r[0], r[1] or "") for r in rows + rows[:30])
    assert fill_in_middle.digests(docs.limit(0)).collect() == []
    assert fill_in_middle.digests(docs.limit(0)).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_one_shuffle(spark):
    plan = fill_in_middle.digests(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2
