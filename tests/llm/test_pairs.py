"""Similarity join, components, decontamination and the pipeline against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leaksafe.llm import components, decontaminate, ngram_join, packing, queries
from tests.llm.cases import SCHEMA, edge_rows, words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def plain_set(text):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(lower))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows):
    """[(id, text)] to [(size, smallest id reached)]."""
    sets, inverted, parent = [], defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (_, text) in enumerate(rows):
        sets.append(plain_set(text))
        common = Counter(j for g in sets[i] for j in inverted[g])
        for g in sets[i]:
            inverted[g].append(i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def test_join_matches_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op1_ngram_join"](spark, SF).collect()}
    assert [got[i] for i, _ in rows] == plain_components(rows)


def chain(n, seed, length=60, step=3):
    """Texts each a few words from the last: neighbours are linked, the ends of the chain are far apart."""
    r = random.Random(seed)
    w = [f"w{r.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        out.append(" ".join(w))
        w = [*w[step:], *(f"w{r.randrange(10**6)}" for _ in range(step))]
    return out


def test_links_through_hot_lists(spark, monkeypatch):
    """Chains, stars and a common passage, with blocks small enough to be used."""
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 16)
    r = random.Random(9)
    common = [f"c{k}" for k in range(40)]
    texts = [t for s in range(4) for t in chain(20, s)]
    texts += [" ".join([*common, *(f"u{k}x{j}" for j in range(60))]) for k in range(60)]
    base = [f"b{k}" for k in range(80)]
    for _ in range(70):
        w = base[:]
        w[r.randrange(80)] = f"z{r.randrange(10**6)}"
        texts.append(" ".join(w))
    for k in range(50):
        texts.append(" ".join(common + [f"t{k % 25}"]))
    texts += texts[:15]
    rows = list(enumerate(texts, 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.near_duplicates(docs).collect()}
    assert [got[i] for i, _ in rows] == plain_components(rows)


@pytest.mark.parametrize("list_rows", [2048, 16])
def test_a_pair_is_given_by_one_of_its_lists(spark, monkeypatch, list_rows):
    """Near copies share most of their lists, which lie in different tasks; texts that only share a passage are not given."""
    monkeypatch.setattr(ngram_join, "LIST_ROWS", list_rows)
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merged)
    spark.conf.set(merged, "false")
    try:
        texts = [t for s in range(3) for t in chain(8, s, length=200, step=1)]
        texts += [" ".join([*(f"c{k}" for k in range(25)), *(f"p{k}x{j}" for j in range(175))]) for k in range(24)]
        held = ngram_join.Join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
        pairs = [tuple(r) for r in ngram_join.tree_pairs(ngram_join.lists(held.nodes), held.nodes).collect()]
        assert len(pairs) == len(set(pairs)) == 3 * 8 * 7 // 2 == held.links(spark.createDataFrame(pairs, "a long, b long")).count()
    finally:
        spark.conf.set(merged, before)


def test_tree_bound_never_loses_a_pair():
    rng = np.random.default_rng(6)
    for n in (1, 2, 17, 300):
        sizes = rng.integers(1, 80, n)
        points = np.stack([np.bincount(rng.integers(0, ngram_join.GROUPS, s), minlength=ngram_join.GROUPS) for s in sizes])
        points[n // 2 :] = points[: n - n // 2]
        sizes = points.sum(1)
        classes = rng.integers(0, max(2, n // 3), n)
        tree = ngram_join.Tree(points, sizes, classes, ngram_join.packed(points, sizes))
        got = {tuple(sorted(p)) for p in ngram_join.close_pairs(tree).tolist()}
        want = set()
        for i in range(n):
            for j in range(i):
                bound = np.minimum(points[i], points[j]).sum()
                if classes[i] != classes[j] and 7 * bound >= 3 * (sizes[i] + sizes[j]) and 4 * sizes[i] >= 3 * sizes[j] and 4 * sizes[j] >= 3 * sizes[i]:
                    want.add((j, i))
        assert got == want
        half = n // 2
        if half:
            trees = [ngram_join.Tree(points[s], sizes[s], classes[s], ngram_join.packed(points[s], sizes[s])) for s in (slice(0, half), slice(half, n))]
            cross = {(i, j + half) for i, j in ngram_join.close_pairs(*trees).tolist()}
            assert cross == {(i, j) for i, j in want if i < half <= j}


def test_join_edges(edge):
    got = ngram_join.near_duplicates(edge).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(got) == len(edge_rows())
    for i in (0, 1, 2):
        assert [(r.n_shingles, r.component_id) for r in by[i]] == [(0, i)]
    assert {r.component_id for i in (4, 5, 6) for r in by[i]} == {4} and len(by[4]) == 2
    assert ngram_join.near_duplicates(edge.limit(0)).count() == 0
    kept = ngram_join.one_of_each(edge)
    left = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == edge.columns and left[4] == 1 and not left[5] and not left[6] and left[0] == left[1] == left[2] == 1


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 200)] + [(300 + i, 300) for i in range(1, 50)] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(parent)
    names = {(find(x), got[x]) for x in got}
    assert len(names) == len({a for a, _ in names}) == len({b for _, b in names})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_leaks(docs, items):
    """Every item against every stretch of every document."""
    vocabulary = {}
    coded = [(str(i), np.array([vocabulary.setdefault(w, len(vocabulary)) for w in decontaminate.words(t)])) for i, t in items]
    out = {}
    for doc, text in docs:
        c = np.array([vocabulary.get(w, -1) for w in decontaminate.words(text or "")], dtype=int)
        place = np.flatnonzero(c >= 0)
        half = decontaminate.HALF
        out[doc] = sorted(
            name for name, item in coded
            if any(decontaminate.judge(item, place, c[place], s, s + 2 * half) for s in range(0, max(len(c) - half, 1), half))
        )
    return out


def test_leaks_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain_leaks(docs, items)
    got = {r.doc_id: [x for x in r["items"].split(",") if x] for r in queries.QUERIES["op5_decontamination"](spark, SF).collect()}
    pairs = {(d, i) for d, found in want.items() for i in found}
    hits = {(d, i) for d, found in got.items() for i in found}
    assert pairs and hits <= pairs and len(hits & pairs) >= 0.95 * len(pairs)


def test_a_space_fitted_on_a_tenth_finds_the_leaks(spark, monkeypatch):
    """The space is the index of a search: fitted on a sample, it must still find what brute force over all rows finds."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(decontaminate, "SVD_ROWS", docs.count() // 10)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain_leaks([(r.doc_id, r.text) for r in docs.collect()], items)
    got = {r.doc_id: [x for x in r["items"].split(",") if x] for r in queries.QUERIES["op5_decontamination"](spark, SF).collect()}
    pairs = {(d, i) for d, found in want.items() for i in found}
    hits = {(d, i) for d, found in got.items() for i in found}
    assert pairs and hits <= pairs and len(hits & pairs) >= 0.9 * len(pairs)


def test_the_space_is_that_of_all_documents(spark, monkeypatch):
    """Pairs of words and the space against plain numpy over every passage of every document."""
    monkeypatch.setattr(decontaminate, "SVD_ROWS", 3)
    monkeypatch.setattr(decontaminate, "PAIRS_HELD", 50)
    r, half = random.Random(3), decontaminate.HALF
    known = [f"w{k}" for k in range(90)]
    benchmark = spark.createDataFrame([(f"i{k}", " ".join(r.sample(known, 30))) for k in range(5)], "item_id string, text string")
    texts = [" ".join(r.choice([*known, "other", "else"]) for _ in range(r.choice([0, 1, 15, 16, 17, 33, 300]))) for _ in range(60)] + [None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").selectExpr("id __row", "id __id", "text __text").repartition(3)
    (block,) = decontaminate.blocks_of(benchmark)
    held = spark.sparkContext.broadcast(block.vocabulary)
    hits = rows.mapInArrow(decontaminate._reduce(held), "__row long, __id long, n int, place array<int>, word array<int>").cache()
    weight = np.random.default_rng(1).uniform(0.5, 3, len(block.vocabulary))
    weight[::7] = 0
    counts = []
    for text in texts:
        found = decontaminate.words(text or "")
        halves = max(1, -(-len(found) // half))
        for a in range(max(halves - 1, 1)):
            row = np.zeros(len(weight))
            for w in found[a * half : (a + 2) * half]:
                if w in block.vocabulary:
                    row[block.vocabulary[w]] += 1
            counts.append(row)
    every = np.array(counts) * (weight > 0)
    want = every.T @ every
    got = np.zeros_like(want)
    for x in decontaminate.word_pairs(hits, weight).collect():
        got[x["one"], x["others"]] += x["counts"]
    assert (got == np.triu(want)).all()
    monkeypatch.setattr(decontaminate, "DENSE_PAIRS", 0)
    listed = {x["one"]: (x["others"], x["counts"]) for x in decontaminate.word_pairs(hits, weight).collect()}
    assert all((got[k, listed[k][0]] == listed[k][1]).all() and len(listed[k][0]) == np.count_nonzero(got[k]) for k in range(len(got)) if got[k].any())
    gram = want * weight[:, None] * weight[None]
    own = block.matrix(weight)
    monkeypatch.setattr(decontaminate, "RANK_ABOVE", 10)
    space = decontaminate.latent_space(hits, block, weight)
    start = np.random.default_rng(5).normal(size=space.shape)
    mine, theirs = own.T @ own @ start, gram @ start
    q, _ = np.linalg.qr(mine / np.abs(mine).sum() + theirs / np.abs(theirs).sum())
    assert np.allclose(space @ space.T, q @ q.T, atol=1e-6)


def test_paraphrases_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_PASSAGES", 7)
    r = random.Random(8)
    items = [(k, words(500 + k, 20 + 3 * k)) for k in range(20)] + [(50, words(900, 400)), (51, None), (None, "x"), (52, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = []
    for k, (_, t) in enumerate(items[:20]):
        w = t.split()
        for _ in range(len(w) // 10):
            w[r.randrange(len(w) - 6)] = "changed"
        docs.append((k, f"{words(k, 90)} {' '.join(w)} {words(k + 50, 70)}"))
    docs += [(100 + k, words(2000 + k, 200)) for k in range(40)] + [(200, None), (201, ""), (202, words(900, 400)[300:]), (0, docs[0][1])]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, word int, items string")
    got = defaultdict(set)
    for x in decontaminate.leaked(frame, benchmark).collect():
        got[x.doc_id] |= {i for i in x["items"].split(",") if i}
    assert all(str(k) in got[k] for k in range(20)) and got[202] == {"50"}
    assert not any(got[k] for k in (*range(100, 140), 200, 201))
    kept = decontaminate.clean(frame, benchmark)
    assert kept.columns == frame.columns and sorted(x.doc_id for x in kept.collect()) == [*range(100, 140), 200, 201]
    assert decontaminate.leaked(frame, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.leaked(frame.limit(0), benchmark).count() == 0


def test_common_subsequence():
    assert decontaminate.common(np.array([1, 2, 3, 4]), np.array([9, 1, 3, 2, 4])) == 3
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = rng.integers(0, 6, 20), rng.integers(0, 6, 30)
        table = np.zeros((21, 31), int)
        for i in range(20):
            for j in range(30):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common(a, b) == table[-1, -1]


def test_pipeline_stages(spark):
    """Each stage's output against its own input by plain rules."""
    from tests.llm.test_native import plain_passages
    from leaksafe.llm import line_winnow

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    given = docs.collect()
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF))
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    assert len(out["language_id"]) >= 0.995 * len(given)
    assert {(r.doc_id, r.text) for r in out["language_id"]} <= {(r.doc_id, r.text) for r in given}
    before = {r.doc_id: r.text for r in out["language_id"]}
    cut = plain_passages([*before.items()], line_winnow.MIN_WORDS)
    assert {r.doc_id: r.text for r in out["line_dedup"]} == {i: t for i, t in cut.items() if t.strip(" \n\r\t") or t == before[i]}
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"])
    rows = sorted((r.doc_id, r.text) for r in out["line_dedup"])
    first = {i for (i, _), (_, least) in zip(rows, plain_components(rows), strict=True) if i == least}
    assert {r.doc_id for r in out["near_duplicates"]} == first
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = plain_leaks([(r.doc_id, r.text) for r in out["near_duplicates"]], items)
    gone = {r.doc_id for r in out["near_duplicates"]} - {r.doc_id for r in out["decontamination"]}
    dirty = {i for i, found in leaks.items() if found}
    assert gone <= dirty and len(gone) >= 0.95 * len(dirty)
    whole = defaultdict(int)
    for p in out["packing"]:
        whole[p.doc_id] += p.length
    assert set(whole) == {r.doc_id for r in out["decontamination"]}
    assert all(whole[p.doc_id] == p.doc_tokens for p in out["packing"])
    by = defaultdict(int)
    for p in out["packing"]:
        by[p.sequence_id] += p.length
    assert max(by.values()) <= packing.WINDOW
    assert corpus_pipeline.run(spark, SF).groupBy().agg(F.sum("length").alias("n")).first().n == sum(whole.values())


def test_one_of_each_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{j}" for j in range(30))
    rows = [(1, text, 77, True, 5, "x"), (2, text, 78, False, 6, "y"), (3, None, 79, True, 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __mark long, __all boolean, __turn int, `a.b` string")
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[2]]
