"""Packing, languages, toxicity and page extraction: exact round trips, held-out accuracy, edge rows."""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leaksafe.llm import html_extract, language_id, packing, queries, toxicity
from tests.llm.cases import SCHEMA, edge_rows, words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def check_pieces(pieces, ids_of):
    """Every id of every document lies in exactly one piece, and sequences have no gaps. `ids_of`: id to list of id lists."""
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault(p.doc_id, []).append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= packing.WINDOW
    assert set(by_doc) == set(ids_of)
    for doc, all_ids in ids_of.items():
        if len(all_ids) > 1:
            assert sum(p.length for p in by_doc[doc]) == sum(map(len, all_ids))
            continue
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            part = np.array(all_ids[0][p.start : p.start + p.length], dtype="<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(all_ids[0]), zlib.crc32(part.tobytes()))
            at += p.length
        assert at == len(all_ids[0])
    return by_sequence


def test_packing_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {i: [e.ids + [0]] for i, e in zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}
    sequences = check_pieces(queries.QUERIES["op4_packing"](spark, SF).collect(), ids)
    sizes = [sum(p.length for p in s) for s in sequences.values()]
    padded = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in sizes)
    assert padded == 0


def test_packing_edges(edge, tokenizer):
    ids = {}
    for r in edge.collect():
        ids.setdefault(r.doc_id, []).append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0])
    check_pieces(packing.pack_documents(edge.repartition(3)).collect(), ids)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    pattern, path = public_tokenizers.PATTERN, str(public_tokenizers.path(packing.RANKS))
    odd = ["", " ", "\n\n  x", "<|endoftext|> a", "a <|endoftext|><|endoftext|>  b<|endoftext", "x" * 20 + "<|endoftext|>", "naïve café 東京 😀👩‍👩‍👧", "a" * 5000, "1234567 12.5%", "don't WE'LL", "  x\t\r\n ", "\x00\x1f�", words(3, 500)]
    for t in odd:
        assert packing.token_ids(t, path, pattern).tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [0]


def test_step_groups_are_balanced():
    rng = np.random.default_rng(1)
    pieces = [packing.Piece(0, 0, np.zeros(n, "<u4"), n) for n in rng.integers(1, 1024, 3000)]
    full, left = packing.settle(packing.best_fit(pieces))
    assert all(sum(len(p.ids) for p in w) == packing.WINDOW for w in full) and sum(len(p.ids) for p in left) < packing.WINDOW
    cost = np.zeros(packing.STEP_GROUPS)
    for w, g in zip(full, packing.step_groups(full), strict=True):
        cost[g] += sum(len(p.ids) ** 2 for p in w)
    assert cost.max() < 1.05 * cost.min()


def test_languages_held_out(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op6_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    out = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(got[r.doc_id].held_out == (r in out) for r in docs)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) >= 0.99 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values()) and sum(r.rejected for r in got.values()) <= 0.005 * len(docs)


def test_language_model_sums_to_one():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 6, 4000)
    keys, n = np.unique(language_id.grams(s), return_counts=True)
    model = language_id.fit_language(keys, n)
    for history in (0, (1 << 20) | (2 << 10) | 3, (900 << 20) | 5):
        p = np.exp(model.log_probability((history << language_id.BITS) | np.arange(language_id.SYMBOLS)))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_language_counts_match_a_plain_count(spark):
    docs = spark.createDataFrame([("aB c", "x"), ("ab", "x"), ("zz", "y"), (None, "x"), ("q", None)], "text string, lang string")
    got = {(r.lang, r.key): r.n for r in language_id.gram_counts(docs).collect()}
    want = {}
    for lang, texts in {"x": ["aB c", "ab"], "y": ["zz"]}.items():
        for t in texts:
            for k in language_id.grams(language_id.symbols(t)).tolist():
                want[lang, k] = want.get((lang, k), 0) + 1
    assert got == want


def test_language_edges(edge, spark):
    models = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = language_id.identify(edge, models).collect()
    assert len(got) == len(edge_rows())
    for r, (_, text, *_) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(edge_rows(), key=lambda r: (r[0] is None, r[0])), strict=True):
        if not any(c.isalpha() for c in text or "") and r.doc_id is not None:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    kept = language_id.known_language(edge, models)
    assert kept.columns == edge.columns and kept.count() <= len(edge_rows())
    assert {r.lang_pred for r in language_id.identify(edge, {}).collect()} == {"und"}
    assert language_id.identify(edge.limit(0), models).count() == 0
    foreign = spark.createDataFrame([(1, "zxqj wvkk qqxz jjkw " * 50)], "doc_id long, text string")
    assert language_id.identify(foreign, models).first().rejected


def test_model_rows_are_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    models = language_id.train(docs, model_rows=5000)
    assert sum(len(m.orders[-1].grams) for m in models.values()) <= 5000
    sample = docs.where(F.length("text") > 200).limit(50).collect()
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, models).collect()}
    assert sum(got[r.doc_id] == r.lang for r in sample) >= 48


def test_every_gram_and_language_is_kept(spark):
    """Millions of 4-grams of one language leave those of a rare one alone."""
    rng = np.random.default_rng(4)
    noise = ["".join(map(chr, 0x4E00 + rng.integers(0, 1000, 90_000))) for _ in range(50)]
    docs = spark.createDataFrame([*((t, "noise") for t in noise), ("ein sehr seltener satz", "rare")], "text string, lang string")
    models = language_id.train(docs)
    assert set(models) == {"noise", "rare"} and len(models["noise"].orders[-1].grams) > 4_000_000
    want = np.unique(language_id.grams(language_id.symbols("ein sehr seltener satz")))
    assert (models["rare"].orders[-1].grams == want).all()


def test_subwords_of_many_words_are_those_of_each(monkeypatch):
    monkeypatch.setattr(toxicity, "SUBWORD_WORDS", 100)
    words = [a + b * n for a in ("", "x_9", "bad", "é", "ü1") for b in ("a", "ab", "abcd", "日") for n in range(1, 14)]
    for part in (words, [w for w in words if w.isascii()], ["é"], ["a"], ["a" * 40]):
        flat, sizes = toxicity.many_subwords(part)
        want = [toxicity.subwords(w) for w in part]
        assert sizes.tolist() == [len(x) for x in want] and flat.tolist() == [y for x in want for y in x]


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op7_toxicity"](spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in labels)
    right = sum(got[r.doc_id].predicted == r.toxic for r in labels)
    assert right >= 0.95 * len(labels)


def test_misspellings_share_vectors():
    rng = np.random.default_rng(2)
    clean = [words(int(s), 60).split() for s in rng.integers(1000, 9000, 120)]
    toxic = [[*t[:30], "horridscum", *t[30:]] for t in clean[:60]]
    model = toxicity.fit(clean[60:] + toxic, np.array([0] * 60 + [1] * 60))
    margin = lambda w: model.word_margins([toxicity.subwords(w)])[0]
    assert margin("horridscum") > margin("horridscumm") > 3 * abs(margin("gentle")) + 0.5


def test_long_runs_are_read_whole():
    run = "".join(chr(0x4E00 + j) for j in range(1234))
    for n in (1, 39, 40, 41, 59, 60, 61, 80, 81, 1234):
        parts = toxicity.pieces(run[:n])
        assert all(len(p) <= toxicity.PIECE for p in parts)
        # Whatever has up to half a piece's length stands whole in one of them.
        size = min(n, toxicity.PIECE // 2)
        assert all(any(run[a : a + size] in p for p in parts) for a in range(n - size + 1))
    rng = np.random.default_rng(2)
    clean = [words(int(s), 60).split() for s in rng.integers(1000, 9000, 120)]
    toxic = [[*t[:30], "horridscum", *t[30:]] for t in clean[:60]]
    model = toxicity.fit(clean[60:] + toxic, np.array([0] * 60 + [1] * 60))
    score = lambda t: model.document(model.word_margins([toxicity.subwords(w) for w in toxicity.words(t)]))
    glued = "_".join(re.sub("[^a-z]", "", w) for w in clean[70])
    assert score(f"{glued}_horridscum") > score(glued) + 0.1 and score(f"{glued[:150]}_horridscum_{glued[150:]}") > score(glued) + 0.1


def test_toxicity_edges(edge, spark):
    labels = spark.createDataFrame([(4, None), (7, 1), (7, 0), (6, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxic_documents(edge, labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxic_documents(edge.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.toxic_documents(edge, labels.limit(0)).collect()} == {0.0}


def article(source: str) -> str:
    """The article of the test pages by their known layout."""
    inner = source[source.find("<article>") + 9 :].split("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_pages(spark):
    got = {r.page_id: r for r in queries.QUERIES["op8_html_extraction"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == article(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_other_layouts(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]
    model = html_extract.boost(*html_extract.training_set(pages[:150]))
    layouts = {
        "<div class='menu'><a href=/>Home</a></div><div id='main-content'><h1>T</h1><p>{}</p><p>{}</p></div><div class='footer'>&copy; me</div>",
        "<header><a href=/>Home</a><a href=/>x</a></header><main><p>{}<p>{}</main><aside><a href=/>more</a></aside><footer>f</footer>",
    }
    one, two = words(1, 60), words(2, 50)
    for layout in layouts:
        page = html_extract.parse("<html><body>" + layout.format(one, two) + "</body></html>")
        text = html_extract.main_text(page, html_extract.decode(page, model.predict(html_extract.features(page))))
        assert text.removeprefix("T\n\n") == f"{one}\n\n{two}"


def test_decoding_is_consistent(spark):
    rng = np.random.default_rng(4)
    page = html_extract.parse(spark.read.parquet(f"{SF}/pages.parquet").first().html)
    for _ in range(20):
        kept = html_extract.decode(page, rng.normal(size=len(page.nodes)))
        assert all(kept[n.parent.order] for n in page.nodes[1:] if kept[n.order])


def test_page_edges(spark):
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "plain text"), (4, "u", "<article><p>a &amp; b&nbsp;<b>c<p>d <br>e"), (5, "u", "<p" * 2000),
        (6, "u", "<div>" * 3000 + "x"), (7, "u", "<script>var a='</p>'"), (None, "u", "<!-- never closed"), (4, "u", "<article><p>a &amp; b&nbsp;<b>c<p>d <br>e"),
        (8, "u", "<article>" + f"<p>{words(5, 20_000)}</p></article>"),
    ]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, __id int, text string")
    got = html_extract.main_texts(pages).collect()
    assert sorted((r.page_id or 0) for r in got) == sorted((r[0] or 0) for r in rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[7] == by[None] == "" and by[8] == words(5, 20_000)
    assert by[4] == "a & b c\n\nd e"
    assert html_extract.main_texts(pages.limit(0)).count() == 0


def test_likeness_of_siblings_has_one_rule_for_any_number():
    place = len(html_extract.TAGS) + html_extract.N_UP + 7  # the share of siblings with the node's tag
    for n in (10, 300):
        page = html_extract.parse("<html><body>" + "<p>some words</p><ul><li>x</li></ul>" * (n // 2) + "</body></html>")
        rows = html_extract.features(page)
        shares = {rows[node.order, place] for node in page.nodes if node.tag in ("p", "ul")}
        assert shares == {0.5}
