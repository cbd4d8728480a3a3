"""Personal data, secrets, syncmers and repeated lines against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from leaksafe.llm import line_winnow, pii, queries, secret_scan, syncmers
from tests.llm.cases import SCHEMA, edge_rows, words

SF = "/root/testdata/sf0.001"
SHA = lambda spans: hashlib.sha256(",".join(spans).encode()).hexdigest()


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, edge):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.select("doc_id", "text", "source").union(edge.select(F.col("doc_id") + 10_000_000, "text", "source"))


def luhn(d: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_pii(t: str) -> dict[str, list[tuple[int, int]]]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, t) if ok(m[0])] for k, (p, ok) in rules.items()}


def test_personal_data(texts):
    got = {(r.doc_id, r.base_sha256): r for r in pii.personal_data(texts).collect()}
    for r in texts.collect():
        want = plain_pii(r.text or "")
        base = [f"{k}:{a}:{b}" for k in want for a, b in want[k]]
        row = got[r.doc_id, SHA(base)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(want[k]) for k in want]
        assert set(base) <= set(row.spans.split(","))


def test_classifier_accepts_contextual_spans(spark):
    lines = [f"Please contact Dr. Anna Miller{i % 7}, phone 0301 {200 + i % 700} 4455." for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    added = pii.find_pii(docs).select(F.explode("spans.kind").alias("k")).groupBy("k").count().collect()
    assert {r.k for r in added} >= {"name"}


def test_redact(spark):
    docs = spark.createDataFrame([(1, "😀 mail a@b.co, +1 (555) 222-3333"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()} == {1: "😀 mail [email], [phone]", 2: ""}


def test_em_finds_the_unreliable_labeler():
    def code(v):
        out = 0
        for x in v:
            out = out * 3 + x
        return out

    # Four labelers agree on 900 spans and reject 100; the last one votes at random.
    cells = [("name", code([2, 2, 2, 2, 2 * (i % 2)]), 1, 450) for i in range(2)]
    cells += [("name", code([0, 0, 0, 0, 2 * (i % 2)]), 2, 50) for i in range(2)]
    model = pii.fit(cells)
    good, bad = model.reliability[0], model.reliability[4]
    assert good[0][2] > 0.9 and good[1][2] < 0.1 and abs(bad[0][2] - bad[1][2]) < 0.2
    assert model.probability["name", 1] > 0.9 > 0.1 > model.probability["name", 2]


def plain_secrets(t: str) -> list[tuple[int, int, str]]:
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, t) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_secrets(texts):
    got = {(r.doc_id, r.base_sha256): r for r in secret_scan.secrets(texts).collect()}
    for r in texts.collect():
        want = plain_secrets(r.text or "")
        row = got[r.doc_id, SHA([f"{k}:{a}:{b}" for a, b, k in want])]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == x for *_, x in want) for k in ("assign", "access", "hex")]


def test_ownership_separates_copied_from_live(spark):
    rows = [(i, 'token = "6faa5144d6efe535fe937a88"', f"repo{i}") for i in range(4)]
    rows += [(9, "password=Zx81kkPq02LmW", "repo1"), (10, "secret: token:abcdefgh", "repo2"), (11, "ghp_" + "a1B2" * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: [(s.kind, s.verdict) for s in r.spans] for r in secret_scan.scan_secrets(docs).collect()}
    assert got[0] == [("assign", "example"), ("hex", "example")]
    assert got[9] == [("assign", "live")] and got[10] == [] and got[11] == [("provider", "live")]


def plain_words(t: str) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]


def test_edited_fingerprints(spark, texts):
    rows = sorted(((r.doc_id, r.text or "") for r in texts.collect() if r.doc_id is not None), key=lambda r: r[0])
    got = [r for r in syncmers.edited_fingerprints(texts).collect() if r.doc_id is not None]
    assert len(got) == len(rows)
    edited = {}
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        cut = len(t) // 4
        edited.setdefault(i, set()).add(hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest())
    for r in got:
        assert r.edited_sha256 in edited[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    same = {}
    for r, t in zip(sorted(got, key=lambda r: r.doc_id), [t for _, t in rows], strict=True):
        same.setdefault(t, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_syncmers_are_context_free(spark):
    a, b = words(5, 200), words(6, 50) + " " + words(5, 200) + " " + words(7, 50)
    docs = spark.createDataFrame([(1, a), (2, b), (3, ""), (4, "short text")], "doc_id long, text string")
    got = {r.doc_id: r for r in docs.select("doc_id", syncmers.positions(F.col("text")).alias("p")).collect()}
    mine, theirs = {x["hash"] for x in got[1].p}, {x["hash"] for x in got[2].p}
    assert mine and mine <= theirs and got[3].p == [] and len(got[4].p) == 1
    # Brute force: closed if the smallest inner hash stands at an edge.
    w = plain_words(a)
    mers = [r[0] for r in spark.createDataFrame([(x, y) for x, y in zip(w, w[1:])], "x string, y string").select(F.xxhash64("x", "y")).collect()]
    inner = syncmers.K_WORDS - syncmers.S_WORDS + 1
    want = [i for i in range(len(mers) - inner + 1) if min(mers[i : i + inner]) in (mers[i], mers[i + inner - 1])]
    assert [x["position"] for x in got[1].p] == want
    shift = docs.where("doc_id < 3").groupBy().agg(
        syncmers.matched_offsets(F.element_at(F.collect_list(F.when(F.col("doc_id") == 1, syncmers.positions(F.col("text")))), 1), F.element_at(F.collect_list(F.when(F.col("doc_id") == 2, syncmers.positions(F.col("text")))), 1)).alias("m")
    ).first().m
    assert shift[0]["shift"] == 50


def test_short_texts_have_fingerprints(spark):
    """Every text with words has an anchor, and texts are only alike as far as they share words."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate([*range(1, 30)] * 4)]
    docs = spark.createDataFrame([*rows, (1000, ""), (1001, " \n"), (1002, "one")], "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(docs).collect()}
    for i, t in rows:
        assert got[i].fingerprint and got[i].near_next == 0
        # The last quarter of the characters is another text's; under 12 words all word pairs are compared.
        assert got[i].near_edited > 0 or len(t.split()) < 4 or len(t.split()) >= syncmers.K_WORDS
    assert len({got[i].fingerprint for i, _ in rows}) == len(rows)
    assert got[1000].fingerprint == got[1001].fingerprint == "" and got[1000].near_next == 1 and got[1001].near_next == 0
    plain = docs.select("doc_id", syncmers.fingerprint(syncmers.anchors(F.col("text"))).alias("f")).collect()
    assert all(got[r.doc_id].fingerprint == r.f for r in plain)


def test_next_keys(spark):
    keys = [-(2**62), -5, 0, 1, 2, 4095, 4096, 10**7, 2**62]
    got = {r.k: r["__following"] for r in syncmers.next_keys(spark.createDataFrame([(k,) for k in keys], "k long"), "k").collect()}
    assert got == dict(zip(keys, keys[1:] + keys[:1], strict=True))


def bare(line):
    return re.sub(r"([.,;:!?]\x20|\n)$", "", line).strip(" \n\r\t")


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def plain_words_of(text):
    inner = text.strip(" \n\r\t")
    return inner.count(" ") + inner.count("\n") + 1


def plain_runs(rows, min_words):
    """Texts without every stretch of whole lines of min_words words that an earlier place has too, found by looking at all of them."""
    key = lambda r: (r[0], signed(xxhash.xxh64_intdigest(r[1].encode(), seed=42)))
    first, out = {}, {}
    texts = {r: line_winnow_lines(r[1]) for r in sorted(rows, key=key)}
    for r, split in texts.items():
        h = [bare(x) for x in split]
        gone = set()
        for a in range(len(h)):
            words, b = 0, a
            while b < len(h) and (b == a or words < min_words):
                words, b = words + h[b].count(" ") + 1, b + 1
            # The shortest stretch from a on, and every longer one that still needs its first line for its words.
            while words >= min_words:
                if first.setdefault(tuple(h[a:b]), (r, a)) != (r, a):
                    gone.update(range(a, b))
                if b == len(h) or words - h[a].count(" ") - 1 + h[b].count(" ") + 1 >= min_words:
                    break
                words, b = words + h[b].count(" ") + 1, b + 1
        for x in sorted(gone):
            if x - 1 not in gone:
                b = next(y for y in range(x, len(h) + 1) if y not in gone)
                if plain_words_of("".join(split[x:b])) < min_words:
                    gone -= set(range(x, b))
        out[r] = "".join(x for j, x in enumerate(split) if j not in gone)
    return out


def line_winnow_lines(t: str) -> list[str]:
    out, last = [], 0
    for m in re.finditer(r"(?<=\n)|(?<=[.,;:!?]\x20)", t):
        out.append(t[last : m.start()])
        last = m.start()
    return [*out, t[last:]]


def test_winnowing_guarantee(spark):
    """Equal runs of lines with MIN_WORDS words share a fingerprint wherever they stand, and most lines are none."""
    line = lambda seed, n: words(seed, n).replace(".", "").replace(",", "") + ".\n"
    r = random.Random(5)
    rows, passages = [], []
    for p in range(60):
        sizes = []
        while sum(sizes) < line_winnow.MIN_WORDS:
            sizes.append(r.randint(1, 9))
        passages.append("".join(line(9000 + p * 30 + j, n) for j, n in enumerate(sizes)))
        for side in range(2):
            around = ["".join(line(p * 1000 + side * 500 + k * 50 + j, r.randint(1, 12)) for j in range(r.randint(0, 30))) for k in range(2)]
            rows.append((2 * p + side, around[0] + passages[-1] + around[1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = line_winnow.fingerprints(docs, "doc_id", "text", line_winnow.MIN_WORDS).collect()
    prints = {t["__id"]: {t.h[p] for p in t.prints if p is not None} for t in table}
    for p, passage in enumerate(passages):
        own = {signed(xxhash.xxh64_intdigest(bare(x).encode(), seed=42)) for x in line_winnow_lines(passage)}
        assert prints[2 * p] & prints[2 * p + 1] & own
    assert sum(map(len, prints.values())) < 0.6 * sum(len(t.h) for t in table)
    got = {r.doc_id: r.text for r in line_winnow.dedup_lines(docs).collect()}
    for (i, t), passage in zip(rows, [p for p in passages for _ in range(2)], strict=True):
        assert got[i] == (t if i % 2 == 0 else t.replace(passage, ""))


def test_line_dedup_by_brute_force(spark, monkeypatch):
    """Repeats of all lengths from several sources, also across the blocks of a text."""
    r = random.Random(11)
    pool = [words(i, r.randint(1, 9)).replace(".", "").replace(",", "") for i in range(60)]
    rows = []
    for i in range(150):
        text = [r.choice(pool) if r.random() < 0.3 else words(5000 + i * 100 + j, r.randint(1, 9)) for j in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            a = r.randint(0, 50)
            at = r.randint(0, len(text))
            text[at:at] = pool[a : a + r.randint(1, 9)]
        rows.append((i // 2 if i < 20 else i, "".join(x + r.choice([".\n", ", ", "\n", ". "]) for x in text)))
    rows = sorted({*rows})
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((i, t) for (i, _), t in plain_runs(rows, line_winnow.MIN_WORDS).items())
    for block in (line_winnow.BLOCK, 7):
        monkeypatch.setattr(line_winnow, "BLOCK", block)
        assert sorted((r.doc_id, r.text) for r in line_winnow.dedup_lines(docs).collect()) == want
    assert want != rows


def test_windows_take_few_steps(spark):
    r = random.Random(9)
    rows = [[r.choice([1, 1, 2, 3, 7, 19, 20]) for _ in range(k)] for k in (0, 1, 2, 30, 200)] + [[1] * 60, [20] * 5, [19, 1], [19]]
    rows = [([r.randrange(-(2**63), 2**63) for _ in n], n) for n in rows]
    docs = spark.createDataFrame(rows, "h array<long>, n array<byte>")
    for most in (1, 3, 20):
        size = line_winnow.window_lengths(F.col("n"), most)
        # No window's lines are summed one by one.
        assert "aggregate(" not in str(size)
        for x in docs.select("h", "n", size.alias("size"), line_winnow.fingerprint_lines(F.col("h"), F.col("n"), size, most).alias("at")).collect():
            for i in range(len(x.n)):
                m = next((m for m in range(1, len(x.n) - i + 1) if sum(x.n[i:i + m]) >= most), 0)
                rank = lambda k: (x.n[k], (x.h[k] % 2**64 >> 18), k)  # noqa: E731, B023
                assert x.size[i] == m and x.at[i] == (max(range(i, i + m), key=rank) if m else None)


def test_both_cuts_agree(spark, edge):
    docs = spark.createDataFrame([(t,) for t in ("", "\n", "a, \nb", "a.  b\n", ".. x", "\n\nx. ", "a,b", ", ")], "text string")
    for df in (docs, edge.where("text is not null")):
        for r in df.select("text", line_winnow.lines(F.col("text")).alias("a"), line_winnow.line_hashes(F.col("text")).alias("b")).collect():
            assert len(r.a) == len(r.b) and "".join(r.a) == r.text


def test_line_dedup_edges(edge, spark):
    got = line_winnow.dedup_lines(edge)
    assert got.columns == [*edge.columns, "lines_cut"]
    kept = {}
    for r in got.collect():
        kept.setdefault(r.doc_id, []).append(r)
    base = edge_rows()
    assert [r.text for r in kept[0]] == [None] and [r.text for r in kept[1]] == [""]
    # Of the copies of one text the first stays whole; all whole lines of the others go.
    assert sorted(len(r.text or "") for i in (4, 5) for r in kept[i])[-1] == len(base[4][1])
    assert sum(r.text == base[4][1] for i in (4, 5) for r in kept[i]) == 1
    # Five equal paragraphs in one text leave one.
    assert kept[13][0].text.count(words(3, 30)) == 1


def test_line_dedup_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.text for r in line_winnow.dedup_lines(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_runs(rows, line_winnow.MIN_WORDS)
    assert {i for i, t in rows if got[i] != t}
    assert got == {i: t for (i, _), t in want.items()}


def plain_passages(rows, min_words):
    """Texts without the later repeats: every run of whole lines of min_words words, and every three lines, that stand earlier too."""
    key = lambda r: (r[0], signed(xxhash.xxh64_intdigest(r[1].encode(), seed=42)))
    seen, out = set(), {}
    for r in sorted(rows, key=key):
        split = line_winnow_lines(r[1])
        h = [bare(x) for x in split]
        gone, tied, n = set(), set(), len(h)
        for a in range(n):
            # Brute force over the lengths up to three; longer runs are made of these.
            for b in range(a + 1, min(n, a + 3) + 1):
                if b - a == 3 or sum(x.count(" ") + 1 for x in h[a:b]) >= min_words:
                    if tuple(h[a:b]) in seen:
                        gone.update(range(a, b))
                        tied.update(range(a + 1, b))
                    seen.add(tuple(h[a:b]))
        for x in sorted(gone - tied):
            b = next(y for y in range(x + 1, n + 1) if y not in tied)
            if plain_words_of("".join(split[x:b])) < min_words:
                gone -= set(range(x, b))
        out[r[0]] = "".join(x for j, x in enumerate(split) if j not in gone)
    return out


def test_passages_of_few_lines_are_cut(spark):
    line = lambda seed, n: words(seed, n).replace(".", "").replace(",", "") + ".\n"
    for lines in ([52], [30, 25], [10, 30, 12], [12] * 4, [10] * 5, [9] * 6, [8] * 7):
        passage = "".join(line(500 + j, n) for j, n in enumerate(lines))
        rows = [(i, line(i * 9, 15) + line(i * 9 + 1, 7) + passage + line(i * 9 + 2, 11)) for i in range(12)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.text for r in line_winnow.dedup_lines(docs).collect()}
        assert got == {i: t if i == 0 else t.replace(passage, "") for i, t in rows}


def test_line_dedup_cuts_every_repeated_passage(spark):
    got = {r.doc_id: r.text for r in queries.QUERIES["op9_line_dedup"](spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == plain_passages(rows, line_winnow.MIN_WORDS)
    # Whatever run of whole lines of 50 words a later text holds, no earlier one does.
    seen = set()
    for i, _ in sorted(rows):
        own = [bare(x) for x in line_winnow_lines(dict(rows)[i])]
        left = [bare(x) for x in line_winnow_lines(got[i])]
        for h, check in ((left, True), (own, False)):
            for a in range(len(h)):
                n, b = 0, a
                while b < len(h) and n < 50:
                    n, b = n + h[b].count(" ") + 1, b + 1
                if n >= 50 and check:
                    assert tuple(h[a:b]) not in seen
                elif n >= 50:
                    seen.add(tuple(h[a:b]))


def test_a_text_of_equal_lines(spark):
    """Work and memory grow with the lines of a text, not with their square."""
    row = "| none | none | none |\n"
    rows = [(1, row * 30_000 + "end of the first"), (2, row * 30_000 + "end of the second"), (3, "\n" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_winnow.dedup_lines(docs).collect()}
    assert got == {1: row + "end of the first", 2: "end of the second", 3: "\n" * 30_000}


def test_empty_tables(spark, edge):
    none = edge.limit(0)
    for build in (pii.personal_data, secret_scan.secrets, syncmers.edited_fingerprints, line_winnow.dedup_lines):
        assert build(none).count() == 0


def test_registered(spark):
    for name in ("op2_personal_data", "op3_secrets", "op9_line_dedup", "op10_fingerprints"):
        assert queries.QUERIES[name](spark, SF).count() == 200
