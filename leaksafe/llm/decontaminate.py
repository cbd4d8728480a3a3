"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into half-overlapping passages. A randomised SVD of TF-IDF passages, those of the benchmark and of all
documents, gives a latent space. What it needs of the documents is how often two words of the benchmark share a passage:
whole numbers, counted where the documents lie and added up, no more of them than pairs of a block's words. Every passage
of every document is compared with every benchmark passage by cosine there, and each close pair goes through an exact
check: the longest common subsequence of words around the passage, and the presence of the item's answer, its last words.
Both find paraphrases that change, drop or insert words.

Words outside the benchmark cannot take part in a match, so documents are reduced to the places of benchmark words once,
and all later steps work on these. The benchmark is taken in blocks of `BLOCK_PASSAGES` passages, which bounds what is
sent to executors; every document meets every block.

Cases: null or empty text is clean; benchmark rows with null id or without words are passed over; items longer than
`PASSAGE_WORDS` are cut into passages, each of which counts; equal items are all reported; repeated rows are judged
alike; an empty table or benchmark gives an empty or an all-clean result; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import written

WORD = re.compile(r"\w+")
PASSAGE_WORDS = 64
BLOCK_PASSAGES = 512
HALF = 16  # words in half a document passage
RANK_ABOVE = 56  # dimensions beyond one per benchmark passage
PAIRS_HELD = 1 << 21  # pairs of words a task holds before it adds them up
DENSE_PAIRS = 1 << 24  # largest table of pairs of words a task keeps whole instead
SVD_ROWS = 256  # words whose pairs are multiplied at a time
MIN_COSINE = 0.45
LIGHT = math.log(5)
MIN_COMMON = 0.6
SURE_COMMON = 0.8
ANSWER_WORDS = 5


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class Block:
    """Some benchmark passages over their common vocabulary."""

    items: list[str]  # item id of each passage
    passages: list[np.ndarray]  # word numbers
    vocabulary: dict[str, int]

    def matrix(self, weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.passages), len(self.vocabulary)))
        for row, p in zip(out, self.passages, strict=True):
            np.add.at(row, p, 1.0)
        return out * weight


def blocks_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Block]:
    """The benchmark in blocks, streamed in order of id; a block is all that is held at a time."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    items: list[str] = []
    texts: list[list[str]] = []

    def block() -> Block:
        vocabulary: dict[str, int] = {}
        coded = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t], dtype=np.int64) for t in texts]
        return Block(list(items), coded, vocabulary)

    for row in rows.orderBy("i", "t").toLocalIterator():
        found = words(row["t"])
        parts = max(1, math.ceil(len(found) / PASSAGE_WORDS))
        size = math.ceil(len(found) / parts)
        for a in range(0, len(found), size or 1):
            items.append(row["i"])
            texts.append(found[a : a + size])
        if len(items) >= BLOCK_PASSAGES:
            yield block()
            items, texts = [], []
    if items:
        yield block()


def _reduce(held):
    """(row, id, text) to the places of benchmark words: (row, id, n, place, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for batch in batches:
            counts, places, numbers = [], [], []
            for text in batch.column(2):
                found = words(text.as_py() or "")
                coded = np.fromiter(map(get, found, repeat(-1)), np.int32, len(found))
                at = np.flatnonzero(coded >= 0).astype(np.int32)
                counts.append(len(found))
                places.append(at)
                numbers.append(coded[at])
            ends = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32)
            flat = lambda a: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(a) if a else np.zeros(0, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int32()), flat(places), flat(numbers)],
                ["__row", "__id", "n", "place", "word"],
            )

    return run


def occupied(n: int, place: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passages of a text of n words that hold one of the places, and the sums of `values` over them.

    A passage is two neighbouring stretches of HALF words; a single stretch stands alone.
    """
    half = place // HALF
    first = np.flatnonzero(np.concatenate([[True], half[1:] != half[:-1]]))
    halves, sums = half[first], np.add.reduceat(values, first, axis=0)
    last = max(-(-n // HALF) - 2, 0)
    if halves[-1] - halves[0] == len(halves) - 1:  # nothing between them
        out = np.zeros((len(halves) + 1, values.shape[1]), values.dtype)
        out[1:] = sums
        out[:-1] += sums
        a, b = max(halves[0] - 1, 0), min(halves[-1], last) + 1
        return np.arange(a, b), out[a - halves[0] + 1 : b - halves[0] + 1]
    numbers = np.unique(np.concatenate([halves - 1, halves]))
    numbers = numbers[(numbers >= 0) & (numbers <= last)]
    out = np.zeros((len(numbers), values.shape[1]), values.dtype)
    for p in (numbers, numbers + 1):
        at = np.minimum(np.searchsorted(halves, p), len(halves) - 1)
        there = halves[at] == p
        out[there] += sums[at[there]]
    return numbers, out


def _paired(n: np.ndarray, size: np.ndarray, place: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of words in one passage as (word, word, weight), over texts of n words with `size` places each.

    Added up, the weight of two words is the product of their counts in a passage, summed over passages; that of a word with
    itself the sum of the squares.
    """
    halves = np.maximum(-(-n.astype(np.int64) // HALF), 1)
    text = np.repeat(np.arange(len(n)), size)
    half = place // HALF
    # Stretches of all texts on one line, two apart from one text to the next.
    at = half + (np.cumsum(halves + 2) - halves)[text]
    # Two passages hold a stretch, one at either end of a text.
    passages = np.where((half > 0) & (half < halves[text] - 1), 2, 1)
    yield word, word, passages
    left = np.arange(len(word))
    for step in range(1, 2 * HALF):
        left = left[left + step < len(word)]
        left = left[at[left + step] - at[left] <= 1]
        if not len(left):
            return
        one, other = word[left], word[left + step]
        weight = np.where(at[left + step] == at[left], passages[left], 1)
        yield np.minimum(one, other), np.maximum(one, other), np.where(one == other, 2 * weight, weight)


def _listed(keys: np.ndarray, counts: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    """Counts of pairs, keys rising, as (one, others, counts): a row for each first word."""
    one, other = numbers[keys // len(numbers)], numbers[keys % len(numbers)]
    first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]]))
    ends = pa.array(np.append(first, len(one)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((other, pa.int32()), (counts, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(one[first], pa.int32()), *lists], ["one", "others", "counts"])


def _count_pairs(held):
    """(n, place, word) to how often two words of weight share a passage, added up for a task, or for PAIRS_HELD pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.flatnonzero(held.value)
        size = len(numbers)
        coded = np.full(len(held.value), -1)
        coded[numbers] = np.arange(size)
        table = np.zeros(size * size, np.int64) if size * size <= DENSE_PAIRS else None
        keys, weights, waiting = [], [], 0

        def added() -> pa.RecordBatch:
            own, at = np.unique(np.concatenate(keys), return_inverse=True)
            # Sums of whole numbers below 2^53 are exact.
            return _listed(own, np.bincount(at, np.concatenate(weights)).astype(np.int64), numbers)

        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                places = part.column(1)
                place, word = places.flatten().to_numpy().astype(np.int64), coded[part.column(2).flatten().to_numpy()]
                sizes = np.diff(places.offsets.to_numpy())
                seen = word >= 0
                told = np.bincount(np.repeat(np.arange(len(sizes)), sizes), seen, len(sizes)).astype(np.int64)
                for one, other, weight in _paired(part.column(0).to_numpy(), told, place[seen], word[seen]):
                    if table is not None:
                        np.add.at(table, one * size + other, weight)
                        continue
                    keys.append(one * size + other)
                    weights.append(weight)
                    waiting += len(one)
                    if waiting >= PAIRS_HELD:
                        yield added()
                        keys, weights, waiting = [], [], 0
        if waiting:
            yield added()
        if table is not None and (own := np.flatnonzero(table)).size:
            yield _listed(own, table[own], numbers)

    return run


def _merge_pairs(size: int):
    """(one, others, counts), sorted by the first word, with the counts of each pair added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, at, total = np.arange(size), -1, np.zeros(size, np.int64)

        def row() -> pa.RecordBatch:
            others = np.flatnonzero(total)
            return _listed(at * size + others, total[others], numbers)

        for batch in batches:
            for one, others, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if one != at:
                    if at >= 0:
                        yield row()
                    at = one
                    total[:] = 0
                total[others.values.to_numpy()] += counts.values.to_numpy()
        if at >= 0:
            yield row()

    return run


def _times(held, basis: np.ndarray):
    """Pairs of a task times a basis: its part of A'A basis, A the TF-IDF passages of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = held.value
        scaled = basis * weight[:, None]
        total = np.zeros(basis.shape)
        for batch in batches:
            for a in range(0, batch.num_rows, SVD_ROWS):
                part = batch.slice(a, SVD_ROWS)
                own, others = part.column(0).to_numpy(), part.column(1)
                rows = np.zeros((len(own), len(weight)))
                rows[np.repeat(np.arange(len(own)), np.diff(others.offsets.to_numpy())), others.flatten().to_numpy()] = part.column(2).flatten().to_numpy()
                total[own] += rows @ scaled
                # A pair is listed under its first word only.
                rows[np.arange(len(own)), own] = 0
                total += rows.T @ scaled[own]
        yield pa.RecordBatch.from_arrays([pa.array([(total * weight[:, None]).tobytes()], pa.binary())], ["part"])

    return run


PAIRS = "one int, others array<int>, counts array<long>"


def word_pairs(hits: DataFrame, weight: np.ndarray) -> DataFrame:
    """(one, others, counts) over all documents: how often two words of weight share a passage, a row for the first of both."""
    held = hits.sparkSession.sparkContext.broadcast(weight > 0)
    parts = hits.select("n", "place", "word").mapInArrow(_count_pairs(held), PAIRS)
    return parts.repartition("one").sortWithinPartitions("one").mapInArrow(_merge_pairs(len(weight)), PAIRS)


def latent_space(hits: DataFrame, block: Block, weight: np.ndarray, seed: int = 5) -> np.ndarray:
    """Orthonormal right singular vectors (vocabulary x rank) of the TF-IDF passages by a randomised range finder.

    The benchmark's own passages weigh as much in total as those of the documents. The documents are read once; each step
    goes over pairs of words and sums one small matrix per task.
    """
    spark = hits.sparkSession
    rank = min(len(block.vocabulary), len(block.passages) + RANK_ABOVE)
    pairs = written(word_pairs(hits, weight))
    held = spark.sparkContext.broadcast(weight)
    own = block.matrix(weight)

    def corpus(basis: np.ndarray) -> np.ndarray:
        parts = pairs.mapInArrow(_times(held, basis), "part binary").toLocalIterator()
        return sum((np.frombuffer(bytes(r["part"])).reshape(basis.shape) for r in parts), np.zeros(basis.shape))

    def joined(mine: np.ndarray, theirs: np.ndarray, size) -> np.ndarray:
        return mine / max(size(mine), 1e-12) + theirs / max(size(theirs), 1e-12)

    start = np.random.default_rng(seed).normal(size=(len(block.vocabulary), rank))
    q, _ = np.linalg.qr(joined(own.T @ (own @ start), corpus(start), lambda m: np.abs(m).sum()))
    y = own @ q
    values, vectors = np.linalg.eigh(joined(y.T @ y, q.T @ corpus(q), np.trace))
    return q @ vectors[:, np.argsort(-values)]


def common(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per item word."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in region.tolist():
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def judge(item: np.ndarray, place: np.ndarray, word: np.ndarray, start: int, stop: int) -> float:
    """The share of the item found in order around the places start .. stop, 0 if too little or without its answer."""
    n = len(item)
    a, b = np.searchsorted(place, [start - n // 2, stop + n // 2])
    region = word[a:b]
    # No more of the item is in order than is there at all.
    there = np.zeros(max(item.max(), region.max(initial=0)) + 1, bool)
    there[region] = True
    if np.count_nonzero(there[item]) / n < MIN_COMMON:
        return 0.0
    share = common(item, region) / n
    if share < MIN_COMMON:
        return 0.0
    answer = item[-ANSWER_WORDS:]
    found = common(answer, region) >= math.ceil(MIN_COMMON * len(answer))
    return share if share >= SURE_COMMON or found else 0.0


def shares(n: int, place: np.ndarray, word: np.ndarray, state) -> dict[str, float]:
    """The items of a block found in a document, with the share of each."""
    items, queries, basis, coded, heavy = state
    hits: dict[str, float] = {}
    telling = heavy[word]
    if telling.any():
        for numbers, scores in _scored(n, place[telling], word[telling], basis, queries):
            for p, k in zip(*np.nonzero(scores >= MIN_COSINE), strict=True):
                if hits.get(items[k], 0.0) < 1.0:
                    at = int(numbers[p]) * HALF
                    share = judge(coded[k], place, word, at, at + 2 * HALF)
                    if share > hits.get(items[k], 0.0):
                        hits[items[k]] = share
    return hits


def _search(held):
    """(row, id, n, place, word) to (row, id, items, share)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                shares(n, place.values.to_numpy(), word.values.to_numpy(), held.value)
                for n, place, word in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([sorted(h) for h in found], pa.list_(pa.string())),
                    pa.array([max(h.values(), default=0.0) for h in found], pa.float64()),
                ],
                ["__row", "__id", "items", "share"],
            )

    return run


def _keep(held, vocabulary):
    """Whole rows, the text last, without those that hold an item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in batch.column(batch.num_columns - 1):
                coded = np.array([vocabulary.value.get(w, -1) for w in words(text.as_py() or "")], dtype=np.int32)
                at = np.flatnonzero(coded >= 0).astype(np.int32)
                kept.append(not shares(len(coded), at, coded[at], held.value))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return run


def _scored(n: int, place: np.ndarray, word: np.ndarray, basis: np.ndarray, queries: np.ndarray, step: int = 2048):
    """Numbers of the passages that hold a place, and their cosines with all queries.

    In stretches of `step` halves, so that a long text needs little memory.
    """
    halves = max(1, -(-n // HALF))
    for a in range(0, max(halves - 1, 1), step):
        b = min(halves, a + step + 1)
        i, j = np.searchsorted(place, [a * HALF, b * HALF])
        if i == j:
            continue
        numbers, z = occupied(min(n, b * HALF) - a * HALF, place[i:j] - a * HALF, basis[word[i:j]])
        z /= np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-9)[:, None]
        yield a + numbers, z @ queries


def light_words(block: Block, weight: np.ndarray) -> np.ndarray:
    """Words too common to tell passages apart, which vectors leave out: those in over a fifth of the documents.

    A passage that would lose over half of its words, as one copied into much of the corpus does, keeps them all.
    """
    light = weight < LIGHT
    common = light.copy()
    for p in block.passages:
        own = np.unique(p)
        if common[own].mean() > 0.5:
            light[own] = False
    return light


def prepared(rows: DataFrame, block: Block):
    """(hits, vocabulary, state): the documents' benchmark words, and what a search for the block needs, as broadcasts."""
    spark = rows.sparkSession
    vocabulary = spark.sparkContext.broadcast(block.vocabulary)
    hits = written(rows.mapInArrow(_reduce(vocabulary), "__row long, __id long, n int, place array<int>, word array<int>"))
    total = hits.count()
    # One row per word of the block.
    seen = hits.select(F.explode(F.array_distinct("word")).alias("w")).groupBy("w").count().collect()
    df = np.zeros(len(block.vocabulary))
    for r in seen:
        df[r["w"]] = r["count"]
    weight = np.maximum(np.log((total + 1) / (df + 0.5)), 0.05)
    weight[light_words(block, weight)] = 0
    basis = latent_space(hits, block, weight)
    queries = block.matrix(weight) @ basis
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    scaled = (basis * weight[:, None]).astype(np.float32)
    state = spark.sparkContext.broadcast((block.items, queries.T.astype(np.float32).copy(), scaled, block.passages, weight > 0))
    return hits, vocabulary, state


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    return rows.select(F.monotonically_increasing_id().alias("__row"), "__id", "__text")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: `__row`, id, `items` (ids found, sorted) and `share`, the largest part of an item found in order."""
    rows = _numbered(docs, id_col, text_col)
    out, n_blocks = None, 0
    for block in blocks_of(benchmark, item_col, item_text_col):
        hits, _, state = prepared(rows, block)
        part = hits.mapInArrow(_search(state), "__row long, __id long, items array<string>, share double")
        out, n_blocks = part if out is None else out.unionByName(part), n_blocks + 1
    if out is None:
        return rows.select("__row", "__id", F.array().cast("array<string>").alias("items"), F.lit(0.0).alias("share"))
    if n_blocks == 1:
        return out
    # Row numbers are those of the files read, the same in every block's pass; each row's id goes along.
    return out.groupBy("__row", "__id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("share").alias("share"))


def leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document whether it holds benchmark passages, and which."""
    found = find_leaks(docs, benchmark)
    return found.select(
        F.col("__id").alias("doc_id"), (F.size("items") > 0).alias("contaminated"),
        F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"), "share",
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows that hold benchmark passages: one pass over whole rows for each block, no join."""
    out = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)], F.col(text_col).cast("string").alias("text"))
    shape = out.schema
    for block in blocks_of(benchmark):
        _, vocabulary, state = prepared(_numbered(docs, id_col, text_col), block)
        out = out.mapInArrow(_keep(state, vocabulary), shape)
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
