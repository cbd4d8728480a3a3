"""Toxicity by averaged subword embeddings and a linear softmax, trained together in numpy.

A word is the mean of the embeddings of its character 3- to 5-grams and of itself, hashed to a fixed table, so that a
misspelling shares most of its vector with the word it hides. A run of letters longer than `PIECE` counts as half-overlapping
pieces, each a word of its own, so that text without blanks is read whole and a toxic piece weighs as a word does. A bag is the mean over a short stretch of words, and a
linear softmax scores it. A text of any length is judged by a soft maximum over its bags, and so is every training text:
its label says that some stretch is toxic, not which one.

Training takes a bounded sample of labelled rows, `SAMPLE_ROWS` per class, those with the smallest hash of their id.

Cases: a null or empty text has one bag of no words, scored by the bias alone; repeated rows are scored alike; several
labels of one id count as toxic if one is; without labels of both classes every score is 0; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import written

BUCKETS = 1 << 17
DIM = 16
BAG = 3
SAMPLE_ROWS = 2000
ROUNDS = 120
RATE = 0.05
DECAY = 0.02
MIN_TEXTS = 5
#: Words of a training text that are read; longer ones are left out of the sample whole.
SAMPLE_WORDS = 4000
CACHE_WORDS = 400_000
#: Words that are hashed at once.
SUBWORD_WORDS = 1 << 15
WORD = re.compile(r"\w+")
PIECE = 40


def subwords(word: str) -> list[int]:
    """Buckets of the word and its character 3- to 5-grams."""
    marked = f"<{word}>"
    parts = {marked} | {marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)}
    return [zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in sorted(parts)]


def _crc_table() -> np.ndarray:
    """The 256 steps of CRC-32, as `zlib.crc32` takes them byte by byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def many_subwords(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """`subwords` of all words one after another, and how many each has. ASCII words are hashed all at once.

    A part of a word is a number: the word's place, its up to five bytes, and a last bit for a whole word of more bytes, which
    sorts as the parts do. So one sort puts the parts of every word in order and repeats side by side. Many words go in stretches.
    """
    if len(found) > SUBWORD_WORDS:
        flat, counts = zip(*[many_subwords(found[a : a + SUBWORD_WORDS]) for a in range(0, len(found), SUBWORD_WORDS)], strict=True)
        return np.concatenate(flat), np.concatenate(counts)
    plain = [w.isascii() for w in found]
    marked = [f"<{w}>".encode() for w, ok in zip(found, plain, strict=True) if ok]
    place = np.flatnonzero(plain)
    sizes = np.zeros(len(found), np.int64)
    lengths = np.array([len(m) for m in marked], dtype=np.int64)
    text = np.frombuffer(b"".join(marked) + bytes(5), np.uint8)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at, owner = np.arange(len(text) - 5), np.repeat(np.arange(len(marked)), lengths)
    state, key = np.full(len(at), 0xFFFFFFFF, np.uint32), np.zeros(len(at), np.uint64)
    keys, hashes = [], []
    for n in range(1, 6):
        byte = text[n - 1 : n - 1 + len(at)]
        state = CRC[(state ^ byte) & 0xFF] ^ (state >> np.uint32(8))
        key = key | (byte.astype(np.uint64) << np.uint64(8 * (5 - n) + 1))
        if n >= 3:
            whole = at + n <= ends
            keys.append((owner[whole].astype(np.uint64) << np.uint64(41)) | key[whole])
            hashes.append(~state[whole])
            if n == 5:  # a whole word stands behind its own beginnings
                long = np.flatnonzero(lengths > 5)
                first = (np.cumsum(lengths) - lengths)[long]
                keys.append((long.astype(np.uint64) << np.uint64(41)) | key[first] | np.uint64(1))
                hashes.append(np.array([zlib.crc32(marked[i]) for i in long.tolist()], dtype=np.uint32))
    keys, order = np.unique(np.concatenate(keys), return_index=True)
    buckets = (np.concatenate(hashes)[order] % BUCKETS).astype(np.int64)
    sizes[place] = np.bincount((keys >> np.uint64(41)).astype(np.int64), minlength=len(marked))
    if all(plain):
        return buckets, sizes
    parts, rest = iter(np.split(buckets, np.cumsum(sizes[place])[:-1])), []
    for i, word in enumerate(found):
        rest.append(next(parts) if plain[i] else np.array(subwords(word), dtype=np.int64))
        sizes[i] = len(rest[-1])
    return np.concatenate(rest), sizes


def words(text: str | None) -> list[str]:
    runs = WORD.findall(text.lower()) if text else []
    return runs if max(map(len, runs), default=0) <= PIECE else [piece for run in runs for piece in pieces(run)]


def pieces(run: str) -> list[str]:
    """A run of up to PIECE characters whole, a longer one in stretches of PIECE that overlap by half."""
    step = PIECE // 2
    return [run] if len(run) <= PIECE else [run[a : a + PIECE] for a in range(0, len(run) - step, step)]


def bag_bounds(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Half-overlapping stretches of BAG words that cover all n words."""
    step = max(1, BAG // 2)
    starts = np.arange(0, max(n - BAG + step, 1), step)
    return starts, np.minimum(starts + BAG, n)


@dataclass
class Classifier:
    embeddings: np.ndarray  # BUCKETS x DIM
    weight: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2
    sharpness: float

    def word_margins(self, subs: list[list[int]]) -> np.ndarray:
        """The class margin of each word: its mean embedding against the two softmax rows."""
        return self.margins(np.concatenate([np.array(s) for s in subs]), np.array([len(s) for s in subs]))

    def margins(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same of words given as `many_subwords` gives them."""
        per_bucket = self.embeddings[flat] @ (self.weight[:, 1] - self.weight[:, 0])
        return np.add.reduceat(per_bucket, np.concatenate([[0], np.cumsum(sizes)[:-1]])) / sizes

    def document(self, margins: np.ndarray) -> float:
        """Probability that some bag is toxic, from the margins of the words in order."""
        a, b = bag_bounds(len(margins))
        total = np.concatenate([[0.0], np.cumsum(margins)])
        bags = (total[b] - total[a]) / np.maximum(b - a, 1)
        top = bags.max()
        return float(1 / (1 + np.exp(-np.clip(_soft_max(bags - top, self.sharpness) + top + self.bias[1] - self.bias[0], -500, 500))))


def _soft_max(bags: np.ndarray, sharpness: float) -> float:
    return float(np.log(np.exp(sharpness * bags).mean() + 1e-300) / sharpness) if sharpness < 50 else float(bags.max())


def fit(texts: Iterable[list[str]], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Classifier:
    """Full-batch descent with momentum over embeddings and softmax together; the pooling sharpens from the mean towards the maximum."""
    vocabulary: dict[str, int] = {}
    parts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t], dtype=np.int32) for t in texts]
    lengths = np.array([len(t) for t in parts])
    sequence = np.concatenate(parts)
    subs = [subwords(w) for w in vocabulary]
    sizes = np.array([len(s) for s in subs], dtype=np.int32)
    flat = np.concatenate([np.array(s, dtype=np.int32) for s in subs])
    owner = np.repeat(np.arange(len(subs), dtype=np.int32), sizes)
    edges = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    del subs
    n_words = len(sizes)
    bounds = [bag_bounds(n) for n in lengths]
    offset = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    a = np.concatenate([o + x[0] for o, x in zip(offset, bounds, strict=True)]).astype(np.int32)
    b = np.concatenate([o + x[1] for o, x in zip(offset, bounds, strict=True)]).astype(np.int32)
    per_doc = np.array([len(x[0]) for x in bounds])
    del bounds
    first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    doc_of = np.repeat(np.arange(len(lengths), dtype=np.int32), per_doc)
    width = np.maximum(b - a, 1)
    y = labels.astype(float)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    del parts
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (BUCKETS, DIM))
    # A subword of very few texts says who wrote, not what: it keeps no vector, as do those never seen.
    pairs = np.unique(np.repeat(np.arange(len(lengths)), lengths) * n_words + sequence)
    spread = np.zeros(BUCKETS)
    for own in np.array_split(pairs, max(1, len(pairs) // 50_000)):
        # (text, bucket) pairs, counted once each; a text's pairs may fall in two parts, which counts a bucket twice at most.
        doc, word = own // n_words, own % n_words
        many = sizes[word]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        bucket = flat[np.repeat(edges[word], many) + inside]
        spread += np.bincount(np.unique(np.repeat(doc, many) * BUCKETS + bucket) % BUCKETS, minlength=BUCKETS)
    e[spread < MIN_TEXTS] = 0
    u = rng.normal(0, 0.5, (DIM, 2))
    c = np.zeros(2)
    steps = [[np.zeros_like(p), 1e-12] for p in (e, u, c)]
    sharp = 1.0
    for step in range(1, rounds + 1):
        sharp = 1.0 + 5.0 * step / rounds
        direction = u[:, 1] - u[:, 0]
        # Both the margin of a word and the softmax gradient only need the embeddings' products, never the word vectors.
        margin = np.add.reduceat((e @ direction)[flat], edges) / sizes
        total = np.concatenate([[0.0], np.cumsum(margin[sequence])])
        bags = (total[b] - total[a]) / width
        top = np.maximum.reduceat(bags, first)
        grown = np.exp(sharp * (bags - top[doc_of]))
        sums = np.add.reduceat(grown, first)
        logit = top + np.log(sums / per_doc) / sharp + c[1] - c[0]
        p = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        back = share * (p - y)
        on_bag = back[doc_of] * grown / sums[doc_of] / width
        change = np.bincount(a, on_bag, len(sequence) + 1) - np.bincount(b, on_bag, len(sequence) + 1)
        on_word = np.bincount(sequence, np.cumsum(change)[:-1], n_words)
        on_bucket = np.bincount(flat, (on_word / sizes)[owner], BUCKETS)
        on_bucket[spread < MIN_TEXTS] = 0
        turn = e.T @ on_bucket
        grads = (np.outer(on_bucket, direction), np.stack([-turn, turn], 1), np.array([-back.sum(), back.sum()]))
        # One rate for all buckets: those with much evidence move, those seen in a few texts hardly do.
        for param, grad, held, rate in zip((e, u, c), grads, steps, (RATE, RATE / 4, RATE / 4), strict=True):
            held[1] = max(held[1], float(np.abs(grad).max()))
            held[0] = 0.9 * held[0] + grad / held[1]
            param -= rate * held[0]
        e *= 1 - DECAY
    return Classifier(e.astype(np.float32), u, c, sharp)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    """Fit on at most `sample_rows` labelled texts of each class."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__label"))
    picked = None
    for value in (0, 1):
        own = marked.where(F.col("__label") == value).orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
        picked = own if picked is None else picked.union(own)
    # At most 2 x sample_rows ids: small enough to broadcast.
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(written(picked)), "__id")
    sample = rows.where(F.size(F.split(F.coalesce("__text", F.lit("")), r"\s+", SAMPLE_WORDS + 2)) <= SAMPLE_WORDS).dropDuplicates(["__id"])
    found = sorted((r["__id"], r["__label"], r["__text"]) for r in sample.collect() if r["__text"])
    y = np.array([label for _, label, _ in found])
    if len(set(y.tolist())) < 2:
        return None
    return fit((words(t) for _, _, t in found), y)


def _scorer(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        margins: dict[str, float] = {}
        for batch in batches:
            scores = []
            for text in batch.column(1):
                if model is None:
                    scores.append(0.0)
                    continue
                tokens = words(text.as_py())
                values = list(map(margins.get, tokens))
                if None in values:
                    fresh = [w for w in dict.fromkeys(tokens) if w not in margins]
                    if len(margins) > CACHE_WORDS:
                        margins.clear()
                        fresh = list(dict.fromkeys(tokens))
                    margins.update(zip(fresh, model.margins(*many_subwords(fresh)).tolist(), strict=True))
                    values = list(map(margins.get, tokens))
                scores.append(model.document(np.array(values, dtype=float)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["__id", "score"])

    return run


def score(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score from 0 to 1. The model has a fixed size: BUCKETS x DIM numbers."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(_scorer(held), "__id long, score double").withColumnRenamed("__id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's toxicity by a model of the labelled rows that are not held out."""
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
