"""Language identification by interpolated Kneser-Ney character models.

Training counts the character 4-grams of every labelled text, summed per task before the shuffle; the model of each
language is a set of sorted key arrays with the interpolated log probability of each seen 4-gram and what the lower
orders need for the rest. A text takes the language with the lowest cross-entropy per character. Each model also knows
the mean and spread of its own cross-entropy over the training corpus, which calibrates rejection: a text whose
cross-entropy lies far above what its language shows is in none of the languages.

Cases: a null text, or one without letters, is `und` with score 0 and rejected; equal cross-entropies go to the first
language by name; repeated rows are scored alike; without any labelled text all rows are `und`; an empty table gives an
empty result; only the id, text and language columns are read.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import written

ORDER = 4
BITS = 10
SYMBOLS = 1 << BITS
CHUNK = 2_000_000
#: A text is rejected from this many standard errors above its language's mean, and not below this share of the mean.
REJECT_ERRORS = 12.0
REJECT_SHARE = 0.35


@functools.cache
def _classes() -> np.ndarray:
    """Code point to symbol: 0 for anything but letters, else 1 .. 1023 (exact below 1023, folded above)."""
    points = np.arange(sys.maxunicode + 1)
    folded = np.where(points < SYMBOLS - 1, points, points % (SYMBOLS - 2)) + 1
    letters = np.fromiter((chr(p).isalpha() for p in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return np.where(letters, folded, 0).astype(np.int64)


def symbols(text: str) -> np.ndarray:
    """The lower-case letters of a text as symbols, with a single 0 for whatever stands between words."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    s = _classes()[raw]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    return s[keep]


def grams(s: np.ndarray) -> np.ndarray:
    """A key for every symbol: it and the three before it (0 before the start)."""
    padded = np.concatenate([np.zeros(ORDER - 1, np.int64), s])
    keys = np.zeros(len(s), np.int64)
    for j in range(ORDER):
        keys = (keys << BITS) | padded[j : j + len(s)]
    return keys


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) rows to (lang, key, n) sums of a task."""
    held: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str) -> None:
        # Every text starts anew, so that the counts do not depend on which texts share a task.
        keys, n = np.unique(np.concatenate([grams(symbols(t)) for t in held.pop(lang)]), return_counts=True)
        if lang in sums:
            old, m = sums[lang]
            both, place = np.unique(np.concatenate([old, keys]), return_inverse=True)
            keys, n = both, np.bincount(place, np.concatenate([m, n]), len(both)).astype(np.int64)
        sums[lang] = keys, n
        size[lang] = 0

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            lang = lang.as_py()
            held.setdefault(lang, []).append(text.as_py())
            size[lang] = size.get(lang, 0) + len(held[lang][-1])
            if size[lang] >= CHUNK:
                add(lang)
    for lang in list(held):
        add(lang)
    for lang, (keys, n) in sums.items():
        for a in range(0, len(keys), 100_000):
            part = keys[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part), pa.array(n[a : a + 100_000].astype(np.int64))], ["lang", "key", "n"])


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, key, n): the 4-gram counts of each language over all given texts."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    return rows.mapInArrow(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _seen(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `wanted` in sorted `keys`, and whether each is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Order:
    """One order of a model: discounted probabilities by gram, back-off weights by history."""

    grams: np.ndarray
    share: np.ndarray
    histories: np.ndarray
    backoff: np.ndarray


@dataclass
class LanguageModel:
    orders: list[Order]  # from 1 to ORDER
    mean: float = 0.0
    spread: float = 0.0

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """Natural logs for 4-gram keys."""
        p = np.full(len(keys), 1.0 / SYMBOLS)
        for n, order in enumerate(self.orders, 1):
            wanted = keys & ((1 << (BITS * n)) - 1)
            at, known = _seen(order.histories, wanted >> BITS)
            weight = np.where(known, order.backoff[at], 1.0)
            at, known = _seen(order.grams, wanted)
            p = np.where(known, order.share[at], 0.0) + weight * p
        return np.log(p)


def fit_language(keys: np.ndarray, counts: np.ndarray) -> LanguageModel:
    """Interpolated Kneser-Ney from the sorted 4-gram counts of a language."""
    by_order: list[tuple[np.ndarray, np.ndarray]] = [(keys, counts.astype(float))]
    for n in range(ORDER - 1, 0, -1):
        # Below the highest order a gram counts for the number of distinct symbols seen before it.
        shorter, types = np.unique(by_order[-1][0] & ((1 << (BITS * n)) - 1), return_counts=True)
        by_order.append((shorter, types.astype(float)))
    orders = []
    for grams_, c in reversed(by_order):
        once, twice = float((c == 1).sum()), float((c == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        histories, place = np.unique(grams_ >> BITS, return_inverse=True)
        total = np.bincount(place, c, len(histories))
        kinds = np.bincount(place, minlength=len(histories))
        cut = np.minimum(c, discount)
        orders.append(Order(grams_, (c - cut) / total[place], histories, np.bincount(place, cut, len(histories)) / total if len(total) else kinds))
    model = LanguageModel(orders)
    cost = -model.log_probability(keys)
    model.mean = float(np.average(cost, weights=counts))
    model.spread = math.sqrt(float(np.average((cost - model.mean) ** 2, weights=counts)))
    return model


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", model_rows: int | None = None) -> dict[str, LanguageModel]:
    """A model for each language of the labelled rows, of all its 4-grams.

    Only a caller that sets `model_rows` gets a pruned model, without the rarest 4-grams.
    """
    counts = written(gram_counts(docs, text_col, lang_col))
    if model_rows is not None:
        steps = [1 << j for j in range(48)]
        sizes = counts.agg(*[F.sum(F.when(F.col("n") >= s, 1).otherwise(0)).alias(f"r{s}") for s in steps]).first()
        least = next(s for s in steps if (sizes[f"r{s}"] or 0) <= model_rows)
        counts = counts.where(F.col("n") >= least)
    table = counts.toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    which = names.indices.to_numpy(zero_copy_only=False)
    keys, n = table.column("key").to_numpy(), table.column("n").to_numpy()
    models = {}
    for place, lang in sorted(enumerate(names.dictionary.to_pylist()), key=lambda x: x[1]):
        own = which == place
        order = np.argsort(keys[own])
        models[lang] = fit_language(keys[own][order], n[own][order])
    return models


def _scorer(models, langs: list[str]):
    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per text and language, symbols per text), 0 symbols without letters."""
        coded = [symbols(t) if t else np.zeros(0, np.int64) for t in texts]
        lengths = np.array([len(s) if s.any() else 0 for s in coded])
        out = np.zeros((len(texts), len(langs)))
        if not lengths.any():
            return out, lengths
        keys = np.concatenate([grams(s) for s, n in zip(coded, lengths, strict=True) if n])
        distinct, place = np.unique(keys, return_inverse=True)
        ends = np.cumsum(lengths[lengths > 0])
        starts = ends - lengths[lengths > 0]
        for j, lang in enumerate(langs):
            cost = -models.value[lang].log_probability(distinct)
            out[lengths > 0, j] = np.add.reduceat(cost[place], starts) / lengths[lengths > 0]
        return out, lengths

    def chosen(texts: list[str | None]) -> list[pa.Array]:
        cost, n = score(texts)
        pred, confidence, rejected, best = [], [], [], []
        for row, size in zip(cost, n, strict=True):
            if not size or not langs:
                pred.append("und"), confidence.append(0.0), rejected.append(True), best.append(None)
                continue
            k = int(row.argmin())
            model = models.value[langs[k]]
            # Neighbouring symbols are not independent: a text of n symbols counts as n / 4 draws.
            draws = max(1.0, size / 4)
            share = np.exp(-(row - row[k]) * min(draws, 50.0))
            pred.append(langs[k])
            confidence.append(float(share[k] / share.sum()))
            limit = model.mean * (1 + REJECT_SHARE) + REJECT_ERRORS * model.spread / math.sqrt(draws)
            rejected.append(bool(row[k] > limit))
            best.append(float(row[k]))
        return [pa.array(pred, pa.string()), pa.array(confidence, pa.float64()), pa.array(rejected, pa.bool_()), pa.array(best, pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each batch with its text, the last column, replaced by the results; texts are scored in stretches of CHUNK characters."""
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            a, size = 0, 0
            for b in range(1, batch.num_rows + 1):
                size += len(texts[b - 1].as_py() or "")
                if size >= CHUNK or b == batch.num_rows:
                    part = batch.slice(a, b - a)
                    columns = [*part.columns[:-1], *chosen(part.column(batch.num_columns - 1).to_pylist())]
                    yield pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])
                    a, size = b, 0

    return run


RESULT = ("lang_pred", "score", "rejected", "cross_entropy")
_TYPES = ("string", "double", "boolean", "double")


def annotate(docs: DataFrame, models: dict[str, LanguageModel], text_col: str = "text") -> DataFrame:
    """(`__c0` .. for the columns of `docs` in order, then RESULT): whole rows with their results, without a join."""
    held = docs.sparkSession.sparkContext.broadcast(models)
    named = docs.select(*[F.col(c).alias(f"__c{k}") for k, c in enumerate(docs.columns)], F.col(text_col).alias("__text"))
    shape = ", ".join([*(f"__c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema.fields)), *(f"{r} {t}" for r, t in zip(RESULT, _TYPES, strict=True))])
    return named.mapInArrow(_named(_scorer(held, sorted(models)), len(docs.columns)), shape)


def _named(run, width: int):
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, [*(f"__c{k}" for k in range(width)), *RESULT])

    return renamed


def known_language(docs: DataFrame, models: dict[str, LanguageModel], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`docs` without the rows whose language is rejected, the predicted language in `lang_col`."""
    out = annotate(docs, models, text_col).where("not rejected")
    return out.select(*[(F.col("lang_pred") if c == lang_col else F.col(f"__c{k}")).alias(c) for k, c in enumerate(docs.columns)])


def identify(docs: DataFrame, models: dict[str, LanguageModel], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, rejected, cross_entropy (nats per symbol). The models are broadcast whole."""
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__body"))
    out = annotate(rows, models, "__body")
    return out.select(F.col("__c0").alias(id_col), *RESULT)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """Every document's language by models of the rows that are not held out."""
    models = train(docs.where(~held_out()))
    out = identify(docs, models)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")
