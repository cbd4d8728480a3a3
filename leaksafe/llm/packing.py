"""Hierarchical packing of token sequences into windows.

Every document is routed to a tier: full windows are cut off at once, and what is left goes to the shortest context size
that holds it. Windows are packed tier by tier from the longest, and shorter tiers fill the gaps of longer ones; gaps that
no whole piece fits take a cut piece, so only full windows leave a task. What is left at a task's end leaves in windows
of the shorter context sizes, which are powers of two and need no padding. Windows are dealt to step groups of equal
attention cost.

A task packs the rows it reads, in bounded buffers and without a shuffle; a lost task packs the same rows again in the
same way, with the same sequence ids. Token ids come from a byte-level BPE vocabulary in rank form, which yields the ids
of the `tokenizers` file of the same vocabulary (a test holds the two against each other) at a fraction of the time.

Cases: null text counts as empty; an empty text is its end token alone; repeated rows are packed as often as they occur;
an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import base64
import bisect
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from leaksafe.llm.shared import text_of

WINDOW = 1024
TIERS = (1024, 512, 256, 128)
END_ID = 0
SPECIAL = {"<|endoftext|>": 50256}  # the vocabulary's added token; in a text it is one id, as the `tokenizers` file has it
FLUSH_TOKENS = 256 * 1024
STEP_GROUPS = 8
RANKS = "byte_bpe_50k.tiktoken"
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, "
    "tier int, step_group long"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("tier", pa.int32()), ("step_group", pa.int64())]
)


@functools.cache
def encoder(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(text: str, ranks_path: str, pattern: str) -> np.ndarray:
    """The ids of a text and its end token, as little-endian unsigned 32-bit numbers."""
    ids = encoder(ranks_path, pattern).encode(text, allowed_special="all")
    ids.append(END_ID)
    return np.array(ids, dtype="<u4")


class Piece:
    """A stretch of one document's ids."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


def tier_of(n: int) -> int:
    return min(t for t in TIERS if t >= n)


def best_fit(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows of pieces by best fit, the longest tier first, each tier in order of falling length."""
    windows: list[list[Piece]] = []
    room: list[tuple[int, int]] = []  # (free, window), sorted
    for piece in sorted(pieces, key=lambda p: (-tier_of(len(p.ids)), -len(p.ids))):
        n = len(piece.ids)
        at = bisect.bisect_left(room, (n, -1))
        if at < len(room):
            free, w = room.pop(at)
            windows[w].append(piece)
        else:
            free, w = WINDOW, len(windows)
            windows.append([piece])
        if free > n:
            bisect.insort(room, (free - n, w))
    return windows


def settle(windows: list[list[Piece]]) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill every gap from the emptiest windows, cutting pieces where needed: (full windows, the pieces left over)."""
    size = lambda w: sum(len(p.ids) for p in w)
    rest = sorted(windows, key=size)
    full: list[list[Piece]] = []
    left: list[Piece] = []
    while rest:
        window = rest.pop()
        gap = WINDOW - size(window)
        while gap and (left or rest):
            if not left:
                left = rest.pop(0)
            piece = left.pop()
            if len(piece.ids) > gap:
                piece, remainder = piece.cut(gap)
                left.append(remainder)
            window.append(piece)
            gap -= len(piece.ids)
        if gap:
            return full, window
        full.append(window)
    return full, left


def short_windows(left: list[Piece]) -> list[list[Piece]]:
    """The last pieces of a task in windows whose lengths are powers of two."""
    out, total = [], sum(len(p.ids) for p in left)
    left = sorted(left, key=lambda p: len(p.ids))
    for n in (1 << b for b in range(total.bit_length() - 1, -1, -1)):
        if not total & n:
            continue
        window: list[Piece] = []
        while n:
            piece = left.pop()
            if len(piece.ids) > n:
                piece, rest = piece.cut(n)
                left.append(rest)
            window.append(piece)
            n -= len(piece.ids)
        out.append(window)
    return out


def step_groups(windows: list[list[Piece]], groups: int = STEP_GROUPS) -> list[int]:
    """A group for each window: by falling attention cost (sum of squared lengths), dealt there and back."""
    cost = [sum(len(p.ids) ** 2 for p in w) for w in windows]
    out = [0] * len(windows)
    for k, w in enumerate(sorted(range(len(windows)), key=lambda w: -cost[w])):
        turn, place = divmod(k, groups)
        out[w] = groups - 1 - place if turn % 2 else place
    return out


def _packer(ranks_path: str, pattern: str):
    def rows_of(windows: list[list[Piece]], base: int, done: int, step: int) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(9)]
        for k, (window, group) in enumerate(zip(windows, step_groups(windows), strict=True)):
            at, total = 0, sum(len(p.ids) for p in window)
            for p in window:
                values = (
                    p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total, base + done + k, at,
                    min((t for t in TIERS if t >= total), default=WINDOW), (base + step) * STEP_GROUPS + group,
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                at += len(p.ids)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done, step = TaskContext.get().partitionId() << 33, 0, 0
        ready: list[list[Piece]] = []  # full windows
        held: list[Piece] = []  # the pieces that wait for one
        tokens = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(text.as_py(), ranks_path, pattern)
                whole = len(ids) // WINDOW * WINDOW
                ready += [[Piece(doc, a, ids[a : a + WINDOW], len(ids))] for a in range(0, whole, WINDOW)]
                if whole < len(ids):
                    held.append(Piece(doc, whole, ids[whole:], len(ids)))
                    tokens += len(ids) - whole
                if tokens >= FLUSH_TOKENS:
                    full, held = settle(best_fit(held))
                    ready, tokens = ready + full, sum(len(p.ids) for p in held)
                if len(ready) * WINDOW >= FLUSH_TOKENS:
                    yield rows_of(ready, base, done, step)
                    done, step, ready = done + len(ready), step + 1, []
        full, held = settle(best_fit(held))
        last = ready + full + short_windows(held)
        if last:
            yield rows_of(last, base, done, step)

    return pack


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per piece. `ranks_path` is a vocabulary in rank form and `pattern` its split pattern, on every executor."""
    if ranks_path is None or pattern is None:
        import public_tokenizers

        ranks_path, pattern = ranks_path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").select("doc_id", text_of("text").alias("text"))
    return rows.mapInArrow(_packer(str(ranks_path), pattern), SCHEMA)
