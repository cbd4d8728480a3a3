"""Offset-preserving encoding into the pieces of a byte-pair model in SentencePiece's file format, and decoding.

Normalisation replaces the longest prefix that the model's compiled character map holds, and otherwise copies a character.
Every normalised character keeps the place of the source character it came from, so a piece, which covers a stretch of
normalised text, is projected to the bytes of the original text. Where no rule can start, whole stretches are copied at once.

Pieces are merged within segments: a text is cut between any two characters that no piece holds side by side, which changes
no merge, and the ids of short segments are kept in a bounded table per task. Characters without a piece become the pieces
of their bytes; as in the library, the last of them carries the character's span and the others are empty.

Encoding and decoding are per row: no shuffle, nothing broadcast but the path of the model, which every executor reads. A
lost task encodes its rows again. Memory is linear in the longest text.

Cases: null text counts as empty; an empty text has the end id alone; repeated rows are kept; an empty table gives an empty
result; null ids decode to an empty text; only the id and text columns are read, so other columns may have any name. Models
that are not byte-pair models, have no byte pieces, or have user-defined or unused pieces are refused.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import text_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
BLOCK = 1 << 20  # characters that are cut into segments at once
KEPT_SEGMENTS = 1 << 17
KEPT_CHARS = 48
FLUSH_IDS = 1 << 18
DECODED_ROWS = 512
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BYTE_PAIR = 2
ENCODED = "doc_id long, ids array<int>, begins array<long>, ends array<long>"
_ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
)


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield number, message[at : at + size]
        at += size


class CharacterMap:
    """Rules of a compiled character map: a double array over UTF-8 bytes whose leaves point at replacement texts."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.texts = compiled[4 + size :]
        # Characters that are a rule themselves, and (first, second) characters of longer rules.
        self.alone = np.zeros(0x110000, bool)
        self.first, self.second = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
        for rule, text in self.rules():
            chars = rule.decode()
            if "  " in text:
                raise ValueError("a rule whose replacement has adjacent blanks")
            if len(chars) == 1:
                self.alone[ord(chars)] = True
            else:
                self.first[ord(chars[0])] = self.second[ord(chars[1])] = True

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _text(self, at: int) -> str:
        return self.texts[at : self.texts.index(b"\0", at)].decode()

    def rules(self) -> Iterator[tuple[bytes, str]]:
        open_nodes = [(b"", self._offset(self.units[0]))] if self.units else []
        units, labels = np.array(self.units, np.int64), np.arange(1, 256)
        while open_nodes:
            prefix, node = open_nodes.pop()
            near = node ^ labels
            near[near >= len(units)] = 0
            for byte in labels[units[near] & 0x800000FF == labels].tolist():
                unit = self.units[node ^ byte]
                below = node ^ byte ^ self._offset(unit)
                if unit >> 8 & 1:
                    yield prefix + bytes([byte]), self._text(self.units[below] & 0x7FFFFFFF)
                open_nodes.append((prefix + bytes([byte]), below))

    def longest(self, text: str, at: int) -> tuple[int, str]:
        """(characters, replacement) of the longest rule at a place; one character stays itself without one."""
        found = (1, text[at])
        if not self.units:
            return found
        node = self._offset(self.units[0])
        for end in range(at, len(text)):
            for byte in text[end].encode():
                node ^= byte
                unit = self.units[node] if node < len(self.units) else 0
                if unit & 0x800000FF != byte:
                    return found
                node ^= self._offset(unit)
                leaf = unit >> 8 & 1
            if leaf:
                found = (end + 1 - at, self._text(self.units[node] & 0x7FFFFFFF))
        return found

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where a rule can start."""
        start = self.alone[codes]
        start[:-1] |= self.first[codes[:-1]] & self.second[codes[1:]]
        return np.flatnonzero(start)


@functools.cache
def character_map(compiled: bytes) -> CharacterMap:
    return CharacterMap(compiled)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class Normalizer:
    def __init__(self, compiled: bytes, dummy_prefix: bool, remove_extra: bool, escape: bool):
        self.map = character_map(compiled)
        self.dummy_prefix, self.remove_extra, self.escape = dummy_prefix, remove_extra, escape

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source place of each of its characters and of its end."""
        codes = code_points(text)
        parts: list[str] = []
        sources: list[np.ndarray] = []
        at = 0

        def copy(end: int) -> None:
            parts.append(text[at:end])
            sources.append(np.arange(at, end))

        for place in self.map.places(codes).tolist() if self.map.units else ():
            if place < at:
                continue
            copy(place)
            n, new = self.map.longest(text, place)
            parts.append(new)
            sources.append(np.full(len(new), place))
            at = place + n
        copy(len(text))
        out, source, end, head = "".join(parts), np.concatenate(sources), len(text), 0
        if self.remove_extra:
            while head < len(text):
                n, new = self.map.longest(text, head)
                if new != " ":
                    break
                head += n
            if head == len(text):
                return "", np.zeros(1, np.int64)
            blank = code_points(out) == 32
            keep = ~blank
            keep[1:] |= ~blank[:-1]
            if len(out) and blank[0]:
                keep[0] = False
            kept = np.flatnonzero(keep)
            out, source = "".join(map(out.__getitem__, kept.tolist())), source[kept]
        if self.dummy_prefix and head < len(text):
            out, source = " " + out, np.concatenate([[head], source])
        if self.escape:
            out = out.replace(" ", SPACE)
        if self.remove_extra:
            shown = out.rstrip(SPACE if self.escape else " ")
            if len(shown) < len(out):
                out, end, source = shown, int(source[len(shown)]), source[: len(shown)]
        return out, np.append(source, end).astype(np.int64)


class Segments(dict):
    """Ids by segment, as bytes of 32-bit numbers. Of short segments the latest are kept, in two generations."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.older = model, {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            ids = np.array(self.model.merged(segment), np.int32).tobytes()
        if len(segment) <= KEPT_CHARS:
            if len(self) >= KEPT_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids


class Model:
    def __init__(self, data: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in fields(data):
            if number == 1:
                own = dict(fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, b"\0" * 4))[0], own.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != BYTE_PAIR or BYTE not in kinds or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.get(24, 0):
            raise ValueError("only byte-pair models with byte pieces and without user-defined or unused pieces")
        self.normalize = Normalizer(normalizer.get(2, b""), *(bool(normalizer.get(k, 1)) for k in (3, 4, 5)))
        self.strip_first = self.normalize.dummy_prefix or self.normalize.remove_extra
        self.scores = {p: -score for p, score, kind in pieces if kind == NORMAL}  # lower is merged earlier
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.end_id = next(i for i, (p, _, kind) in enumerate(pieces) if kind == CONTROL and p == "</s>")
        self.byte_ids = [0] * 256
        self.bytes: list[bytes] = []  # what an id decodes to
        self.chars = np.zeros(len(pieces), np.int64)  # normalised characters of an id; bytes count with the last of them
        self.lead = np.zeros(len(pieces), np.int64)  # of an id for a character's first byte: how many bytes there are
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                byte = int(p[3:5], 16)
                self.byte_ids[byte] = i
                self.lead[i] = 1 if byte < 0x80 else 0 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                self.bytes.append(bytes([byte]))
            else:
                self.chars[i] = len(p) if kind == NORMAL else 0
                self.bytes.append({NORMAL: p.replace(SPACE, " "), UNKNOWN: " ⁇ "}.get(kind, "").encode())
        self.kinds = [kind for _, _, kind in pieces]
        pairs = sorted({(a, b) for p in self.scores for a, b in zip(p, p[1:], strict=False)})
        self.classes = np.zeros(0x110000, np.int32)
        alphabet = sorted({ord(c) for pair in pairs for c in pair})
        self.classes[alphabet] = np.arange(1, len(alphabet) + 1)
        self.joined = np.zeros((len(alphabet) + 1,) * 2, bool)
        for a, b in pairs:
            self.joined[self.classes[ord(a)], self.classes[ord(b)]] = True
        self.segments = Segments(self)

    def merged(self, segment: str) -> tuple[int, ...]:
        """Ids of a segment: the best-scored pair of neighbours is merged first, of equal ones the leftmost."""
        scores = self.scores
        ids: list[int] = []
        for part in self._merge_short(segment) if len(segment) <= KEPT_CHARS else self._merge_long(segment):
            if part in scores:
                ids.append(self.ids[part])
            else:
                ids += [self.byte_ids[b] for b in part.encode()]
        return tuple(ids)

    def _merge_short(self, segment: str) -> list[str]:
        """By looking through all pairs for each merge."""
        get, never = self.scores.get, float("inf")
        parts = [*segment]
        costs = [get(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while costs and (best := min(costs)) < never:
            k = costs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del costs[k]
            if k < len(costs):
                costs[k] = get(parts[k] + parts[k + 1], never)
            if k:
                costs[k - 1] = get(parts[k - 1] + parts[k], never)
        return parts

    def _merge_long(self, segment: str) -> list[str]:
        """By a heap of the pairs; pairs whose parts have changed are passed over."""
        get, parts = self.scores.get, [*segment]
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        agenda: list[tuple[float, int, str]] = []

        def propose(left: int, right: int) -> None:
            whole = parts[left] + parts[right]
            cost = get(whole)
            if cost is not None:
                heapq.heappush(agenda, (cost, left, whole))

        for k in range(len(parts) - 1):
            propose(k, k + 1)
        while agenda:
            _, left, whole = heapq.heappop(agenda)
            right = after[left]
            if not parts[left] or right < 0 or parts[left] + parts[right] != whole:
                continue
            parts[left], parts[right] = whole, ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                propose(left, after[left])
            if before[left] >= 0:
                propose(before[left], left)
        return [p for p in parts if p]

    def cut(self, text: str) -> Iterator[list[str]]:
        """Segments of a normalised text, block by block: no piece reaches from one segment into the next."""
        start = 0
        for a in range(1, len(text), BLOCK):
            classes = self.classes[code_points(text[a - 1 : a + BLOCK])]
            ends = (np.flatnonzero(~self.joined[classes[:-1], classes[1:]]) + a).tolist()
            yield [text[i:j] for i, j in zip([start, *ends], ends, strict=False)]
            start = ends[-1] if ends else start
        if text:
            yield [text[start:]]

    def encode(self, text: str, add_end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and the end byte of each in the original text."""
        normal, source = self.normalize(text)
        found = map(self.segments.__getitem__, chain.from_iterable(self.cut(normal)))
        ids = np.frombuffer(b"".join(found), np.int32)
        chars, lead = self.chars[ids], self.lead[ids]
        first = np.flatnonzero(lead)
        chars[first + lead[first] - 1] += 1
        ends = np.cumsum(chars)
        place = utf8_offsets(text)[source]
        spans = [place[ends - chars], place[ends]]
        if add_end:
            total = len(text.encode())
            ids, spans = np.append(ids, np.int32(self.end_id)), [np.append(s, total) for s in spans]
        return ids, *spans

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the blank that a first piece begins with is the one encoding put there."""
        text = b"".join(map(self.bytes.__getitem__, ids))
        if self.strip_first and text[:1] == b" " and next(k for i in ids if (k := self.kinds[i]) != CONTROL) == NORMAL:
            text = text[1:]
        return text.decode(errors=_ONE_BYTE)


_ONE_BYTE = "leaksafe-one-byte"
codecs.register_error(_ONE_BYTE, lambda error: ("�", error.start + 1))


def utf8_offsets(text: str) -> np.ndarray:
    """Byte offset of every character and of the end."""
    codes = code_points(text)
    sizes = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.concatenate([[0], np.cumsum(sizes)])


@functools.cache
def model(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def _encoder(path: str, add_end: bool):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        docs, *columns = zip(*rows, strict=True)
        ends = pa.array(np.cumsum([0, *map(len, columns[0])]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(c))) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), *lists], schema=_ENCODED)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows, held = model(path), [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                rows.append((doc.as_py(), *own.encode(text.as_py(), add_end)))
                held += len(rows[-1][1])
                if held >= FLUSH_IDS:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return encode


def _decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in (b.slice(at, DECODED_ROWS) for b in batches for at in range(0, b.num_rows, DECODED_ROWS)):
            lists = batch.column(batch.num_columns - 1)
            ids = lists.flatten().to_numpy()
            ends = np.cumsum([0, *(n or 0 for n in pc.list_value_length(lists).to_pylist())])
            texts = [own.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"])

    return decode


def _path(model_path: str | None) -> str:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path(MODEL)
    return str(model_path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, add_end: bool = True) -> DataFrame:
    """doc_id, ids, and for each id the first and the end byte it stands for in the original text.

    `model_path` is the model's file on every executor.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.select("doc_id", text_of("text").alias("text")).mapInArrow(_encoder(_path(model_path), add_end), ENCODED)


def decode(encoded: DataFrame, keep: list[str], ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """The columns `keep` and the text of the ids as `decoded`."""
    rows = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids_col}`").cast("array<int>").alias("__ids"))
    schema = rows.drop("__ids").withColumn("decoded", F.lit("")).schema
    return rows.mapInArrow(_decoder(_path(model_path)), schema)


def round_trip(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Per document the number and digest of its ids, the digest of the text they decode to, and a hash of the spans."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    encoded = encode(docs, model_path=model_path).select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.xxhash64("begins", "ends").alias("spans_xxhash64"),
    )
    kept = ["doc_id", "n_tokens", "ids_sha256", "spans_xxhash64"]
    decoded = decode(encoded, kept, model_path=model_path)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "spans_xxhash64")
