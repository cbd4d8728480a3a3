"""Fill-in-middle transformation by a secondary sort.

A text is a sequence of units, runs of ASCII letters or single other characters. Hashes of the document's id choose two
places between units and a form: plain, prefix-suffix-middle or suffix-prefix-middle. No task assembles a text: the
sections leave as pieces of at most `CHUNK` units, keyed by document and place in the output. Repartitioning by document and
sorting within partitions brings the pieces together in output order, and they stream into an incremental digest. For the
restoration the output, as it streams by, is cut at its markers alone; its sections get their places in the original text as
keys, and the same partitions are sorted anew. Documents stay where they are, so the second sort has no shuffle. The sorts
are Spark's own and spill; a task holds one batch of pieces at a time and a long document is no special case.

A piece's key is a digest of id and text together with the partition its row was read from, so lost tasks make the same
keys again, and equal rows, however many, are spread over the tasks that read them. Equal rows of one partition share a
key; their pieces count once and their result is given as often as the row occurs.

Cases: null text counts as empty; a text that is empty or holds a marker stays plain; a null id hashes like an empty one and
comes back as null; ties in the two places make an empty middle; repeated rows are kept; an empty table gives an empty
result; only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ORDER = {PLAIN: (), PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
PLACE = {PREFIX: 1, MIDDLE: 2, SUFFIX: 3}  # of a section in the original text
TRANSFORMED_PERCENT = 90
SPM_PERCENT = 20
SALT = "1:"
CHUNK = 4096
MOST_BYTES = 1 << 16
FLUSH_BYTES = 1 << 22
HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
# A row at place 0 is a document's head; `output_sha256` and `copies` are known once the output has streamed by.
PIECES = f"document binary, place int, k int, piece binary, {HEAD}, copies long, output_sha256 string"
DIGESTS = f"{HEAD}, output_sha256 string, restored_sha256 string"
TEXTS = f"{HEAD}, output string"
_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = pa.schema(
    [("document", pa.binary()), ("place", pa.int32()), ("k", pa.int32()), ("piece", pa.binary())]
    + _HEAD
    + [("copies", pa.int64()), ("output_sha256", pa.string())]
)
_DIGESTS = pa.schema([*_HEAD, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_TEXTS = pa.schema([*_HEAD, ("output", pa.large_string())])

Rows = Iterator[tuple]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the units of a UTF-8 text begin."""
    letter = ((data | 32) - 97) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


def plan(doc_id: int | None, text: bytes, n: int, salt: str = SALT) -> tuple[str, int, int]:
    """The form, and the units after which prefix and middle end."""
    digest = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, form, order = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    first, last = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(m.encode() in text for m in PLACE) or form % 100 >= TRANSFORMED_PERCENT:
        return PLAIN, first, last
    return SPM if order % 100 < SPM_PERCENT else PSM, first, last


def chunks(text: bytes, starts: np.ndarray, a: int, b: int) -> Iterator[bytes]:
    """Units a to b in pieces of at most CHUNK units; a run of letters beyond MOST_BYTES is cut as well."""
    for unit in range(a, b, CHUNK):
        at = int(starts[unit])
        end = int(starts[unit + CHUNK]) if unit + CHUNK < b else int(starts[b]) if b < len(starts) else len(text)
        while end - at > MOST_BYTES:
            cut = at + MOST_BYTES
            while text[cut] & 0xC0 == 0x80:
                cut -= 1
            yield text[at:cut]
            at = cut
        yield text[at:end]


def pieces_of(doc_id: int | None, text: bytes, salt: str) -> tuple[tuple, Iterator[bytes]]:
    """(doc_id, n, form, prefix_chars, middle_chars) and the output in pieces."""
    data = np.frombuffer(text, np.uint8)
    starts = unit_starts(data)
    n = len(starts)
    form, first, last = plan(doc_id, text, n, salt)
    if form == PLAIN:
        return (doc_id, n, form, None, None), chunks(text, starts, 0, n)
    units = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, n)}

    def chars(section: str) -> int:
        a, b = (int(starts[u]) if u < n else len(text) for u in units[section])
        return int(((data[a:b] & 0xC0) != 0x80).sum())

    def output() -> Iterator[bytes]:
        for section in ORDER[form]:
            yield section.encode()
            yield from chunks(text, starts, *units[section])

    return (doc_id, n, form, chars(PREFIX), chars(MIDDLE)), output()


def sections(output: Iterator[bytes], form: str) -> Iterator[tuple[int, bytes]]:
    """The output cut at its markers: (place of the section in the text, part of it). Markers may lie across pieces."""
    marks, place, held = [*ORDER[form]], 1, b""
    for piece in output:
        data = held + piece
        while marks and (at := data.find(marks[0].encode())) >= 0:
            if at:
                yield place, data[:at]
            place, data = PLACE[marks[0]], data[at + len(marks.pop(0)) :]
        end = max(0, len(data) - (len(PREFIX) - 1)) if marks else len(data)
        if end:
            yield place, data[:end]
        held = data[end:]
    if held:
        yield place, held


def _piece(document: bytes, place: int, k: int, part: bytes) -> tuple:
    return (document, place, k, zlib.compress(part, 1), None, None, None, None, None, None, None)


def _emit(salt: str):
    def emit(rows: Rows) -> Rows:
        partition = TaskContext.get().partitionId()
        for doc_id, text in rows:
            data = text.encode()
            document = hashlib.sha256(f"{partition}:{doc_id}:".encode() + hashlib.sha256(data).digest()).digest()[:16]
            head, output = pieces_of(doc_id, data, salt)
            yield (document, 0, 0, None, *head, 1, None)
            for k, piece in enumerate(output):
                yield _piece(document, 1, k, piece)

    return emit


def _documents(rows: Rows) -> Iterator[tuple[bytes, tuple, int, str, Iterator[bytes]]]:
    """(document, head, how many equal rows, digest of the output, pieces) from sorted rows; equal pieces count once."""
    row = next(rows, None)
    while row is not None:
        document, head, output, copies = row[0], row[4:9], row[10], 0
        while row is not None and row[:2] == (document, 0):
            copies, row = copies + row[9], next(rows, None)

        def stream(document: bytes = document) -> Iterator[bytes]:
            nonlocal row
            before = None
            while row is not None and row[0] == document:
                if row[1:3] != before:
                    before = row[1:3]
                    yield zlib.decompress(row[3])
                row = next(rows, None)

        own = stream()
        yield document, head, copies, output, own
        for _ in own:  # what the reader left
            pass


def _digest_output(rows: Rows) -> Rows:
    """The digest of each output, and the pieces that its markers cut it into, keyed by their places in the text."""
    for document, head, copies, _, output in _documents(rows):
        digest = hashlib.sha256()

        def seen(output=output, digest=digest) -> Iterator[bytes]:
            for piece in output:
                digest.update(piece)
                yield piece

        for k, (place, part) in enumerate(sections(seen(), head[2])):
            yield _piece(document, place, k, part)
        yield (document, 0, 0, None, *head, copies, digest.hexdigest())


def _digest_restored(rows: Rows) -> Rows:
    for _, head, copies, output, text in _documents(rows):
        digest = hashlib.sha256()
        for part in text:
            digest.update(part)
        for _ in range(copies):
            yield (*head, output, digest.hexdigest())


def _assemble(rows: Rows) -> Rows:
    for _, head, copies, _, output in _documents(rows):
        text = b"".join(output).decode()
        for _ in range(copies):
            yield (*head, text)


def _over_batches(work, schema: pa.Schema):
    """`work` over the rows of a partition, its results in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for row in work(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            held.append(row)
            size += 100 + sum(len(v) for v in row if isinstance(v, bytes | str))
            if size >= FLUSH_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    return run


def output_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = SALT) -> DataFrame:
    """Documents' heads and compressed output pieces, each document in one partition and in output order."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = rows.select("doc_id", text_of("text").alias("text")).mapInArrow(_over_batches(_emit(salt), _PIECES), PIECES)
    return pieces.repartition("document").sortWithinPartitions("document", "place", "k")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = SALT) -> DataFrame:
    """One row per document with its transformed text."""
    return output_pieces(docs, id_col, text_col, salt).mapInArrow(_over_batches(_assemble, _TEXTS), TEXTS)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = SALT) -> DataFrame:
    """One row per document with the digests of its transformed text and of the text rebuilt from that."""
    cut = output_pieces(docs, id_col, text_col, salt).mapInArrow(_over_batches(_digest_output, _PIECES), PIECES)
    restored = cut.sortWithinPartitions("document", "place", "k")
    return restored.mapInArrow(_over_batches(_digest_restored, _DIGESTS), DIGESTS)


def restore(output: Column, form: Column) -> Column:
    """The original text, from a transformed text and its form."""

    def text(order: str) -> Column:
        marks = ORDER[order]
        pattern = "(?s)^" + "".join(f"{m}(.*{'' if m == marks[-1] else '?'})" for m in marks) + "$"
        return F.concat(*[F.regexp_extract(output, pattern, marks.index(m) + 1) for m in PLACE])

    return F.when(form == PSM, text(PSM)).when(form == SPM, text(SPM)).otherwise(output)
