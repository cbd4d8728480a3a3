"""Winnowing over line hashes: fingerprints that every repeated run of lines has, joined, extended and cut.

A line here ends at a line break or after a punctuation mark and a space, so that a passage pasted into the middle of a
paragraph still has whole lines. Lines are compared without their outer blanks and closing mark.

1. A window is the shortest stretch of lines from one line on that has `min_words` words or more. Its fingerprint is its
   least line in an order of its own: that with the most words, then by hash, then the last. A window depends on its own lines alone, so two runs of whole lines
   that are equal and have `min_words` words share a fingerprint, however few lines they have.
2. Places with the same fingerprint are joined: what no other place has is left out from here on.
3. Around the places that are left, the match is extended both ways: by every stretch that starts at a line whose window has the
   fingerprint, from the window's end on up to where the next line's window takes over. Together these stretches cover a run of `min_words` words from its first line to its
   last. A stretch that stands at an earlier place (by id, then place) too is a repeat.
4. The lines of all repeats are taken together where they overlap or touch, and deleted.

Stretches are compared with every earlier place, not only with the first place of a fingerprint, as rows: hot fingerprints
are counted before the shuffle and no list of places is ever built. Long texts are dealt in blocks of `BLOCK` lines. Only
DataFrame functions, and work linear in the lines.

Cases: null text stays null; of rows equal in id and text one is treated as any
other and the rest are cut whole; rows that share an id but not the text are ordered by a hash of the text; the first of several
equal texts stays whole; an empty table gives an empty result; other columns are passed on untouched. Blank lines count as
one word in a window, and a run must have `min_words` words without its outer blanks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaksafe.llm.shared import indexes, let, written

# A place right after a line break, or after a mark and one blank: the line keeps what ends it.
LINE_END = r"(?<=\n)|(?<=[.,;:!?]\x20)"
# The same cuts, with what ends a line left out.
LINE_MARK = r"[.,;:!?]\x20|\n"
MIN_WORDS = 20
#: Lines of one text that are worked on together; a window reaches into the next block. A place takes ten bits.
BLOCK = 512
NO_ID = -(2**63)


def lines(text: Column) -> Column:
    """The lines of a text; joined, they are the text."""
    return F.split(text, LINE_END, -1)


def bare_lines(text: Column) -> Column:
    return F.transform(F.split(text, LINE_MARK, -1), lambda x: F.trim(x, F.lit(" \n\r\t")))


def line_hashes(text: Column) -> Column:
    return F.transform(bare_lines(text), lambda x: F.xxhash64(x))


def hashes_and_words(text: Column, most: int) -> Column:
    """The hashes of the lines as `h`, and as `n` their words, counted up to `most`."""
    blanks = lambda x: F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit("")))
    words = lambda x: F.least(blanks(x) + 1, F.lit(most)).cast("byte")
    return let(bare_lines(text), lambda b: F.struct(F.transform(b, lambda x: F.xxhash64(x)).alias("h"), F.transform(b, words).alias("n")))


def word_count(text: Column) -> Column:
    """Blanks and line breaks between the outer ones, plus one."""
    bare = lambda t: F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return let(F.trim(text, F.lit(" \n\r\t")), lambda t: F.octet_length(t) - F.octet_length(bare(t)) + 1)


def _key(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__id"), F.xxhash64(F.col(text_col)).alias("__key")]


def spanning(values: Column, spans: list[int], join: Callable[[Column, Column], Column], use: Callable[[list[Column]], Column]) -> Column:
    """`use` of what `join` makes of 1, 2, 4 ... `spans[-1]` values from each place on; past the last value it joins null."""

    def further(found: list[Column]) -> Column:
        if len(found) == len(spans):
            return use(found)
        beyond = F.slice(found[-1], spans[len(found) - 1] + 1, F.size(found[-1]))
        return let(F.zip_with(found[-1], beyond, lambda a, b: join(a, b)), lambda x: further([*found, x]))

    return let(values, lambda x: further([x]))


def window_lengths(n: Column, min_words: int) -> Column:
    """For each line the lines of its window, 0 where the text ends before; a line has a word at least."""
    step = 2 * min_words  # sums of words times `step`, plus the lines so far
    spans = [2**k for k in range(min_words.bit_length())]

    def lengths(sums: list[Column]) -> Column:
        # The most lines that have too few words: as many as 2 to some power at a time, the largest first.
        few = F.transform(n, lambda _: F.lit(0))
        for span, words in reversed(list(zip(spans, sums))):
            few = F.transform(few, _longer(words, span, step, min_words))
        return F.transform(few, lambda s, i: F.when(i + s % step < F.size(n), s % step + 1).otherwise(0))

    return spanning(F.transform(n, lambda x: x.cast("int")), spans, lambda a, b: a + b, lengths)


def _longer(words: Column, span: int, step: int, min_words: int) -> Callable[[Column, Column], Column]:
    def grown(s: Column, i: Column) -> Column:
        more = F.get(words, i + s % step) * step + s
        return F.when(more < min_words * step, more + span).otherwise(s)

    return grown


def fingerprint_lines(h: Column, n: Column, length: Column, min_words: int) -> Column:
    """For each line of a block the place of its window's fingerprint, null where it has no window."""
    # Words first, as long lines are rarer than short ones, then 46 bits of the hash, then the place, which is read off the largest.
    hashed = lambda x: F.shiftleft(F.shiftrightunsigned(x, 18), 10)
    ranks = F.transform(h, lambda x, i: F.shiftleft(F.get(n, i).cast("long"), 56) + hashed(x) + i)
    spans = [2**k for k in range(min_words.bit_length())]

    def largest(top: list[Column]) -> Column:
        # Two stretches as long as a power of two, from its first and to its last line, cover a window.
        def of_line(m: Column, i: Column) -> Column:
            found = F.when(m < 1, None)
            for span, t in zip(spans, top):
                found = found.when(m < 2 * span, F.greatest(F.get(t, i), F.get(t, i + m - span)))
            return found.bitwiseAND(F.lit(1023)).cast("int")

        return F.transform(length, of_line)

    return spanning(ranks, spans, lambda a, b: F.greatest(a, b), largest)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(__id, __key, block, h, length, prints): texts in blocks of lines; `prints` has each line's fingerprint place.

    Places count within the block, and `h` goes on for the lines that the block's windows reach.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def blocks(s: Column) -> Column:
        part = lambda c, b: F.slice(c, b * BLOCK + 1, BLOCK + min_words + 1)

        def block(b: Column) -> Column:
            def marked(e: Column) -> Column:
                prints = lambda size: F.slice(fingerprint_lines(e["h"], e["n"], size, min_words), 1, BLOCK)
                return let(window_lengths(e["n"], min_words), lambda size: F.struct(b.alias("block"), e["h"].alias("h"), size.alias("length"), prints(size).alias("prints")))

            return let(F.struct(part(s["h"], b).alias("h"), part(s["n"], b).alias("n")), marked)

        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s["h"]) - 1) / BLOCK).cast("int")), block)

    return docs.select(*_key(id_col, text_col), F.explode(let(hashes_and_words(text, min_words), blocks)).alias("b")).select("__id", "__key", "b.*")


def joined_places(table: DataFrame) -> DataFrame:
    """(__id, __key, block, at): of each block the fingerprint places that some other place shares."""
    prints = table.select("__id", "__key", "block", "h", F.explode(F.array_distinct(F.filter("prints", lambda p: p.isNotNull()))).alias("place"))
    prints = prints.select(F.get("h", F.col("place")).alias("hash"), "__id", "__key", "block", "place")
    # A place that windows of two blocks share counts twice and is only looked at once more than it has to be.
    counted = prints.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return prints.join(counted.hint("shuffle_hash"), "hash").groupBy("__id", "__key", "block").agg(F.collect_set("place").alias("at"))


def stretches(table: DataFrame, places: DataFrame, min_words: int) -> DataFrame:
    """(hash, __id, __key, mark): the stretches around joined places; mark is `min_words` + 1 times the first line, plus the lines."""
    held = table.join(places, ["__id", "__key", "block"])
    length = F.col("length")

    def of_line(i: Column) -> Column:
        # Up to the line before the next window's end, and to the end of the text where there is no next window.
        after = F.get(length, i + 1)
        last = F.when(after > 0, after).otherwise(F.size("h") - i)
        return F.transform(F.sequence(F.get(length, i), F.greatest(F.get(length, i), last)), lambda m: F.struct(i.alias("i"), m.alias("m")))

    found = F.filter(indexes(F.size("prints")), lambda i: F.array_contains("at", F.get("prints", i)))
    rows = held.select("__id", "__key", "block", "h", F.explode(F.flatten(F.transform(found, of_line))).alias("s"))
    mark = (F.col("block") * BLOCK + F.col("s.i")).cast("long") * (min_words + 1) + F.col("s.m")
    return rows.select(F.xxhash64(F.slice("h", F.col("s.i") + 1, F.col("s.m"))).alias("hash"), "__id", "__key", mark.alias("mark"))


def repeats(docs: DataFrame, id_col: str, text_col: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(__id, __key, marks): for rows with stretches that an earlier place has too, the marks of these, at most two a line."""
    table = written(fingerprints(docs, id_col, text_col, min_words))
    rows = written(stretches(table, joined_places(table), min_words))
    # Plain counts and minima of numbers, reduced before the shuffle however hot a stretch is.
    counted = rows.groupBy("hash").agg(F.count("*").alias("n"), F.min("__id").alias("__first")).where("n > 1").drop("n")
    repeated = rows.join(counted.hint("shuffle_hash"), "hash")
    heads = repeated.where(F.col("__id") == F.col("__first")).groupBy("hash").agg(F.min(F.struct("__key", "mark")).alias("head"))
    later = repeated.join(heads, "hash").where(F.struct("__id", "__key", "mark") > F.struct("__first", "head.__key", "head.mark"))
    return later.groupBy("__id", "__key").agg(F.collect_set("mark").alias("marks"))


def _runs(marks: Column, min_words: int) -> Column:
    """The lines of all marked stretches as sorted (a, b) runs that neither overlap nor touch."""
    # A stretch has at most `min_words` lines, of a word each at least.
    first = lambda m: F.floor((m - 1) / (min_words + 1)).cast("int")
    many = lambda m: (m % (min_words + 1)).cast("int")
    places = F.array_distinct(F.flatten(F.transform(marks, lambda m: F.sequence(first(m), first(m) + many(m) - 1))))

    def between(p: Column) -> Column:
        starts = F.array_sort(F.array_except(p, F.transform(p, lambda x: x + 1)))
        stops = F.array_sort(F.array_except(F.transform(p, lambda x: x + 1), p))
        return F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    return let(places, between)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the later repeated runs cut out of the text, plus `lines_cut`, the number of lines deleted.

    Any run of whole lines of `min_words` words that stands at an earlier place too goes, however few lines it has.
    """
    found = repeats(docs, id_col, text_col, min_words)
    keyed = docs.select(*_key(id_col, text_col), *[F.col(c).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    text = F.col(f"c{docs.columns.index(text_col)}")
    joined = keyed.join(found, ["__id", "__key"], "left")
    # Equal rows meet in the join's own partitioning: the second and later ones repeat the first from end to end.
    twin = F.row_number().over(Window.partitionBy("__id", "__key").orderBy("__id")) > 1
    joined = joined.withColumn("__twin", twin)

    def long_enough(ls: Column, spans: Column) -> Column:
        joined = lambda s: F.array_join(F.slice(ls, s["a"] + 1, s["b"] - s["a"]), "")
        return F.filter(spans, lambda s: word_count(joined(s)) >= min_words)

    def spans_of(ls: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("a"), F.size(ls).alias("b")))
        return long_enough(ls, F.when(F.col("__twin"), whole).otherwise(_runs(F.col("marks"), min_words)))

    def rebuild(ls: Column) -> Column:
        def cut(spans: Column) -> Column:
            before = lambda i: F.when(i > 0, spans[i - 1]["b"]).otherwise(0)
            kept = F.transform(indexes(F.size(spans)), lambda i: F.array_join(F.slice(ls, before(i) + 1, spans[i]["a"] - before(i)), ""))
            rest = F.array_join(F.slice(ls, before(F.size(spans)) + 1, F.size(ls)), "")
            gone = F.aggregate(spans, F.lit(0), lambda acc, s: acc + s["b"] - s["a"])
            return F.struct(F.array_join(F.concat(kept, F.array(rest)), "").alias("text"), gone.alias("cut"))

        return let(spans_of(ls), cut)

    touched = (F.col("marks").isNotNull() | F.col("__twin")) & text.isNotNull()
    as_is = F.struct(text.alias("text"), F.lit(0).alias("cut"))
    # Exploding one element keeps the optimizer from working a text out again for every later use of it.
    done = F.explode(F.array(F.when(touched, let(lines(text), rebuild)).otherwise(as_is))).alias("__done")
    out = joined.select(*[F.col(f"c{n}") for n, c in enumerate(docs.columns) if c != text_col], done)
    return out.select(
        *[(F.col("__done.text") if c == text_col else F.col(f"c{n}")).alias(c) for n, c in enumerate(docs.columns)],
        F.col("__done.cut").cast("long").alias("lines_cut"),
    )
