"""Document fingerprints from closed syncmers over words.

A k-mer of words is an anchor if the smallest hash among its inner s-mers stands at its first or last place. Whether a
k-mer is an anchor depends on its own words alone, so an edit only moves the anchors that touch it, and equal stretches
of two texts share their anchors. Only DataFrame functions.

A text without any such k-mer, which most of fewer words than k and a few more are, has all its s-mers as anchors instead,
and whatever it is compared with is compared by s-mers too.

Cases: null text counts as empty; a text with fewer than s words has the hash of its whole word sequence as its only
anchor, and only one without words has none (empty fingerprint); two texts without words are alike (1.0); repeated ids are
ordered by their text; a row without id has no next document. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaksafe.llm.shared import indexes, let, text_of, written

K_WORDS = 12
S_WORDS = 2
IDS_PER_BLOCK = 1024


SHAPE = "array<struct<position:int,hash:bigint>>"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " "), lambda w: w != "")


def _mers(words: Column, s: int) -> Column:
    pair = [lambda i, j=j: words[i + j] for j in range(s)]
    return F.transform(indexes(F.size(words) - (s - 1)), lambda i: F.xxhash64(*[f(i) for f in pair]))


def _closed(words: Column, k: int, s: int) -> Column:
    """array of (position, hash) of the closed syncmers."""
    inner = k - s + 1

    def select(mers: Column) -> Column:
        window = lambda i: F.slice(mers, i + 1, F.lit(inner))
        closed = lambda i: let(F.array_min(window(i)), lambda low: (low == mers[i]) | (low == mers[i + inner - 1]))
        chosen = F.filter(indexes(F.size(mers) - (inner - 1)), closed)
        return F.transform(chosen, lambda i: F.struct(i.alias("position"), F.xxhash64(window(i)).alias("hash"))).cast(SHAPE)

    return F.when(F.size(words) >= k, let(_mers(words, s), select)).otherwise(F.array().cast(SHAPE))


def _every(words: Column, s: int) -> Column:
    """array of (position, hash) of all s-mers, or of the one sequence of fewer words."""
    mers = F.transform(_mers(words, s), lambda h, i: F.struct(i.alias("position"), h.alias("hash"))).cast(SHAPE)
    whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(words).alias("hash"))).cast(SHAPE)
    return F.when(F.size(words) >= s, mers).when(F.size(words) > 0, whole).otherwise(F.array().cast(SHAPE))


def positions(text: Column, k: int = K_WORDS, s: int = S_WORDS) -> Column:
    """array of (position, hash) of the anchors of a text, in order: its closed syncmers or, without any, its s-mers."""
    return let(_words(text), lambda w: let(_closed(w, k, s), lambda c: F.when(F.size(c) > 0, c).otherwise(_every(w, s))))


def _hashes(places: Column) -> Column:
    return F.array_distinct(F.transform(places, lambda a: a["hash"]))


def anchors(text: Column, k: int = K_WORDS, s: int = S_WORDS) -> Column:
    """Distinct anchor hashes in order of first occurrence."""
    return _hashes(positions(text, k, s))


def closed_hashes(text: Column, k: int = K_WORDS, s: int = S_WORDS) -> Column:
    """Distinct syncmer hashes; none for a text that has its s-mers as anchors."""
    return let(_words(text), lambda w: _hashes(_closed(w, k, s)))


def short_hashes(text: Column, s: int = S_WORDS) -> Column:
    """Distinct s-mer hashes."""
    return let(_words(text), lambda w: _hashes(_every(w, s)))


def fingerprint(hashes: Column) -> Column:
    """The low 32 bits of every anchor in hex, joined."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two anchor sets."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def text_likeness(a: Column, a_text: Column, b: Column, b_text: Column) -> Column:
    """Likeness of two texts by their closed syncmers, or by their s-mers if either has none."""
    fine = likeness(short_hashes(a_text), short_hashes(b_text))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), fine).otherwise(likeness(a, b))


def matched_offsets(a: Column, b: Column) -> Column:
    """Shifts between two texts' shared anchors (`positions` of each), commonest first: (shift, anchors)."""
    shared = F.flatten(F.transform(a, lambda x: F.transform(F.filter(b, lambda y: y["hash"] == x["hash"]), lambda y: y["position"] - x["position"])))
    return F.array_sort(
        F.transform(F.array_distinct(shared), lambda d: F.struct((-F.size(F.filter(shared, lambda e: e == d))).alias("n"), d.alias("shift")))
    )


def next_keys(keys: DataFrame, key: str, fan: int = 4096) -> DataFrame:
    """(key, __following): each distinct integer key with the next larger one, the last with the first.

    Four levels of integer division reach any 64-bit key, so the top level has at most 2^16 rows.
    """
    levels = [keys.select(F.col(key).alias("__k"))]
    for _ in range(3):
        levels.append(levels[-1].select(F.floor(F.col("__k") / fan).alias("__k")).distinct())
    top = levels[-1].withColumn("__all", F.lit(0))
    ring = Window.partitionBy("__all").orderBy("__k")
    lowest = F.min("__k").over(Window.partitionBy("__all"))
    follow = top.select("__k", F.coalesce(F.lead("__k").over(ring), lowest).alias("__f"))
    for level in reversed(levels[:-1]):
        inside = level.withColumn("__up", F.floor(F.col("__k") / fan))
        own = Window.partitionBy("__up").orderBy("__k")
        heads = inside.groupBy("__up").agg(F.min("__k").alias("__low"))
        jump = follow.join(heads.withColumnRenamed("__up", "__f"), "__f").select(F.col("__k").alias("__up"), "__low")
        follow = inside.withColumn("__in", F.lead("__k").over(own)).join(jump, "__up").select(
            "__k", F.coalesce("__in", "__low").alias("__f")
        )
    return follow.select(F.col("__k").alias(key), F.col("__f").alias("__following"))


def _compared(rows: DataFrame) -> DataFrame:
    """(text, anchors, next_text, next_anchors) to the texts' fingerprints and likenesses; other columns stay."""
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    head = F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut)
    rest = [c for c in rows.columns if c not in ("text", "anchors", "next_text", "next_anchors")]
    edited = F.concat(F.substring("text", F.lit(1), n - cut), head).alias("edited")
    follower = [F.coalesce("next_text", F.lit("")).alias("next_text"), F.coalesce("next_anchors", F.array().cast("array<bigint>")).alias("next_anchors")]
    rows = rows.select(*rest, "text", "anchors", *follower, n.cast("long").alias("n_chars"), edited)
    rows = rows.withColumn("edited_anchors", closed_hashes(F.col("edited")))
    printed = lambda a, text: fingerprint(F.when(F.size(a) == 0, short_hashes(F.col(text))).otherwise(F.col(a)))
    near = lambda a, text: text_likeness(F.col("anchors"), F.col("text"), F.col(a), F.col(text))
    return rows.select(
        *rest, "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        printed("anchors", "text").alias("fingerprint"),
        printed("edited_anchors", "edited").alias("edited_fingerprint"),
        near("edited_anchors", "edited").alias("near_edited"),
        near("next_anchors", "next_text").alias("near_next"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter is overwritten with the next document's head.

    The next document is the one with the next larger id, the first for the last. Blocks of ids are ordered each on its
    own; a block's last row takes the first row of the next block that exists, found level by level over the blocks, so
    no task ever orders all rows. Texts are shuffled once.
    """
    ids = F.col("doc_id").cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # Rows without id are no neighbours: they are dealt to blocks of their own by their content.
    rows = rows.select("*", F.floor(ids / IDS_PER_BLOCK).alias("__block"), F.when(ids.isNull(), F.xxhash64("text") % 4096).alias("__lone"))
    rows = rows.repartition("__block", "__lone").withColumn("anchors", closed_hashes(F.col("text")))
    order = Window.partitionBy("__block", "__lone").orderBy(ids, F.xxhash64("text"), "text")
    following = F.when(ids.isNotNull(), F.lead(F.struct("text", "anchors")).over(order))
    placed = rows.withColumn("__next", following).withColumn("__head", F.row_number().over(order) == 1)
    last = F.col("__next").isNull() & F.col("__block").isNotNull()
    edge = F.when(last | (F.col("__head") & F.col("__block").isNotNull()), F.struct("text", "anchors"))
    placed = placed.select(
        "doc_id", "__block", "__head", last.alias("__last"), edge.alias("__edge"), "text", "anchors",
        F.col("__next.text").alias("next_text"), F.col("__next.anchors").alias("next_anchors"),
    )
    done = written(_compared(placed))
    heads = done.where(F.col("__head") & F.col("__block").isNotNull()).select(F.col("__block").alias("__following"), F.col("__edge").alias("__first"))
    follower = next_keys(heads.select(F.col("__following").alias("__block")), "__block")
    ends = done.where("__last").select("doc_id", "__block", "__edge").join(follower, "__block").join(heads, "__following")
    ends = _compared(
        ends.select(
            "doc_id", F.col("__edge.text").alias("text"), F.col("__edge.anchors").alias("anchors"),
            F.col("__first.text").alias("next_text"), F.col("__first.anchors").alias("next_anchors"),
        )
    )
    return done.where(~F.col("__last")).select(*ends.columns).unionByName(ends)
