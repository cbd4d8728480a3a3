"""Secrets, weighed by who else holds them.

Every candidate is hashed and counted over the corpus by distinct repositories and owners. A value in many owners' files
is a copied example; a value that one owner alone holds and that looks random is probably live. Only DataFrame functions.

Cases: null or empty text gives no span; repeated rows give one result row each; null owners count as one owner of
their own per repository; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import matches, span_string, text_of, written

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
# The length limits are part of these two patterns: what fails them holds no other match of its kind.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
BASE = ("assign", "access", "hex")
# Formats published by their issuers.
PROVIDER = (
    r"gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+|[sr]k_live_[0-9A-Za-z]{16,}+|AIza[0-9A-Za-z_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----|://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._~-]{1,64}@"
)
KINDS = BASE + ("provider",)
SHARED_OWNERS = 3


def _found(spans: Column, kind: str, value) -> Column:
    return F.transform(
        spans,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["stop"].alias("stop"),
            F.lit(kind).alias("kind"), value(m["hit"]).alias("value"),
        ),
    )


def candidates(docs: DataFrame, text_col: str = "text") -> Column:
    """All spans of a text with the secret's value, by start and then kind."""
    text = text_of(text_col)
    value = lambda hit: F.regexp_extract(hit, ASSIGN, 1)
    assign = F.filter(matches(text, ASSIGN), lambda m: F.length(value(m["hit"])) >= 6)
    same = lambda hit: hit
    return F.array_sort(
        F.concat(
            _found(assign, "assign", value),
            _found(matches(text, ACCESS), "access", same),
            _found(matches(text, HEX), "hex", same),
            _found(matches(text, PROVIDER), "provider", same),
        )
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(value_hash, repository, owner) rows to counts per hash. Sums run before each shuffle, so a hot value is no burden."""
    pairs = spans.groupBy("value_hash", "repository", "owner").agg(F.count("*").alias("n"))
    repositories = pairs.groupBy("value_hash", "repository").agg(F.sum("n").alias("n"))
    owners = pairs.groupBy("value_hash", "owner").agg(F.lit(1).alias("one"))
    return (
        repositories.groupBy("value_hash").agg(F.count("*").alias("n_repositories"), F.sum("n").alias("n_uses"))
        .join(owners.groupBy("value_hash").agg(F.count("*").alias("n_owners")), "value_hash")
    )


def verdict(kind: Column, value: Column, n_owners: Column, shared_owners: int = SHARED_OWNERS) -> Column:
    """example: held by several owners or plainly a placeholder; live: one owner, mixed characters; else unclear."""
    placeholder = F.lower(value).rlike("example|changeme|dummy|sample|placeholder|your_|xxxx|123456|test")
    repeated = F.size(F.array_distinct(F.split(value, ""))) <= 4
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 12)
    return (
        F.when((n_owners >= shared_owners) | placeholder | repeated, "example")
        .when((n_owners == 1) & (mixed | (kind == "provider")), "live")
        .otherwise("unclear")
    )


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "source",
    owner_col: str = "source", shared_owners: int = SHARED_OWNERS,
) -> DataFrame:
    """Per row: id and `spans`, an array of (start, rank, stop, kind, value_hash, verdict, n_owners) by start and rank."""
    found = written(
        docs.select(
            F.col(id_col).alias("__id"),
            F.col(repository_col).cast("string").alias("repository"),
            F.coalesce(F.col(owner_col).cast("string"), F.concat(F.lit("?"), F.coalesce(F.col(repository_col).cast("string"), F.lit("")))).alias("owner"),
            candidates(docs, text_col).alias("found"),
        ).withColumn("__row", F.monotonically_increasing_id())
    )
    spans = found.select("__row", "repository", "owner", F.explode("found").alias("s")).select(
        "__row", "repository", "owner", "s.*", F.sha2("s.value", 256).alias("value_hash")
    )
    judged = spans.join(ownership(spans), "value_hash").select(
        "__row",
        F.struct(
            "start", "rank", "stop", "kind", "value_hash",
            verdict(F.col("kind"), F.col("value"), F.col("n_owners"), shared_owners).alias("verdict"), "n_owners",
        ).alias("s"),
    )
    # All spans of one text meet here; their number is bounded by the text.
    grouped = judged.groupBy("__row").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    empty = F.array().cast(grouped.schema["spans"].dataType)
    return found.select("__row", "__id").join(grouped, "__row", "left").select(
        F.col("__id").alias(id_col), F.coalesce("spans", empty).alias("spans")
    )


def secrets(docs: DataFrame) -> DataFrame:
    """The digest of `scan_secrets`: counts, hash of the base spans, all spans, and how many look live or copied."""
    found = scan_secrets(docs)
    base = F.filter("spans", lambda s: s["kind"] != "provider")
    count = lambda field, value: F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")
    return found.select(
        "doc_id",
        *[count("kind", k).alias(f"n_{k}") for k in BASE],
        F.sha2(span_string(base), 256).alias("base_sha256"),
        span_string(F.col("spans")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )
