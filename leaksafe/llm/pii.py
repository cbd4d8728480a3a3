"""Personal data by weak supervision.

Regex patterns, a gazetteer and context words vote on candidate spans. Expectation-maximisation estimates how reliable
each labeler is without any labelled span, and the posteriors train a span classifier over shape features. Only DataFrame
functions touch the data; the driver sees counts per vote pattern and feature cell, of which there are at most
3^5 x 96 for each of eight kinds.

Cases: null or empty text gives no span; repeated rows are treated alike, one result row each; an empty table gives an
empty result; only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.llm.shared import indexes, let, matches, span_string, text_of, written

# The base kinds in their order of listing. Possessive repeats match the same text without backtracking, and a start is
# only tried at the edge of a run (or where the last match ended), so that long runs cost linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
# Further candidates, accepted only by the trained classifier.
OTHER = (
    r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b\.?\x20\p{Lu}\p{L}++(?:\x20\p{Lu}\p{L}++)?"
    r"|(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
    r"|\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+\b"
    r"|(?<![0-9+])\(?[0-9]{3,5}\)?[\x20/-][0-9]{3}[\x20-]?[0-9]{4}(?![0-9-])"
)
KINDS = BASE + ("name", "ssn", "iban", "local_phone")
# Words that make personal data likely, endings and prefixes known to belong to real data.
CUES = r"(?i)\b(?:e-?mail|mail|contact|write|phone|tel|call|fax|mobile|card|visa|account|ip|host|address|ssn|iban|name|born|von|de)\b"
ANTI_CUES = r"(?i)\b(?:version|isbn|example|sample|chapter|page|figure|total|id|no|sku|invoice|order)\b\W*$"
KNOWN = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$",
    "ip": r"^(?!0|127\.|255\.)[0-9.]+$",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|33|34|39|41|43|44|49)\b",
    "name": r"(?i)^(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b",
    "ssn": r"^(?!000|666|9)",
    "iban": r"^(?:DE|FR|ES|GB|IT|NL|AT|CH|BE)",
    "local_phone": r"^\(?0?[2-9]",
}
CONTEXT = 40
LABELERS = 5


def luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + let(
            F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
            lambda d: F.when(d > 9, d - 9).otherwise(d),
        ),
    )
    return total % 10 == 0


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _octets(hit: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(
        F.split(hit, r"\."), lambda p: F.when(F.length(part(p)) <= 3, part(p).try_cast("int") <= 255).otherwise(False)
    )


def _card(hit: Column) -> Column:
    return let(digits_of(hit), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))


def base_spans(text: Column) -> dict[str, Column]:
    """Valid base matches per kind."""
    return {
        "email": matches(text, EMAIL),
        "ip": F.filter(matches(text, IP), lambda m: _octets(m["hit"])),
        "card": F.filter(matches(text, CARD), lambda m: _card(m["hit"])),
        "phone": F.filter(matches(text, PHONE), lambda m: F.length(digits_of(m["hit"])).between(8, 15)),
    }


def _other_kind(hit: Column) -> Column:
    return (
        F.when(hit.rlike(r"^\p{L}+\b\.?\x20\p{Lu}"), "name")
        .when(hit.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(hit.rlike("^[A-Z]{2}[0-9]{2}"), "iban")
        .otherwise("local_phone")
    )


def _vote(yes: Column, no: Column) -> Column:
    """2 for, 1 abstain, 0 against."""
    return F.when(F.coalesce(yes, F.lit(False)), 2).when(F.coalesce(no, F.lit(False)), 0).otherwise(1)


def _candidate(text: Column, kind: Column, m: Column, validated: Column) -> Column:
    hit, start, stop = m["hit"], m["start"], m["stop"]
    at = F.greatest(F.lit(0), start - CONTEXT)
    before = F.substring(text, (at + 1).cast("int"), (start - at).cast("int"))
    after = F.substring(text, (stop + 1).cast("int"), F.lit(CONTEXT))
    known = F.lit(False)
    for name, pattern in KNOWN.items():
        known = F.when(kind == name, hit.rlike(pattern)).otherwise(known)
    solid = digits_of(hit)
    votes = [
        _vote(validated, ~validated),
        _vote(known, ~known),
        _vote(before.rlike(CUES), before.rlike(ANTI_CUES)),
        _vote(after.rlike(r"^[\x20\x09-\x0D,.;:)\"]"), after.rlike("^[A-Za-z0-9_]")),
        _vote((F.length(solid) == 0) | solid.rlike("([0-9])(?!\\1).*"), solid.rlike("^([0-9])\\1+$")),
    ]
    code = F.lit(0)
    for vote in votes:
        code = code * 3 + vote
    size = F.least(F.length(hit), F.lit(47)) / 4
    mixed = F.when(F.length(solid) == 0, 0).when(F.length(solid) == F.length(hit), 1).otherwise(2)
    spaced = F.when(hit.contains(" "), 1).otherwise(0)
    cell = (F.floor(size) * 6 + mixed * 2 + spaced).cast("int")
    return F.struct(
        kind.alias("kind"), start.alias("start"), stop.alias("stop"), code.alias("votes"), cell.alias("cell")
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the base spans by kind and start, and the other candidates that overlap none of them."""
    rows = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text"))
    base = base_spans(F.col("__text"))
    rows = rows.select("__id", "__text", *[c.alias(f"__{k}") for k, c in base.items()], matches(F.col("__text"), OTHER).alias("__other"))
    text = F.col("__text")

    def of(kind: str) -> Column:
        return F.transform(f"__{kind}", lambda m: _candidate(text, F.lit(kind), m, F.lit(True)))

    spans = F.concat(*[of(k) for k in BASE])
    extra = F.transform(
        "__other", lambda m: _candidate(text, _other_kind(m["hit"]), m, ~m["hit"].rlike(r"^([0-9])\1{2}"))
    )
    rows = rows.select("__id", spans.alias("base"), extra.alias("extra"))
    clear = F.filter("extra", lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])))
    return rows.select("__id", "base", clear.alias("extra"))


@dataclass
class SpanModel:
    """Reliabilities of the labelers and the span classifier's accepted (kind, cell) pairs."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: list[tuple[tuple[float, ...], tuple[float, ...]]] = field(default_factory=list)
    probability: dict[tuple[str, int], float] = field(default_factory=dict)

    def accepts(self, threshold: float = 0.5) -> list[str]:
        return sorted(f"{k}/{c}" for (k, c), p in self.probability.items() if p >= threshold)


def _unpack(code: int) -> tuple[int, ...]:
    out = []
    for _ in range(LABELERS):
        code, vote = divmod(code, 3)
        out.append(vote)
    return tuple(reversed(out))


def fit(cells: list[tuple[str, int, int, int]], rounds: int = 25) -> SpanModel:
    """EM over (kind, votes, cell, count) counts: two classes, labelers independent given the class.

    Votes for start at 80 % reliability and are re-estimated with add-one smoothing; the classifier is
    naive Bayes on the feature cell within a kind, fitted to the posteriors.
    """
    model = SpanModel()
    counts: dict[tuple[str, int], int] = defaultdict(int)
    for kind, votes, _, n in cells:
        counts[kind, votes] += n
    table = sorted((kind, votes, _unpack(votes), n) for (kind, votes), n in counts.items())
    model.prior = {kind: 0.5 for kind in KINDS}
    model.reliability = [((0.2, 0.3, 0.5), (0.5, 0.3, 0.2)) for _ in range(LABELERS)]
    post: dict[tuple[str, int], float] = {}
    for _ in range(rounds):
        true, false = [[1.0] * 3 for _ in range(LABELERS)], [[1.0] * 3 for _ in range(LABELERS)]
        held: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
        for kind, code, votes, n in table:
            p, q = math.log(model.prior[kind]), math.log(1 - model.prior[kind])
            for (pos, neg), v in zip(model.reliability, votes, strict=True):
                p, q = p + math.log(pos[v]), q + math.log(neg[v])
            post[kind, code] = share = 1 / (1 + math.exp(max(-500.0, min(500.0, q - p))))
            held[kind][0] += n * share
            held[kind][1] += n * (1 - share)
            for j, v in enumerate(votes):
                true[j][v] += n * share
                false[j][v] += n * (1 - share)
        model.reliability = [
            (tuple(x / sum(t) for x in t), tuple(x / sum(f) for x in f)) for t, f in zip(true, false, strict=True)
        ]
        model.prior |= {kind: a / (a + b) for kind, (a, b) in held.items()}
    soft: dict[tuple[str, int], list[float]] = defaultdict(lambda: [0.5, 0.5])
    for kind, votes, cell, n in cells:
        soft[kind, cell][0] += n * post[kind, votes]
        soft[kind, cell][1] += n * (1 - post[kind, votes])
    model.probability = {key: a / (a + b) for key, (a, b) in soft.items()}
    return model


def train(found: DataFrame) -> SpanModel:
    """Count vote patterns and feature cells over all candidates and fit on the counts."""
    spans = found.select(F.explode(F.concat("base", "extra")).alias("s")).select("s.kind", "s.votes", "s.cell")
    counts = spans.groupBy("kind", "votes", "cell").count().collect()
    return fit(sorted((r["kind"], r["votes"], r["cell"], r["count"]) for r in counts))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: id, `base` spans (always kept) and `spans`, which adds the candidates the classifier accepts."""
    found = written(candidates(docs, id_col, text_col))
    accepted = train(found).accepts(threshold)
    taken = (
        F.filter("extra", lambda s: F.concat_ws("/", s["kind"], s["cell"].cast("string")).isin(accepted))
        if accepted
        else F.filter("extra", lambda s: F.lit(False))
    )
    order = F.array_sort(
        F.transform(
            taken,
            lambda s: F.struct(
                F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("rank"),
                s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"),
            ),
        )
    )
    slim = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return found.select(F.col("__id").alias(id_col), slim(F.col("base")).alias("base"), F.concat(slim(F.col("base")), slim(order)).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts with every span of `base_spans` cut out and its kind left in brackets, one kind after another."""
    rows = docs.select(F.col(id_col), text_of(text_col).alias(text_col))
    for kind in BASE:
        rows = rows.withColumn("__m", base_spans(F.col(text_col))[kind])
        end = lambda i: F.when(i > 0, F.col("__m")[i - 1]["stop"]).otherwise(F.lit(0)).cast("int")
        kept = F.transform(
            indexes(F.size("__m")),
            lambda i: F.substring(F.col(text_col), end(i) + 1, F.col("__m")[i]["start"].cast("int") - end(i)),
        )
        rest = F.substring(F.col(text_col), end(F.size("__m")) + 1, F.length(text_col))
        rows = rows.withColumn(text_col, F.array_join(F.concat(kept, F.array(rest)), f"[{kind}]")).drop("__m")
    return rows


def personal_data(docs: DataFrame) -> DataFrame:
    """The digest of `find_pii`: counts, hash of the base spans, all spans."""
    found = find_pii(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(span_string(F.col("base")), 256).alias("base_sha256"),
        span_string(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
