"""Personal data in texts, found with SQL functions alone.

Each kind has a pattern that proposes spans and a validator that confirms them:
address parts, digit counts, the Luhn checksum, the mod-97 checksum. A score
starts from how telling the pattern and its check are and rises if words that
go with the kind stand near. Four base kinds (email, ip, card, phone) keep every
confirmed span; further kinds report a span only if its score reaches
``min_score``.

Positions come from one split of the text at the matches: a match begins after
all pieces and matches before it, counted in code points. The patterns are
written so that a run of characters is tried once (possessive quantifiers, a
look-behind at the run's start), which finds the same leftmost matches in time
linear in the text.

Defined results: a null text is empty and has no spans; every row is taken as
it is; matches of one kind do not overlap, kinds may.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a match in which context words count.
CONTEXT = 48
MIN_SCORE = 0.6


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def digit_array(value: Column) -> Column:
    """Digits of a value as numbers, last first."""
    return F.transform(F.split(F.reverse(digits(value)), ""), lambda c: c.cast("int"))


def luhn(value: Column) -> Column:
    """Whether the value's digits pass the Luhn checksum."""

    def weigh(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(digit_array(value), weigh), F.lit(0), lambda s, x: s + x)
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 checksum (its first four characters go last, letters count from 10)."""
    bare = F.upper(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    moved = F.concat(F.substring(bare, F.lit(5), F.char_length(bare)), F.substring(bare, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97).cast("int")

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def octets(value: Column) -> Column:
    """Whether all dotted parts are at most 255."""
    parts = F.transform(F.split(value, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p.cast("int")).otherwise(F.lit(999)) <= 255))


def digits_between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda value: F.length(digits(value)).between(low, high)


def always(value: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """What proposes, confirms and supports one kind of span."""

    name: str
    pattern: str
    confirms: Callable[[Column], Column]
    base: bool
    score: float
    words: str
    needs: str = field(default="[0-9]")
    context_score: float = 0.3


# Patterns and limits of the base kinds.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        always,
        True,
        0.8,
        "mail|contact|write|address|correo|courriel|kontakt",
        "@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        octets,
        True,
        0.6,
        "ip|host|server|address|client|login|addr",
        r"[0-9]\.[0-9]",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda v: digits_between(13, 19)(v) & luhn(v), True, 0.7, "card|visa|credit|debit|payment|karte|tarjeta|carte", "[0-9][ 0-9-][0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", digits_between(9, 15), True, 0.6, "phone|call|tel|mobile|fax|whatsapp|telefon|tél|llam", r"\+[0-9]"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda v: F.length(F.regexp_replace(v, " ", "")).between(15, 34) & mod97(v),
        False,
        0.9,
        "iban|account|bank|konto|compte|cuenta|transfer",
        "[A-Z]{2}[0-9]{2}",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        always,
        False,
        0.6,
        "ssn|social|security|insurance|tax",
        "[0-9]-[0-9]",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])",
        digits_between(10, 10),
        False,
        0.4,
        "phone|call|tel|mobile|fax|whatsapp|telefon|tél|llam",
        "[0-9][.-][0-9]",
    ),
    Kind(
        "secret",
        r"(?i)(?<![A-Za-z0-9_])(?:api[_-]?key|token|secret|passw(?:or)?d|access[_-]?key)\x20{0,3}[:=]\x20{0,3}[\"']?[A-Za-z0-9/+_-]{12,}+",
        always,
        False,
        0.8,
        "api|auth|secret|credential",
        "[:=]",
    ),
)

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,score:double>"


def _spans(kind: Kind, text: Column, min_score: float) -> Column:
    """Confirmed spans of one kind in order, as an array of ``SPAN``."""
    pattern = F.lit(kind.pattern)
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, kind.pattern, -1)

    def found(values_: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            start = state["at"] + F.char_length(x["piece"])
            end = start + F.char_length(x["value"])
            return F.struct(
                end.cast("long").alias("at"),
                F.when(
                    kind.confirms(x["value"]),
                    F.concat(state["spans"], F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), x["value"].alias("value")))),
                )
                .otherwise(state["spans"])
                .alias("spans"),
            )

        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,value:string>>").alias("spans"))
        pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(values_)), values_, lambda p, v: F.struct(p.alias("piece"), v.alias("value")))
        return F.aggregate(pairs, zero, step, lambda s: s["spans"])

    def scored(span: Column) -> Column:
        first = F.greatest(span["start"] - CONTEXT, F.lit(0))
        near = F.concat(
            F.substring(text, (first + 1).cast("int"), (span["start"] - first).cast("int")), F.lit(" "), F.substring(text, (span["end"] + 1).cast("int"), F.lit(CONTEXT))
        )
        context = near.rlike(f"(?i)(?<![a-z])(?:{kind.words})")
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(context, F.lit(kind.context_score)).otherwise(F.lit(0.0)))
        return F.struct(F.lit(kind.name).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), span["value"].alias("value"), score.alias("score"))

    spans = F.transform(F.transform(F.array(values), found)[0], scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= min_score)
    # texts without what every match needs are not searched
    return F.when(text.contains(kind.needs) if kind.needs == "@" else text.rlike(kind.needs), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def find(docs: DataFrame, *, text: str = "text", min_score: float = MIN_SCORE, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The documents' columns in ``doc``, with ``spans``: kind, start, end, value, score, by kind and then start."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    each = rows.select("doc", *[_spans(k, F.col("_text"), min_score).alias(f"_{k.name}") for k in kinds])
    return each.select("doc", F.concat(*[f"_{k.name}" for k in kinds]).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def masked(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, every span replaced by its kind in angle brackets; of overlapping spans the first."""

    def step(state: Column, s: Column) -> Column:
        between = F.substring(state["text"], (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        more = F.struct(s["end"].alias("at"), F.concat(state["out"], between, F.lit("<"), s["kind"], F.lit(">")).alias("out"), state["text"].alias("text"))
        return F.when(s["start"] >= state["at"], more).otherwise(state)

    rows = find(docs, text=text, **options)
    body = F.coalesce(F.col("doc").getField(text), F.lit(""))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"), body.alias("text"))
    clean = F.aggregate(order, zero, step, lambda s: F.concat(s["out"], F.substring(s["text"], (s["at"] + 1).cast("int"), F.char_length(s["text"]))))
    new = F.when(F.size("spans") > 0, clean).otherwise(F.col("doc").getField(text))
    return rows.select(*[new.alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns])
