"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Everything is a column expression. ``split`` and ``regexp_extract_all`` walk a
text with the same matcher, so the lengths of the gaps and of the matches give
the place of every match in code points. All steps are linear in the text: sums run in blocks,
context comes from the neighbouring gaps, and masks cut blocks of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds with a fixed definition, in the order in which equal starts are listed.
BASE_KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the base kinds. A greedy loop that ends a pattern is written
# possessively, which matches the same and does not recurse; a start inside a run
# that has already failed is skipped, so a long run costs one walk. A card's pattern is
# met only by whole runs of 12 to 19 digits: other runs would be dropped for their length.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SECRET = (
    r"(?i)(?<![a-z0-9])(?:token|password|passwd|secret|api[_-]?key)\x20{0,3}[=:]\x20{0,3}"
    r"""["']?[A-Za-z0-9_/+-]{8,}+["']?"""
)

# Code points on each side of a span that are searched for context words, at most so many
# matches away.
CONTEXT, NEIGHBOURS = 48, 4
# Values summed, and code points of a text cut, as one block.
BLOCK = 256
KEEP_FROM = 0.5


@dataclass(frozen=True)
class Kind:
    """One kind of span.

    ``guard`` is a cheap test that a text can hold a match at all. ``score`` is
    what a confirmed match starts from; a context word nearby adds ``lift``.
    """

    name: str
    pattern: str
    guard: str
    score: float
    lift: float
    context: str


# Fixed list of kinds and their context words.
KINDS = (
    Kind("email", EMAIL, "@", 0.9, 0.1, "mail|contact|write|kontakt|correo|courriel"),
    Kind("ip", IP, r"[0-9]\.[0-9]", 0.7, 0.2, "ip|address|host|server|adresse"),
    Kind("card", CARD, r"[0-9][\x20-]?[0-9]", 0.8, 0.2, "card|visa|credit|karte|tarjeta|carte"),
    Kind("phone", PHONE, r"\+[0-9]", 0.7, 0.2, "phone|tel|call|fax|mobile|telefon"),
    Kind("iban", IBAN, r"[A-Z]{2}[0-9]{2}", 0.8, 0.2, "iban|bank|account|konto|cuenta|compte"),
    Kind("ssn", SSN, r"[0-9]-[0-9]{2}-[0-9]", 0.3, 0.4, "ssn|social|security|insurance|tax"),
    Kind("secret", SECRET, "[=:]", 0.6, 0.2, "token|password|secret|key"),
)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    units = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)
        ),
    )
    return F.aggregate(units, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """True if an account number's check digits hold (remainder 1)."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return (
        F.aggregate(
            F.transform(F.split(moved, ""), lambda c: F.conv(c, 36, 10).cast("int")),
            F.lit(0),
            lambda a, x: F.when(x > 9, a * 100 + x).otherwise(a * 10 + x) % 97,
        )
        == 1
    )


def small_parts(ip: Column) -> Column:
    """True if no dotted part is above 255, however many zeros lead it."""
    return F.forall(
        F.transform(F.split(ip, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")),
        lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False),
    )


def confirmed(kind: str, found: Column) -> Column:
    """What a match of a kind has to pass besides its pattern."""
    if kind == "ip":
        return small_parts(found)
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(found, F.lit(" "), F.lit("")))
    return F.lit(True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` has made of all values up to each, itself included, from ``zero`` on.

    A block's own results are gathered apart, so appending never copies more than a block
    (or one value for each block).
    """

    def scan(block: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("all"))

        def step(a: Column, x: Column) -> Column:
            now = combine(a["at"], x)
            return F.struct(now.alias("at"), F.array_append(a["all"], now).alias("all"))

        return F.aggregate(block, start, step)["all"]

    def in_blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda i: F.slice(v, i * BLOCK + 1, F.lit(BLOCK)))

    def of_blocks(blocks: Column) -> Column:
        zeros = F.lit(zero)
        totals = F.transform(blocks, lambda b: F.aggregate(b, zeros, combine))
        # a block begins with what all before it have made
        firsts = F.slice(F.concat(F.array(zeros), scan(totals, zeros)), 1, F.size(blocks))
        return F.flatten(F.zip_with(blocks, firsts, scan))

    made = bound(values, lambda v: bound(in_blocks(v), of_blocks))
    return F.when(F.size(values) > 0, made).otherwise(F.array().cast("array<int>"))


SPANS = "array<struct<start:int,order:int,kind:string,end:int,score:double>>"


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """Confirmed spans of one kind: array of (start, order, kind, end, score)."""
    cut = F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
        F.split(text, kind.pattern, -1).alias("gaps"),
    )

    def placed(c: Column) -> Column:
        steps = F.zip_with(
            F.slice(c["gaps"], 1, F.size(c["found"])),
            c["found"],
            lambda gap, match: F.length(gap) + F.length(match),
        )
        return F.struct(
            c["found"].alias("found"),
            running(steps, 0, lambda a, x: a + x).alias("ends"),
            F.transform(c["gaps"], lambda g: F.right(g, F.lit(CONTEXT))).alias("tails"),
            F.transform(c["gaps"], lambda g: F.left(g, F.lit(CONTEXT))).alias("heads"),
        )

    def at(values: Column, i: Column) -> Column:
        return F.coalesce(F.get(values, i), F.lit(""))

    def near(c: Column, i: Column) -> Column:
        before = [x for k in range(NEIGHBOURS, 0, -1) for x in (at(c["tails"], i - k), at(c["found"], i - k))]
        after = [x for k in range(1, NEIGHBOURS + 1) for x in (at(c["found"], i + k), at(c["heads"], i + k + 1))]
        return F.concat(
            F.right(F.concat(*before, at(c["tails"], i)), F.lit(CONTEXT)),
            F.lit(" "),
            F.left(F.concat(at(c["heads"], i + 1), *after), F.lit(CONTEXT)),
        )

    def scored(c: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(c["found"]) - 1)
        good = F.filter(numbers, lambda i: confirmed(kind.name, c["found"][i]))

        def span(i: Column) -> Column:
            lift = F.when(near(c, i).rlike(f"(?i)\\b(?:{kind.context})"), kind.lift).otherwise(0.0)
            return F.struct(
                (c["ends"][i] - F.length(c["found"][i])).alias("start"),
                F.lit(order).alias("order"),
                F.lit(kind.name).alias("kind"),
                c["ends"][i].alias("end"),
                (F.lit(kind.score) + lift).alias("score"),
            )

        return F.transform(good, span)

    none = F.array().cast(SPANS)
    spans = bound(
        cut, lambda c: F.when(F.size(c["found"]) > 0, bound(placed(c), scored)).otherwise(none)
    )
    if kind.name not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= KEEP_FROM)
    return F.when(text.rlike(kind.guard), spans).otherwise(none)


def find_spans(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Adds ``out``, the spans of each text by start, then kind: array of structs.

    Offsets are code points, the end exclusive. Spans of different kinds may
    overlap. A NULL text counts as empty; repeated rows are searched each on its
    own; other columns pass through, except one already named ``out``, which is
    replaced. Base kinds are kept whatever their score; other kinds from
    ``KEEP_FROM`` on.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(
        out,
        F.array_sort(F.concat(*(_spans(whole, i, k) for i, k in enumerate(KINDS)))),
    )


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[KIND]``; spans that overlap become one."""

    def piece(blocks: Column, begin: Column, end: Column) -> Column:
        """Code points ``begin`` to ``end`` from the blocks that hold them."""
        first = F.floor(begin / BLOCK).cast("int")
        n = F.floor((end - 1) / BLOCK).cast("int") - first + 1
        held = F.array_join(F.slice(blocks, first + 1, n), "")
        return F.when(
            end > begin, F.substring(held, begin - first * BLOCK + 1, end - begin)
        ).otherwise("")

    def marked(c: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(c["spans"]) - 1)
        # a span that begins before an earlier one has ended is part of that one
        kept = F.filter(numbers, lambda i: c["spans"][i]["start"] >= c["ends"][i])
        parts = F.transform(
            kept,
            lambda i: F.concat(
                piece(c["blocks"], c["ends"][i], c["spans"][i]["start"]),
                F.lit("["),
                F.upper(c["spans"][i]["kind"]),
                F.lit("]"),
            ),
        )
        rest = piece(c["blocks"], F.element_at(c["ends"], -1), F.length(text))
        return F.concat(F.array_join(parts, ""), rest)

    ends = running(F.transform(spans, lambda s: s["end"]), 0, lambda a, x: F.greatest(a, x))
    whole = F.struct(
        spans.alias("spans"),
        # before each span the last end of those before it, and the last end of all
        F.concat(F.array(F.lit(0)), ends).alias("ends"),
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
    )
    return F.when(F.size(spans) > 0, bound(whole, marked)).otherwise(text)


def mask_documents(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data masked in ``text``.

    ``length``, if it names a column, is brought up to date where the text has
    changed. A NULL text stays NULL. Columns may have any names.
    """
    # own names inside, so that no column is taken for one made here
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    body = f"c{docs.columns.index(text)}"
    found = find_spans(plain, body, "spans").withColumn(
        "masked", masked(F.col(body), F.col("spans"))
    )
    columns = []
    for i, name in enumerate(docs.columns):
        kept = F.col(f"c{i}")
        if name == text:
            kept = F.col("masked")
        elif name == length:
            new = F.length("masked").cast(docs.schema[name].dataType)
            kept = F.when(F.size("spans") > 0, new).otherwise(kept)
        columns.append(kept.alias(name))
    return found.select(*columns)
