"""Secrets in texts: three fixed patterns, and runs of random characters by sliding-window entropy. DataFrame operations only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds. The last two take a run whole, so the shortest length stands in them.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

@dataclass(frozen=True)
class Shape:
    """A shape of runs: those that match all of ``has`` and none of ``lacks``.

    No pattern repeats a group without a bound: Java's matcher goes one level deeper for every such repetition, and long
    runs would overflow the stack.
    """

    has: tuple[str, ...]
    lacks: tuple[str, ...] = ()


@dataclass(frozen=True)
class Allow:
    """What is not a secret, whatever its entropy: runs that have one of the ``shapes``, and in other runs the windows that
    overlap a match of ``parts``."""

    shapes: tuple[Shape, ...] = ()
    parts: str = ""


#: Universally unique ids, words joined by signs, digests named as such by a prefix that is part of the run; the alphabet
#: and digits in order, documented example keys.
ALLOW = Allow(
    (
        Shape(("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",)),
        Shape(("^[A-Za-z][A-Za-z_/+-]*$", "[a-z]$"), ("[A-Za-z][A-Z]", "[A-Z]([^a-z]|$)")),
        Shape(("^[A-Z][A-Z_/+-]*$", "[A-Z]$")),
        Shape(("^[0-9][0-9_/+-]*$", "[0-9]$")),
        Shape(("^(sha1|sha256|sha384|sha512|md5)-",)),
    ),
    "abcdefghij|ABCDEFGHIJ|0123456789|EXAMPLE",
)

SCALE, PIECE = 1 << 20, 1024


@dataclass(frozen=True)
class RunClass:
    """A class of characters: runs of at least ``window`` of them are candidates, those whose window reaches ``bits`` of entropy count."""

    name: str
    chars: str
    window: int
    bits: float


#: Windows of as many random characters of the class lie under ``bits`` in about one of a hundred cases.
CLASSES = (
    RunClass("random_hex", "0-9A-Fa-f", 24, 3.0), RunClass("random_base64", "A-Za-z0-9+/_-", 24, 3.9),
    RunClass("random_base32", "A-Z2-7", 24, 3.5), RunClass("random_alnum", "A-Za-z0-9", 24, 3.85),
)
KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))
SPAN = "array<struct<start:long,rank:int,end:long>>"


def plogp(count: int) -> int:
    """count * log2(count) in fixed point, so that sums have no rounding drift."""
    return round(count * math.log2(count) * SCALE) if count else 0


def spans_of(text: Column, pattern: str, rank: int, good=None) -> Column:
    """Start and end (code points, end exclusive) of the matches of a pattern for which ``good(match, group 2)`` holds."""

    def step(done: Column, now: Column) -> Column:
        start = done["at"] + now["gap"]
        end = start + F.length(now["all"])
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        fits = F.lit(True) if good is None else good(now["all"], now["part"])
        return F.struct(end.alias("at"), F.when(fits, F.concat(done["spans"], one)).otherwise(done["spans"]).alias("spans"))

    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if pattern == ASSIGN else every
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(every)).alias("gap"), every.alias("all"), parts.alias("part"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))
    found = F.aggregate(zipped, start, step, lambda done: done["spans"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def lowest(run: Column, window: int) -> Column:
    """The least sum of c * log2(c), c the counts of the characters, over all windows of a run.

    A step takes out the character that leaves the window and puts in the one that enters, each by its count alone.
    """
    table = F.array(*[F.lit(plogp(c)).cast("long") for c in range(window + 1)])

    def f(count: Column) -> Column:
        return F.element_at(table, (count + 1).cast("int"))

    def count(part: Column, char: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, char, F.lit("")))

    def step(done: Column, i: Column) -> Column:
        old = F.substring(run, F.greatest(i - window, F.lit(1)), F.when(i > window, window).otherwise(i - 1))
        rest = F.when(i > window, F.substring(old, 2, window)).otherwise(old)
        leaves = count(old, F.substring(old, 1, 1))
        enters = count(rest, F.substring(run, i, F.lit(1)))
        out = F.when(i > window, f(leaves - 1) - f(leaves)).otherwise(F.lit(0).cast("long"))
        total = done["sum"] + out + f(enters + 1) - f(enters)
        return F.struct(total.alias("sum"), F.when(i >= window, F.least(done["least"], total)).otherwise(done["least"]).alias("least"))

    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(1 << 60).cast("long").alias("least"))
    return F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step, lambda done: done["least"])


def allowed(run: Column, shapes: tuple[Shape, ...]) -> Column:
    """Whether a run has one of the shapes."""
    out = F.lit(False)
    for shape in shapes:
        one = F.lit(True)
        for pattern in shape.has:
            one = one & run.rlike(pattern)
        for pattern in shape.lacks:
            one = one & ~run.rlike(pattern)
        out = out | one
    return out


def overlapping(texts: Column, window: int) -> Column:
    """Texts cut into pieces that overlap by a window less one, so that every window is in one piece."""

    def cut(text: Column) -> Column:
        # an array of one, so that the pieces are cut once and can be looked up by place
        pieces = F.array(F.regexp_extract_all(text, F.lit(f".{{1,{PIECE}}}"), F.lit(0)))

        def each(all_: Column) -> Column:
            after = lambda i: F.coalesce(F.substring(F.get(all_, i + 1), 1, window - 1), F.lit(""))
            return F.transform(all_, lambda piece, i: F.concat(piece, after(i)))

        return F.flatten(F.transform(pieces, each))

    return F.flatten(F.transform(texts, cut))


def random_run(kind: RunClass, allow: Allow):
    """The test that a run holds a window of high entropy that no allow-list entry silences.

    What lies between the matches of the list's parts holds just the windows that overlap none.
    """
    most = plogp(kind.window) - round(kind.bits * kind.window * SCALE)

    def good(run: Column, _: Column) -> Column:
        rest = F.split(run, allow.parts, -1) if allow.parts else F.array(run)
        pieces = overlapping(F.filter(rest, lambda x: F.length(x) >= kind.window), kind.window)
        high = F.exists(pieces, lambda piece: (F.length(piece) >= kind.window) & (lowest(piece, kind.window) <= most))
        return F.when(allowed(run, allow.shapes), False).otherwise(high)

    return good


def find(text: Column, classes: tuple[RunClass, ...] = CLASSES, allow: Allow = ALLOW) -> Column:
    """All spans of a text as an array of (start, rank of the kind, end), by start, then kind."""
    clean = F.coalesce(text, F.lit(""))
    spans = [
        spans_of(clean, ASSIGN, 0, lambda _, value: F.length(value) >= ASSIGN_LEAST),
        spans_of(clean, ACCESS, 1),
        spans_of(clean, HEX, 2),
    ]
    for i, kind in enumerate(classes):
        spans.append(spans_of(clean, f"[{kind.chars}]{{{kind.window},}}", 3 + i, random_run(kind, allow)))
    return F.array_sort(F.concat(*spans))


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def scan(docs: DataFrame, text: str = "text", classes: tuple[RunClass, ...] = CLASSES, allow: Allow = ALLOW) -> DataFrame:
    """Add ``secret_spans`` (start, rank in KINDS, end; code points, end exclusive) to every row.

    The base kinds are reported as they match; the allow-list only silences the entropy kinds. Runs of any length are
    scanned whole. A null or empty text has
    no spans. Repeated rows are scanned one by one, an empty table gives an empty result, and a column already named
    ``secret_spans`` is replaced.
    """
    return docs.withColumn("secret_spans", find(F.col(text), classes, allow))


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """Replace the secrets in a text by a mask; overlapping spans become one. Null texts stay null, other columns as they are."""

    def step(done: Column, s: Column) -> Column:
        piece = F.concat(F.substring(F.col(text), (done["at"] + 1).cast("int"), F.greatest(s["start"] - done["at"], F.lit(0)).cast("int")), F.lit(mask))
        out = F.when(s["start"] >= done["at"], F.concat(done["out"], piece)).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    def end(done: Column) -> Column:
        return F.concat(done["out"], F.substring(F.col(text), (done["at"] + 1).cast("int"), F.length(F.col(text))))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    columns = docs.columns
    spans = "spans" + "_" * max(map(len, columns))  # longer than any column, so of another name
    found = docs.select(*[F.col(f"`{c}`") for c in columns], find(F.col(text), **options).alias(spans))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, end)).otherwise(F.col(text))
    return found.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in columns])
