"""Secret scan in DataFrame functions: fixed patterns plus sliding-window entropy.

Base kinds are three patterns. The entropy kinds look at long runs of one character class: the
Shannon entropy of every window of 20 characters is kept up to date from character counts, one
character in and one out per step, and a run is a secret if some window reaches the class's limit.
Allow-listed windows are suppressed: without digits (compound names are as dense as keys) or without letters, or
touching six equal characters or a word that marks a sample value. The other windows of the run still count, and
the whole run is reported. It may overlap spans of other kinds; only what lies inside one of them is left out.

Entropies use a table of c*log2(c) in millionths of a bit, so sums are exact and do not depend on
their order. Spans count code points, end exclusive. A null text counts as empty and has no spans;
a repeated row gets its own result; an empty table gives an empty one.

``split`` and ``regexp_extract_all`` walk a text by the same matches, so the pieces between matches
and the matches themselves give every position without a user function.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import ascii_any_case, only

# The base patterns.
_KEYWORDS = ("password", "passwd", "secret", "token")
ASSIGN = (
    "(" + "|".join([*map(ascii_any_case, _KEYWORDS), ascii_any_case("api") + "_?" + ascii_any_case("key")]) + ")"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE_CHARS = 8
ACCESS = "AKIA[A-Z0-9]{12,}"  # 16 characters or more in all
HEX = "[0-9a-f]{32,}"
BASE_KINDS = ("assign", "access", "hex")

WINDOW = 20
SCALE = 1_000_000
SAMPLE_WORDS = ("example", "sample", "dummy", "placeholder", "changeme")


@dataclass(frozen=True)
class CharacterClass:
    """Candidate runs of one class and the entropy, in bits per character, a window must reach."""

    kind: str
    pattern: str
    alphabet: str
    bits: float


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("entropy_hex", f"[0-9A-Fa-f]{{{WINDOW},}}", _DIGITS + "abcdefABCDEF", 3.0),
    CharacterClass(
        "entropy_base64", f"[A-Za-z0-9+/_-]{{{WINDOW},}}", _DIGITS + _LOWER + _LOWER.upper() + "+/_-", 3.8
    ),
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))
#: Allow-list: windows that touch a repeated character or the name of a sample are left out.
MARKED = "|".join([*(f"{c}{{6}}" for c in (_DIGITS + _LOWER + _LOWER.upper())), *map(ascii_any_case, SAMPLE_WORDS)])


def count_bits(count: int) -> int:
    """count * log2(count) in millionths."""
    return round(count * math.log2(count) * SCALE) if count else 0


def most_repetition(bits: float) -> int:
    """The largest sum of ``count_bits`` at which a window's entropy still reaches ``bits``."""
    return count_bits(WINDOW) - round(bits * WINDOW * SCALE)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found) of all matches, left to right without overlap."""
    return F.when(
        text.rlike(pattern),
        F.aggregate(
            F.arrays_zip(
                F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
            ),
            F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,end:int,found:string>>)").alias("out")),
            lambda state, x: F.when(x["found"].isNull(), state).otherwise(
                F.struct(
                    (state["at"] + x["gap"] + F.length(x["found"])).alias("at"),
                    F.concat(
                        state["out"],
                        F.array(
                            F.struct(
                                (state["at"] + x["gap"]).alias("start"),
                                (state["at"] + x["gap"] + F.length(x["found"])).alias("end"),
                                x["found"].alias("found"),
                            )
                        ),
                    ).alias("out"),
                )
            ),
            lambda state: state["out"],
        ),
    ).otherwise(F.expr("CAST(array() AS array<struct<start:int,end:int,found:string>>)"))


def least_repetition(run: Column, alphabet: str) -> Column:
    """The smallest sum of ``count_bits`` over the windows of a run with a digit and a letter, by incremental counts."""
    table = F.array(*[F.lit(count_bits(c)) for c in range(WINDOW + 1)])
    place = lambda at: F.instr(F.lit(alphabet), F.substring(run, at, F.lit(1)))
    # An alphabet holds the digits first, then the letters.
    letters = len(_DIGITS) + sum(c.isalpha() for c in alphabet)
    digit = lambda at: at.between(1, len(_DIGITS)).cast("int")
    letter = lambda at: at.between(len(_DIGITS) + 1, letters).cast("int")

    def step(state: Column, at: Column) -> Column:
        entering, leaving = place(at), F.when(at > WINDOW, place(at - WINDOW)).otherwise(F.lit(0))
        before_in = F.get(state["counts"], entering)
        added = state["sum"] + F.get(table, before_in + 1) - F.get(table, before_in)
        # The one that leaves is counted after the one that enters, so equal characters cancel out.
        before_out = F.get(state["counts"], leaving) + (leaving == entering).cast("int")
        total = F.when(
            leaving > 0, added + F.get(table, before_out - 1) - F.get(table, before_out)
        ).otherwise(added)
        counts = F.transform(
            state["counts"],
            lambda count, i: count + (i == entering).cast("int") - ((i == leaving) & (leaving > 0)).cast("int"),
        )
        digits = state["digits"] + digit(entering) - digit(leaving)
        letters = state["letters"] + letter(entering) - letter(leaving)
        counted = (at >= WINDOW) & (digits > 0) & (letters > 0)
        least = F.when(counted, F.least(state["least"], total)).otherwise(state["least"])
        parts = {"counts": counts, "digits": digits, "letters": letters, "sum": total, "least": least}
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"),
        F.lit(0).alias("digits"),
        F.lit(0).alias("letters"),
        F.lit(0).alias("sum"),
        F.lit(2**31 - 1).alias("least"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step, lambda state: state["least"])


def dense_runs(text: Column, of: CharacterClass) -> Column:
    """Matches of a class with a window of enough entropy between the allow-listed stretches."""

    def dense(part: Column) -> Column:
        return (F.length(part) >= WINDOW) & (least_repetition(part, of.alphabet) <= most_repetition(of.bits))

    return F.filter(matches(text, of.pattern), lambda m: F.exists(F.split(m["found"], MARKED, -1), dense))


def _tagged(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")),
    )


def _beyond(found: Column, others: Column) -> Column:
    """Those that do not lie inside one of the others."""
    return F.filter(found, lambda m: ~F.exists(others, lambda o: (o["start"] <= m["start"]) & (m["end"] <= o["end"])))


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``base`` and ``spans``: arrays of (start, kind, end), in order."""
    text = F.coalesce("text", F.lit(""))
    value_chars = lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2))
    rows = docs.select(
        "*",
        F.concat(
            _tagged(F.filter(matches(text, ASSIGN), lambda m: value_chars(m) >= ASSIGN_VALUE_CHARS), "assign"),
            _tagged(matches(text, ACCESS), "access"),
            _tagged(matches(text, HEX), "hex"),
        ).alias("base"),
        *[
            _tagged(dense_runs(text, c), c.kind).alias(c.kind)
            for c in CLASSES
        ],
    )
    every = F.col("base")
    for c in CLASSES:
        every = F.concat(every, _beyond(F.col(c.kind), every))
    return rows.withColumn("spans", F.array_sort(every)).withColumn("base", F.array_sort("base")).drop(*[c.kind for c in CLASSES])


def written(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.col(spans), one), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans, per row of ``docs``."""
    rows = with_spans(only(docs, "doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(written("base"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )


def redact(docs: DataFrame, marker: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced by ``marker``; n_chars follows if there."""
    text = F.col("text")

    def step(state: Column, s: Column) -> Column:
        new = s["start"] >= state["at"]
        piece = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(marker))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(new, piece).otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans", start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    )
    found = F.size("spans") > 0
    # The row travels as one column, so that none of its names can clash with ours.
    packed = docs.select("text", F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    replaced = with_spans(packed).select("row", found.alias("found"), F.when(found, clean).otherwise(text).alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("found"), F.length("text").cast("long"))}
    return replaced.select(
        *[
            (F.coalesce(changed[name], F.col("row")[name]) if name in changed else F.col("row")[name]).alias(name)
            for name in docs.columns
        ]
    )
