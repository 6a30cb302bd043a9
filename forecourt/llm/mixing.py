"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the output's characters over its own characters: the mean
number of times each of its documents is repeated. Every document draws its count by inverting the
Poisson distribution at a uniform hash of the seed and its doc_id, is repeated that often, and all
copies are dealt to tasks by another hash and sorted by it there, which is a shuffle over all documents
without a sample of them first. Any subset of machines, or a retried task, draws the same.

The distribution is tabulated once per source, so a document only counts the table entries at or
below its uniform number. A rate above ``PART_RATE`` is the sum of independent parts of smaller
rate, since exp(-rate) would vanish. Large sources are summed per task before the shuffle; the
table of rates is joined without a hint, so Spark broadcasts it only if it is small.

A null source is a source of its own. A null text has no characters; a source without characters
keeps the rate 1. Rows that share a doc_id draw the same count. Rows without doc_id draw by a hash
of their text. An empty table gives an empty result. A source that ``weights`` does not name gets
weight 0.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import only, text_or_empty
from forecourt.session import stage

SEED = 20
PART_RATE = 16.0
#: Table entries for a rate of at most PART_RATE: beyond them the distribution holds less than 2^-52.
ENTRIES = 72
_HEX_DIGITS = 13  # 52 bits of a hash make a uniform number


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the MD5 of the parts, joined by colons (null: empty)."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(float(16**_HEX_DIGITS))


def _drawn_by() -> Column:
    """What a row's hashes are taken of: its doc_id, or a hash of its text if it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(text_or_empty())))


def _table(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... at ``rate``."""

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        total = F.element_at(state["cdf"], -1) + p
        return F.struct(p.alias("p"), F.concat(state["cdf"], F.array(total)).alias("cdf"))

    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ENTRIES - 1)), start, step, lambda s: s["cdf"])


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0) -> DataFrame:
    """source, n_chars, rate, n_parts and cdf per source.

    ``weights`` are target shares, scaled to sum to 1; by default they follow the square root of a
    source's characters, which lifts small sources. ``size`` is the output's length as a multiple
    of the input's.
    """
    sizes = stage(
        only(docs, "source", "text")
        .groupBy("source")
        .agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("double").alias("n_chars")),
        "sizes",
    )
    if weights is None:
        weight = F.sqrt("n_chars")
    else:
        pairs = [F.lit(x) for name, share in weights.items() for x in (name, float(share))]
        named = F.create_map(*pairs) if pairs else F.expr("CAST(map() AS map<string,double>)")
        weight = F.coalesce(F.try_element_at(named, F.col("source")), F.lit(0.0))
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.sum("n_chars").alias("n_chars"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(total["weight"] or 1.0)
    rate = F.when(F.col("n_chars") > 0, F.lit(size * (total["n_chars"] or 0.0)) * share / F.col("n_chars")).otherwise(1.0)
    rates = sizes.select("source", "n_chars", rate.alias("rate"))
    rates = rates.withColumn("n_parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE).cast("int")))
    return rates.withColumn("cdf", _table(F.col("rate") / F.col("n_parts")))


def replication_counts(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), ``drawn_by`` and ``n_copies``, the document's Poisson count."""

    def draw(part: Column) -> Column:
        u = uniform(F.lit(str(seed)), F.col("drawn_by"), part.cast("string"))
        return F.size(F.filter("cdf", lambda p: p <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("n_parts")), F.lit(0), lambda total, part: total + draw(part))
    # The row travels as one column, so that none of its names can clash with ours.
    packed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), F.col("source").alias("own"), _drawn_by().alias("drawn_by")
    )
    joined = packed.join(rates.select("source", "n_parts", "cdf"), F.col("own").eqNullSafe(F.col("source")))
    return joined.select("row", "drawn_by", count.alias("n_copies"))


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0, seed: int = SEED
) -> DataFrame:
    """Every document as often as it was drawn, in an order shuffled over all documents.

    Adds ``n_copies``, ``copy`` (from 1) and ``position`` (the hash that orders the rows of a task);
    columns of ``docs`` with these names are replaced.
    """
    rows = docs.drop("n_copies", "copy", "position")
    counted = replication_counts(rows, source_rates(rows, weights, size), seed)
    copies = counted.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    position = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("drawn_by"), F.col("copy").cast("string")))
    dealt = copies.select("row", "n_copies", "copy", position.alias("position"))
    dealt = dealt.repartition("position").sortWithinPartitions("position")
    return dealt.select(*[F.col("row")[name].alias(name) for name in rows.columns], "n_copies", "copy", "position")
