"""What each filter removes in every order of application, from decision diagrams of failure masks.

Every document gets a mask of the filters it fails. The masks of a part are counted on Spark (at most 2^n rows
a part, whatever its size) and become one count-weighted decision diagram: a level per filter, the low branch
passes, the high branch fails, and a node that nobody fails is left out. Neighbouring levels are swapped in
place, and a chain of such swaps visits all orders. In each, the path on which everything passes gives the
steps: the weight of a node's high branch is removed there, that of its low branch stays.

Documents are rows: repeated rows count each. Null text is empty (no words, so it fails A and no other but E);
null lang is the part ``''``. A row without doc_id has no labels, and is neither a copy nor an original for E.
Rows with one doc_id and one text are no copies of each other. Of several labels of a document any that says 1
counts. Empty documents give no rows; further columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import only, text_or_empty

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = "[#$%&*|]"
_WHITE = r"[\x20\x09-\x0D]+"
_LOST = ("good", "toxic")
_COUNTS = ("n", *_LOST)
_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long,"
    " good_lost long, toxic_lost long, shapley long"
)


def _text_failures() -> dict[str, Column]:
    """The filters that a text decides by itself."""
    first, last = F.col("words")[0] == "", F.element_at("words", -1) == ""
    n_words = F.size("words") - first.cast("int") - (last & (F.size("words") > 1)).cast("int")
    n_distinct = F.size(F.array_distinct("words")) - (first | last).cast("int")
    return {
        "A": n_words < LEAST_WORDS,
        "B": F.lit(100).cast("long") * n_distinct < F.lit(LEAST_DISTINCT_PERCENT).cast("long") * n_words,
        "C": F.lit(100).cast("long") * F.regexp_count("text", F.lit("[A-Z]"))
        > F.lit(MOST_CAPITALS_PERCENT).cast("long") * F.length("text"),
        "D": F.col("text").rlike(SYMBOLS),
    }


def _bits(failures: dict[str, Column]) -> Column:
    """Bit i is set if the i-th filter fails."""
    bits = [F.when(failed, 1 << FILTERS.index(name)).otherwise(0) for name, failed in failures.items()]
    return sum(bits[1:], bits[0]).cast("int")


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail exactly the filters of the mask.

    Texts are read once and leave the scan as digests. Copies are counted before they meet under their digest,
    so a large group of them is a few rows a task.
    """
    texts = only(docs, "doc_id", "text", "lang").select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_or_empty().alias("text"))
    split = texts.withColumn("words", F.split("text", _WHITE))
    rows = split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), _bits(_text_failures()).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))

    marked = only(labels, "doc_id", "quality", "toxic").where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    marked = marked.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    # Rows without id match nothing; their digest spreads them over the join's tasks.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    rows = rows.withColumn("spread", spread).join(marked.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    lost = [F.coalesce(name, F.lit(False)).alias(name) for name in _LOST]

    known = F.col("doc_id").isNotNull()
    per_text = (
        rows.select("doc_id", "part", "digest", "mask", "n", *lost)
        .groupBy("digest", "part", "mask", *_LOST)
        .agg(
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_known"),
            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_unknown"),
            F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
        )
    )
    # A text has a row for each part and label at most.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    original = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    counted = per_text.select("part", "mask", *_LOST, "n_known", (original + F.col("n_unknown")).alias("n_original"), original.alias("n_least"))
    copies = 1 << FILTERS.index("E")
    kinds = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("n_original").alias("n")),
        F.struct((F.col("mask") + copies).alias("mask"), (F.col("n_known") - F.col("n_least")).alias("n")),
    )
    kinds = counted.select("part", *_LOST, F.explode(kinds).alias("kind")).select("part", *_LOST, "kind.mask", "kind.n")
    sums = [F.sum("n").alias("n"), *[F.sum(F.when(F.col(x), F.col("n")).otherwise(0)).alias(x) for x in _LOST]]
    return kinds.where(F.col("n") > 0).groupBy("part", "mask").agg(*sums)


Weights = tuple[int, ...]


class Diagram:
    """A zero-suppressed decision diagram whose ends are weights.

    Nodes are numbered. Node 0 is the end without weight; a node's weight is the sum of what lies below it.
    No two nodes have one filter and the same branches, and no node's high branch is node 0.
    """

    def __init__(self, order: str, counts: dict[int, Weights], width: int):
        self.order = list(order)
        zero = (0,) * width
        self.filter: list[str | None] = [None]
        self.low, self.high = [0], [0]
        self.weight: list[Weights] = [zero]
        self._node_of: dict[tuple, int] = {}
        ends = {mask: self._end(weights) for mask, weights in counts.items() if any(weights)}
        # Bit i of a mask is the i-th filter of the first order.
        self.root = self._build(0, ends)

    def _end(self, weights: Weights) -> int:
        return self._intern((None, weights), weights, None, 0, 0)

    def _intern(self, key: tuple, weight: Weights, name: str | None, low: int, high: int) -> int:
        if key not in self._node_of:
            self._node_of[key] = len(self.filter)
            self.filter.append(name)
            self.low.append(low)
            self.high.append(high)
            self.weight.append(weight)
        return self._node_of[key]

    def _node(self, name: str, low: int, high: int) -> int:
        if not high:
            return low
        weight = tuple(a + b for a, b in zip(self.weight[low], self.weight[high]))
        return self._intern((name, low, high), weight, name, low, high)

    def _build(self, level: int, ends: dict[int, int]) -> int:
        if not ends:
            return 0
        if level == len(self.order):
            (end,) = ends.values()
            return end
        passed = {mask: end for mask, end in ends.items() if not mask >> level & 1}
        failed = {mask: end for mask, end in ends.items() if mask >> level & 1}
        return self._node(self.order[level], self._build(level + 1, passed), self._build(level + 1, failed))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below. Nodes keep their numbers, meanings and weights."""
        upper, lower = self.order[level : level + 2]
        self.order[level : level + 2] = lower, upper
        for node in [i for i, name in enumerate(self.filter) if name == upper]:
            low, high = self.low[node], self.high[node]
            if lower not in (self.filter[low], self.filter[high]):
                continue
            (low_low, low_high), (high_low, high_high) = (self._branches(child, lower) for child in (low, high))
            del self._node_of[upper, low, high]
            new_low, new_high = self._node(upper, low_low, high_low), self._node(upper, low_high, high_high)
            self.filter[node], self.low[node], self.high[node] = lower, new_low, new_high
            self._node_of[lower, new_low, new_high] = node

    def _branches(self, node: int, name: str) -> tuple[int, int]:
        return (self.low[node], self.high[node]) if self.filter[node] == name else (node, 0)

    def all_pass_path(self) -> Iterator[tuple[str, Weights, Weights, Weights]]:
        """Per step: filter, weight that stays, weight removed here, and of that what fails no later filter."""
        node = self.root
        for name in self.order:
            node, removed = self._branches(node, name)
            alone = removed
            while self.filter[alone] is not None:
                alone = self.low[alone]
            yield name, self.weight[node], self.weight[removed], self.weight[alone]


def swaps_through_all_orders(n: int) -> Iterator[int]:
    """Levels to swap with the next one, so that every order of n filters comes up exactly once.

    The last filter travels through each order of the others, to and fro.
    """
    if n < 2:
        return
    inner = swaps_through_all_orders(n - 1)
    downwards = False
    while True:
        yield from range(n - 1) if downwards else range(n - 2, -1, -1)
        level = next(inner, None)
        if level is None:
            return
        # With the travelling filter in front, the others stand one level lower.
        yield level if downwards else level + 1
        downwards = not downwards


def audit_rows(counts: dict[int, Weights], filters: str = FILTERS) -> Iterator[tuple]:
    """filter_order, step and all figures of one part, from (n, good, toxic) per mask."""
    diagram = Diagram(filters, counts, len(_COUNTS))
    steps: list[tuple] = []

    def note() -> None:
        order = "".join(diagram.order)
        steps.extend((order, step, *path) for step, path in enumerate(diagram.all_pass_path(), 1))

    note()
    for level in swaps_through_all_orders(len(filters)):
        diagram.swap(level)
        note()
    fails, over_orders = {}, dict.fromkeys(filters, 0)
    for _, step, name, _, removed, _ in steps:
        over_orders[name] += removed[0]
        if step == 1:
            fails[name] = removed[0]
    for order, step, name, kept, removed, alone in steps:
        figures = kept[0], removed[0], fails[name] - removed[0], alone[0], *removed[1:], over_orders[name]
        yield order, step, *figures


def _audit_part(masks: pd.DataFrame) -> pd.DataFrame:
    counts = {mask: tuple(map(int, weights)) for mask, *weights in masks[["mask", *_COUNTS]].itertuples(index=False)}
    part = masks["part"].iloc[0]
    names = [field.split()[0] for field in _SCHEMA.split(",")]
    return pd.DataFrame([(part, *row) for row in audit_rows(counts)], columns=names)


def audit(masks: DataFrame) -> DataFrame:
    """A row per part, order and step from ``failure_masks``."""
    return masks.groupBy("part").applyInPandas(_audit_part, _SCHEMA)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic)."""
    return audit(failure_masks(docs, labels))
