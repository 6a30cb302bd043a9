import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import duckdb
import pyarrow as pa
import pytest
from conftest import SF_DIR
from llm_fixtures import documents, empty, odd_rows
from oracle import connect, differences

from forecourt.llm import filter_audit as audit
from forecourt.llm.oracles import ORACLES
from forecourt.llm.queries import QUERIES

LABELS = "doc_id long, quality long, toxic long"


def plain_audit(counts, filters):
    """All figures of one part by going through the masks for every order and step."""
    rows = []
    for order in permutations(filters):
        gone = 0
        for step, name in enumerate(order, 1):
            bit = 1 << filters.index(name)
            total = [sum(w[i] for w in counts.values()) for i in range(3)]
            here = [sum(w[i] for m, w in counts.items() if m & bit and not m & gone) for i in range(3)]
            kept = total[0] - sum(w[0] for m, w in counts.items() if m & (gone | bit))
            earlier = sum(w[0] for m, w in counts.items() if m & bit and m & gone)
            rows.append(["".join(order), step, kept, here[0], earlier, counts.get(bit, (0,))[0], here[1], here[2]])
            gone |= bit
    shapley = Counter()
    for row in rows:
        shapley[row[0][row[1] - 1]] += row[3]
    return {(*row, shapley[row[0][row[1] - 1]]) for row in rows}


@pytest.mark.parametrize("n", range(1, 7))
def test_swaps_visit_every_order_once(n):
    order, seen = list(range(n)), set()
    seen.add(tuple(order))
    for level in audit.swaps_through_all_orders(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == factorial(n)


@pytest.mark.parametrize("seed", range(30))
def test_diagram_gives_the_figures_of_the_masks(seed):
    chance = random.Random(seed)
    filters = "ABCDEF"[: chance.randrange(1, 6)]
    masks = chance.sample(range(2 ** len(filters)), chance.randrange(1, 2 ** len(filters)))
    counts = {m: (chance.randrange(4), chance.randrange(3), chance.randrange(3)) for m in masks}
    rows = list(audit.audit_rows(counts, filters))
    assert len(rows) == factorial(len(filters)) * len(filters)
    assert set(rows) == plain_audit(counts, filters)


def test_swap_keeps_nodes_reduced_and_their_meaning():
    chance = random.Random(5)
    counts = {m: (chance.randrange(1, 3), 0, 0) for m in chance.sample(range(32), 20)}
    diagram = audit.Diagram("ABCDE", counts, 3)

    def at(mask):
        node = diagram.root
        for name in diagram.order:
            low, high = diagram._branches(node, name)
            node = high if mask >> "ABCDE".index(name) & 1 else low
        return diagram.weight[node]

    for level in audit.swaps_through_all_orders(5):
        diagram.swap(level)
        assert all(at(mask) == counts.get(mask, (0, 0, 0)) for mask in range(32))
        inner = [(f, lo, hi) for f, lo, hi in zip(diagram.filter, diagram.low, diagram.high) if f]
        assert len(set(inner)) == len(inner) and all(hi for _, _, hi in inner)


def run(spark, rows, labels):
    frame = spark.createDataFrame([(*row, "x") for row in labels], LABELS + ", part string")
    return audit.filter_audit(documents(spark, rows), frame)


def masks_of(rows, labels):
    """Part to mask to counts, row by row."""
    parts = {}
    for doc_id, text, lang, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, *_ in rows)
        fails = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)), copy,
        ]
        mask = sum(1 << i for i, failed in enumerate(fails) if failed)
        own = [label for label in labels if doc_id is not None and label[0] == doc_id]
        counts = parts.setdefault(lang or "", {}).setdefault(mask, [0, 0, 0])
        for i, flag in enumerate([True, any(q == 1 for _, q, _ in own), any(x == 1 for *_, x in own)]):
            counts[i] += flag
    return parts


def test_odd_rows_against_plain_masks(spark):
    many = [(100 + i, "SAME text # here", "en", "a") for i in range(40)] + [(None, "SAME text # here", "en", "a")] * 3
    rows = odd_rows() + many + [(100, "SAME text # here", None, "b"), (100, "SAME text # here", "en", "a"), (9, "SAME text # here", "", "b")]
    labels = [(4, 1, 0), (4, 0, 1), (5, 1, None), (101, 1, 1), (102, None, 1), (None, 1, 1), (777, 1, 1)]
    found = {}
    for part, *row in run(spark, rows, labels).collect():
        found.setdefault(part, set()).add(tuple(row))
    assert found == {part: plain_audit({m: tuple(w) for m, w in c.items()}, "ABCDE") for part, c in masks_of(rows, labels).items()}


def test_every_part_has_all_orders_and_steps(spark):
    rows = run(spark, odd_rows(), []).collect()
    assert len(rows) == 3 * 600 and {r.part for r in rows} == {"", "en", "de"}


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]).count() == 0
    assert audit.filter_audit(empty(spark), spark.createDataFrame([], LABELS)).count() == 0


def test_query_matches_sql(spark):
    rows = QUERIES["op12_filter_audit"](spark, SF_DIR).toArrow()
    assert differences(rows, connect(SF_DIR).sql(ORACLES["op12_filter_audit"]).to_arrow_table()) == []


def test_sql_matches_on_odd_rows(spark, new_dir):
    documents(spark, odd_rows(), clashing=False).write.parquet(f"{new_dir}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (None, 1, 1)], LABELS).write.parquet(f"{new_dir}/labels.parquet")
    rows = QUERIES["op12_filter_audit"](spark, new_dir).toArrow()
    database = duckdb.connect()
    for name in ("documents", "labels"):
        database.register(name, pa.table(spark.read.parquet(f"{new_dir}/{name}.parquet").toArrow()))
    assert differences(rows, database.sql(ORACLES["op12_filter_audit"]).to_arrow_table()) == []
