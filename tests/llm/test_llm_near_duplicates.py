import itertools
import random

import numpy as np
import pytest
from llm_fixtures import documents, empty, odd_rows, sentences
from pyspark.sql import functions as F

from forecourt.llm import components, near_duplicates as nd


def plain_sets(text):
    words = nd.words_of(text)
    width = min(5, len(words))
    counts = {}
    for i in range(len(words) - width + 1 if words else 0):
        shingle = tuple(words[i : i + width])
        counts[shingle] = counts.get(shingle, 0) + 1
    return {s: 1 + np.log(n) for s, n in counts.items()}


def plain_similarity(a, b):
    shared = sum(min(a[s], b[s]) for s in a if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def plain_classes(texts):
    """Least id per connected component of all pairs at 0.8 or more, or of equal words."""
    label = {i: i for i in texts}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    sets = {i: plain_sets(t) for i, t in texts.items()}
    for i, j in itertools.combinations(sorted(texts), 2):
        same = nd.words_of(texts[i]) == nd.words_of(texts[j]) if sets[i] or sets[j] else texts[i] == texts[j]
        if same or plain_similarity(sets[i], sets[j]) >= 0.8:
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def edited(text, changes, seed):
    words, chance = text.split(), random.Random(seed)
    for _ in range(changes):
        words[chance.randrange(len(words))] = f"e{chance.randrange(10**6)}"
    return " ".join(words)


def test_signatures_agree_as_often_as_the_sets_are_similar():
    chance = np.random.default_rng(0)
    base = np.sort(chance.integers(0, 2**63, 300).astype(np.uint64))
    heavy = (base, 1 + np.log(chance.integers(1, 9, 300)))
    light = (base, np.ones(300))
    part = (base[:250], np.ones(250))
    signatures = nd.dart_min_hash([heavy, light, part], 4000)
    for i, j, pair in ((0, 1, (heavy, light)), (1, 2, (light, part)), (0, 2, (heavy, part))):
        assert (signatures[i] == signatures[j]).mean() == pytest.approx(nd.similarity(*pair), abs=0.03)


def test_a_set_alone_or_in_a_batch_has_the_same_signature():
    sets = [nd.weighted_set(sentences(i, n)) for i, n in enumerate((1, 5, 60, 4000))]
    together = nd.dart_min_hash(sets)
    for i, one in enumerate(sets):
        assert (nd.dart_min_hash([one])[0] == together[i]).all()


def test_similarity_matches_the_plain_one():
    a, b = sentences(1, 300, 20), sentences(1, 280, 20) + " x y z"
    assert nd.similarity(nd.weighted_set(a), nd.weighted_set(b)) == pytest.approx(
        plain_similarity(plain_sets(a), plain_sets(b))
    )


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies around the limit, chains, shared passages and short texts."""
    texts, chance = {}, random.Random(5)
    passage = sentences(77, 60)
    for i in range(60):
        base = sentences(i, chance.choice((6, 30, 120, 400)))
        texts[len(texts)] = base
        for changes in (0, 1, 2, 4, 8, 16):
            texts[len(texts)] = edited(base, changes, i) if changes else base.upper() + " !"
        texts[len(texts)] = base + " " + passage
    chain = sentences(500, 200)
    for i in range(12):
        chain = edited(chain, 3, i)
        texts[len(texts)] = chain
    for i in range(150):
        texts[len(texts)] = edited(sentences(900, 250), 3, i)
    return texts


def test_classes_match_all_pairs(spark, corpus):
    rows = [(i, t, "en", "s") for i, t in corpus.items()]
    random.Random(1).shuffle(rows)
    found = {r.doc_id: r.class_id for r in nd.duplicate_classes(documents(spark, rows)).collect()}
    assert found == plain_classes(corpus)


def test_prefixes_of_similar_texts_meet(corpus):
    """Whatever the order, a link shares an element that passes the join's conditions."""
    chance = np.random.default_rng(3)
    for counts in (np.zeros(nd._SLOTS, np.int64), chance.integers(0, 9, nd._SLOTS)):
        cut = {i: nd.prefix(t, counts) for i, t in corpus.items() if i < 200}
        sets = {i: nd.weighted_set(corpus[i]) for i in cut}
        n_links = 0
        for i, j in itertools.combinations(cut, 2):
            if nd.similarity(sets[i], sets[j]) < 0.8:
                continue
            n_links += 1
            (a, a_left, a_weight), (b, b_left, b_weight) = sorted((cut[i], cut[j]), key=lambda c: c[2])
            _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            passes = np.minimum(a_left[at_a], b_left[at_b]) >= nd._SHARED * (a_weight + b_weight)
            assert (passes & (a_left[at_a] >= 2 * nd._SHARED * a_weight)).any()
        assert n_links > 100


def test_unlike_texts_with_a_common_passage_do_not_meet(spark):
    """Texts that share most of their words by one passage: hardly any prefix element is common."""
    passage = sentences(7, 120)
    texts = {i: f"{sentences(1000 + i, 40)} {passage}" for i in range(3000)}
    table = spark.createDataFrame(list(texts.items()), "node long, text string").repartition(8)
    nodes = table.select("node", F.col("node").alias("label"))
    found = nd.prefixes(table, nodes)
    met = found.groupBy("element").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert met < 3000


def test_one_row_per_class_is_kept(spark, corpus):
    some = {i: t for i, t in corpus.items() if i < 120}
    docs = documents(spark, [(i, t, "en", "s") for i, t in some.items()])
    kept = nd.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain_classes(some).values()))


def test_odd_rows_and_empty_table(spark):
    rows = nd.duplicate_classes(documents(spark, odd_rows())).collect()
    classes = sorted((r.doc_id, r.class_id) for r in rows if r.doc_id is not None)
    assert classes == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (5, 4), (6, 6), (7, 7), (8, 8)]
    assert len(rows) == len(odd_rows())
    assert {r.n_same for r in rows if r.class_id == 4} == {3}
    assert nd.duplicate_classes(empty(spark)).count() == 0
    kept = [r.doc_id for r in nd.one_per_class(documents(spark, odd_rows())).collect()]
    assert sorted(kept, key=str) == [1, 3, 4, 6, 7, 8, None]


def test_different_texts_under_one_id_are_documents_of_their_own(spark):
    a, b, c, near_b = sentences(1, 50), sentences(2, 50), sentences(3, 50), sentences(2, 50) + " end"
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, c, "en", "s")]
    assert sorted((r.doc_id, r.text) for r in nd.one_per_class(documents(spark, rows)).collect()) == sorted((i, t) for i, t, *_ in rows)
    rows += [(3, near_b, "en", "s"), (0, a + " end", "en", "s"), (1, b, "en", "s")]
    kept = sorted((r.doc_id, r.text) for r in nd.one_per_class(documents(spark, rows)).collect())
    assert kept == sorted([(0, a + " end"), (1, b), (2, c)])
    classes = sorted((r.doc_id, r.class_id) for r in nd.duplicate_classes(documents(spark, rows)).collect())
    assert classes == [(0, 0), (1, 0), (1, 1), (1, 1), (2, 2), (3, 1)]


def test_names_of_the_operators_own(spark):
    rows = [(i, sentences(i % 3, 30), "en", "s") for i in range(6)]
    docs = documents(spark, rows).withColumns({name: F.lit(name) for name in ("__own", "__place", "place", "tie", "key", "row")})
    kept = nd.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r["__own"], r["place"], r["row"]) for r in kept.collect()) == [(i, "__own", "place", "row") for i in range(3)]


def test_labels_follow_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 40)] + [(140, 139)]
    links = [(b, a) if a % 3 else (a, b) for a, b in links]
    labels = components.component_labels(spark.createDataFrame(links, "a long, b long"))
    found = {r.node: r.label for r in labels.collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 141)}
