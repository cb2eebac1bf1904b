import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpora import PLAIN, docs, nothing, prose  # noqa: F401
from stardw.llm import fp_search as S

WORD = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, rank int, score string"


def terms(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(documents, items, k=20):
    """Every document scored for every item: (item, rank, doc, score)."""
    bags = [(d, Counter(terms(t))) for d, t in documents]
    bags = [(d, b) for d, b in bags if b]
    n, size = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n // size
            score = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, c in Counter(terms(text)).items() if b[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, documents, items, **options):
    df = S.ranked(spark.createDataFrame(documents, "doc_id long, text string").repartition(3),
                  spark.createDataFrame([(*i, 1, "x") for i in items], ITEMS), **options)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def items(docs):  # noqa: F811
    rng = random.Random(3)
    texts = [prose(rng, 20) for _ in range(12)] + ["the the the of", "nosuchterm", None, "", "  ,.", "é ü 漢字", "The HOUSE river"]
    texts += [r.text[:120] for r in docs.filter("length(text) > 200").limit(6).collect()]
    return list(enumerate(texts))


@pytest.mark.parametrize("k,bytes_,entries,bucket", [(20, 1 << 20, 1 << 20, 128), (3, 1 << 20, 200, 2), (20, 300, 1 << 20, 1)])
def test_like_brute_force(spark, docs, items, monkeypatch, k, bytes_, entries, bucket):  # noqa: F811
    monkeypatch.setattr(S, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(S, "BUCKET", bucket)
    documents = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(spark, documents, items, k=k, part_bytes=bytes_) == brute(documents, items, k)


def test_ties_and_copies(spark):
    """Far more equal scores than ranks: the lowest ids come first, a null id last."""
    documents = [(i * 37 % 501, "the river and the house") for i in range(501)] + [(None, "the river and the house")] * 3
    documents += [(1000 + i, "house " * (i % 5) + "mill") for i in range(60)]
    items = [(1, "river river house"), (2, "mill"), (3, "the"), (3, "the"), (None, "mill")]
    assert run(spark, documents, items) == brute(documents, items)


def test_few_documents(spark):
    documents = [(None, "alone here"), (2, None), (3, "..."), (4, "alone")]
    items = [(1, "alone"), (2, "here there"), (3, None)]
    assert run(spark, documents, items) == brute(documents, items)


def test_empty_tables(spark, docs, nothing):  # noqa: F811
    some = spark.createDataFrame([(1, "the river", 1, "")], ITEMS)
    assert S.ranked(nothing, some).count() == 0
    assert S.ranked(docs, some.limit(0)).count() == 0
    assert S.ranked(nothing, some.limit(0)).count() == 0
    assert S.ranked(docs, some).columns == ["item_id", "rank", "doc_id", "score"]


def test_ids_of_other_types(spark):
    documents = spark.createDataFrame([("b", "mill"), ("a", "mill"), (None, "mill"), ("c", "house")], "doc_id string, text string")
    found = S.ranked(documents, spark.createDataFrame([("q 1", "mill")], "item_id string, text string"))
    assert [tuple(r)[:3] for r in found.orderBy("rank").collect()] == [("q 1", 1, "a"), ("q 1", 2, "b"), ("q 1", 3, None)]


def test_a_very_long_text(spark):
    rng = random.Random(8)
    documents = [(1, prose(rng, 200_000)), (2, "x" * 3_000_000 + " mill"), *[(i, prose(rng, 50)) for i in range(3, 40)]]
    items = [(1, "mill house"), (2, " ".join(PLAIN))]
    assert run(spark, documents, items) == brute(documents, items)


def shard(rng, n, kinds, bucket):
    """A shard of ``n`` vectors, many of them equal."""
    sets = [np.sort(rng.choice(40, rng.integers(0, 12), replace=False)) for _ in range(kinds)]
    chosen = [sets[i] for i in rng.integers(kinds, size=n)]
    ptr = np.concatenate(([0], np.cumsum([len(c) for c in chosen])))
    term = np.concatenate([*chosen, np.zeros(0, int)]).astype(np.int64)
    return S.Shard(ptr, term, rng.integers(1, 9, len(term)), rng.integers(75, 300, n), 40, bucket)


@pytest.mark.parametrize("n,kinds,bucket", [(500, 60, 8), (300, 2, 4), (200, 200, 1), (1, 1, 1), (50, 1, 50)])
def test_bounds_hold_and_shards_are_whole(n, kinds, bucket):
    rng = np.random.default_rng(n)
    tree = shard(rng, n, kinds, bucket)
    leaves = [v for v, kids in enumerate(tree.kids) if not kids]
    assert sorted(p for v in leaves for p in range(tree.low[v], tree.high[v])) == list(range(n))
    for _ in range(20):
        term = np.sort(rng.choice(40, 6, replace=False))
        query = S.Query(0, term, rng.integers(1, 50, 6))
        weights = np.zeros(40, np.int64)
        weights[term] = query.weight
        bounds = tree.bounds(np.arange(len(tree.kids)), query)
        every = np.concatenate([tree.scores(v, weights) for v in leaves])
        place = np.concatenate([np.arange(tree.low[v], tree.high[v]) for v in leaves])
        scores = np.zeros(n, np.int64)
        scores[place] = every
        for v in range(len(tree.kids)):
            assert scores[tree.low[v]:tree.high[v]].max() <= bounds[v]


def test_paths_are_shared_and_subtrees_left_out():
    rng = np.random.default_rng(2)
    tree = shard(rng, 4000, 300, 8)
    best, weights = S.Best(5), np.zeros(40, np.int64)
    best.ids = range(4000)
    query = S.Query(0, np.array([3, 11, 30]), np.array([5, 900, 40]))
    weights[query.term] = query.weight
    seen = tree.search(query, weights, best)
    leaves = sum(not kids for kids in tree.kids)
    assert len(best.rows) == 5 and seen < leaves / 3
