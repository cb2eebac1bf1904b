import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpora import WORD, docs, nothing, prose  # noqa: F401
from stardw.llm import jaccard_join as J
from stardw.llm.graph import connected


def shingles(text, n):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def roots(rows, n, percent):
    """The sets of the rows, and the first row of each row's component."""
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return sets, [root(i) for i in range(len(rows))]


def brute(rows, n, percent):
    """(id, set size, least id of the component) of each row."""
    sets, first = roots(rows, n, percent)
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [k for j, (k, _) in enumerate(rows) if first[j] == first[i] and k is not None]
        out.append((own, len(sets[i]), own if not sets[i] else min(ids, default=None)))
    return out


def order(rows):
    return sorted(rows, key=str)


def altered(rng, text, share):
    return " ".join(w if rng.random() > share else f"z{rng.random()}" for w in text.split())


@pytest.fixture(scope="module")
def similar():
    """Groups of copies that differ in more or fewer words, of all sizes."""
    rng = random.Random(3)
    rows = []
    for size in (3, 5, 6, 7, 9, 12, 20, 45, 100, 300):
        text = prose(rng, size)
        rows += [altered(rng, text, s) for s in (0, 0, .005, .01, .02, .02, .03, .04, .05, .08)]
    chain = prose(rng, 150).split()
    rows += [" ".join(chain[i:i + 100]) for i in range(0, 50, 2)]
    rows += ["a", "a b", "a b c", "A b c d", "a b c d", "a a a a a a a", "", None]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words, percent, heavy, cell", [
    (4, 85, J.HEAVY, J.HEAVY_CELL), (5, 80, J.HEAVY, J.HEAVY_CELL), (4, 85, 500, J.HEAVY_CELL),
    (2, 60, 3000, 8)])
def test_like_brute_force(spark, similar, words, percent, heavy, cell):
    docs = spark.createDataFrame(similar, "doc_id long, text string").repartition(3)
    found = J.components(docs, words=words, percent=percent, heavy=heavy, heavy_cell=cell)
    got = [tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()]
    assert order(got) == order(brute(similar, words, percent))


def test_edge_rows(docs, nothing):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = J.components(docs)
    got = [tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()]
    assert order(got) == order(brute(rows, 4, 85))
    assert J.components(nothing).count() == 0
    assert J.one_of_each(nothing, words=5, percent=80).count() == 0


def test_one_of_each_group_stays(docs):
    kept = J.one_of_each(docs, words=5, percent=80)
    assert kept.schema == docs.schema
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sets, first = roots(rows, 5, 80)
    groups = {r for own, r in zip(sets, first) if own}
    without = sum(not shingles(t, 5) for _, t in rows)
    found = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert len([t for _, t in found if shingles(t, 5)]) == len(groups)
    assert len([t for _, t in found if not shingles(t, 5)]) == without


def test_cells_hold_every_linked_pair():
    rng = np.random.default_rng(5)
    for size in (*range(1, 40), 77, 150, 400):
        for _ in range(20):
            own = np.unique(rng.integers(0, 2**62, size, dtype=np.uint64))
            drop = J.most_apart(len(own), 85)
            other = own[rng.permutation(len(own))[drop:]] if drop < len(own) else own
            other = np.unique(other)
            if 100 * len(other) >= 85 * len(own):
                assert len(np.intersect1d(J.cells(own, 85), J.cells(other, 85)))


def test_points_differ_less_than_sets():
    rng = np.random.default_rng(8)
    for n, m in ((40, 60), (1400, 1600), (3000, 7000), (7000, 7000), (800, 9000)):
        pool = rng.integers(0, 2**62, n + m, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n // 2:n // 2 + m])
        space = J.Points(80, [J.point(a), J.point(b)], [len(a), len(b)])
        for width in (256, min(len(i) for i in space.items)):
            assert space._l1([0], [1], width)[0, 0] <= len(np.setxor1d(a, b))
    sets = [np.unique(rng.integers(0, 2**62, 9000, dtype=np.uint64)) for _ in range(3)]
    space = J.Points(80, [J.point(s) for s in sets], [9000] * 3)
    assert (space.near([0, 1, 2], [0, 1, 2]) == np.eye(3, dtype=bool)).all()


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r.node: r.label for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
