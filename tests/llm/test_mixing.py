import itertools
import random
import time

import pytest

from corpora import WORD, docs, nothing, prose  # noqa: F401
from stardw.llm import mixing as M


def test_targets():
    found = M.targets({"b": 100, None: 50, "a": 1000, "c": 10_000})
    assert list(found) and sum(found.values()) == pytest.approx(1.5 * 11_150)
    assert found["b"] == 200 and found[None] == 100
    assert found["a"] == 2000 and found["c"] == pytest.approx(1.5 * 11_150 - 2300)
    assert M.targets({}) == {} and M.targets({"a": 0}) == {"a": 0}
    equal = M.targets({s: 1000 for s in "abcd"})
    assert equal == {"a": 2000, "b": pytest.approx(1000), "c": pytest.approx(2000), "d": pytest.approx(1000)} or \
        sum(equal.values()) == pytest.approx(6000)


def test_flow_prefers_fresh_words_and_meets_quotas():
    patterns = {("a",): 100, ("b",): 10, ("a", "b"): 50}
    taken = M.route(patterns, {"a": 100, "b": 60})
    assert taken == {("a",): 100, ("b",): 10, ("a", "b"): 50}
    taken = M.route(patterns, {"a": 100, "b": 80})
    assert sum(taken.values()) == 180 and taken[("a",)] == 100
    assert all(taken[p] <= 2 * n for p, n in patterns.items())


def exhaustive(patterns, quotas, times):
    """The most words that fit and what they cost at least, by trying every split."""
    names = list(quotas)
    found = {tuple(round(q) for q in quotas.values()): 0}

    def cost(used, size):
        return sum((2 * n + 1) * min(size, max(0, used - n * size)) for n in range(times))
    for key, size in patterns.items():
        after = {}

        def split(places, used, left, paid):
            if not places:
                total = paid + cost(used, size)
                after[tuple(left)] = min(total, after.get(tuple(left), total))
                return
            for amount in range(min(left[places[0]], times * size - used) + 1):
                rest = [n - amount * (i == places[0]) for i, n in enumerate(left)]
                split(places[1:], used + amount, rest, paid)
        for left, paid in found.items():
            split([names.index(s) for s in key], 0, list(left), paid)
        found = after
    least = min(map(sum, found))
    return least, min(c for left, c in found.items() if sum(left) == least), cost


def test_flow_like_every_split():
    rng = random.Random(1)
    for _ in range(250):
        names, times = "abc"[:rng.randint(1, 3)], rng.randint(1, 3)
        patterns = {k: rng.randint(0, 3) for n in range(1, len(names) + 1)
                    for k in itertools.combinations(names, n) if rng.random() < 0.7}
        quotas = {s: rng.randint(0, 6) for s in names}
        taken = M.route(patterns, quotas, times)
        left, paid, cost = exhaustive(patterns, quotas, times)
        assert sum(quotas.values()) - sum(taken.values()) == left
        assert sum(cost(taken[k], n) for k, n in patterns.items()) == paid


@pytest.mark.parametrize("sources,alone", [(100_000, 100_000), (60_000, 90_000), (3000, 0)])
def test_flow_of_many_patterns(sources, alone):
    rng, patterns, sizes = random.Random(2), {}, {}
    while len(patterns) < 100_000:
        n = 1 if len(patterns) < min(alone, sources) else rng.randint(2, 3)
        key = (f"s{len(patterns)}",) if n == 1 else tuple(sorted(f"s{rng.randrange(sources)}" for _ in range(n)))
        patterns[tuple(dict.fromkeys(key))] = rng.randint(1, 1000)
    for key, n in patterns.items():
        for s in key:
            sizes[s] = sizes.get(s, 0) + n
    quotas = M.targets(sizes)
    begin = time.monotonic()
    taken = M.route(patterns, quotas)
    assert time.monotonic() - begin < 60
    assert all(0 <= taken[k] <= 2 * n for k, n in patterns.items())
    assert sum(taken.values()) <= sum(map(round, quotas.values()))


def test_sources_come_to_their_targets(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "y", "y", "z", None]), prose(rng, rng.randint(1, 30)))
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")  # noqa: F811
    found = M.mix_by_source(docs).collect()
    wanted = M.targets({s: sum(len(WORD.findall(t)) for _, o, t in rows if o == s)
                        for s in {o for _, o, _ in rows}})
    by_id = {i: (s, len(WORD.findall(t))) for i, s, t in rows}
    for source, target in wanted.items():
        own = [r for r in found if by_id[r.doc_id][0] == source]
        assert {round(r.target, 6) for r in own} == {round(target, 6)}
        assert {r.source_size for r in own} == {sum(by_id[r.doc_id][1] for r in own)}
        assert sum(r.taken for r in own) == pytest.approx(target, abs=10)
    assert all(r.size == by_id[r.doc_id][1] and 0 <= r.taken <= 2 * r.size for r in found)
    assert sorted(found) == sorted(M.mix_by_source(docs.repartition(5)).collect())


def test_overlapping_sources(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([["a"], ["b"], ["a", "b"], ["b", "a", "a"], [None]]), prose(rng, 20), "x")
            for i in range(500)] + [(900, None, "lost words", "x"), (901, [], None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, sources array<string>, text string, Size string")  # noqa: F811
    found = M.mix(docs).collect()
    assert len(found) == len(rows) and all(r.taken <= 2 * r["size"] for r in found)
    assert {len(r.of) for r in found if r.doc_id < 900} == {1, 2}
    assert all(r.taken == 0 for r in found if r.doc_id >= 900)
    with pytest.raises(ValueError, match="combinations"):
        M.mix(docs, most_patterns=2)


def test_edge_rows(docs, nothing):  # noqa: F811
    found = M.mix_by_source(docs).collect()
    assert len(found) == docs.count() and all(0 <= r.taken <= 2 * r["size"] for r in found)
    assert M.mix_by_source(nothing).count() == 0
