import hashlib
import random

import pytest

from corpora import WORD, docs, nothing, prose  # noqa: F401
from stardw.llm import suffix_dedup as S


def brute(rows, size):
    """Repeated words of each row, by all windows of all distinct texts."""
    texts = {t or "" for _, t in rows}
    words = {t: WORD.findall(t) for t in texts}
    places = {}
    for t, w in words.items():
        for i in range(len(w) - size + 1):
            places.setdefault(tuple(w[i:i + size]), []).append((t, i))
    marked = {t: set() for t in texts}
    for found in places.values():
        if len(found) > 1:
            for t, i in found:
                marked[t].update(range(i, i + size))
    out = []
    for own, t in rows:
        w = words[t or ""]
        copies = sum((x or "") == (t or "") for _, x in rows)
        n = len(w) if copies > 1 and len(w) >= size else len(marked[t or ""])
        if n:
            out.append((own, len(w), n))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def repeated():
    rng = random.Random(11)
    passages = [prose(rng, n).split() for n in (12, 13, 14, 20, 60)]
    rows = []
    for i in range(60):
        words = prose(rng, rng.randint(5, 40)).split()
        words = [f"{w}{rng.randint(0, 99)}" for w in words]
        for p in rng.sample(passages, rng.randint(0, 3)):
            at, cut = rng.randint(0, len(words)), rng.randint(0, 2)
            words[at:at] = p[cut:]
        rows.append((i, " ".join(words)))
    return rows + [(99, rows[0][1]), (98, "x y " * 40), (97, None), (96, ""), (95, "a b")]


@pytest.mark.parametrize("hot, run", [(S.HOT, S.RUN_ROWS), (0, S.RUN_ROWS), (4, 10)])
def test_like_brute_force(spark, repeated, hot, run, monkeypatch):
    monkeypatch.setattr(S, "RUN_ROWS", run)
    docs = spark.createDataFrame(repeated, "doc_id long, text string").repartition(3)
    found = S.find(docs, min_words=12, gram=4, hot=hot)
    got = sorted([(r.doc_id, r.n_words, r.n_repeated) for r in found.collect()], key=str)
    assert got == brute(repeated, 12)


@pytest.mark.parametrize("hot", [S.HOT, 0])
def test_all_but_the_first_place_are_cut(spark, repeated, hot):
    rows = repeated[:-5]  # without whole copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = {r.doc_id: WORD.findall(r.text) for r in S.remove(docs, min_words=12, gram=4, hot=hot).collect()}
    words = {i: WORD.findall(t) for i, t in rows}
    places = {}
    for i, t in rows:
        for at in range(len(words[i]) - 11):
            places.setdefault(tuple(words[i][at:at + 12]), []).append(
                (hashlib.md5(t.encode()).digest(), at, i))
    cut = {i: set() for i in words}
    for found in places.values():
        for _, at, i in sorted(found)[1:]:
            cut[i].update(range(at, at + 12))
    left = {i: [w for k, w in enumerate(own) if k not in cut[i]] for i, own in words.items()}
    assert kept == {i: own for i, own in left.items() if own}
    assert sum(map(len, left.values())) < sum(map(len, words.values()))


def test_edge_rows(docs, nothing):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted([(r.doc_id, r.n_words, r.n_repeated) for r in S.find(docs).collect()], key=str)
    assert got == brute(rows, S.MIN_WORDS) and got
    kept = S.remove(docs)
    assert kept.schema == docs.schema
    touched = {r.doc_id for r in S.find(docs).filter("n_cut > 0").collect()}
    same = {tuple(r) for r in docs.collect() if r.doc_id not in touched and WORD.search(r.text or "")}
    assert same <= {tuple(r) for r in kept.collect()}
    assert S.find(nothing).count() == 0 and S.remove(nothing).count() == 0
