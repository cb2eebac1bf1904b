import random

import numpy as np
import pytest

from corpora import docs, nothing, prose  # noqa: F401
from stardw.llm import weak_labels as W


def test_em_finds_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.6])
    votes = np.where(rng.random((20_000, 5)) < right, 1, -1) * np.where(truth, 1, -1)[:, None]
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    found = W.expectation_maximisation(patterns, times)
    assert found.prior == pytest.approx(0.7, abs=0.02)
    given = found.table[:, 1, 2] / (found.table[:, 1, 2] + found.table[:, 1, 0])
    assert given == pytest.approx(right, abs=0.03)
    assert ((found.posterior(votes) > 0.5) == truth).mean() > 0.93


def test_scorer_separates_junk(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(80, 200))) for i in range(200)]
    rows += [(1000 + i, " ".join(f"{w}{rng.choice(['###', '$$$', '|'])}" for w in prose(rng, 90).split()))
             for i in range(40)]
    rows += [(2000 + i, "spam again and " * 60) for i in range(40)]
    found = {r.doc_id: r for r in W.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert np.mean([found[i].kept for i in range(200)]) > 0.97
    assert np.mean([found[i].kept for i in found if i >= 1000]) < 0.03


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = W.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert np.mean([not r.kept for r in found if r.quality == 0]) >= 0.95
    assert np.mean([r.kept for r in found if r.quality == 1]) >= 0.98


def test_texts_without_votes_teach_nothing():
    """What the scorer says of them comes from the others, not from their own labels."""
    rng = np.random.default_rng(3)
    cells = np.sort(rng.integers(0, 1 << 10, (60, 20)), axis=1).astype(np.int32)
    values, sizes = np.ones((60, 20), np.float32), np.full(60, 20)
    votes = rng.choice([-1, 0, 1, W.UNTOLD], (60, 10))
    votes[40:] = rng.choice([0, W.UNTOLD], (20, 10))
    good = rng.random(60)
    told = W.told_by(votes)
    assert (told[:40] > 0).all() and (told[40:] == 0).all()
    with_them = W.fit(cells.ravel(), values.ravel(), sizes, good, told, 10)
    without = W.fit(cells[:40].ravel(), values[:40].ravel(), sizes[:40], good[:40], told[:40], 10)
    assert with_them == pytest.approx(without)
    assert np.isfinite(W.fit(cells.ravel(), values.ravel(), sizes, good, np.zeros(60), 10)).all()


CHINESE = "今天天气很好，我们去公园散步。路上看到很多花，非常漂亮。\n孩子们在湖边放风筝，老人坐在树下聊天。"
THAI = "วันนี้อากาศดีมากเราไปเดินเล่นในสวนสาธารณะและเห็นดอกไม้สวยงามมากมายระหว่างทาง"


def test_scripts_without_spaces_and_capitals(spark):
    rng = random.Random(13)
    rows = good_and_bad(rng, 200) + [(3000, CHINESE * 6), (3001, THAI * 6), (3002, "Погода хороша, сад. " + " ".join(
        f"слово{rng.randint(1, 999)}" for _ in range(120)) + ".")]
    stats = W.statistics(W.pa.array([r[1] for r in rows[-3:]]))
    names = list(W.LABELLERS)
    assert np.isnan(stats[:2, names.index("word_length")]).all() and np.isnan(stats[:, names.index("capitals")]).all()
    assert (stats[:, names.index("words")] >= 80).all() and stats[0, names.index("line_ends")] == 1
    found = {r.doc_id: r for r in W.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i].kept and found[i].weak_label >= 0.5 for i in (3000, 3001, 3002))
    assert not any(found[i].kept for i in found if 1000 <= i < 2000)


@pytest.mark.parametrize("text, name, value", [
    ("one | two | | three", "worded", 0.5), ("AB cd", "capitals", 0.5), ("SHOUT", "capitals", 1.0),
    ("a.\nb", "line_ends", 0.5), ("a…\nb»\nc。\nd\n؟", "line_ends", 0.8), ("。", "line_ends", 1.0)])
def test_statistics(text, name, value):
    found = W.statistics(W.pa.array(["x", text, None]))
    assert found[1, list(W.LABELLERS).index(name)] == pytest.approx(value)


def test_menus_are_bad(spark):
    rng = random.Random(14)
    rows = good_and_bad(rng, 200) + [(1500 + i, " | ".join(prose(rng, 90).split())) for i in range(20)]
    found = {r.doc_id: r for r in W.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(found[i].kept for i in found if i >= 1000) and all(found[i].kept for i in range(200))


def test_a_bound_on_features_shortens_the_sample(spark):
    rows = good_and_bad(random.Random(15), 60)
    found = W.judge(spark.createDataFrame(rows, "doc_id long, text string"), sample_cells=30_000).collect()
    assert len(found) == len(rows) and np.mean([r.kept == (r.doc_id < 1000) for r in found]) > 0.9


def test_edge_rows(docs, nothing):  # noqa: F811
    found = W.judge(docs)
    assert found.columns[:2] == ["doc_id", "lang"] and found.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in found.collect())
    assert W.judge(nothing).count() == 0
    assert sorted(map(str, W.judge(docs).collect())) == sorted(map(str, found.collect()))


def good_and_bad(rng, n):
    rows = [(i, prose(rng, rng.randint(80, 200))) for i in range(n)]
    return rows + [(1000 + i, " ".join(f"{w}{rng.choice(['###', '$$$', '|'])}"
                                       for w in prose(rng, 90).split())) for i in range(n // 3)]


def test_copies_take_one_place_of_the_sample(spark):
    rows = good_and_bad(random.Random(3), 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")  # noqa: F811
    # The text of least hash, which is first in every sample.
    first = docs.orderBy(W.F.xxhash64("text")).first().text
    copies = [(5000 + i, first) for i in range(500)]
    sizes = []
    real, W.fit = W.fit, lambda c, v, sizes_, *a: (sizes.append(len(sizes_)), real(c, v, sizes_, *a))[1]
    try:
        found = {r.doc_id: r for r in W.judge(
            spark.createDataFrame(rows + copies, "doc_id long, text string"), sample=100).collect()}
    finally:
        W.fit = real
    assert sizes == [100]
    assert np.mean([found[i].kept == (i < 1000) for i in found if i < 5000]) > 0.97


def test_long_texts_are_learnt_from(spark):
    rng = random.Random(4)
    def many_words():
        return " ".join(w + "".join(rng.choices("aeioulnrst", k=4)) for w in prose(rng, 6000).split(" "))
    rows = [(i, many_words()) for i in range(12)]
    rows += [(1000 + i, " ".join(f"{w}###" for w in many_words().split())) for i in range(6)]
    assert min(len(t) for _, t in rows) > 32_768
    found = W.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 18 and all(r.kept == (r.doc_id < 1000) for r in found)


def test_an_empty_sample_gives_the_prior(spark):
    rows = good_and_bad(random.Random(5), 30)
    found = W.judge(spark.createDataFrame(rows, "doc_id long, text string"), sample=0).collect()
    assert len({r.score for r in found}) == 1 and 0 < found[0].score < 1
