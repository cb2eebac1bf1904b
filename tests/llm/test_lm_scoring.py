import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpora import WORD, docs, nothing  # noqa: F401
from stardw.llm import elias_fano as E, lm_scoring as L

def held():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    return [*WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)})), None]


def brute(rows, mu, held):
    """By order, counts of n-grams and of their contexts in plain dictionaries."""
    order = len(mu) + 1
    one = Counter()
    grams, contexts = ([Counter() for _ in range(order + 1)] for _ in range(2))

    def ngrams(own, k):
        padded = ["<"] * (k - 1) + own
        return [(tuple(padded[i:i + k - 1]), w) for i, w in enumerate(own)]
    for (_, text), out in zip(rows, held):
        if not out:
            one.update(tokens(text))
            for k in range(2, order + 1):
                found = ngrams(tokens(text), k)
                grams[k].update(found)
                contexts[k].update(c for c, _ in found)
    n, v = sum(one.values()), len(one)
    for (i, text), out in zip(rows, held):
        own = tokens(text)
        base = p = [(one[w] + 1) / (n + v + 1) for w in own]
        for k, m in enumerate(mu, 2):
            p = [(grams[k][g] + m * q) / (contexts[k][g[0]] + m) for g, q in zip(ngrams(own, k), p)]
        yield (i, out, len(own), sum(one[w] > 0 for w in own), n, sum(map(math.log10, base)),
               sum(map(math.log10, p)))


def alike(found, wanted, orders):
    found, wanted = sorted(map(tuple, found), key=str), sorted(wanted, key=str)
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-9 * b[2])
        assert a[6] == pytest.approx(b[6], abs=(orders * L.QUANTUM / 2 + 1e-6) * b[2])


@pytest.mark.parametrize("block, mu", [(L.BLOCK_TEXT, (50.0,)), (3000, (50.0,)), (3000, (50.0, 5.0)),
                                       (L.BLOCK_TEXT, (20.0, 5.0, 2.0))])
def test_like_brute_force(spark, docs, block, mu):  # noqa: F811
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    alike(L.score(docs, held(), block_text=block, mu=mu).collect(), brute(rows, mu, out), len(mu))


@pytest.mark.parametrize("mu", [(50.0,), (50.0, 5.0)])
def test_stored_shards_answer_documents_that_were_not_learnt(spark, docs, mu):  # noqa: F811
    """What the model is asked for is not what it was built from."""
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    model = L.learn(docs.filter(~F.coalesce(held(), F.lit(False))), mu=mu, block_text=3000)
    assert all(t.filter("a is not null").count() for t in [model.words, *model.tries])
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    strange = [("x1", "the of and never heard words the of"), ("x2", None), (None, rows[0][1] + " the")]
    wanted = list(brute([*rows, *strange], mu, [*out, True, True, True]))
    found = model.score(docs.filter(held())).collect()
    alike(found, [w for w, o in zip(wanted, out) if o], len(mu))
    texts = spark.createDataFrame(strange, "doc_id string, text string")
    alike(model.score(texts, block_text=100).collect(), wanted[-3:], len(mu))
    alike(model.score(texts.limit(0)).collect(), [], len(mu))


def test_ids_of_any_type(spark):
    rows = [("a-1", "one two one two"), ("b/2", "two one"), (None, "one")]
    found = L.score(spark.createDataFrame(rows, "doc_id string, text string"), F.lit(False)).collect()
    alike(found, brute(rows, (50.0,), [False] * 3), 1)


def test_hot_contexts_and_hot_pairs_are_spread(spark):
    """A pair that holds much of the words has its successors in all shards."""
    rows = [(i, " ".join(f"the same w{i * 40 + k}" for k in range(40))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)  # noqa: F811
    out = [i % 5 == 0 for i, _ in rows]
    found = L.score(docs, F.col("doc_id") % 5 == 0, mu=(50.0, 5.0), block_text=2000).collect()
    alike(found, brute(rows, (50.0, 5.0), out), 2)
    model = L.learn(docs, mu=(50.0, 5.0))
    assert all(len(h.value[0]) > 1 for h in model.hot)
    pair = L.extended(*[L.words_of(L.pa.array([w])).hashes()[:1] >> L._SHORT for w in ("the", "same")])
    assert pair[0] in model.hot[1].value[0]


def test_a_very_long_text(spark):
    rows = [(1, "again " * 300_000), (2, "again and again")]
    found = L.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False),
                    mu=(50.0, 5.0), block_text=1000).collect()
    alike(found, brute(rows, (50.0, 5.0), [False, False]), 2)


def test_no_training_documents_and_empty_table(docs, nothing):  # noqa: F811
    found = L.score(docs, F.lit(True)).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.train_tokens == 0 for r in found)
    assert L.score(nothing, F.lit(False)).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = L.op9_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert len(rows) > 100 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 5), (5, 2), (1000, 2**60), (70_000, 10**6), (40_000, 300)])
def test_elias_fano_round_trip(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n, dtype=np.uint64))
    made = E.EliasFano.encode(values)
    assert (made.values() == values).all()
    for a, b in ((0, n), (n // 3, n // 2), (n, n), (max(0, n - 1), n)):
        assert (made.slice(a, b) == values[a:b]).all()


def test_elias_fano_is_compact():
    values = np.arange(100_000, dtype=np.uint64) * np.uint64(200)
    made = E.EliasFano.encode(values)
    assert made.low.nbytes + made.upper.nbytes + made.starts.nbytes < 2.3 * 100_000


def test_trie(tmp_path):
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 400, (60_000, 2)).astype(np.uint64), axis=0)
    kept = rng.random(len(pairs)) < 0.4
    code = rng.integers(1, 256, len(pairs)).astype(np.uint8)
    weight = (pairs[:, 0] % 200 + 1).astype(np.uint8)

    def stored(kept):
        path = tmp_path / str(kept.sum())
        path.write_bytes(E.Trie.of(pairs[kept, 0], pairs[kept, 1], code[kept], weight[kept]).store())
        return E.Trie.mapped(path)
    found, left = stored(kept).search(pairs[:, 0], pairs[:, 1], 7)
    assert (found == np.where(kept, code, 0)).all()
    assert (left == np.where(np.isin(pairs[:, 0], pairs[kept, 0]), weight, 7)).all()
    found, left = stored(kept).search(np.array([5000], np.uint64), np.array([1], np.uint64), 7)
    assert not found.any() and left[0] == 7
    found, left = stored(np.zeros(len(pairs), bool)).search(pairs[:, 0], pairs[:, 1], 7)
    assert not found.any() and (left == 7).all()


def test_codes():
    p = np.array([0, 1e-14, 3e-5, 0.2, 1.0])
    back = L.probability(L.quantised(p))
    assert back[0] == 0 and back[-1] == pytest.approx(1)
    assert np.abs(np.log10(back[1:]) - np.log10(p[1:])).max() <= L.QUANTUM / 2 + 1e-9
    for a in (np.array([], np.uint32), np.arange(300, dtype=np.uint64) * 2**40):
        assert (L.unpacked(L.packed(a), a.dtype) == a).all()


def test_the_query_scores_with_trigrams(spark, docs, tmp_path):  # noqa: F811
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = L.op9_lm_scoring(spark, str(tmp_path)).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    alike(found, brute(rows, (50.0, 50.0), out), 2)


class Sent:
    """What a broadcast gives: no hot contexts but one."""

    value = np.array([1], np.uint64), np.array([1.0])


def zipf_block(tokens):
    """A packed block of so many words, some frequent and some rare, in texts of 100."""
    h = L.mix(np.random.default_rng(tokens).zipf(1.2, tokens).astype(np.uint64))
    n = tokens // 100
    return L._pack(0, [L.pa.array(range(n))], [i % 7 == 2 for i in range(n)], [100] * n, [h])


def test_a_block_takes_little_memory_and_sends_its_ngrams_piece_by_piece():
    """An asker held all n-grams of a block several times over, and sent them at once."""
    tokens = 400_000
    block = zipf_block(tokens)
    tracemalloc.start()
    sent, most = 0, 0
    for batch in L._asker(3, Sent, 7)(iter([block])):
        sent, most = sent + batch.nbytes, max(most, batch.nbytes)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 60 * tokens
    assert most < 2 * L._SENT < sent


def test_what_is_asked_is_compact():
    """Words of a shard are named once, names in order by their steps."""
    block = zipf_block(400_000)
    rows = [r for b in L._asker(2, Sent, 4)(iter([block])) for r in b.to_pylist()]
    own = [L._merged([dict(r)]) for r in rows]
    assert sum(len(r["a"]) + len(r["b"]) for r in rows) < 6.5 * sum(len(m[0]) for m in own)
    packed = L.Block(block.to_pylist()[0])
    assert sum(int(m[2].sum()) for m in own) == packed.learnt.sum()
    for row, (context, word, _, place, sizes) in zip(rows, own):
        pairs = list(zip(context.tolist(), word.tolist()))
        assert pairs == sorted(set(pairs)) and (place == np.arange(sizes[0])).all()
        assert (L.shard_of(context, word, Sent.value[0], 4) == row["shard"]).all()


def test_all_answers_are_written_so_that_no_shuffled_ngrams_stay(spark, docs):  # noqa: F811
    """The answers of the last order were still shuffled n-grams when the blocks met them."""
    packs = L._packed_blocks(docs, held(), "text", "doc_id", 3000)
    _, answers = L._learnt(packs, (50.0, 5.0), L.SHARD_BYTES, False)
    plans = [a._jdf.queryExecution().optimizedPlan().toString() for a in answers]
    assert len(plans) == 3 and not any("MapInArrow" in p or "Repartition" in p for p in plans)


def test_blocks_meet_their_answers_in_as_many_tasks_as_there_are_blocks(spark, docs):  # noqa: F811
    """By the session's number of partitions the blocks of a task were more the larger the table."""
    blocks = L._packed_blocks(docs, held(), "text", "doc_id", 3000).count()
    found = L.score(docs, held(), block_text=3000)
    assert blocks != int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "RepartitionByExpression [block" in (plan := found._jdf.queryExecution().optimizedPlan().toString())
    assert f", {blocks}\n" in plan
