import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpora import WORD, docs, nothing, prose  # noqa: F401
from stardw.llm import quality_rules as Q
from stardw.llm.vocabularies import Vocabulary


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1
             for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(again))


def test_counts_like_brute_force(docs):  # noqa: F811
    judged = Q.judge(docs, keep_text=True).collect()
    assert len(judged) == docs.count()
    for r in judged:
        assert tuple(r[c] for c in Q.COUNTS) == brute(r.text)
        n, *_, again = brute(r.text)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", ["a\na\n \n\nb\na ", "x x x x", "#|\n#|\n<>", " é\x85 z", "\0 \x1f"])
def test_counts_of_odd_texts(text):
    found = Q.base_counts(pa.array([text, None, text]))
    assert tuple(int(found[c][2]) for c in Q.COUNTS) == brute(text)
    assert all(found[c][1] == 0 for c in Q.COUNTS)


def test_measures():
    vocabulary = Vocabulary.public("piece_bpe_32k.model")
    text = "plain words 漢 \U0001F9EA"
    found = Q.token_measures([text, ""], vocabulary)
    ids = vocabulary.encode([text])[0]
    share = Counter(ids)
    assert found["n_tokens"] == [len(ids), 0] and found["chars_per_token"][0] == len(text) / len(ids)
    assert found["entropy"][0] == pytest.approx(-sum(
        n / len(ids) * np.log2(n / len(ids)) for n in share.values()))
    assert found["byte_share"][0] == 7 / len(ids) and found["byte_share"][1] == 0
    assert Q.script_of("Привет мир abc") == "Cyrillic" and Q.script_of("12") == "Other"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"])
def test_other_vocabularies(name):
    found = Q.token_measures(["some plain words", "漢字"], Vocabulary.public(name))
    assert found["n_tokens"][0] > 0 and found["byte_share"][0] == 0


def test_odd_texts_fall_out_of_the_bands(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(70, 120)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{rng.choice('qxzjkvw')}{rng.randint(10**6, 10**7)}#%&"
                                 for _ in range(90)), "en") for i in range(20)]
    kept = {r.doc_id: r.kept for r in Q.judge(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(kept[i] for i in range(300)) >= 297
    assert not any(kept[1000 + i] for i in range(20))


def test_keep_returns_the_columns_of_documents(docs, nothing):  # noqa: F811
    kept = Q.keep(docs)
    assert kept.schema == docs.schema
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}
    assert Q.keep(nothing).count() == 0


def junk(rng: random.Random) -> str:
    return " ".join(f"{rng.choice('qxzjkvw')}{rng.randint(10**6, 10**7)}#%&" for _ in range(90))


def kept_of(spark, rows):
    schema = "doc_id long, text string, lang string, source string"
    kept = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, schema)).collect()}
    assert len(kept) == len(rows)
    return kept


def clean_rows(rng):
    """400 texts of one language and 120 of another, by four sources."""
    return [(i, prose(rng, rng.randint(70, 120)), "en" if i < 400 else "fr", f"s{i % 4}")
            for i in range(520)]


def test_copies_have_one_vote(spark):
    rng = random.Random(5)
    rows = clean_rows(rng)
    # A third of all rows are copies of one text, in the smaller language.
    copied = " ".join(rng.choice(["understanding", "international", "government"]) + f" {w}"
                      for w in prose(rng, 70).split())
    rows += [(1000 + i, copied, "fr", "s9") for i in range(270)]
    kept = kept_of(spark, rows)
    assert sum(kept[i] for i in range(400, 520)) >= 118 and sum(kept[i] for i in range(400)) >= 396
    assert len({kept[i] for i in kept if i >= 1000}) == 1


@pytest.mark.parametrize("lang", ["en", "fr"])
def test_a_junk_source_does_not_move_the_bands(spark, lang):
    rng = random.Random(6)
    rows = clean_rows(rng) + [(1000 + i, junk(rng), lang, "hot") for i in range(270)]
    kept = kept_of(spark, rows)
    assert sum(kept[i] for i in range(520)) >= 513
    assert not any(kept[i] for i in kept if i >= 1000)


def test_a_small_language_is_judged_by_the_others(spark):
    rng = random.Random(8)
    rows = [*clean_rows(rng), *[(2000 + i, prose(rng, 90), "de", "s1") for i in range(20)],
            *[(3000 + i, junk(rng), "de", "s2") for i in range(10)]]
    kept = kept_of(spark, rows)
    assert sum(kept[2000 + i] for i in range(20)) >= 19
    assert not any(kept[3000 + i] for i in range(10))


def test_shortest_half():
    q = np.concatenate([np.zeros(12), np.linspace(5, 6, 29)])
    low, high = Q.shortest_half(q)
    assert 5 <= low < high <= 6
