import pytest

from corpora import docs, nothing  # noqa: F401
from stardw.llm.token_counts import count_tokens, fill, stored
from stardw.llm.vocabularies import Vocabulary
from stardw.session import scratch_dir


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"])
def test_like_the_library(spark, docs, name):  # noqa: F811
    vocabulary = Vocabulary.public(name)
    rows = count_tokens(docs, scratch_dir(spark, "cache"), vocabulary)
    texts = {(r.doc_id, r.n_chars): r.text or "" for r in docs.collect()}
    found = rows.collect()
    assert len(found) == docs.count()
    for r in found:
        text = texts[r.doc_id, r.n_chars]
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(vocabulary.encode([text])[0]))


def test_special_strings_are_text():
    for name in ("piece_bpe_32k.model", "byte_bpe_50k.json"):
        vocabulary = Vocabulary.public(name)
        assert vocabulary.encode([""]) == [[]]
        assert len(vocabulary.encode(["a<|endoftext|>b </s>"])[0]) > 3


def test_only_misses_are_encoded(spark, docs, nothing):  # noqa: F811
    cache, vocabulary = scratch_dir(spark, "cache"), Vocabulary.public("piece_bpe_32k.model")
    half = docs.filter("doc_id % 2 = 0")

    def rows():
        return spark.read.parquet(cache).count()
    fill(half, cache, vocabulary)
    assert rows() == half.selectExpr("coalesce(text, '')").distinct().count()
    fill(half, cache, vocabulary)
    assert rows() == half.selectExpr("coalesce(text, '')").distinct().count()
    fill(docs, cache, vocabulary)
    texts = docs.selectExpr("coalesce(text, '')").distinct().count()
    assert rows() == texts == stored(spark, cache, vocabulary.digest).count()
    other = Vocabulary.public("byte_bpe_50k.json")
    assert other.digest != vocabulary.digest
    fill(docs, cache, other)
    assert rows() == 2 * texts
    assert count_tokens(nothing, cache, vocabulary).count() == 0


def test_stored_counts_are_used(spark):
    cache, vocabulary = scratch_dir(spark, "cache"), Vocabulary.public("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "some text"), (2, "more")], "doc_id long, text string")  # noqa: F811
    spark.sql("SELECT unhex(sha2('some text', 256)) AS digest, 9L AS n_bytes, 77L AS n_tokens, "
              f"'{vocabulary.digest}' AS version").write.partitionBy("version").parquet(cache)
    found = {r.doc_id: r.n_tokens for r in count_tokens(docs, cache, vocabulary).collect()}
    assert found[1] == 77 and found[2] == len(vocabulary.encode(["more"])[0])
