import hashlib
import random

import pytest

from corpora import docs, nothing  # noqa: F401
from stardw.llm.bpe_tree import Tree, decode, encode, unpacked
from stardw.llm.vocabularies import Vocabulary

VOCABULARY = Vocabulary.public("byte_bpe_50k.tiktoken")
LIBRARY, RANKS = VOCABULARY.encoder, VOCABULARY._ranks()
PARTS = ["a", "b", "l", "s", "'", "ll", "'ll", " ", "  ", "\n", "1", "2", "!", "?!", "漢", "é", "the", "re", "'ve", "\t",
         "ing", "🎉", " ", " ", "<|endoftext|>", "ء", "́", "²"]


@pytest.mark.parametrize("leaf,short", [(1, 1), (2, 2), (3, 5), (7, 3), (16, 24)])
def test_like_the_library_wherever_halves_part(leaf, short):
    tree, rng = Tree(RANKS, leaf, short), random.Random(leaf)
    for k in range(1500):
        text = "".join(rng.choice(PARTS if k % 3 else PARTS[:7]) for _ in range(rng.randint(0, 40)))
        assert unpacked(tree.encode(text)) == LIBRARY.encode_ordinary(text), text


@pytest.mark.parametrize("text", [
    "a" * 10007, " " * 5001, "=" * 7777 + "x", "ab" * 9999, "漢字" * 5000, "1" * 12345, "\n" * 999 + " a", "x'" * 3000 + "ll",
    "word " * 20000, " \n" * 4096 + "z", "é" * 4097])
def test_long_runs(text):
    tree = Tree(RANKS)
    ids = unpacked(tree.encode(text))
    assert ids == LIBRARY.encode_ordinary(text)
    assert tree.decode(ids) == text.encode()


def test_merges_like_all_pairs():
    """Merges of a short stretch and with the heap of a long one, against trying every pair."""
    tree, rng = Tree(RANKS), random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"abcdhinot \xc3\xa9") for _ in range(rng.randint(0, 60)))
        parts = [data[i:i + 1] for i in range(len(data))]
        while True:
            pairs = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        wanted = [RANKS[p] for p in parts]
        assert tree.merged(data) == tree._merged_long(data) == tree.tokens(data) == wanted


def test_a_token_that_merges_don_t_reach():
    """A match that is a token as a whole stays one; inside a longer match merges decide."""
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 256, b"abcd": 257, b"ab": 258}
    tree = Tree(ranks, leaf=1, short=1)
    assert unpacked(tree.encode("abcd")) == [257]
    assert unpacked(tree.encode("abcdz")) == [97, 256, 100, 122] == Tree(ranks).merged(b"abcdz")


def test_windows_don_t_reach_the_ends():
    """Two long halves are joined by work about the cut only."""
    tree, seen = Tree(RANKS), []
    left, right = tree.node("plain words here " * 3000 + "wor"), tree.node("ds and more of them " * 3000)
    find = tree.find
    tree.find = lambda text: seen.append(len(text)) or find(text)
    tree.join(left, right)
    assert max(seen) < 40


def test_documents(spark, docs):  # noqa: F811
    made = decode(encode(docs, VOCABULARY), VOCABULARY)
    assert made.columns == [c for c in docs.columns if c != "text"] + ["ids", "decoded"]
    texts = {}
    for r in docs.collect():
        texts.setdefault((r.doc_id, r.n_chars, r.source), []).append(r.text or "")
    found = made.collect()
    assert len(found) == docs.count()
    for r in found:
        text = next(t for t in texts[r.doc_id, r.n_chars, r.source] if t.encode() == bytes(r.decoded))
        assert unpacked(r.ids) == LIBRARY.encode_ordinary(text)


def test_edges(spark, nothing):  # noqa: F811
    assert decode(encode(nothing, VOCABULARY), VOCABULARY).count() == 0
    df = spark.createDataFrame([("x", None, "a", 1), (None, "", "b", 2), ("x", "Hi", "c", 3), ("x", "Hi", "c", 3)],
                               "IDS string, text string, Decoded string, k int")
    found = decode(encode(df, VOCABULARY), VOCABULARY).orderBy("k").collect()
    assert [(unpacked(r.ids), bytes(r.decoded)) for r in found] == [([], b""), ([], b"")] + [([17250], b"Hi")] * 2
    assert decode(spark.createDataFrame([(None,)], "ids binary"), VOCABULARY).first().decoded is None


def test_query(spark):
    from stardw.llm.bpe_tree import op12_bpe_tree
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    found = op12_bpe_tree(spark, path).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
