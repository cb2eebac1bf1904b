import re

import pytest

from corpora import PLAIN, docs, nothing  # noqa: F401
from stardw.llm.decontaminate import matches, remove

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return TOKEN.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(rows, items):
    out = []
    for text in rows:
        words, hit, ids = tokens(text), set(), set()
        for item_id, item in items:
            own = tokens(item)
            n = min(10, len(own))
            for j in range(len(own) - n + 1 if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i:i + n] == own[j:j + n]:
                        hit.update(range(i, i + n))
                        ids.add(item_id)
        out.append((text, len(words), len(hit), sorted(i for i in ids if i is not None)))
    return out


@pytest.fixture(scope="module")
def items(docs):
    texts = [r.text for r in docs.select("text").collect() if r.text and len(tokens(r.text)) > 40]
    some = [" ".join(tokens(t)[5:5 + n]) for t, n in zip(texts, (10, 12, 30, 9, 11))]
    return [(1, some[0]), (2, some[1].upper()), (3, some[2]), (3, some[2]), (12, some[3]),
            (4, "two words"), (5, None), (6, ""), (7, "?!"), (None, some[4]), (8, " ".join(PLAIN))]


@pytest.mark.parametrize("part", [1 << 24, 100])
def test_like_brute_force(spark, docs, items, part):
    table = spark.createDataFrame(items, "item_id long, text string")
    found = matches(docs, table, part_bytes=part)
    got = [(r.text, r.n_words, r.n_hit, list(r.item_ids)) for r in found.collect()]
    wanted = brute([t for t, *_ in got], items)
    assert got == wanted and any(n for _, _, n, _ in got)
    assert found.columns[:4] == docs.columns[:4]


def test_longest_match(spark):
    docs = spark.createDataFrame([(1, "x " + " ".join(f"w{i}" for i in range(30)) + " y")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(9, "z " + " ".join(f"w{i}" for i in range(4, 26)))],
                                  "item_id long, text string")
    row = matches(docs, items).first()
    assert [tuple(m) for m in row.longest] == [(9, 1, 5, 22)]
    assert list(row.hit_spans) == [5, 27] and row.n_hit == 22


def test_remove_and_empty_tables(spark, docs, nothing, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    kept = remove(docs, table)
    assert kept.schema == docs.schema
    hit = sum(n > 0 for _, _, n, _ in brute([r.text for r in docs.collect()], items))
    assert kept.count() == docs.count() - hit
    assert remove(nothing, table).count() == 0
    assert remove(docs, table.limit(0)).count() == docs.count()


def test_items_with_ids_of_text_and_many_parts(spark, docs, items):  # noqa: F811
    """One part is sent at a time, whatever the number of parts; ids keep their type."""
    table = spark.createDataFrame([(None if i is None else f"item {i:03d}", t) for i, t in items], "item_id string, text string")
    whole = matches(docs, table).collect()
    df = matches(docs, table, part_bytes=40)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(str, df.collect())) == sorted(map(str, whole))
    assert any(i.startswith("item 0") for r in whole for i in r.item_ids)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 70000}" for i in range(400_000))
    docs = spark.createDataFrame([(1, text), (2, "x" * 2_000_000)], "doc_id long, text string")  # noqa: F811
    items = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(69_990, 70_000)))], "item_id long, text string")  # noqa: F811
    found = {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in matches(docs, items).collect()}
    assert found == {1: (400_000, 50, [7]), 2: (1, 0, [])}
