import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from corpora import WORD
from stardw.llm.words import ALNUM, blocks, covered, windows, words_of

texts = st.lists(st.one_of(st.none(), st.text("aB \n\té漢#0", max_size=30)), max_size=8)


@settings(deadline=None, max_examples=60)
@given(texts)
def test_words_are_those_of_the_pattern(rows):
    import re
    for kind, fold in ((WORD, False), (re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), True)):
        lower = [(r or "").translate({i: i + 32 for i in range(65, 91)}) if fold else r or ""
                 for r in rows]
        found = words_of(pa.array(rows, pa.string()), ALNUM, True) if fold else words_of(
            pa.array(rows, pa.string()))
        wanted = [kind.findall(r) for r in lower]
        assert found.count.tolist() == [len(w) for w in wanted]
        flat = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end)]
        assert flat == sum(wanted, [])
        by_word = dict(zip(flat, found.hashes().tolist()))
        assert [by_word[w] for w in flat] == found.hashes().tolist()
        assert len(set(by_word.values())) == len(by_word)


def test_windows_depend_on_content_only():
    h = np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64)
    twice = np.concatenate((h, h[:7], h))
    for size in (1, 4, 10, 20, 30):
        own, both = windows(h, size), windows(twice, size)
        assert (both[:len(own)] == own).all() and (both[47:] == own).all()
        assert len(np.unique(own)) == len(own)
    assert len(windows(h, 41)) == 0


def test_blocks_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 90, "", "c"])], ["text"])
    parts = list(blocks([batch], limit=12))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert [p.num_rows for p in parts] == [2, 1, 2]


def test_covered():
    assert covered(np.array([1, 2, 6]), 2, 8).tolist() == [0, 1, 1, 1, 0, 0, 1, 1]
