"""Rows of the whole pipeline against a plain version of its five stages, over planted documents."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpora import WORD, prose
from stardw.llm import mixing, quality_rules as Q
from stardw.llm.vocabularies import Vocabulary

FOLD = {i: i + 32 for i in range(65, 91)}
BENCH_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    """Rows by kind, and benchmark items."""
    rng = random.Random(33)
    made = defaultdict(list)
    items = [("b1", "what does the quiet river carry past old mill stones when evening wind turns"),
             ("b2", "seven lamps"), ("b3", None)]

    def text(n):  # words with numbers, so that nothing repeats by chance
        return " ".join(f"{w}{rng.choice(['', '', rng.randint(0, 99)])}" for w in prose(rng, n).split())
    for i in range(260):
        made["clean"].append((i, text(rng.randint(70, 160)), "en" if i < 140 else "fr", f"s{i % 4}"))
    for i in range(300, 318):
        made["junk"].append((i, " ".join(f"{rng.choice('qxzjkvw')}{rng.randint(10**6, 10**7)}#%&"
                                         for _ in range(90)), "en", "s1"))
    made["short"] += [(320, "too few words", "en", "s0"), (321, None, "en", None), (322, "", "fr", "s1"),
                      (323, "again and " * 60, "en", "s2")]
    for k, i in enumerate(range(330, 342)):  # copies, exact and with one word more
        made["copy"].append((i, made["clean"][k][1] + (" tail" if k % 2 else ""), "en", "hot"))
    passage = text(60)
    for i in range(350, 356):
        made["passage"].append((i, f"{text(70)}\n{passage} {text(65)}", "fr", "s3"))
    for i in range(360, 364):
        own = text(80).split()
        own[40:40] = items[0][1].upper().split()
        made["leak"].append((i, " ".join(own), "en", "s2"))
    made["leak"].append((364, text(75) + " Seven LAMPS!", "fr", None))
    made["clean"].append((370, text(400) + " é 漢字", "en", None))
    return made, items


# --- the five stages, plainly -------------------------------------------------------------------

def measured(rows):
    vocabularies = [Vocabulary.public(name) for name in Q.VOCABULARIES]
    for row in rows:
        text = row[1] or ""
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        again = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1
                 for j in range(i, i + 3)}
        made = {"row": row, "text": text, "group": row[2], "source": row[3] or "",
                "failed": len(words) < 50 or 100 * len(again) > 50 * len(words)}
        for v, vocabulary in enumerate(vocabularies):
            ids = vocabulary.encode([text])[0]
            n, times = len(ids), Counter(ids)
            made.setdefault("length", int(math.log2(max(n, 1))))
            made["chars_per_token", v] = len(text) / n if n else 0.0
            made["byte_share", v] = sum(bool(vocabulary.bytes_only[i]) for i in ids) / n if n else 0.0
            made["entropy", v] = math.log2(n) - sum(t * math.log2(t) for t in times.values()) / n if n else 0.0
        yield made


def half(texts, metric):
    """The shortest half of the votes of some texts."""
    step, bins = Q.STEP[metric[0]], []
    of = Counter(t["source"] for t in texts)
    tally = Counter((t["source"], math.floor(t[metric] / step + 0.5)) for t in texts)
    for (source, at), n in tally.items():
        rest = len(texts) - of[source]
        share = min(1.0, rest / (2 * of[source])) if rest >= Q.LEAST else 1.0
        bins += [at] * max(1, math.floor(share * Q.VOTE * n + 0.5))
    q = np.percentile(bins, np.arange(Q.GRID + 1) * 100 / Q.GRID) * step
    m = Q.GRID // 2
    widths = [round(q[i + m] - q[i], 9) for i in range(m + 1)]
    at = min(range(m + 1), key=lambda i: (widths[i], abs(i - m // 2)))
    return q[at], q[at + m]


def good(rows):
    all_ = list(measured(rows))
    texts = list({(t["group"], t["text"]): t for t in sorted(all_, key=lambda t: t["source"], reverse=True)}.values())
    inside = {id(t): not t["failed"] for t in all_}
    for metric in [(m, v) for v in range(len(Q.VOCABULARIES)) for m in Q.METRICS]:
        by_length = metric[0] in Q.BY_LENGTH
        cell = (lambda t: (t["group"], t["length"])) if by_length else (lambda t: t["group"])
        cells = defaultdict(list)
        for t in texts:
            cells[cell(t)].append(t)
        halves = {k: half(own, metric) for k, own in cells.items()}
        large = [k for k, own in cells.items() if len(own) >= Q.LEAST]
        typical = float(np.median([halves[k][1] - halves[k][0] for k in large])) if large else 0.0

        def about(low, high):
            middle, width = (low + high) / 2, high - low
            if large:
                width = min(max(width, typical), max(Q.WIDEST * typical, Q.LEAST_WIDTH[metric[0]]))
            below, above = (max(r * width, Q.LEAST_WIDTH[metric[0]]) for r in Q.REACH[metric[0]])
            return middle - width / 2 - below, middle + width / 2 + above
        for t in all_:
            k = cell(t)
            if k in large:
                low, high = about(*halves[k])
            elif by_length or not large:
                low, high = about(*half([o for o in texts if not by_length or o["length"] == t["length"]], metric))
            else:
                low = min(about(*halves[g])[0] for g in large)
                high = max(about(*halves[g])[1] for g in large)
                if not low <= sum(halves[k]) / 2 <= high:
                    low, high = about(*halves[k])
            inside[id(t)] &= low <= t[metric] <= high
    return [t["row"] for t in all_ if inside[id(t)]]


def distinct(rows):
    sets, root = {}, {r[0]: r[0] for r in rows}
    for r in rows:
        w = WORD.findall((r[1] or "").translate(FOLD))
        sets[r[0]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j]) if i < j else 0
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [r for r in rows if root[r[0]] == r[0]]


def without_passages(rows):
    places = defaultdict(list)
    for r in rows:
        words = WORD.findall(r[1] or "")
        for at in range(len(words) - 49):
            places[tuple(words[at:at + 50])].append((hashlib.md5((r[1] or "").encode()).digest(), at, r[0]))
    cut = defaultdict(set)
    for found in places.values():
        for _, at, i in sorted(found)[1:]:
            cut[i].update(range(at, at + 50))
    out = []
    for r in rows:
        if not cut[r[0]]:
            out.append(r)
            continue
        left = " ".join(w for k, w in enumerate(WORD.findall(r[1])) if k not in cut[r[0]])
        if left:
            out.append((r[0], left, *r[2:]))
    return out


def without_benchmark(rows, items):
    def words(text):
        return BENCH_WORD.findall((text or "").translate(FOLD))

    def windows(w, n):
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    tests = [(w, min(10, len(w))) for w in (words(t) for _, t in items) if w]
    return [r for r in rows if not any(windows(words(r[1]), n) & windows(w, n) for w, n in tests)]


def mixed(rows, bucket):
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    total, order = Counter(), sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    for r in rows:
        total[r[3]] += size[r[0]]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, list(order), 1.5 * sum(size.values())
    while free:
        wanted = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if wanted[s] > 2 * total[s]]
        if not over:
            target |= wanted
            break
        target |= {s: 2.0 * total[s] for s in over}
        left -= sum(2 * total[s] for s in over)
        free = [s for s in free if s not in over]
    out = []
    for s in order:
        own = [r[0] for r in rows if r[3] == s]
        take = min(round(target[s]), 2 * total[s])
        times, rest = divmod(take, total[s]) if total[s] else (0, 0)
        held = Counter()
        for i in own:
            held[bucket[i]] += size[i]
        share, before = {}, 0
        for b in sorted(held):
            share[b] = min(max(rest - before, 0), held[b])
            before += held[b]
        out += [(i, size[i], total[s], target[s],
                 times * size[i] + (size[i] * share[bucket[i]] // held[bucket[i]] if held[bucket[i]] else 0))
                for i in own]
    return sorted(out)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made, items = planted()
    rows = [(*r, len(r[1] or "")) for kind in made.values() for r in kind]
    at = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_like_the_plain_version(spark, folder):
    made, items = planted()
    rows = [r for kind in made.values() for r in kind]
    buckets = spark.range(400).select("id", F.pmod(F.xxhash64("id", F.lit(mixing.SEED)), F.lit(
        mixing.BUCKETS))).collect()
    kept = [good(rows)]
    kept.append(distinct(kept[-1]))
    kept.append(without_passages(kept[-1]))
    kept.append(without_benchmark(kept[-1], items))
    # Every stage has something to do, and the planted rows leave where they should.
    assert [len(k) for k in kept] == sorted((len(k) for k in kept), reverse=True)
    ids = [{r[0] for r in k} for k in kept]
    clean = {r[0] for r in made["clean"]}
    assert not ids[0] & {r[0] for kind in ("junk", "short") for r in made[kind]}
    assert not ids[1] & {r[0] for r in made["copy"]} and ids[0] & {r[0] for r in made["copy"]}
    assert ids[2] == ids[1] and sum(a != b for a, b in zip(kept[1], kept[2])) == 5
    assert not ids[3] & {r[0] for r in made["leak"]} and ids[2] & {r[0] for r in made["leak"]}
    assert len(ids[3] & clean) >= 0.98 * len(clean)

    at, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, folder)
        found.append(at.collect())
    for own, wanted in zip(found, kept):
        assert sorted((r.doc_id, WORD.findall(r.text)) for r in own) == sorted(
            (r[0], WORD.findall(r[1])) for r in wanted)
    ran = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    wanted = mixed(kept[-1], {r[0]: r[1] for r in buckets})
    assert [r[:3] + r[4:] for r in ran] == [r[:3] + r[4:] for r in wanted]
    assert [r[3] for r in ran] == pytest.approx([r[3] for r in wanted])
