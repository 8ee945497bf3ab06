import random
import time
import tracemalloc
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tidemark.llm import passages
from tidemark.session import FREE_SHUFFLES

from .conftest import invented


def test_minimizers_hit_every_window():
    words = passages.word_hashes(invented(1, 500))
    at, _ = passages.seeds(words)
    assert at[0] < passages.WINDOW and np.diff(at).max() <= passages.WINDOW
    assert len(at) < 500 / 4
    assert len(passages.seeds(words[:4])[0]) == 0
    assert len(passages.seeds(words[:5])[0]) == 1
    assert len(passages.seeds(np.full(300, 7, "u8"))[0]) == 1


def test_seeds_of_a_batch_are_those_of_its_texts():
    draw = random.Random(4)
    texts = [[draw.choice("abc") if draw.random() < 0.3 else draw.choice(["x", "y", str(draw.random())]) for _ in range(draw.choice([0, 3, 4, 5, 11, 30, 39, 40, 200]))] for _ in range(300)]
    texts += [["same"] * 50, ["same"] * 5, ["same"] * 60, []]
    words = [passages.word_hashes(" ".join(t)) for t in texts]
    for level in passages.LEVELS:
        text, at, hashes = passages.seeds_of_all(np.concatenate(words), np.array([len(w) for w in words]), *level)
        got = sorted(zip(text.tolist(), at.tolist(), hashes.tolist(), strict=True))
        want = [(i, *pair) for i, w in enumerate(words) for pair in zip(*(c.tolist() for c in passages.seeds(w, *level)), strict=True)]
        assert got == sorted(want)


def test_long_gaps_are_aligned():
    """Beyond a table of words, halves are aligned, as well as by the whole table."""
    draw = np.random.default_rng(3)
    for n, m in ((250, 251), (600, 90), (1, 50_000), (90, 600)):
        a, b = draw.integers(0, 4, n).astype("u8"), draw.integers(0, 4, m).astype("u8")
        row = passages._common_lengths(a, b)
        table = np.zeros((n + 1, m + 1), int)
        for i in range(n):
            table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + (a[i] == b)))
        assert (row == table[-1]).all()
        assert passages._partnered(a, b).sum() == table[-1, -1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=12))
def test_best_chain_by_force(matches):
    own, other = [m[0] for m in matches], [m[1] for m in matches]
    got = passages.chains(own, other)
    assert sorted(i for c in got for i in c) == list(range(len(matches)))

    def worth(chain):
        steps = zip(chain, chain[1:], strict=False)
        cost = sum(passages.GAP * (own[j] - own[i] + other[j] - other[i]) for i, j in steps)
        return passages.K * len(chain) - cost

    best = [0.0] * len(matches)
    for i in sorted(range(len(matches)), key=lambda i: (own[i], other[i])):
        before = [best[j] - passages.GAP * (own[i] - own[j] + other[i] - other[j])
                  for j in range(len(matches)) if own[j] < own[i] and other[j] < other[i]]
        best[i] = passages.K + max([0.0, *before])
    assert abs(worth(got[0]) - max(best)) < 1e-6
    for chain in got:
        assert all(own[i] < own[j] and other[i] < other[j] for i, j in zip(chain, chain[1:], strict=False))


def covered(found, texts):
    out = defaultdict(set)
    for r in found:
        first = len(texts[r.doc_id][: r.start].split())
        assert len(texts[r.doc_id][r.start : r.end].split()) == r.n_words
        out[r.doc_id].update(range(first, first + r.n_words))
    return out


def test_exact_repeats_by_force(sample):
    rows = sorted((r.doc_id, r.text) for r in sample.collect())
    first, want = {}, defaultdict(set)
    for doc, text in rows:
        words = text.lower().split()
        for i in range(len(words) - 54):
            run = tuple(words[i : i + 55])
            if first.setdefault(run, doc) != doc:
                want[doc].update(range(i, i + 55))
    got = covered(passages.repeated_passages(sample).collect(), dict(rows))
    assert set(want) <= set(got)
    assert sum(len(want[d] - got[d]) for d in want) <= 0.01 * sum(map(len, want.values()))


def test_planted_passages(spark):
    draw, passage = random.Random(3), invented(77, 70)
    fuzzy = passage.split()
    for at in (20, 45):
        fuzzy[at] = "other"
    del fuzzy[33]
    docs = [(i, invented(100 + i, draw.randint(30, 200)) + " " + passage + " " + invented(300 + i, 60)) for i in range(30)]
    docs += [(50, invented(500, 90) + "\n" + " ".join(fuzzy) + "\n" + invented(501, 40))]
    docs += [(60 + i, invented(600 + i, 150)) for i in range(20)]
    short = invented(78, 30)
    docs += [(90, invented(700, 50) + " " + short), (91, short + " " + invented(701, 50))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = passages.repeated_passages(frame).collect()
    assert sorted(r.doc_id for r in found) == [*range(1, 30), 50]
    assert {r.source_id for r in found} == {0}
    texts = dict(docs)
    for r in found:
        span = texts[r.doc_id][r.start : r.end]
        assert span == (passage if r.doc_id < 50 else " ".join(fuzzy))
        assert r.rest == texts[r.doc_id].replace(span, "")
        assert r.similarity >= 0.8


def test_a_passage_in_two_halves(spark):
    """Its halves first stand in different documents; together they are one repeat."""
    a, b = invented(1, 40), invented(2, 40)
    docs = [(1, invented(11, 50) + " " + a), (2, b + " " + invented(12, 50)), (3, a + " " + b), (4, a + " " + b + " " + invented(13, 9))]
    found = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(found) == {3, 4} and found[4].n_words == 80


def test_a_passage_whose_short_seeds_stand_elsewhere(spark):
    """Every run of five words of it is in some earlier document, alone."""
    passage = invented(21, 60)
    words = passage.split()
    docs = [(i, invented(100 + i, 40) + " " + " ".join(words[i : i + 5]) + " " + invented(200 + i, 40)) for i in range(56)]
    docs += [(100, invented(300, 80) + " " + passage + " " + invented(301, 50)), (101, invented(302, 50) + " " + passage + " " + invented(303, 30))]
    found = passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert [(r.doc_id, r.source_id, r.n_words) for r in found] == [(101, 100, 60)]


def test_stock_phrases_make_no_passage(spark):
    phrases = [invented(400 + i, 14) for i in range(6)]
    docs = [(i, invented(500 + i, 60) + " " + p + " " + invented(600 + i, 60)) for i, p in enumerate(phrases)]
    docs += [(50, invented(700, 40) + " " + " ".join(phrases) + " " + invented(701, 40))]
    assert passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).count() == 0


def test_fuzzy_passages_are_found(spark):
    """Substitutions at random places in 80 words; 60 passages at each similarity."""
    draw, docs, wanted = random.Random(9), [], {}
    for kind, edits in enumerate((8, 12, 16)):
        for i in range(60):
            words = invented(1000 + 100 * kind + i, 80).split()
            fuzzy = list(words)
            for at in draw.sample(range(80), edits):
                fuzzy[at] = f"edit{at}"
            a, b = (1000 * kind + i, 10_000 + 1000 * kind + i)
            docs += [(a, invented(a + 50_000, 60) + " " + " ".join(words)), (b, " ".join(fuzzy) + " " + invented(b + 50_000, 60))]
            wanted[b] = (kind, a)
    found = {r.doc_id: r.source_id for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    share = [sum(found.get(b) == a for b, (k, a) in wanted.items() if k == kind) / 60 for kind in range(3)]
    assert share[0] >= 0.98 and share[1] >= 0.95 and share[2] >= 0.85


def test_odd_rows(spark, edge, empty):
    found = passages.repeated_passages(edge).collect()
    assert {r.doc_id for r in found} == {2, 3, 10}
    cleaned = passages.without_repeats(edge)
    assert cleaned.columns == edge.columns
    kept = {(r.doc_id, r.text) for r in cleaned.collect()}
    before = {(r.doc_id, r.text) for r in edge.collect()}
    assert {k for k in before - kept} == {b for b in before if b[0] in (2, 3, 10)}
    assert {d for d, _ in kept - before} <= {3, 10}
    assert passages.repeated_passages(empty).count() == 0
    assert passages.without_repeats(empty).count() == 0
    twice = passages.repeated_passages(edge.unionByName(edge))
    assert sorted(r.doc_id for r in twice.collect()) == sorted(r.doc_id for r in found)


def test_seeds_of_a_batch_take_little_memory(monkeypatch):
    """Four workers share an executor with its heap, so tables over all words of a batch at once do not fit."""
    words = [f"w{i % 9973}x{i % 31}" for i in range(40_000)]
    texts = [" ".join(words[i:] + words[:i]) for i in range(12)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.array(texts)], ["doc", "text"])
    caught = []
    passages._seed_blocks(SimpleNamespace(mapInArrow=lambda run, _: caught.append(run)), 3)
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    passages._hashed(words)
    tracemalloc.start()
    n = sum(sum(block["n"].to_pylist()) for block in map(pa.Table.from_batches, ([b] for b in caught[0](iter([batch])))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 300_000
    assert peak < 13 * sum(map(len, texts))


def test_seeds_and_matches_leave_the_disk_with_the_chains(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    docs = spark.createDataFrame([(i, invented(40 + i, 60) + " " + invented(7, 60)) for i in range(6)], "doc_id long, text string")
    before = shuffled()
    found = passages.repeated_passages(docs)
    end = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(FREE_SHUFFLES, None) is None
    assert {r["doc_id"] for r in found.collect()} == {1, 2, 3, 4, 5}
