import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import queries, runs


def by_force(words, least=24, periods=3):
    """Every run by comparing the words with themselves at every distance."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, periods * q) and i > s:
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(draw, size):
    kinds, words = draw.choice([1, 2, 3, 40]), []
    while len(words) < size:
        phrase = [draw.randrange(kinds) for _ in range(draw.randint(1, 20))]
        words += (phrase * 12)[: draw.randint(1, 12 * len(phrase))] if draw.random() < 0.6 else phrase
    return words[:size]


def test_runs_by_force():
    draw, seen = random.Random(3), 0
    for _ in range(400):
        texts = [repetitive(draw, draw.randint(0, 200)) for _ in range(draw.randint(1, 5))]
        got = runs.find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
        want = {i: found for i, t in enumerate(texts) if (found := by_force(t))}
        assert got == want
        seen += sum(map(len, want.values()))
    assert seen > 500


@pytest.mark.parametrize("least, periods", [(6, 2), (10, 4), (40, 3), (2, 2)])
def test_other_limits(least, periods):
    draw = random.Random(least)
    for _ in range(150):
        words = repetitive(draw, draw.randint(0, 120))
        got = runs.find_runs(np.array(words, np.int64), np.array([len(words)]), least, periods)
        assert got.get(0, []) == by_force(words, least, periods)


def test_one_word_many_times():
    assert runs.find_runs(np.zeros(100_000, np.int64), np.array([100_000])) == {0: [(0, 100_000, 1)]}


def test_lines_with_many_left_words():
    """A line that stands often after different words is a run only where it follows itself."""
    line = list(range(1, 21))
    words = sum(([100 + k, *line] for k in range(800)), []) + line * 4
    got = runs.find_runs(np.array(words), np.array([len(words)]))
    assert got == {0: [(800 * 21 - 20, 100, 20)]}


def test_strongest_is_exact():
    assert runs.strongest([(5, 30, 10), (0, 60, 20), (9, 24, 8)]) == (0, 60, 20)
    assert runs.strongest([(0, 30, 10), (3, 10**15 + 1, 10**14), (7, 10**15, 10**14)]) == (3, 10**15 + 1, 10**14)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = by_force(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def as_tuples(rows):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[n] for n in names) for r in rows), key=str)


def test_query_by_force(spark):
    got = queries.op13_runs(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    # By force a distance costs one pass, so the longest texts are left to the fixture of the edge cases.
    short = {d.doc_id for d in docs if len(d.text.split()) <= 1500}
    assert len(short) > 150
    assert as_tuples(r for r in got if r.doc_id in short) == sorted((expected(d.doc_id, d.text) for d in docs if d.doc_id in short), key=str)
    assert len(got) == len(docs) and any(r.n_runs for r in got)
    assert [f.dataType.simpleString() for f in queries.op13_runs(spark, "/root/testdata/sf0.001").schema] == ["bigint"] * 6 + ["string"] * 2


def test_edge_rows(spark, edge, empty):
    found = runs.periodic_runs(runs.with_planted_runs(edge))
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    short = [r for r in rows if len((r[1] or "").split()) < 5000]
    got = runs.run_digests(found).collect()
    assert len(got) == len(rows)
    assert as_tuples(r for r in got if r.doc_id != 11) == sorted((expected(*r) for r in short), key=str)
    assert runs.run_digests(runs.periodic_runs(runs.with_planted_runs(empty))).collect() == []
    clash = edge.withColumns({"runs": edge.text, "strongest": edge.text, "collapsed": edge.text, "words": edge.text, "a": edge.text})
    assert as_tuples(runs.run_digests(runs.periodic_runs(runs.with_planted_runs(clash))).collect()) == as_tuples(got)


def test_texts_and_spans(spark):
    docs = spark.createDataFrame([(1, "start " + "a b c " * 9 + "end"), (2, " \n")], "doc_id long, text string")
    got = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert got[1].collapsed == "start a b c end" and [tuple(r) for r in got[1].runs] == [(1, 27, 3)]
    assert got[2].collapsed == "" and got[2].runs == [] and got[2].strongest is None
