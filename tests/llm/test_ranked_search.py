import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm import queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def by_force(docs, items, k=10):
    """item_id -> (doc_id, score) by scoring every document for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()}
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, words in asked.items():
        scored = []
        for d, b in bags:
            m = 10 + 90 * sum(b.values()) * n // total
            score = sum(weight[w] * (1_000_000_000 * b[w] // (1000 * b[w] + 8 * m)) for w in words if w in b)
            if score > 0:
                scored.append((-score, d))
        if scored:
            out[i] = [(d, -s) for s, d in sorted(scored)[:k]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r["rank"])):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def corpus(seed, size, kinds=300):
    draw = random.Random(seed)
    vocabulary = [f"W{k}" if k % 3 else f"é{k}Ü" for k in range(kinds)]
    docs = [(i, " ".join(vocabulary[min(int(draw.expovariate(0.02)), kinds - 1)] for _ in range(int(draw.paretovariate(1.1) * 3)))) for i in range(size)]
    draw.shuffle(docs)
    return docs


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_by_force_in_many_shards(spark, monkeypatch, k):
    """Shards, pieces of strata and blocks of items far smaller than the table."""
    for name, value in {"SHARD_WORDS": 700, "PIECE_WORDS": 90, "ITEM_BLOCK": 5, "FIRST_STRATA": 1}.items():
        monkeypatch.setattr(ranked_search, name, value)
    docs, items = corpus(1, 600), corpus(2, 30)
    d, i = tables(spark, docs, items)
    index = ranked_search.build_index(d)
    assert index.postings.select("shard").distinct().count() > 5
    assert result(ranked_search.search(index, i, k)) == by_force(docs, items, k)


def test_strata_are_left_out():
    """A shard stops before strata that can't enter the list, and finds the same."""
    draw = random.Random(4)
    rows = [{"shard": 0, "m": 10 + 20 * (d % 60), "doc_id": d, "text": " ".join(draw.sample("abcdefgh", draw.randint(1, 8)))} for d in range(900)]
    table = ranked_search._post(ranked_search.pa.Table.from_pylist(rows))
    table = table.append_column("w", ranked_search.pa.array([100 * (k + 1) for k in range(table.num_rows)]))
    shard = ranked_search._Shard(table)
    seen = []
    whole = ranked_search._ranges
    try:
        ranked_search._ranges = lambda a, b: (seen.append(int((b - a).sum())), whole(a, b))[1]
        ids, scores = shard.best(ranked_search.np.arange(table.num_rows), 5)
    finally:
        ranked_search._ranges = whole
    assert sum(seen[1:]) < 0.5 * len(shard.doc)
    bags = [(r["doc_id"], r["m"], Counter(r["text"].split())) for r in rows]
    weight = {t: 100 * (k + 1) for k, t in enumerate(table["term"].to_pylist())}
    want = sorted((-sum(weight[t] * (10**9 * f // (1000 * f + 8 * m)) for t, f in b.items()), d) for d, m, b in bags)[:5]
    assert list(zip(ids.tolist(), scores.tolist(), strict=True)) == [(d, -s) for s, d in want]


def test_ties_and_repeats(spark):
    docs = [(k, "same text here") for k in range(40, 0, -1)] + [(7, "same text here"), (7, "same text"), (99, "other words")]
    items = [(1, "SAME"), (1, "text"), (2, "nothing of it"), (3, None), (None, "same"), (4, ""), (5, "same Same sAME")]
    d, i = tables(spark, docs, items)
    assert result(ranked_search.search(ranked_search.build_index(d), i)) == by_force(docs, items)


def test_edge_rows(spark, edge, empty):
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    items = [(1, docs[0][1][:200]), (2, "日本語 ÉÄSS Éäß don't short"), (3, "er x"), (4, docs[10][1])]
    _, i = tables(spark, [(1, "")], items)
    assert result(ranked_search.search(ranked_search.build_index(edge), i.selectExpr("*", "1 as score", "2 as doc_id", "3 as term"))) == by_force(docs, items)
    none = ranked_search.build_index(empty)
    assert (none.documents, none.words) == (0, 0) and ranked_search.search(none, i).collect() == []
    assert ranked_search.search(ranked_search.build_index(edge), i.where("false")).collect() == []


def test_frequent_terms_weigh_nothing(spark):
    """A term of every document has weight 0 and gives no rows."""
    docs = [(k, "all") for k in range(2000)]
    d, i = tables(spark, docs, [(1, "all")])
    assert result(ranked_search.search(ranked_search.build_index(d), i)) == by_force(docs, [(1, "all")]) == {}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = queries.op11_ranked_search(spark, folder)
    assert result(got) == by_force(docs, items)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_counts_of_a_sliced_batch():
    texts = ["a b", "", None, "é1 x", "_", "end", "joined", "", "x-y-z"]
    array = ranked_search.pa.array(["before", *texts, "after"])
    for part, want in ((array.slice(1, len(texts)), texts), (array.slice(3, 2), texts[2:4]), (array.slice(2, 1), [""])):
        assert ranked_search._count_terms(part).to_pylist() == [len(terms(t)) for t in want]
