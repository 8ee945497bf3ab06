import numpy as np

from tidemark.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def by_force(rows, queries, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if queries(q):
            d = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q and len(v) == len(x))
            out[q] = d[:k]
    return out


def test_recall_and_exact_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = by_force([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 100 == 0)
    hits = 0
    got = neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0")).collect()
    for q, near in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        hits += len({r.vec_id for r in mine} & {i for _, i in near})
    assert hits >= 0.9 * 10 * len(want)


def test_blocks_do_not_matter(spark, monkeypatch):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(5)
    want = by_force([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 20 == 0)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 60)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    got = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()
    hits = sum(len({r.vec_id for r in got if r.query_id == q} & {i for _, i in near}) for q, near in want.items())
    assert hits >= 0.95 * 10 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (2, [1.0, 0.0]), (200, [nan, 0.0])]
    vectors = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA).repartition(3)
    got = {}
    for r in neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    root = 2**0.5
    assert sorted(got[0]) == [(1, 1, 0.0), (2, 2, 0.0), (3, 2, 0.0), (4, 100, root)]
    assert [v for _, v, _ in sorted(got[100])] == [0, 1, 2, 2]
    assert set(got) == {0, 100}
    none = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(none, none).count() == 0
    assert neighbours.nearest(vectors, none).count() == 0


def test_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0, "") for i in range(3000)] + [(5000, [3.0, 2.0, 1.0], 0, "")]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(vectors, vectors.where("vec_id = 100")).collect())
    assert got == [(100, n + 1, n) for n in range(10)]
