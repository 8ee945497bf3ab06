import numpy as np
import pytest

from tidemark.llm import queries, sorted_passes

SCHEMA = "vec_id long, embedding array<float>, label int, component string"


def by_force(rows, cosine=0.95):
    """(vec_id, n_links, component_id) of every row by all pairs."""
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, root = [0] * len(rows), {k: k for k, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for dims in {len(rows[i][1]) for i in good}:
        at = [i for i in good if len(rows[i][1]) == dims]
        x = np.array([rows[i][1] for i in at], np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        near = x @ x.T >= cosine
        for a, i in enumerate(at):
            links[i] = int(near[a].sum()) - 1
            for b in np.flatnonzero(near[a]):
                p, q = sorted((find(rows[i][0]), find(rows[at[b]][0])))
                root[q] = p
    return sorted(((k, n, find(k)) for (k, _), n in zip(rows, links, strict=True)), key=str)


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(k, v, 0, "mine") for k, v in rows], SCHEMA).repartition(parts)


def planted(seed, lone=300, groups=(2, 3, 40), spread=0.02, dims=16):
    draw = np.random.default_rng(seed)
    rows = [draw.standard_normal(dims) for _ in range(lone)]
    for size in groups:
        centre = draw.standard_normal(dims)
        rows += [centre + draw.standard_normal(dims) * spread for _ in range(size)]
    order = draw.permutation(len(rows))
    return [(int(k), [float(x) for x in np.float32(rows[i])]) for k, i in enumerate(order)]


def test_groups_and_links(spark):
    rows = planted(1)
    assert result(sorted_passes.near_vectors(table(spark, rows))) == by_force(rows)


def test_windows_across_partitions(spark, monkeypatch):
    """Small partitions and windows: borders, several passes and jobs."""
    monkeypatch.setattr(sorted_passes, "PART_ROWS", 90)
    rows = planted(2, lone=500, groups=(2,) * 20 + (150, 30))
    assert sorted_passes.passes_needed(len(rows), window=32) > sorted_passes.AT_ONCE
    assert result(sorted_passes.near_vectors(table(spark, rows), window=32)) == by_force(rows)


@pytest.mark.parametrize("spread", [0.01, 0.08, 0.14])
def test_large_groups(spark, monkeypatch, spread):
    """Tight groups are counted by pivots alone, loose ones block by block; both as by force."""
    monkeypatch.setattr(sorted_passes, "SMALL", 20)
    rows = planted(3, lone=60, groups=(2, 90, 35), spread=spread)
    got = dict((k, (n, c)) for k, n, c in result(sorted_passes.near_vectors(table(spark, rows))))
    want = dict((k, (n, c)) for k, n, c in by_force(rows))
    assert got == want


def test_tight_groups_compare_nothing(spark, monkeypatch):
    monkeypatch.setattr(sorted_passes, "SMALL", 20)

    def refuse(cosine):
        def run(asks, others):
            assert not asks.num_rows
            return sorted_passes.pa.table({"row": sorted_passes.pa.array([], "int64"), "found": sorted_passes.pa.array([], "int64")})

        return run

    monkeypatch.setattr(sorted_passes, "_count_between", refuse)
    rows = planted(4, lone=30, groups=(200,), spread=0.01)
    assert result(sorted_passes.near_vectors(table(spark, rows))) == by_force(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [2.0, 0.01]), (2, [1e30, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 1.0]), (None, None), (8, []), (9, [1.0, 2.0, 3.0]), (2, [1e-30, 0.0]), (200, [nan, 0.0]),
            (30, [5.0, 5.0, 5.0]), (30, [5.0, 5.0, 5.0]), (31, [1.0]), (31, [1.0, 1.0, -9.0])]
    got = sorted_passes.near_vectors(table(spark, rows))
    assert result(got) == by_force(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got.collect())
    assert sorted_passes.near_vectors(table(spark, rows).where("false")).collect() == []


def test_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(sorted_passes, "PART_ROWS", 500)
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(2500)] + [(9000, [3.0, 2.0, 1.0])]
    want = sorted([(k, 2499, 0) for k in range(2500)] + [(9000, 0, 9000)], key=str)
    assert result(sorted_passes.near_vectors(table(spark, rows), window=16)) == want


def test_recall_at_the_threshold(spark):
    """Pairs that just reach the cosine, among many others, with a window far smaller than the table."""
    draw = np.random.default_rng(5)
    x = draw.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = draw.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.952 * x + (1 - 0.952**2) ** 0.5 * side
    rows = [(2 * k + s, [float(t) for t in v[k]]) for k in range(len(x)) for s, v in enumerate((x, y))]
    got = sorted_passes.near_vectors(table(spark, rows), window=64).collect()
    assert sum(r.n_links for r in got) >= 0.98 * sum(n for _, n, _ in by_force(rows))


def test_query(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    got = queries.op12_vector_copies(spark, "/root/testdata/sf0.1")
    assert result(got) == by_force(rows)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
