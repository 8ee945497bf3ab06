import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import fingerprint, near
from tidemark.llm.components import connected_components

from .conftest import invented


class Union(dict):
    def find(self, a):
        self.setdefault(a, a)
        while self[a] != a:
            a = self[a]
        return a

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60))
def test_components(spark, edges):
    union = Union()
    for a, b in edges:
        union.join(a, b)
    frame = spark.createDataFrame([*edges, (None, 3), (5, None)], "u long, v long").repartition(3)
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert got == {a: union.find(a) for a in union if union.find(a) != a}


def test_components_of_chains_and_hubs(spark):
    chain, hub = [(i, i + 1) for i in range(500)], [(1000, 2000 + i) for i in range(500)]
    frame = spark.createDataFrame(chain + hub, "u long, v long").repartition(7)
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert got == {i: 0 for i in range(1, 501)} | {2000 + i: 1000 for i in range(500)}


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    runs = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_force(rows, radius=4):
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    union = Union()
    for i, (_, a) in enumerate(prints):
        union.find(i)
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                union.join(i, j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            root = union.find(i)
            least[root] = min(least.get(root, d), d)
    return sorted(((d, f"{p:016x}", least.get(union.find(i))) for i, (d, p) in enumerate(prints)), key=str)


def found(docs):
    hexed = near.near_duplicates(docs).select("doc_id", fingerprint.as_hex(F.col("fp")[0]), "component_id")
    return sorted(map(tuple, hexed.collect()), key=str)


def test_near_duplicates_by_force(sample, edge, empty):
    for docs in (sample, edge):
        assert found(docs) == components_by_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert near.near_duplicates(empty).count() == 0


def test_dense_cells_keep_their_links():
    draw = np.random.default_rng(3)
    bits = np.repeat(draw.integers(0, 2**63, 3, dtype="u8"), 60)
    for i in range(len(bits)):
        for b in draw.integers(0, 64, 4):
            bits[i] ^= np.uint64(1) << np.uint64(b)
    u, v = near._cell_links(np.zeros(len(bits), "i8"), bits[:, None], 4)
    mine, want = Union(), Union()
    for i in range(len(bits)):
        mine.find(i), want.find(i)
        for j in range(i):
            if int(bits[i] ^ bits[j]).bit_count() <= 4:
                want.join(i, j)
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        assert int(bits[a] ^ bits[b]).bit_count() <= 4
        mine.join(a, b)
    assert len(u) < len(bits)
    assert [mine.find(i) for i in range(len(bits))] == [want.find(i) for i in range(len(bits))]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1))
def test_manhattan_is_a_lower_bound(a, b):
    x, y = (near._embedded(np.array([[v]], "u8")) for v in (a, b))
    counts = lambda v: [(v >> (2 * i) & 3).bit_count() for i in range(32)]
    apart = sum(abs(p - q) for p, q in zip(counts(a), counts(b), strict=True))
    assert int(near._apart(x, y)[0]) == apart <= (a ^ b).bit_count()


def test_similar_documents_and_what_stays(spark):
    base, docs = invented(7, 400), []
    words = base.split()
    draw = random.Random(5)
    for i in range(40):
        copy = list(words)
        for at in draw.sample(range(400), 3):
            copy[at] = f"edit{i}"
        docs.append((i, " ".join(copy), 7))
    docs += [(100 + i, invented(50 + i, 200), 7) for i in range(40)] + [(200, docs[0][1], 8), (300, "", 1), (301, None, 1), (None, base, 9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, fp int").repartition(4)
    groups = {r.doc_id: r.component_id for r in near.similar_documents(frame).collect()}
    assert all(groups[i] == 0 for i in range(40))
    assert all(groups[100 + i] == 100 + i for i in range(40))
    kept = [r.doc_id for r in near.keep_one_of_each(frame).collect()]
    assert sorted(kept, key=str) == sorted([None, *range(100, 140), 300], key=str)
    again = near.keep_one_of_each(frame.unionByName(frame))
    assert again.count() == len(kept) and again.columns == frame.columns


def pair_at(seed, shingles, shared):
    """Two texts of so many distinct five-word shingles each that share their first ones."""
    words = [f"w{seed}x{i}" for i in range(shingles + 4)]
    other = words[: shared + 4] + [f"o{seed}x{i}" for i in range(shingles - shared)]
    return " ".join(words), " ".join(other)


def test_pairs_just_above_and_below_the_similarity(spark):
    docs = []
    for i in range(120):  # 178 of 222 is 0.802, 184 of 216 is 0.852, 172 of 228 is 0.754
        for kind, shared in enumerate((178, 184, 172)):
            docs += [(1000 * i + 10 * kind + k, t) for k, t in enumerate(pair_at(3 * i + kind, 200, shared))]
    groups = {r.doc_id: r.component_id for r in near.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    linked = [sum(groups[1000 * i + 10 * kind + 1] == 1000 * i + 10 * kind for i in range(120)) for kind in range(3)]
    assert linked[0] >= 0.95 * 120 and linked[1] >= 0.98 * 120
    assert linked[2] == 0


def test_links_between_groups_by_force():
    draw = np.random.default_rng(4)
    bits = np.repeat(draw.integers(0, 2**63, 3, dtype="u8"), 20)
    bits ^= np.uint64(1) << draw.integers(0, 64, 60).astype("u8")
    group = draw.integers(0, 9, 60)
    u, v = near._cell_links(np.zeros(60, "i8"), bits[:, None], 4, group)
    want = {(i, j) for i in range(60) for j in range(i) if group[i] != group[j] and int(bits[i] ^ bits[j]).bit_count() <= 4}
    assert {(max(p), min(p)) for p in zip(u.tolist(), v.tolist(), strict=True)} == want and len(u) == len(want)


def test_forests_of_sets_by_force():
    draw = np.random.default_rng(6)
    base = draw.integers(0, 2**63, 60, dtype="u8")
    for _ in range(20):
        sets = [np.unique(np.r_[draw.permutation(base)[: draw.integers(50, 61)], draw.integers(0, 2**63, draw.integers(0, 8), dtype="u8")]) for _ in range(30)]
        sets += [np.empty(0, "u8"), np.empty(0, "u8")]
        group = draw.integers(0, 24, len(sets))
        mine, want = Union(), Union()
        u, v = near.set_forest(group, sets)
        for i in range(len(sets)):
            for j in range(i):
                if group[i] == group[j] or near.agree(sets[i], sets[j]):
                    want.join(i, j)
                if group[i] == group[j]:
                    mine.join(i, j)
        for a, b in zip(u, v, strict=True):
            assert near.agree(sets[a], sets[b]) and group[a] != group[b]
            mine.join(a, b)
        assert len(u) < len(np.unique(group))
        assert [mine.find(i) for i in range(len(sets))] == [want.find(i) for i in range(len(sets))]


def template_pages(pages, words=120):
    """Pages of one template whose shingles agree to about 0.75, and for every tenth a copy that agrees to 0.9."""
    base, docs = invented(31, words).split(), []
    for i in range(pages):
        draw, page = random.Random(i), list(base)
        for at in draw.sample(range(words), 4):
            page[at] = f"own{i}"
        docs.append((2 * i, " ".join(page)))
        if i % 10 == 0:
            docs.append((2 * i + 1, " ".join([*page[:60], "other", *page[61:]])))
    return docs


@pytest.mark.parametrize("held", [near.CLUSTER_BYTES, 40_000])
def test_template_pages_by_force_without_writing_pairs(spark, monkeypatch, held):
    monkeypatch.setattr(near, "CLUSTER_BYTES", held)
    monkeypatch.setattr(near, "CELL_BYTES", held)
    written = {}
    stored = near._stored
    monkeypatch.setattr(near, "_stored", lambda df, label: written.setdefault(label, []).append(stored(df, label)) or written[label][-1])
    docs = template_pages(300)
    sets = [near.shingle_set(t, 5) for _, t in docs]
    union = Union()
    for i in range(len(docs)):
        union.find(i)
        for j in range(i):
            if near.agree(sets[i], sets[j]):
                union.join(i, j)
    got = {r.doc_id: r.component_id for r in near.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    want = {d: docs[union.find(i)][0] for i, (d, _) in enumerate(docs)}
    assert sum(got[d] == want[d] for d in want) >= 0.99 * len(want)
    assert all(want[d] == want[got[d]] for d in want)
    assert all(frame.count() < len(docs) for frame in written["dense"][:1])
    if "wide" in written:
        assert held == 40_000 and written["wide"][0].where("cell is not null").count() > 0
        assert written["wide"][0].count() <= (near._LINKS_A_ROW + 1) * near.WIDE_GRIDS["grids"] * len(docs)
    else:
        assert held > 40_000


def test_fingerprints_of_edited_texts(spark, sample, edge, empty):
    rows = sorted(((r.doc_id, r.text or "") for r in sample.collect()))
    got = {r.doc_id: r for r in fingerprint.document_fingerprints(sample).collect()}
    prints = {d: int(got[d].fingerprint, 16) for d, _ in rows}
    for i, (d, text) in enumerate(rows):
        follow, follow_text = rows[(i + 1) % len(rows)]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow_text[:half]
        digest = spark.range(1).select(F.sha2(F.lit(edited).cast("binary"), 256)).head()[0] if i < 3 else None
        assert got[d].n_chars == len(text)
        assert digest in (None, got[d].edited_sha256)
        assert got[d].near_next == pytest.approx(1 - (prints[d] ^ prints[follow]).bit_count() / 64)
        apart = (prints[d] ^ int(got[d].edited_fingerprint, 16)).bit_count()
        assert got[d].near_edited == pytest.approx(1 - apart / 64)
        within = sum((prints[d] ^ p).bit_count() <= 3 for p in prints.values()) - 1
        assert got[d].n_within == (within if d % 50 == 0 else None)
    odd = fingerprint.document_fingerprints(edge).collect()
    assert len(odd) == edge.count()
    assert len({r.fingerprint for r in odd if r.doc_id in (1, 2)}) == 1
    assert {r.fingerprint for r in odd if r.doc_id in (4, 5, 6)} == {"0" * 16}
    assert fingerprint.document_fingerprints(empty).count() == 0


def test_native_fingerprint_by_force(spark):
    text = invented(9, 700)
    words = text.split()
    got = spark.createDataFrame([(text,)], "text string").select(fingerprint.fingerprint(F.col("text"))).head()[0]
    runs = spark.createDataFrame([tuple(words[i : i + 3]) for i in range(len(words) - 2)], "a string, b string, c string")
    h = F.xxhash64(F.xxhash64(F.xxhash64("a"), F.col("b")), F.col("c"))
    hashes = [r[0] % (1 << 64) for r in runs.select(h).collect()]
    assert got % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def test_no_task_contracts_links_while_it_finds_them(edge, monkeypatch):
    """Two operators with Python in one task take two workers, and idle ones keep their memory beside the heap."""
    plans = []

    def components(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return connected_components(links)

    monkeypatch.setattr(near, "connected_components", components)
    assert near.similar_documents(edge).count() == edge.count()
    assert len(plans) == 3 and not any("MapInArrow" in p for p in plans)
