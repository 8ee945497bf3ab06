"""Near duplicates: SimHash fingerprints joined by the popcounts of their segments.

A fingerprint is embedded as the popcounts of its 2-bit segments. The Manhattan
distance of two embeddings never exceeds the Hamming distance of the
fingerprints. A grid fixes some segments; fingerprints within reach fall into
the same cell of some grid, are ranged by Manhattan distance there and verified
bit by bit.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import free_names
from tidemark.llm.components import connected_components
from tidemark.session import scratch_path

SEED = 42
_EVEN = 0x5555555555555555
#: Shingles whose bits are unpacked at a time.
_SHINGLES = 65_536
#: Cells up to this size are compared pair by pair.
_SMALL_CELL = 8
#: Links that a cell with groups may write out for each of its rows.
_LINKS_A_ROW = 4
#: Odd multipliers that derive further hashes of a shingle from its first.
_MIX = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every run of so many words, repeats included; a shorter text is one run.

    Words are what ASCII white space separates, with A-Z lower-cased.
    """
    split = text.encode("utf-8").lower().split()
    if not split:
        return np.empty(0, "<u8")
    joined = b" ".join(split)
    if len(split) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    starts = list(itertools.accumulate((len(w) + 1 for w in split), initial=0))
    runs = (joined[a : b - 1] for a, b in zip(starts, starts[words:], strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), "<u8", len(split) - words + 1)


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct shingle hashes in ascending order."""
    return np.unique(shingle_hashes(text, words))


def simhash(hashes: np.ndarray, n_words: int = 1) -> list[int]:
    """Fingerprint of n_words * 64 bits: a bit is set if it is in over half the hashes."""
    out = []
    for mix in _MIX[:n_words]:
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), _SHINGLES):
            part = hashes[at : at + _SHINGLES]
            if mix != 1:
                part = part * np.uint64(mix)
                part ^= part >> np.uint64(29)
                part = part * np.uint64(_MIX[2])
                part ^= part >> np.uint64(32)
            counts += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0]))
    return out


def fingerprints(docs: DataFrame, words: int = 4, n_words: int = 1, repeats: bool = True) -> DataFrame:
    """doc_id, text_hash and ``fp``, an array of ``n_words`` longs. A null or empty text has all bits clear.

    Without ``repeats`` each distinct shingle counts once.
    """
    hashes = shingle_hashes if repeats else shingle_set

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(hashes(t or "", words), n_words) for t in batch.column(2).to_pylist()]
            fp = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fp], ["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text_hash(text), text).mapInArrow(
        run, "doc_id long, text_hash long, fp array<long>"
    )


def text_hash(text: Column) -> Column:
    """With doc_id it tells rows apart that share their id; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash")


def exact_grids(radius: int = 4, groups: int = 8) -> list[list[int]]:
    """Grids that miss no pair within ``radius``: each fixes all but ``radius`` of ``groups`` equal groups of segments.

    A distance of ``radius`` touches at most so many groups; the others agree.
    """
    size = 64 // groups
    fixed = itertools.combinations(range(groups), groups - radius)
    return [[sum(((1 << size) - 1) << (g * size) for g in chosen)] for chosen in fixed]


def sampled_grids(n_words: int, grids: int, segments: int) -> list[list[int]]:
    """Grids that fix some segments drawn by a seeded generator, for radii no exact set of grids covers."""
    draw = np.random.default_rng(SEED)
    out = []
    for _ in range(grids):
        masks = [0] * n_words
        for at in draw.choice(32 * n_words, segments, replace=False).tolist():
            masks[at // 32] |= 3 << (2 * (at % 32))
        out.append(masks)
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def segment_popcounts(fp: Column) -> Column:
    """The embedding of a 64-bit word, each count written in unary: 0, 01 or 11.

    So the popcount of the exclusive or of two embeddings is their Manhattan distance.
    """
    even = F.lit(_EVEN)
    high = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(high).bitwiseAND(even)
    both = fp.bitwiseAND(high).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _embedded(bits: np.ndarray) -> np.ndarray:
    even, one = np.uint64(_EVEN), np.uint64(1)
    high = bits >> one
    return ((bits | high) & even) | (((bits & high) & even) << one)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _within(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which rows are within reach: those in Manhattan range first, then verified by Hamming distance."""
    near = _apart(_embedded(a), _embedded(b)) <= radius
    hit = np.flatnonzero(near)
    if len(hit):
        near[hit] = _apart(a[hit], b[hit] if len(b) == len(a) else b) <= radius
    return near


def _forest(bits: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links of one cell. A fingerprint that is reached is not compared again."""
    left, u, v = np.arange(len(bits)), [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _within(bits[left], bits[at][None, :], radius)
            found = left[near].tolist()
            u += [at] * len(found)
            v += found
            queue += found
            left = left[~near]
    return u, v


def _across(bits: np.ndarray, group: np.ndarray, radius: int, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All links of one cell between rows of different groups, the smaller group's rows against all larger groups'.

    More than ``most`` links are not kept: then the rows that have any come third instead.
    """
    _, of, size = np.unique(group, return_inverse=True, return_counts=True)
    order = np.lexsort((of, size[of]))
    ends = np.searchsorted(size[of][order] * len(of) + of[order], size[of][order] * len(of) + of[order], "right")
    none, many, met = np.empty(0, int), 0, np.zeros(len(bits), bool)
    us, vs = [none], [none]
    for at, end in enumerate(ends.tolist()):
        if end == len(order):
            break
        found = order[end:][_within(bits[order[end:]], bits[order[at]][None, :], radius)]
        many += len(found)
        met[found] = True
        met[order[at]] |= len(found) > 0
        if many <= most:
            us.append(np.full(len(found), order[at]))
            vs.append(found)
    return (none, none, np.flatnonzero(met)) if many > most else (np.concatenate(us), np.concatenate(vs), none)


def forest_of_groups(group: np.ndarray, meets: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Links that connect every two groups that any chain of links does; ``meets(at, left)`` tells which rows link with one.

    Rows of a group are connected already. Each row meets the groups not reached yet, smaller groups first.
    """
    _, of, rows = np.unique(group, return_inverse=True, return_counts=True)
    left, u, v = np.lexsort((of, rows[of])), [], []
    while len(left):
        mine = of[left] == of[left[0]]
        queue, left = left[mine].tolist(), left[~mine]
        while queue and len(left):
            at = queue.pop()
            hit = left[meets(at, left)]
            if len(hit):
                reached, one = np.unique(of[hit], return_index=True)
                u += [at] * len(one)
                v += hit[one].tolist()
                came = np.isin(of[left], reached)
                queue += left[came].tolist()
                left = left[~came]
    return u, v


def _cell_links(
    cell: np.ndarray, bits: np.ndarray, radius: int, group: np.ndarray | None = None, dense: list | None = None, forest: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of the same cell; rows come sorted by cell. With ``group`` all those between groups.

    If a list ``dense`` is given, a cell with more links than a few a row adds its linked rows there instead. With
    ``forest`` larger cells yield one link for each group reached.
    """
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[first, len(cell)])
    of = np.repeat(np.arange(len(first)), size)
    small = np.repeat(size <= _SMALL_CELL, size)
    us, vs = [], []
    for step in range(1, _SMALL_CELL):
        a = np.flatnonzero((of[step:] == of[:-step]) & small[step:]) if len(of) > step else np.empty(0, int)
        if not len(a):
            break
        if group is not None:
            a = a[group[a] != group[a + step]]
        hit = a[_within(bits[a], bits[a + step], radius)]
        us.append(hit)
        vs.append(hit + step)
    for k in np.flatnonzero(size > _SMALL_CELL):
        rows = slice(first[k], first[k] + size[k])
        if group is None:
            u, v = _forest(bits[rows], radius)
        elif forest:
            own = bits[rows]
            u, v = forest_of_groups(group[rows], lambda at, left: _within(own[left], own[at][None, :], radius))
        else:
            u, v, met = _across(bits[rows], group[rows], radius, np.inf if dense is None else _LINKS_A_ROW * size[k])
            if len(met):
                dense.append(met + first[k])
        us.append(np.array(u, int) + first[k])
        vs.append(np.array(v, int) + first[k])
    none = np.empty(0, int)
    return np.concatenate([none, *us]), np.concatenate([none, *vs])


def _grid_links(distinct: DataFrame, grids: list[list[int]], radius: int, n_words: int, forest: bool = False) -> DataFrame:
    """Links (u, v) between nodes of (node, fp): rows are dealt by cell and read in its order, one cell at a time.

    A cell yields a spanning forest. If there is a column ``group``, it yields all links between groups, with a null
    ``cell``; one with more than a few links a row yields its linked rows instead: (u, v) is (node, group) then. With ``forest`` it connects the groups and has no ``cell``.
    """
    grouped = ["group"] if "group" in distinct.columns else []
    words = [F.col("fp")[i] for i in range(n_words)]
    embedded = [segment_popcounts(w) for w in words]
    masks = F.array(*(F.struct(F.lit(t).alias("t"), *(F.lit(_signed(m)).alias(f"m{i}") for i, m in enumerate(ms)))
                      for t, ms in enumerate(grids)))
    rows = distinct.select("node", *grouped, *(w.alias(f"w{i}") for i, w in enumerate(words)),
                           *(e.alias(f"e{i}") for i, e in enumerate(embedded)), F.explode(masks).alias("g"))
    key = F.xxhash64(F.col("g.t"), *(F.col(f"e{i}").bitwiseAND(F.col(f"g.m{i}")) for i in range(n_words)))
    rows = rows.select(key.alias("cell"), "node", *(f"w{i}" for i in range(n_words)), *grouped)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(cell, node, bits, *group):
            if forest or not group:
                u, v = _cell_links(cell, bits, radius, *group, forest=forest)
                return pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], ["u", "v"])
            dense = [np.empty(0, int)]
            u, v = _cell_links(cell, bits, radius, *group, dense)
            rows = np.concatenate(dense)
            cells = pa.concat_arrays([pa.nulls(len(u), pa.int64()), pa.array(cell[rows])])
            ends = (np.concatenate([node[u], node[rows]]), np.concatenate([node[v], group[0][rows]]))
            return pa.RecordBatch.from_arrays([*map(pa.array, ends), cells], ["u", "v", "cell"])

        held: list[tuple] = []
        for batch in batches:
            cell, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bits = np.stack([batch.column(2 + i).to_numpy() for i in range(n_words)], 1).view("<u8")
            columns = (cell, node, bits, *(batch.column(2 + n_words).to_numpy() for _ in grouped))
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            if cut:
                held.append(tuple(c[:cut] for c in columns))
                yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append(tuple(c[cut:] for c in columns))
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    schema = "u long, v long, cell long" if grouped and not forest else "u long, v long"
    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, schema)


def _prints(docs: DataFrame, words: int, n_words: int, repeats: bool = True) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows with their ``node``, and one row of each node: its fp and its least row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, words, n_words, repeats).write.parquet(path)
    prints = spark.read.parquet(path)
    node = F.col("fp")[0] if n_words == 1 else F.xxhash64("fp")
    prints = prints.withColumn("node", node)
    same = [F.min(F.col("fp")[i]).alias(f"w{i}") for i in range(n_words)]  # all rows of a node agree
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = prints.groupBy("node").agg(F.min("doc_id").alias("least"), first, *same)
    return prints, classes.select("node", "least", "first", F.array(*(f"w{i}" for i in range(n_words))).alias("fp"))


def _named(prints: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, ``root`` (a name of the group) and component_id of every row."""
    roots = connected_components(links)
    named = classes.select("node", "least").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("component", "node")).select("node", "root", "least")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("node", "root", "component_id")
    return prints.join(named, "node").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, words: int = 4, n_words: int = 1, radius: int = 4, grids: list[list[int]] | None = None
) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links of at most ``radius`` bits reach.

    Equal fingerprints are one node, so groups of copies of any size are not
    compared among themselves; a cell yields a spanning forest, not all its
    pairs. Null and empty texts have the all-clear fingerprint and are linked
    by it like others. Rows without doc_id never name a group; one of theirs
    alone has a null component_id. Repeated rows are repeated; other columns
    are ignored.
    """
    prints, classes = _prints(docs, words, n_words)
    links = _grid_links(classes.select("node", "fp"), grids or exact_grids(radius), radius, n_words)
    return _named(prints, classes, links).select("doc_id", "fp", "component_id")


#: Wide fingerprints for similarities: four words, five-word shingles.
WIDE = {"words": 5, "n_words": 4}
SIMILARITY = 0.8
#: Sets of shingles with similarity s differ in at most about acos(2s/(1+s))/pi of their bits: 0.15 at 0.8, a
#: distance of 38.8 with a standard deviation of 5.7. With three deviations' leeway, as links are verified.
WIDE_RADIUS = 56
WIDE_GRIDS = {"grids": 128, "segments": 9}
#: Close copies are grouped first, so that the wide search need not pair them with each other.
CLOSE_RADIUS = 42
CLOSE_GRIDS = {"grids": 16, "segments": 10}
#: Bytes of sets that a cluster may bring to one task, and that a part of a cell holds, about.
CLUSTER_BYTES = 32 << 20
CELL_BYTES = 32 << 20


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id and component_id of groups that links of similarity 0.8 or more connect.

    The similarity is that of the sets of five-word shingles (shared over all).
    256-bit SimHash proposes pairs, exact sets decide. Nulls, empty texts, ties
    and repeated rows as in ``near_duplicates``.
    """
    return _similar(docs).select("doc_id", "component_id")


def _similar(docs: DataFrame) -> DataFrame:
    """Verified links of forests group close copies; then all wide pairs between different groups are verified.

    A forest of candidates alone would lose links: what a rejected link leads to is not compared again. So a forest only
    tells which groups belong to one cluster, and each cluster's sets meet in one task, where every pair of groups is
    verified but only what connects them written. A cluster above CLUSTER_BYTES is compared cell by cell instead.
    """
    n_words = WIDE["n_words"]
    prints, classes = _prints(docs, **WIDE, repeats=False)
    classes = _stored(classes, "classes")
    close = _grid_links(classes.select("node", "fp"), sampled_grids(n_words, **CLOSE_GRIDS), CLOSE_RADIUS, n_words)
    close = _once(close)
    close = _verified(close, _shingle_sets(docs, classes, _ends(close)))
    roots = connected_components(close)
    grouped = classes.select("node", "fp").join(roots, "node", "left")
    grouped = _stored(grouped.select("node", "fp", F.coalesce("component", "node").alias("group")), "groups")
    grids = sampled_grids(n_words, **WIDE_GRIDS)
    # stored first: a task that also contracts the links would need a second Python worker, and those live on
    forest = _stored(_grid_links(grouped, grids, WIDE_RADIUS, n_words, forest=True), "forest")
    clusters = connected_components(close.unionByName(forest))
    rows = grouped.join(clusters, "node", "left").select(F.coalesce("component", "node").alias("cell"), "node", "group")
    mixed = rows.groupBy("cell").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi")
    rows = rows.join(mixed, "cell", "left_semi")
    sets = _shingle_sets(docs, classes, rows.select("node"))
    sized = rows.join(sets.select("node", "n_bytes"), "node").groupBy("cell").agg(F.sum("n_bytes").alias("n_bytes"))
    large = sized.where(F.col("n_bytes") > CLUSTER_BYTES)
    links = close.unionByName(_dense_links(rows.join(large, "cell", "left_anti"), sets))
    if not large.isEmpty():
        members = rows.join(large, "cell", "left_semi").select("node")
        wide = _stored(_grid_links(grouped.join(members, "node", "left_semi"), grids, WIDE_RADIUS, n_words), "wide")
        pairs = _once(wide.where("cell is null"))
        dense = wide.where("cell is not null").select("cell", F.col("u").alias("node"), F.col("v").alias("group"))
        links = links.unionByName(_verified(pairs, sets)).unionByName(_dense_links(dense, sets))
    return _named(prints, classes, links)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _once(links: DataFrame) -> DataFrame:
    return _stored(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "candidates")


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("u", "v")).alias("node"))


def _shingle_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, fp, ``shingles`` (its set's hashes, ascending, 8 bytes each) and ``n_bytes`` of the asked nodes, each once."""
    wanted = classes.join(nodes.distinct(), "node")
    wanted = wanted.select("node", "fp", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long"), text_hash(text), text.alias("text"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    texts = texts.join(wanted, on).select("node", "fp", "text").dropDuplicates(["node"])

    def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t or "", WIDE["words"]).tobytes() for t in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array(found, pa.binary()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "fp", "shingles", "n_bytes"])

    return _stored(texts.mapInArrow(shingles, "node long, fp array<long>, shingles binary, n_bytes long"), "shingles")


def _verified(links: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (u, v) whose nodes' sets of shingles agree to SIMILARITY."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, a, b = batch.columns
            good = [agree(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")) for x, y in zip(a, b, strict=True)]
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(keep), v.filter(keep)], ["u", "v"])

    paired = links.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    paired = paired.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    return _stored(paired.select("u", "v", "a", "b").mapInArrow(check, "u long, v long"), "verified")


def _dense_links(dense: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (u, v) that connect what agrees in each cell of (cell, node, group), one for each group reached.

    A cell whose sets exceed CELL_BYTES is cut in parts by its counted bytes, and each two parts meet in a task, so no
    task holds more than two parts.
    """
    sized = dense.join(sets.select("node", "n_bytes"), "node")
    parts = sized.groupBy("cell").agg(F.ceil(F.sum("n_bytes") / CELL_BYTES).cast("int").alias("parts")).where("parts > 1")
    rows = dense.join(parts, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = rows.select("cell", "node", "group", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    unit = F.xxhash64("cell", F.least("part", "other"), F.greatest("part", "other"))
    rows = rows.select(unit.alias("unit"), "node", "group").join(sets.select("node", "fp", "shingles"), "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            node, group = (whole.column(i).to_numpy() for i in (1, 2))
            bits = np.array(whole.column(3).to_pylist(), "<i8").view("<u8")
            u, v = set_forest(group, [np.frombuffer(x.as_buffer(), "<u8") for x in whole.column(4)], bits)
            return pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], ["u", "v"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for a, b in itertools.pairwise(cuts):
                if held and held[0].column(0)[0].as_py() != at[a]:
                    yield links(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield links(held)

    rows = rows.select("unit", "node", "group", "fp", "shingles").repartition("unit").sortWithinPartitions("unit", "node")
    return _stored(rows.mapInArrow(run, "u long, v long"), "dense")


def set_forest(group: np.ndarray, sets: list[np.ndarray], bits: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links between sets that agree (see ``agree``) which connect every two groups that any chain of such links does.

    With fingerprints ``bits`` only what lies within WIDE_RADIUS is verified.
    """
    size, least = np.array([len(s) for s in sets]), SIMILARITY - 1e-12
    hashes, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own, held = np.split(flat, np.cumsum(size)[:-1]), np.zeros(len(hashes), bool)

    def meets(at: int, left: np.ndarray) -> np.ndarray:
        good = np.minimum(size[left], size[at]) >= least * np.maximum(size[left], size[at])
        if bits is not None:
            good[good] = _within(bits[left[good]], bits[at][None, :], WIDE_RADIUS)
        asked = left[good]
        held[own[at]] = True
        shared = np.fromiter((np.count_nonzero(held[own[i]]) for i in asked.tolist()), np.int64, len(asked))
        held[own[at]] = False
        good[good] = shared >= least * (size[at] + size[asked] - shared)
        return good

    return forest_of_groups(group, meets)


def agree(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets share SIMILARITY or more of what either holds; empty sets agree with each other."""
    least = SIMILARITY - 1e-12
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= least * (len(a) + len(b) - shared)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs with one row of each group of similar documents: the one with the smallest doc_id.

    Of rows that share it the text with the smallest hash stays, once; null ids
    come first. Empty and null texts are one group. All columns stay.
    """
    kept = _similar(docs).groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
    of, key, doc, text = free_names(docs, "of", "key", "doc", "text_of")
    kept = kept.select(F.col("k.doc_id").alias(of), F.col("k.text_hash").alias(key))
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), text: text_hash(F.col("text").cast("string"))})
    chosen = keyed.join(kept, F.col(doc).eqNullSafe(F.col(of)) & (F.col(text) == F.col(key)), "left_semi")
    return chosen.dropDuplicates([doc, text]).drop(doc, text)
