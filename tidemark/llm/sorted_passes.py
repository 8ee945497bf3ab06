"""Near copies of vectors by sorted passes.

A pass orders all vectors by the signs of random projections laid end to end,
so near copies come to stand side by side, and compares each with a bounded
window of those after it. Passes with other projections find what one misses.
Verified pairs leave a task as a spanning forest only; their union gives the
groups. Links are then counted within each group, exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidemark.llm.components import _stars, connected_components
from tidemark.llm.neighbours import usable
from tidemark.session import scratch_path

COSINE = 0.95
#: Vectors after each one that a pass compares it with.
WINDOW = 1024
#: Share of the pairs that just reach the cosine which all passes together may miss.
MISS = 0.005
#: Signs in a key, passes sorted by one job, rows of a sorted partition.
BITS = 63
AT_ONCE = 4
PART_ROWS = 50_000
#: A group of at most so many vectors is compared whole; rows of a block and of a bucket of small groups.
SMALL = 2048
BUCKET_ROWS = 50_000
#: Reference vectors of a larger group.
PIVOTS = 8
#: Angles computed by different sums differ by less.
SLACK = 1e-7
SEED = 12


def passes_needed(rows: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair of just this cosine was in no common window with probability ``miss``.

    Two vectors agree in a sign with probability 1 - angle / pi; they share a
    window at the latest when so many first signs agree that no more than a
    window of rows does.
    """
    signs = math.log2(max(1.0, rows / window))
    together = (1 - math.acos(cosine) / math.pi) ** signs
    return 1 if together > 1 - miss else math.ceil(math.log(miss) / math.log1p(-together))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in doubles, however large or small their components are."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _rows(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = _rows(column)
    return _unit(np.array(rows, np.float64)) if rows else np.empty((0, 0))


def _sign_keys(vectors: np.ndarray, passes: int) -> np.ndarray:
    """One key of signs per vector and pass, the first projection in the highest bit."""
    keys = np.empty((len(vectors), passes), np.int64)
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for p in range(passes):
        planes = np.random.default_rng([SEED, vectors.shape[1], p]).standard_normal((vectors.shape[1], BITS))
        keys[:, p] = ((vectors @ planes) >= 0).astype(np.int64) @ weights
    return keys


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _with_keys(vectors: DataFrame, passes: int) -> DataFrame:
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column("embedding"))
            keys = np.empty((len(rows), passes), np.int64)
            sizes = np.array([len(r) for r in rows])
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                keys[at] = _sign_keys(_unit(np.array([rows[i] for i in at], np.float64)), passes)
            array = pa.ListArray.from_arrays(np.arange(0, len(rows) * passes + 1, passes, dtype=np.int32), keys.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, array], [*batch.schema.names, "keys"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(add, f"{ddl}, keys array<long>")


def _pairs(ids: np.ndarray, unit: np.ndarray, fresh: int, window: int, cosine: float) -> Iterator[np.ndarray]:
    """Verified pairs (2 x n) of every row with the next ``window``; the first ``fresh`` rows meet later ones only from there on."""
    step = 256
    for a in range(0, len(ids), step):
        last = min(a + step + window, len(ids))
        start = max(a + 1, fresh) if a + step <= fresh else a + 1
        if start >= last:
            continue
        near = unit[a : a + step] @ unit[start:last].T >= cosine
        i, j = np.nonzero(near)
        i, j = i + a, j + start
        good = (j > i) & (j - i <= window) & (j >= fresh)
        if good.any():
            yield np.stack([ids[i[good]], ids[j[good]]])


def _forest(pairs: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the pairs connect, and a loop for every id that stands in two linked rows."""
    u, v, loops = np.empty(0, np.int64), np.empty(0, np.int64), set()
    for pair in pairs:
        same = pair[0] == pair[1]
        loops.update(pair[0][same].tolist())
        u, v = np.concatenate([u, pair[0][~same]]), np.concatenate([v, pair[1][~same]])
        if len(u) > 1 << 18:
            u, v = _stars(u, v)
    if len(u):
        u, v = _stars(u, v)
    own = np.array(sorted(loops), np.int64)
    return np.concatenate([u, own]), np.concatenate([v, own])


def _scan(window: int, cosine: float, kind: pa.DataType):
    """Compares sorted rows (vec_id, dims, turn, embedding) with their windows; hands on its first and last rows.

    Edges go out as (u, v); the first and last ``window`` rows of the partition
    with their vectors, so that windows across its borders can be compared too.
    """
    from pyspark import TaskContext

    names = ["u", "v", "part", "side", "at", "dims", "turn", "embedding"]

    def edges(u, v):
        nothing = [pa.nulls(len(u), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), kind)]
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *nothing], names)

    def border(rows: pa.Table, part: int, side: int):
        rows = rows.combine_chunks()
        n = rows.num_rows
        at = np.arange(n) if side else np.arange(n) - n
        flat = [pa.array(np.full(n, x, np.int32)) for x in (part, side)]
        columns = [rows["vec_id"], pa.nulls(n, pa.int64()), *flat, pa.array(at), rows["dims"], rows["turn"], rows["embedding"]]
        return pa.Table.from_arrays(columns, names).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, tail = TaskContext.get().partitionId(), None, None
        label, ids, unit = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if head is None or head.num_rows < window:
                head = table if head is None else pa.concat_tables([head, table])
                head = head.slice(0, window)
            tail = table if tail is None else pa.concat_tables([tail, table])
            tail = tail.slice(max(0, tail.num_rows - window))
            labels = np.stack([batch.column(c).to_numpy() for c in ("dims", "turn")], 1)
            cuts = np.flatnonzero((labels[1:] != labels[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(labels)], strict=True):
                now = tuple(labels[a])
                new_ids, new_unit = batch.column("vec_id").to_numpy()[a:b], _matrix(batch.column("embedding").slice(a, b - a))
                fresh = 0
                if now == label:
                    fresh = len(ids)
                    new_ids, new_unit = np.concatenate([ids, new_ids]), np.concatenate([unit, new_unit])
                u, v = _forest(_pairs(new_ids, new_unit, fresh, window, cosine))
                if len(u):
                    yield edges(u, v)
                label, ids, unit = now, new_ids[-window:], new_unit[-window:]
        if head is not None:
            yield from border(head, part, 1)
            yield from border(tail, part, 0)

    return run


def _across(window: int, cosine: float):
    """Compares the last rows of one sorted partition with the first of the next."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("side", "ascending"), ("at", "ascending")])
        labels = np.stack([rows.column(c).to_numpy() for c in ("dims", "turn")], 1)
        side, found = rows.column("side").to_numpy(), [np.empty(0, np.int64)] * 2
        first = int((side == 0).sum())
        if 0 < first < len(side) and (labels[first - 1] == labels[first]).all():
            at = np.flatnonzero((labels == labels[first]).all(1))
            table = rows.take(pa.array(at))
            fresh = int((side[at] == 0).sum())
            found = _forest(_pairs(table["u"].to_numpy(), _matrix(table["embedding"]), fresh, window, cosine))
        return pa.Table.from_arrays([pa.array(x) for x in found], schema=schema)

    return run


def _pass_edges(keyed: DataFrame, turns: range, rows: int, window: int, cosine: float) -> DataFrame:
    """Verified edges of some passes, as a written table."""
    turn = F.posexplode(F.slice("keys", turns.start + 1, len(turns)))
    dealt = keyed.select("vec_id", "dims", "embedding", turn.alias("turn", "key"))
    order = ["dims", "turn", "key", "vec_id"]
    parts = max(1, -(-rows * len(turns) // PART_ROWS))
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "dims", "turn", "embedding")
    inner = keyed.schema["embedding"].dataType.simpleString()
    kind = pa.list_(pa.float32() if "float" in inner else pa.float64())
    ddl = f"u long, v long, part int, side int, at long, dims int, turn int, embedding {inner}"
    found = _written(dealt.mapInArrow(_scan(window, cosine, kind), ddl), "passes")
    border = found.where("side is not null").withColumn("border", F.col("part") - F.col("side"))
    across = border.groupBy("border").applyInArrow(_across(window, cosine), "u long, v long")
    return _written(found.where("side is null").select("u", "v").unionByName(across), "links")


def _count_within(cosine: float):
    """Links of every row with the other rows of its group, for a bucket of whole groups."""
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int64()), ("n_links", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("component", "ascending"), ("dims", "ascending")])
        labels = np.stack([rows.column(c).to_numpy() for c in ("component", "dims")], 1)
        counts = np.zeros(len(labels), np.int64)
        cuts = np.flatnonzero((labels[1:] != labels[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(labels)], strict=True):
            unit = _matrix(rows.column("embedding").slice(a, b - a))
            counts[a:b] = (unit @ unit.T >= cosine).sum(1) - 1
        return pa.Table.from_arrays([rows["vec_id"], rows["component"], pa.array(counts)], schema=schema)

    return run


def _place(angle: float):
    """Angles to the pivots of the group, and the nearest pivot if it is within half the linking angle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots = _rows(batch.column("pivots").flatten())
            ends = batch.column("pivots").offsets.to_numpy()
            ends = ends - ends[0]
            balls, angles = [], []
            for i, row in enumerate(_rows(batch.column("embedding"))):
                both = _unit(np.array([row, *pivots[ends[i] : ends[i + 1]]], np.float64))
                away = np.arccos(np.clip(both[1:] @ both[0], -1, 1))
                at = int(away.argmin())
                balls.append(at if away[at] <= angle / 2 - SLACK else -1)
                angles.append(away)
            keep = [batch.column(n) for n in ("vec_id", "component", "dims", "embedding")]
            out = [*keep, pa.array(balls, pa.int32()), pa.array(angles, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, ["vec_id", "component", "dims", "embedding", "ball", "angles"])

    return run


def _count_between(cosine: float):
    """Rows of one block that link with those of another, by row; a row does not link with itself."""
    schema = pa.schema([("row", pa.int64()), ("found", pa.int64())])

    def run(asks: pa.Table, others: pa.Table) -> pa.Table:
        rows, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        if asks.num_rows and others.num_rows:
            rows = asks["row"].to_numpy()
            near = _matrix(asks["embedding"]) @ _matrix(others["embedding"]).T >= cosine
            counts = near.sum(1) - np.isin(rows, others["row"].to_numpy())
        return pa.Table.from_arrays([pa.array(rows), pa.array(counts, pa.int64())], schema=schema)

    return run


def _count_in_large(rows: DataFrame, cosine: float) -> DataFrame:
    """(vec_id, component, n_links) for groups of any size.

    Rows within half the linking angle of a pivot form a ball: they link with
    each other for certain. A ball that lies wholly inside or outside the
    linking angle of a row is counted or left out as a whole. Only what is
    undecided, and rows in no ball, are compared, block against block.
    """
    angle, group = math.acos(cosine), ["component", "dims"]
    first = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("vec_id"), "vec_id"))
    pivots = rows.withColumn("rn", first).where(F.col("rn") <= PIVOTS).groupBy(*group).agg(F.collect_list("embedding").alias("pivots"))
    inner = rows.schema["embedding"].dataType.simpleString()
    ddl = f"vec_id long, component long, dims int, embedding {inner}, ball int, angles array<double>"
    placed = rows.join(pivots, group).select("vec_id", *group, "embedding", "pivots").mapInArrow(_place(angle), ddl)
    path = scratch_path(rows.sparkSession, "placed")
    placed.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    placed, others = (rows.sparkSession.read.parquet(path) for _ in range(2))

    radius = F.max(F.get("angles", F.col("ball"))).alias("radius")
    balls = placed.groupBy(*group, "ball").agg(F.count("*").alias("n"), radius)
    of_group = balls.groupBy(*group).agg(F.collect_list(F.struct("ball", "n", "radius")).alias("balls"))

    def away(b: Column) -> Column:
        return F.get("angles", b["ball"])

    inside = F.filter("balls", lambda b: (b["ball"] >= 0) & (away(b) + b["radius"] <= angle - SLACK))
    inside = F.aggregate(inside, F.lit(0).cast("long"), lambda total, b: total + b["n"])
    open_ = F.filter("balls", lambda b: (b["ball"] < 0) | ((away(b) + b["radius"] > angle - SLACK) & (away(b) - b["radius"] <= angle + SLACK)))
    own = (F.col("ball") >= 0).cast("long")
    judged = placed.join(of_group, group).select("row", "vec_id", *group, "embedding", (inside - own).alias("sure"), F.explode_outer(open_).alias("open"))
    asks = judged.where("open is not null").select("row", *group, "embedding", F.col("open.ball").alias("ball"), F.col("open.n").alias("n"))
    key = [*group, "ball"]
    n_asks = asks.groupBy(*key).agg(F.count("*").alias("n_asks"))
    blocks = [F.ceil(F.col(n) / SMALL).cast("int").alias(f"{n}_blocks") for n in ("n", "n_asks")]
    asked = balls.join(n_asks, key).select(*key, *blocks)

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("row"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = asks.drop("n").join(asked, key).select("row", *key, "embedding", block("n_asks_blocks").alias("mine"), every("n_blocks").alias("theirs"))
    right = others.join(asked, key).select("row", *key, "embedding", every("n_asks_blocks").alias("mine"), block("n_blocks").alias("theirs"))
    meet = [*key, "mine", "theirs"]
    found = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(_count_between(cosine), "row long, found long")
    found = found.groupBy("row").agg(F.sum("found").alias("found"))
    sure = judged.select("row", "vec_id", "component", "sure").distinct()
    return sure.join(found, "row", "left").select("vec_id", "component", (F.col("sure") + F.coalesce("found", F.lit(0))).alias("n_links"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> DataFrame:
    """Near copies of every vector: vec_id, n_links, component_id, kept; one row per row of the table.

    ``n_links`` counts the other vectors of the row's group with at least this
    cosine, ``component_id`` is the smallest vec_id that links reach, and the
    row that has it is ``kept``. Groups are those that the passes find: a pair
    that just reaches the cosine is missed by all of them with probability
    ``miss``, nearer ones far less often; within a group every link is counted
    whatever the windows saw. Passes grow slowly with the number of rows and
    run ``AT_ONCE`` in a job. A group that is neither tight nor small costs the
    square of its undecided rows in comparisons, in blocks, never in rows.

    Vectors that are null, zero, empty, or hold null or non-finite components
    link with nothing, nor do rows without vec_id; vectors of other lengths are
    not compared. Ties do not arise: links are symmetric. Rows that repeat a
    vec_id are vectors of their own with one component. Other columns are not
    read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    held = vectors.schema["embedding"].dataType
    kind = "array<float>" if isinstance(held, ArrayType) and isinstance(held.elementType, FloatType) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind))
    fit = F.coalesce(F.col("vec_id").isNotNull() & usable(F.col("embedding")), F.lit(False))
    good = rows.where(fit).withColumn("dims", F.size("embedding"))
    n = good.count()
    turns = passes_needed(n, cosine, window, miss)
    keyed = _written(_with_keys(good, turns), "keyed")
    jobs = [_pass_edges(keyed, range(a, min(a + AT_ONCE, turns)), n, window, cosine) for a in range(0, turns, AT_ONCE)]
    edges = jobs[0]
    for more in jobs[1:]:
        edges = edges.unionByName(more)

    found = connected_components(edges)
    roots = found.select(F.col("component").alias("node"), "component")
    loops = edges.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    nodes = found.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
    joined = keyed.drop("keys").join(nodes, F.col("vec_id") == F.col("node"), "left").drop("node")
    members = _written(joined, "members")

    grouped = members.where("component is not null")
    sizes = grouped.groupBy("component", "dims").agg(F.count("*").alias("size"))
    sized = grouped.join(sizes, ["component", "dims"])
    small, large = sized.where(F.col("size") <= SMALL), sized.where(F.col("size") > SMALL).drop("size")
    n_small = sizes.where(F.col("size") <= SMALL).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bucket = F.pmod(F.xxhash64("component"), F.lit(max(1, -(-n_small // BUCKET_ROWS)))).alias("bucket")
    dealt = small.select("vec_id", "component", "dims", "embedding", bucket)
    counted = dealt.groupBy("bucket").applyInArrow(_count_within(cosine), "vec_id long, component long, n_links long")
    if sizes.where(F.col("size") > SMALL).limit(1).count():
        counted = counted.unionByName(_count_in_large(large, cosine))
    none = F.lit(0).cast("long").alias("n_links")
    alone = members.where("component is null").select("vec_id", F.col("vec_id").alias("component"), none)
    apart = rows.where(~fit).select("vec_id", F.col("vec_id").alias("component"), none)
    whole = counted.unionByName(alone).unionByName(apart)
    kept = F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept")
    return whole.select("vec_id", "n_links", F.col("component").alias("component_id"), kept)
