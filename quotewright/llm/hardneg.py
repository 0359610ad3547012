"""Hard-negative mining over Hilbert-ordered blocks with zone maps (operator 11).

Every component x becomes floor(SCALE * x), so inner products are whole numbers
and comparisons exact. For an anchor the positives are the rows of its label with the
largest inner products; the negatives of a positive are the best rows of other
labels whose inner product lies between LEAST and MOST percent of the positive's.

The rows are put in the order of a Hilbert curve over all dimensions (those
that vary most first) and stored as Parquet blocks of BLOCK rows, one block a record, with
the least and largest value of each dimension (the zone map) and the labels in it. For
an anchor a the products with a block lie between sum(min(a_d low_d, a_d high_d))
and sum(max(a_d low_d, a_d high_d)). The anchor's own block gives a first bound on its
positives; then the blocks are read that hold its label and can reach that bound.
With the positives known, the blocks are read that can hold a product inside one of
the anchor's windows. So rows that are not read cannot belong to the result, which is exact.

Anchors travel in chunks along the curve: a chunk meets the zone maps in lanes of LANE
blocks, and the blocks that its anchors need as matrix products. Of each such pair only the
best few rows of every anchor come out; they are ranked over all blocks. A block that many
anchors need is met by many chunks, one at a time. Nothing goes to the driver but
sums of the dimensions. How many blocks the bounds leave out depends on the data: on
clusters most of them, on vectors that point everywhere alike in many dimensions none.

Rows take no part whose id, label or vector is null or whose vector holds null or
non-finite components. Rows of another dimension than the others cannot be
compared and raise an error, as do components so large that a product might not
fit a long. Equal rows (id, label, vector) count once; rows that share an id but differ
are candidates and anchors each, though none for another of that id. Vectors without components
all have product 0. Ties go to the smaller id. Extra columns are ignored. An empty
table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.scratch import written

SCALE = 256
POSITIVES = NEGATIVES = 5
#: Percent of the positive's product between which a negative's lies.
LEAST, MOST = 80, 100
BLOCK, CHUNK, LANE = 1024, 128, 256
#: Bits of each dimension along the curve.
BITS = 4

_ANCHOR_FIELDS = ["key", "vec_id", "label", "v", "windows"]
_FOUND = "key long, anchor_id long, place int, score long, vec_id long"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places along the Hilbert curve of points with whole coordinates of ``bits`` bits, as bytes that sort alike."""
    n, dimensions = cells.shape
    x = cells.astype(np.int64).T.copy()
    # Skilling (2004): undo the excess turns from the top bit down, then Gray encode.
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for d in range(dimensions):
            set_ = (x[d] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[d]) & p)
            x[0] ^= np.where(set_, p, swap)
            x[d] ^= swap
        q >>= 1
    for d in range(1, dimensions):
        x[d] ^= x[d - 1]
    turn = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0) if dimensions else 0
        q >>= 1
    x ^= turn
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]
    flat = np.concatenate(planes, axis=0).T.astype(np.uint8) if dimensions else np.zeros((n, 0), np.uint8)
    return [row.tobytes() for row in np.packbits(flat, axis=1)]


def valid_rows(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part; v holds whole numbers."""
    v = F.col("embedding").cast("array<double>")
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(finite, F.lit(False))).withColumn("v", F.transform("v", lambda x: F.floor(scale * x).cast("long")))


def _moments(batches):
    """Sums by dimension of each batch: (dimension, size of the vectors, count, sum, sum of squares, largest absolute value)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = batch.column(0)
        sizes = v.value_lengths().to_numpy()
        flat = v.flatten().to_numpy()
        for size in np.unique(sizes).tolist():
            x = flat[np.repeat(sizes == size, sizes)].reshape(int((sizes == size).sum()), size).astype(np.float64)
            out = [np.arange(max(size, 1)), np.full(max(size, 1), size), np.full(max(size, 1), len(x))]
            out += [x.sum(axis=0), (x * x).sum(axis=0), np.abs(x).max(axis=0)] if size else [np.zeros(1)] * 3
            types = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["d", "size", "n", "s", "ss", "most"])


def _dimensions(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(order of the dimensions, mean and spread of each, largest absolute value)."""
    sums = rows.select("v").mapInArrow(_moments, "d int, size int, n long, s double, ss double, most double")
    # One record a dimension.
    table = sums.groupBy("size", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.max("most").alias("most")).orderBy("size", "d").toPandas()
    if table["size"].nunique() > 1:
        raise ValueError(f"vectors of {sorted(table['size'].unique().tolist())} components cannot be compared")
    if not len(table) or not table["size"].iloc[0]:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 0.0
    mean = (table["s"] / table["n"]).to_numpy()
    spread = np.sqrt(np.maximum((table["ss"] / table["n"]).to_numpy() - mean**2, 0))
    most = float(table["most"].max())
    if most * most * len(mean) >= 2.0**62:
        raise ValueError("components are too large for whole-number products")
    return np.argsort(-spread, kind="stable"), mean, spread, most


def _matrix(v, dimensions: int) -> np.ndarray:
    return v.flatten().to_numpy().reshape(-1, dimensions) if dimensions else np.zeros((len(v), 0), np.int64)


def _lists(values: np.ndarray, offsets) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), pa.array(values))


def _vectors(v: np.ndarray) -> pa.ListArray:
    return _lists(v.ravel(), np.arange(len(v) + 1) * v.shape[1])


def _blocked(dimensions: int, number: type):
    """Consecutive rows of a partition as blocks with zone maps; equal rows, which are neighbours, once."""

    def run(batches):
        task, made, last = TaskContext.get().partitionId(), 0, None
        held: list[tuple] = []

        def block():
            ids, labels, asked = (np.array(c, np.int64) for c in list(zip(*held))[:3])
            v = np.stack([h[3] for h in held]).astype(number)
            one = [0, len(ids)]
            columns = [pa.array([(task << 32) + made]), _lists(ids, one), _lists(labels, one), _lists(asked, one), pa.array([v.tobytes()], pa.binary())]
            columns += [_vectors(v.min(axis=0)[None]), _vectors(v.max(axis=0)[None])]
            return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "labels", "asked", "v", "low", "high"])

        for batch in batches:
            ids, labels, asked = (batch.column(name).to_numpy() for name in ("vec_id", "label", "asked"))
            v = _matrix(batch.column("v"), dimensions)
            for i in range(batch.num_rows):
                row = (int(ids[i]), int(labels[i]), v[i].tobytes())
                if row == last:
                    continue
                last = row
                held.append((row[0], row[1], int(asked[i]), v[i]))
                if len(held) == BLOCK:
                    yield block()
                    held, made = [], made + 1
        if held:
            yield block()

    return run


def _scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Whole-number products; floating point where it holds them all exactly."""
    return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if exact else a @ b.T


def _bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product of each anchor with anything inside each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return _scores(up, low, exact) + _scores(down, high, exact), _scores(up, high, exact) + _scores(down, low, exact)


def _best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed of each row, ties to the smaller id."""
    if scores.shape[1] > k:
        # All that reach the k-th best score; the order by id decides among them.
        masked = np.where(allowed, scores, np.iinfo(np.int64).min)
        edge = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed = allowed & (scores >= edge[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], column[keep]


def mine(table: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the rows where ``is_anchor`` holds.

    ``is_anchor`` is an expression over vec_id and label.
    """
    rows = valid_rows(table, scale)
    order, mean, spread, most = _dimensions(rows)
    dims = len(mean)
    exact = most * most * max(dims, 1) < 2.0**52
    number, kind = (np.int32, "int") if most < 2.0**31 else (np.int64, "long")

    def keyed(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            # Cells of the range in which most values lie; others fall into the outer ones.
            unit = (v[:, order] - mean[order]) / np.where(spread[order] > 0, 4 * spread[order], 1.0) + 0.5
            cells = np.clip(np.floor(unit * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, BITS), pa.binary())], names=[*batch.schema.names, "curve"])

    marked = rows.withColumn("asked", F.coalesce(is_anchor, F.lit(False)).cast("long")).mapInArrow(
        keyed, "vec_id long, label long, v array<long>, asked long, curve binary"
    )
    # The id is part of the range key, so rows at one place of the curve split over tasks too.
    ordered = marked.repartitionByRange("curve", "vec_id").sortWithinPartitions("curve", "vec_id", "label", "v").drop("curve")
    blocks = written(
        ordered.mapInArrow(
            _blocked(dims, number), f"block long, ids array<long>, labels array<long>, asked array<long>, v binary, low array<{kind}>, high array<{kind}>"
        ),
        "blocks",
    )

    def block_of(batch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = batch.column("ids")[i].values.to_numpy()
        v = np.frombuffer(batch.column("v")[i].as_buffer(), number)
        return ids, batch.column("labels")[i].values.to_numpy(), v.reshape(len(ids), dims)

    def seeded(batches):
        """Anchors in the order of the curve, CHUNK at a time.

        Each has as its bound the product of the last of its positives in its own block, if all are there.
        """
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def chunk():
            keys, ids, labels, bounds = (np.array(c, np.int64) for c in list(zip(*held))[:4])
            anchors = pa.StructArray.from_arrays(
                [pa.array(keys), pa.array(ids), pa.array(labels), _vectors(np.stack([h[4] for h in held])), _vectors(bounds[:, None])], names=_ANCHOR_FIELDS
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made]), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), anchors)], names=["chunk", "anchors"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                own = np.flatnonzero(batch.column("asked")[i].values.to_numpy())
                if not len(own):
                    continue
                ids, labels, v = block_of(batch, i)
                scores = _scores(v[own], v, exact)
                row, column = _best(scores, ids, (labels[own][:, None] == labels) & (ids[own][:, None] != ids), positives)
                bound = np.full(len(own), np.iinfo(np.int64).max)
                np.minimum.at(bound, row, scores[row, column])
                bound[np.bincount(row, minlength=len(own)) < positives] = np.iinfo(np.int64).min
                block = batch.column("block")[i].as_py()
                for r, at in enumerate(own.tolist()):
                    held.append((block * BLOCK + at, int(ids[at]), int(labels[at]), int(bound[r]), v[at]))
                    if len(held) == CHUNK:
                        yield chunk()
                        held, made = [], made + 1
        if held:
            yield chunk()

    anchor = f"struct<key:long,vec_id:long,label:long,v:array<{kind}>,windows:array<long>>"
    chunks = written(blocks.mapInArrow(seeded, f"chunk long, anchors array<{anchor}>"), "anchors")
    lanes = max(1, -(-blocks.count() // LANE))
    zones = F.struct("block", F.array_distinct("labels").alias("labels"), "low", "high")
    zone_lanes = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(lanes)).alias("lane")).agg(F.collect_list(zones).alias("zones"))

    def parts(flat):
        windows = flat.field("windows")
        each = windows.value_lengths().to_numpy()
        owner = np.repeat(np.arange(len(each)), each)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
        return (*(flat.field(name).to_numpy() for name in _ANCHOR_FIELDS[:3]), _matrix(flat.field("v"), dims), owner, nth, windows.flatten().to_numpy())

    def needed(same: bool):
        """The blocks of a lane with the anchors of a chunk that must read them."""

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    flat, zone = batch.column("anchors")[i].values, batch.column("zones")[i].values
                    _, _, labels, v, owner, _, bound = parts(flat)
                    least, largest = _bounds(v, _matrix(zone.field("low"), dims), _matrix(zone.field("high"), dims), exact)
                    sizes = zone.field("labels").value_lengths().to_numpy()
                    has = np.zeros(least.shape, bool)
                    row, at = np.nonzero(labels[:, None] == zone.field("labels").flatten().to_numpy())
                    has[row, np.repeat(np.arange(len(sizes)), sizes)[at]] = True
                    if same:
                        read = has & (largest >= bound[:, None])
                    else:
                        inside = (100 * largest[owner] >= LEAST * bound[:, None]) & (100 * least[owner] <= MOST * bound[:, None])
                        read = np.zeros(least.shape, bool)
                        np.logical_or.at(read, owner, inside)
                        # A block with the anchor's label alone holds no negatives.
                        read &= ~has | (sizes > 1)
                    block, asking = np.nonzero(read.T)
                    chosen, counts = np.unique(block, return_counts=True)
                    if len(chosen):
                        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), flat.take(pa.array(asking)))
                        yield pa.RecordBatch.from_arrays([pa.array(zone.field("block").to_numpy()[chosen]), lists], names=["block", "anchors"])

        return run

    def read(same: bool):
        """The best rows of a block for each of the anchors."""

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, labels, v = block_of(batch, i)
                    keys, own, own_labels, own_v, owner, nth, bound = parts(batch.column("anchors")[i].values)
                    scores = _scores(own_v, v, exact)
                    alike, other = own_labels[:, None] == labels, own[:, None] != ids
                    if same:
                        row, column = _best(scores, ids, alike & other, positives)
                        place = np.zeros(len(row), np.int64)
                        asking = row
                    else:
                        wide = scores[owner]
                        inside = (~alike & other)[owner] & (100 * wide >= LEAST * bound[:, None]) & (100 * wide <= MOST * bound[:, None])
                        row, column = _best(wide, ids, inside, negatives)
                        place, asking = nth[row], owner[row]
                    columns = [pa.array(keys[asking]), pa.array(own[asking]), pa.array(place, pa.int32()), pa.array(scores[asking, column]), pa.array(ids[column])]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor_id", "place", "score", "vec_id"])

        return run

    def searched(asking: DataFrame, same: bool, k: int) -> DataFrame:
        dealt = asking.select("anchors", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"))
        wanted = dealt.join(zone_lanes, "lane").select("anchors", "zones").mapInArrow(needed(same), f"block long, anchors array<{anchor}>")
        met = wanted.join(blocks.select("block", "ids", "labels", "v"), "block")
        best = met.select("ids", "labels", "v", "anchors").mapInArrow(read(same), _FOUND)
        # The trim to k rows a window is done in each task before the exchange.
        rank = F.row_number().over(Window.partitionBy("key", "place").orderBy(F.desc("score"), "vec_id"))
        return best.withColumn("rank", rank).filter(F.col("rank") <= k)

    found = written(searched(chunks, True, positives), "positives")
    listed = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("positives"))
    windows = listed.select("key", F.col("positives.score").alias("windows"))
    asked = chunks.select("chunk", F.inline("anchors")).drop("windows").join(windows, "key").groupBy("chunk").agg(
        F.collect_list(F.struct(*_ANCHOR_FIELDS)).alias("anchors")
    )
    rest = searched(asked, False, negatives).select("key", (F.col("place") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    chosen = found.select("key", "anchor_id", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(rest, ["key", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The registered query: every hundredth id an anchor, labels moved on where the id is divisible by 7.
ORACLE_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.label = a.label AS alike, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM pairs WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY q.score DESC, q.vec_id) AS rank,
    q.vec_id AS negative_id, p.positive_score, q.score AS negative_score
FROM positives p JOIN pairs q ON q.anchor_id = p.anchor_id AND NOT q.alike
    AND 80 * p.positive_score <= 100 * q.score AND 100 * q.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
