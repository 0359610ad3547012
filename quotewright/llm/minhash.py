"""Near-duplicate documents by SuperMinHash, banding and union-find (operator 7).

Signatures: every shingle of a document draws a random value and a place for
level 0, 1, 2, ...; the places of one shingle form a random permutation
(Fisher-Yates), and a place keeps the smallest level + value it is given. As
values of level j are at least j, a document is finished when all its places
are below j: with many shingles after two or three levels. All shingles of a
batch go through a level together.

Classes: documents with the same set of shingles are one class, known by its
size and a 128-bit sum of scrambled shingles; only the smallest ``doc_id`` of a
class is compared. Copies never become pairs.

Candidates: signatures are cut into BANDS bands of ROWS places. At similarity
0.75 a pair shares no band with a probability of 5e-6. In each bucket everyone
is compared with its leader only: the member that meets most others over all
its buckets, for the text that a group's copies were made from is nearer to
each copy than they are to one another. Members that are connected need no
more work. Where a bucket still joins unconnected members, their pairs are
compared too, unless sizes or the distances to the leader (Jaccard
distance is a metric) prove them too far apart. So no pair that shares a band
is left undecided, and a large group costs one comparison for each member.

Links are confirmed on the full sets of 64-bit shingle hashes, and ``components``
joins them.

Null and empty texts, and texts without words, have the empty set and are
linked with nothing. Rows that share a ``doc_id`` must be equal; repeated ones
give repeated results. Rows without ``doc_id`` are left out. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm import wordhash
from quotewright.llm.scratch import components, written

WIDTH = 5
ROWS, BANDS = 4, 32
PLACES = ROWS * BANDS
#: Shingles that go through the levels together, but for one document alone.
_TOGETHER = 40_000
_U = np.uint64


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    words, counts = wordhash.word_hashes(texts)
    flat, per_text = wordhash.shingles(words, counts, width)
    return [np.unique(part) for part in np.split(flat, np.cumsum(per_text)[:-1])]


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """SuperMinHash: level and value of every place, as one number each; sets must not be empty."""
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best = np.full(len(sets) * places, np.iinfo(np.uint64).max, np.uint64)
    deal = None
    for level in range(places):
        drawn = wordhash.mix(items + _U((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = level + (((drawn & _U(0xFFFFFFFF)) * _U(places - level)) >> _U(32)).astype(np.int64)
        value = (_U(level) << _U(32)) | (drawn >> _U(32))
        if deal is None:
            target = place
        else:
            target = deal[rows, place].astype(np.int64)
        np.minimum.at(best, owner * places + target, value)
        open_ = best.reshape(-1, places).max(axis=1) >= _U((level + 1) << 32)
        stay = open_[owner]
        if not stay.any():
            break
        if deal is None:
            items, owner, place = items[stay], owner[stay], place[stay]
            deal = np.tile(np.arange(places, dtype=np.uint8), (len(items), 1))
        elif stay.mean() < 0.7:
            items, owner, place, deal = items[stay], owner[stay], place[stay], deal[stay]
        rows = np.arange(len(items))
        deal[rows, place] = deal[:, level]
    return best.reshape(-1, places)


def _bands(best: np.ndarray) -> np.ndarray:
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    for row in range(ROWS):
        out = wordhash.mix(out + best[:, row::ROWS][:, :BANDS])
    return out.view(np.int64)


def _groups(sets: list[np.ndarray]):
    """Index lists of non-empty sets with about _TOGETHER shingles each."""
    group, size = [], 0
    for i, s in enumerate(sets):
        if len(s):
            if group and size + len(s) > _TOGETHER:
                yield group
                group, size = [], 0
            group.append(i)
            size += len(s)
    if group:
        yield group


def _describe(batches):
    """doc_id, n_shingles, the digest of the set (two numbers) and the bands."""
    for batch in batches:
        ids, texts = batch.column(0), wordhash.decoded(batch.column(1))
        for first, part in wordhash.chunks(texts):
            sets = _sets(part, WIDTH)
            sizes = np.array([len(s) for s in sets], np.int64)
            sums = np.array([(wordhash.mix(s).sum(), wordhash.mix(s ^ _U(0x5851F42D4C957F2D)).sum()) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            bands = np.zeros((len(sets), BANDS), np.int64)
            for group in _groups(sets):
                bands[group] = _bands(signatures([sets[i] for i in group]))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0)))).astype(np.int32)),
                pa.array(bands[sizes > 0].ravel()),
            )
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, len(part)), pa.array(sizes), pa.array(sums[:, 0]), pa.array(sums[:, 1]), lists],
                names=["doc_id", "n", "s1", "s2", "bands"],
            )


def _as_arrays(batches):
    for batch in batches:
        ids, texts = batch.column(0), wordhash.decoded(batch.column(1))
        for first, part in wordhash.chunks(texts):
            sets = _sets(part, WIDTH)
            offsets = pa.array(np.cumsum([0] + [len(s) for s in sets]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, len(part)), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))],
                names=["doc_id", "items"],
            )


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, shared, total``: sizes of intersection and union for the pairs (a, b)."""
    of = {s: sets.select(F.col("doc_id").alias(s), F.col("items").alias(f"{s}_items")) for s in "ab"}
    both = pairs.select("a", "b").join(of["a"], "a").join(of["b"], "b")
    shared = F.size(F.array_intersect("a_items", "b_items")).cast("long")
    return both.select("a", "b", shared.alias("shared"), (F.size("a_items") + F.size("b_items")).alias("sum")).select(
        "a", "b", "shared", (F.col("sum") - F.col("shared")).alias("total")
    )


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, links`` for every document.

    ``links`` counts the confirmed links that joined its class to others.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    described = written(
        texts.mapInArrow(_describe, "doc_id long, n long, s1 long, s2 long, bands array<long>"), "signatures"
    )
    classes = written(described.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = described.select("doc_id", "n", "bands").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    keys = written(reps.select("doc_id", "n", F.explode("bands").alias("key")).distinct(), "bands")
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    met = written(keys.join(shared, "key"), "shared-bands")
    central = met.groupBy("doc_id").agg(F.sum("size").alias("meets"))
    ranked = met.join(central, "doc_id").withColumn("order", F.struct(-F.col("meets"), F.col("doc_id").alias("doc_id")))
    leaders = ranked.groupBy("key").agg(F.min("order").getField("doc_id").alias("leader"))
    members = written(met.drop("size").join(leaders, "key"), "buckets")

    needed = members.select("doc_id").distinct()
    sets = written(texts.join(needed, "doc_id", "left_semi").distinct().mapInArrow(_as_arrays, "doc_id long, items array<long>"), "sets")
    first = members.filter("doc_id != leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")).distinct()
    stars = written(_compared(first, sets), "stars")
    linked = F.lit(100) * F.col("shared") >= F.lit(percent) * F.col("total")
    links = stars.filter(linked).select("a", "b")

    groups = written(components(links), "groups")
    named = members.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "doc_id", "n", "leader", F.coalesce("component", "doc_id").alias("component")
    )
    apart = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    far = stars.select(F.col("a").alias("doc_id"), F.col("b").alias("leader"), (1 - F.col("shared") / F.col("total")).alias("d"))
    still = named.join(apart, "key", "left_semi").join(far, ["doc_id", "leader"])  # a leader's own pairs are done
    still = still.join(sets, "doc_id").join(described.select("doc_id", "bands").distinct(), "doc_id")
    left, right = still.alias("x"), still.alias("y")
    slack = 1 - percent / 100 + 1e-9
    # Compared within the join, in the first bucket that a pair shares: only links become rows.
    shared_items = F.size(F.array_intersect("x.items", "y.items"))
    close = (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.doc_id") > F.col("y.doc_id")) & (F.col("x.component") != F.col("y.component"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) & (F.abs(F.col("x.d") - F.col("y.d")) <= slack)
        & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key"))
        & (100 * shared_items >= percent * (F.col("x.n") + F.col("y.n") - shared_items))
    )
    crossing = written(left.join(right, close).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct(), "crossing")
    links = links.union(crossing)
    final = components(links).withColumnRenamed("node", "rep")
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))

    of_class = described.select("doc_id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left")
    placed = of_class.join(final, "rep", "left").join(degree, "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("doc_id")).alias("kept"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )
