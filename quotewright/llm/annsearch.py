"""Approximate nearest neighbours by cross-polytope hashing (operator 2).

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform)
turns a unit vector; its hash is the signed axis it points at most. A cell joins
several such hashes, the last one over fewer axes, so that a table of N vectors has
about N / LOAD cells, whatever N is. There are TABLES tables with rotations of their own.

A query probes the cells nearest to it over all tables: the cost of a cell is the sum,
over its hashes, of the squared margin between the query's largest coordinate and
that of the cell's axis. The number of probes grows with N ** 0.6, so that the share
of the vectors that a query meets falls as the table grows, while the recall stays.

A part is a range of cells of one table with about as many vectors as fit a task. A query goes
once to each part that holds cells it probes, with the list of these. Cells are answered
as blocks by matrix products, of which each query's best are kept and measured again in a fixed
order of summation; so candidates never become rows of pairs. The best of all parts are ranked.

Equal vectors are one candidate, known with its k + 1 smallest ids, and one question: in the order
of the result no more can be among the k nearest of any query. Parts that still hold more
vectors or queries than a task should are cut by a hash on both sides. The inner product is the measure; vectors of other
lengths than one are hashed by direction, with one more coordinate that makes
all lengths equal (the usual reduction of inner product to angle).

Vectors that are null, zero or hold null or non-finite components, and rows
without an id, take no part. Rows of another dimension than the most common
one cannot be compared and raise an error. Rows with equal (vec_id, embedding)
count once; rows that share an id but differ are candidates each, and the id's nearest
are ranked together. Extra columns are ignored. With no valid rows there is no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quotewright.llm.scratch import written

TABLES = 8
#: Vectors a cell on average.
LOAD = 16
#: Probes over all tables: PROBES * N ** GROWTH.
PROBES, GROWTH = 1.75, 0.6
#: Bytes of the vectors of a part; and scores that are computed together.
PART_BYTES, TOGETHER = 1 << 25, 1 << 20
#: Axes of one hash that a query's cells are made of, at least.
_AXES = 32
_SEED = 20240229


def axes_of(vectors: int, size: int) -> list[int]:
    """Number of axes of each hash of a cell, so that there are about ``vectors / LOAD`` cells."""
    bits = max(0, round(np.log2(max(1, vectors) / LOAD)))
    out = []
    while bits:
        out.append(1 << (min(bits, size.bit_length()) - 1))
        bits -= out[-1].bit_length()
    return out


def _size(dimension: int) -> int:
    return 1 << (dimension - 1).bit_length()


def _rotations(dimension: int, tables: int, hashes: int) -> np.ndarray:
    """tables x hashes x 3 x size random signs; size is the next power of two."""
    return np.random.default_rng(_SEED).choice([-1.0, 1.0], (tables, hashes, 3, _size(dimension)))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def _turned(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), signs.shape[1]))
    out[:, : x.shape[1]] = x
    for round_ in signs:
        out = _hadamard(out * round_)
    return out


def _signed(x: np.ndarray, signs: np.ndarray, axes: int) -> np.ndarray:
    """Coordinates along the first axes of a rotation and against them."""
    y = _turned(x, signs)[:, :axes]
    return np.concatenate((y, -y), axis=1)


def cells(x: np.ndarray, axes: list[int], tables: int) -> np.ndarray:
    """rows x tables: the cell of each vector."""
    out = np.zeros((len(x), tables), np.int64)
    for t, hashes in enumerate(_rotations(x.shape[1], tables, len(axes))):
        for signs, n in zip(hashes, axes):
            out[:, t] = out[:, t] * (2 * n) + _signed(x, signs, n).argmax(axis=1)
    return out


def probed(x: np.ndarray, axes: list[int], tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """rows x probes: table and cell of the cells nearest to each query, over all tables."""
    most = -(-2 * probes // tables)
    width = max(_AXES, int(np.ceil(most ** (1 / max(1, len(axes))))))
    costs, found = [], []
    for hashes in _rotations(x.shape[1], tables, len(axes)):
        cost, cell = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for signs, n in zip(hashes, axes):
            y = _signed(x, signs, n)
            near = np.argsort(-y, axis=1, kind="stable")[:, :width]
            y = np.take_along_axis(y, near, 1)
            cost = (cost[:, :, None] + ((y[:, :1] - y) ** 2)[:, None, :]).reshape(len(x), -1)
            cell = (cell[:, :, None] * (2 * n) + near[:, None, :]).reshape(len(x), -1)
            if cost.shape[1] > most:
                least = np.argpartition(cost, most - 1, axis=1)[:, :most]
                cost, cell = np.take_along_axis(cost, least, 1), np.take_along_axis(cell, least, 1)
        costs.append(cost)
        found.append(cell)
    table = np.repeat(np.arange(tables), [c.shape[1] for c in costs])
    cost, cell = np.concatenate(costs, axis=1), np.concatenate(found, axis=1)
    if cost.shape[1] > probes:
        least = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
        return table[least], np.take_along_axis(cell, least, 1)
    return np.broadcast_to(table, cell.shape), cell


class _Best:
    """The best vectors of each query so far, by score and smallest id."""

    def __init__(self, queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
        self.queries, self.vectors, self.ids, self.k = queries, vectors, ids, k
        self.least = np.full(len(queries), -np.inf)
        self.slack = 1e-9 * (1 + np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1])
        self.rows, self.columns, self.scores = (np.empty(0, t) for t in (np.int64, np.int64, float))

    def add(self, rows: np.ndarray, columns: np.ndarray, rough: np.ndarray) -> None:
        near = rough >= self.least[rows] - self.slack
        rows, columns = rows[near], columns[near]
        exact = np.concatenate(
            [(self.queries[rows[i : i + 65536]] * self.vectors[columns[i : i + 65536]]).sum(axis=1) for i in range(0, len(rows), 65536)] or [np.empty(0)]
        )
        rows, columns, exact = np.append(self.rows, rows), np.append(self.columns, columns), np.append(self.scores, exact)
        order = np.lexsort((self.ids[columns], -exact, rows))
        rows, columns, exact = rows[order], columns[order], exact[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = nth < self.k
        self.rows, self.columns, self.scores = rows[keep], columns[keep], exact[keep]
        last = nth[keep] == self.k - 1
        self.least[self.rows[last]] = self.scores[last]


def _met(asked: np.ndarray, owner: np.ndarray, held: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """For each cell that is held and asked for: its queries and its range of vectors (``held`` is sorted)."""
    order = np.argsort(asked, kind="stable")
    asked, owner = asked[order], owner[order]
    names, begins = np.unique(held, return_index=True)
    ends = np.append(begins[1:], len(held))
    left, right = np.searchsorted(asked, names), np.searchsorted(asked, names, side="right")
    for i in np.flatnonzero(left < right):
        lo, hi = int(begins[i]), int(ends[i])
        step = max(1, TOGETHER // (hi - lo))
        for at in range(left[i], right[i], step):
            yield owner[at : min(at + step, right[i])], lo, hi


def answered(queries: np.ndarray, asked: np.ndarray, owner: np.ndarray, vectors: np.ndarray, held: np.ndarray, ids: np.ndarray, k: int) -> _Best:
    """The k best vectors of each query among those of the cells that it asks for."""
    best, wait, size = _Best(queries, vectors, ids, k), [], 0

    def settle():
        best.add(*(np.concatenate(part) for part in zip(*wait)))
        wait.clear()

    for rows, lo, hi in _met(asked, owner, held):
        rough = queries[rows] @ vectors[lo:hi].T
        at, column = np.nonzero(rough >= (best.least[rows] - best.slack)[:, None])
        wait.append((rows[at], lo + column, rough[at, column]))
        size += len(at)
        if size >= TOGETHER:
            settle()
            size = 0
    if wait:
        settle()
    return best


def _lifted(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """One more coordinate: vectors get equal lengths, queries a zero."""
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))
    return np.column_stack((x, rest)) if longest else x


def valid_vectors(table: DataFrame) -> DataFrame:
    """Distinct ``vec_id, v`` whose components are all finite numbers and not all zero."""
    v = F.col("embedding").cast("array<double>")
    rows = table.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return rows.filter(finite & F.exists("v", lambda x: x != 0)).distinct()


def _classes(vectors: DataFrame, k: int) -> DataFrame:
    """``class, v, ids``: the distinct vectors, each with its k smallest ids."""
    first = Window.partitionBy("v").orderBy("vec_id")
    least = vectors.select("v", "vec_id").withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k)
    grouped = least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return written(grouped.select(F.monotonically_increasing_id().alias("class"), "v", "ids"), "classes")


def search(table: DataFrame, is_query, k: int = 20, tables: int = TABLES, probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found for rows where ``is_query`` holds.

    ``probes`` counts the cells over all tables; without it the number follows the size of the table.
    """
    kind = table.schema["embedding"].dataType
    dtype = np.float32 if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else np.float64
    vectors = written(valid_vectors(table), "vectors")
    classes = _classes(vectors, k + 1)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = classes.agg(F.min(F.size("v")), F.max(F.size("v")), F.max(length), F.min(length), F.count("*")).first()
    if facts[0] != facts[1]:
        raise ValueError(f"vectors of {facts[0]} and {facts[1]} components cannot be compared")
    dimension, count = facts[0] or 1, facts[4]
    longest = 0.0 if facts[2] is None or facts[2] - facts[3] <= 1e-5 * facts[2] else facts[2]
    axes = axes_of(count, _size(dimension + bool(longest)))
    n_cells = int(np.prod([2 * n for n in axes], dtype=np.int64))
    most = max(tables, int(np.ceil(PROBES * count**GROWTH))) if probes is None else probes
    span = max(1024, PART_BYTES // (8 * dimension))
    ranges = max(1, min(n_cells, -(-count // span)))

    def part_of(table_of, cell):
        return table_of * ranges + cell * ranges // n_cells

    def stored(frames):
        for frame in frames:
            for at in range(0, len(frame), 4096):
                part = frame.iloc[at : at + 4096]
                x = np.stack(part["v"])
                cell = cells(_lifted(x, longest, False), axes, tables)
                for t in range(tables):
                    yield pd.DataFrame({
                        "part": part_of(t, cell[:, t]), "class": part["class"], "cell": cell[:, t], "id": [i[0] for i in part["ids"]],
                        "v": [r.tobytes() for r in x.astype(dtype)],
                    })

    def asking(frames):
        step = max(1, TOGETHER // max(_AXES * _AXES, most * _AXES // tables))
        for frame in frames:
            for at in range(0, len(frame), step):
                part = frame.iloc[at : at + step]
                x = np.stack(part["v"])
                table_of, cell = probed(_lifted(x, longest, True), axes, tables, most)
                to = part_of(table_of, cell)
                order = np.argsort(to, axis=1, kind="stable")
                to, cell = np.take_along_axis(to, order, 1), np.take_along_axis(cell, order, 1)
                rows, begins, lists = [], [], []
                for i in range(len(x)):
                    cut = np.flatnonzero(np.diff(to[i], prepend=-1))
                    rows += [i] * len(cut)
                    begins += to[i, cut].tolist()
                    lists += np.split(cell[i], cut[1:])
                sent = [r.tobytes() for r in x.astype(dtype)]
                yield pd.DataFrame({"part": begins, "class": part["class"].to_numpy()[rows], "v": [sent[i] for i in rows], "cells": lists})

    def counted(run, name: str):
        """Rows that go to each part, without the vectors."""

        def only(frames):
            for frame in run(frames):
                part, n = np.unique(frame["part"].to_numpy(np.int64), return_counts=True)
                yield pd.DataFrame({"part": part, name: n})

        return only

    asked = vectors.filter(is_query).join(classes.select("v", "class"), "v").select(F.col("vec_id").alias("query_id"), "class")
    asked = written(asked, "asked")
    questions = classes.join(asked.select("class").distinct(), "class", "left_semi").select("class", "v")
    questions = written(questions, "questions")
    held = classes.mapInPandas(counted(stored, "held"), "part long, held long").groupBy("part").agg(F.sum("held").alias("held"))
    meeting = questions.mapInPandas(counted(asking, "asked"), "part long, asked long").groupBy("part").agg(F.sum("asked").alias("asked"))
    blocks = held.join(meeting, "part").select(
        "part", F.ceil(F.col("held") / (2 * span)).cast("long").alias("of_v"), F.ceil(F.col("asked") * 2 / span).cast("long").alias("of_q")
    )
    blocks = written(blocks, "blocks")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in the block that its class falls into, for all blocks of the other side."""
        placed = rows.join(blocks, "part").withColumn(own, F.pmod(F.xxhash64("class"), own))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))

    left = dealt(questions.mapInPandas(asking, "part long, class long, v binary, cells array<long>"), "of_q", "of_v")
    right = dealt(classes.mapInPandas(stored, "part long, class long, cell long, id long, v binary"), "of_v", "of_q")

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "near": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        right = right.sort_values("cell", kind="stable")
        x, v = (np.frombuffer(b"".join(side["v"]), dtype).reshape(len(side), -1).astype(float) for side in (left, right))
        ids, owner = right["id"].to_numpy(), np.repeat(np.arange(len(left)), left["cells"].str.len())
        best = answered(x, np.concatenate(left["cells"].to_numpy()), owner, v, right["cell"].to_numpy(), ids, k + 1)
        return pd.DataFrame({
            "query": left["class"].to_numpy()[best.rows], "near": right["class"].to_numpy()[best.columns], "id": ids[best.columns], "score": best.scores,
        })

    keys = ("part", "of_v", "of_q")
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(answer, "query long, near long, id long, score double").distinct()
    by_class = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = best.withColumn("nth", F.row_number().over(by_class)).filter(F.col("nth") <= k + 1)
    members = best.join(classes.select(F.col("class").alias("near"), "ids"), "near").select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    members = members.withColumn("nth", F.row_number().over(by_id)).filter(F.col("nth") <= k + 1).drop("nth")
    found = asked.join(members, F.col("class") == F.col("query")).filter("query_id != vec_id").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
