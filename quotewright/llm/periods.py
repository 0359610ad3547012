"""Periodic runs of words (operator 13).

A run is a stretch of consecutive words with smallest period q and a length of
at least max(6, 4 q) that no neighbouring word extends keeping period q. Words
are the stretches of characters other than ASCII white space, compared exactly.

A text is exploded into overlapping tiles for each octave 2^k <= q < 2^(k+1) of
periods. Tiles of an octave are centred on boundaries 3 * 2^k words apart. The
words i with word i = word i + q form intervals, and a run's has at least 3 q of
them, so it holds a boundary c. In a tile the Z-function of the words from c on
tells how far each interval reaches to the right of c, and the Z-function of the
mirrored words before c + q how far to the left; both are cut off at the
neighbouring boundaries. So a tile holds at most eleven times 2^k words, an
octave under four times the text, and no step looks at pairs of places. Tiles in
which no shift of the octave repeats PROBE words beside the boundary cannot
hold a run and are not dealt. The others are dealt out one by one, so the tiles
of one long text go to many tasks. Each gives the intervals that are long enough
or reach a neighbouring boundary. These are exchanged by (text, period), stitched
where they touch, and measured. A stretch found under several periods has the
smallest one: by Fine and Wilf the others are its multiples.

Null texts and texts without words have no runs. Each input row counts for
itself: rows that share a doc_id, equal rows and rows without doc_id get one
output row each. Other columns than doc_id and text are ignored, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.scratch import written

MIN_WORDS, COPIES = 6, 4
#: Boundaries of an octave lie so many times its least period apart.
STRIDE = COPIES - 1
#: Words beside a boundary that must repeat for its tile to be dealt, at most.
PROBE = 16
#: Words of texts that are searched for tiles together.
BATCH_WORDS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"

_TEXTS = "row long, doc_id long, n long, plain_sha256 string, text string, tiles array<struct<octave:int,at:int,first:int,words:binary>>"
_FRAGMENTS = "row long, period int, low int, high int"


def _needed(q):
    """Places of a run of period q with word i = word i + q, at least."""
    return np.maximum(MIN_WORDS, COPIES * q) - q


def _same(x: np.ndarray, i: np.ndarray, j: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, way: int) -> np.ndarray:
    """Which pairs i, j have ``depth`` equal words from there on in direction ``way``, all of one text [low, high)."""
    left = np.arange(len(i))
    for step in range(depth):
        a, b = i[left] + way * step, j[left] + way * step
        inside = (np.minimum(a, b) >= low[left]) & (np.maximum(a, b) < high[left])
        left, a, b = left[inside], a[inside], b[inside]
        left = left[x[a] == x[b]]
        if not len(left):
            break
    found = np.zeros(len(i), bool)
    found[left] = True
    return found


def live_tiles(words: list[np.ndarray]) -> list[list[tuple[int, int, int, np.ndarray]]]:
    """For each text of word numbers the tiles (octave, boundary, first word, words) that can hold a run."""
    sizes = np.array([len(w) for w in words], np.int64)
    x, tiles = np.concatenate([*words, np.zeros(0, np.int32)]), [[] for _ in words]
    begins = np.cumsum(sizes) - sizes
    octave = 0
    while True:
        least = 1 << octave
        stride = STRIDE * least
        long_enough = np.flatnonzero(sizes >= max(MIN_WORDS, COPIES * least))
        if not len(long_enough):
            return tiles
        # A boundary every ``stride`` words, the first at word 0.
        per_text = -(-sizes[long_enough] // stride)
        text = np.repeat(long_enough, per_text)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * stride
        low, high = begins[text], begins[text] + sizes[text]
        depth = min(-(-int(_needed(least)) // 2), stride, PROBE)
        live = np.zeros(len(text), bool)
        # Shifts of the octave by boundaries, in parts that keep the arrays small.
        wide = min(least, BATCH_WORDS)
        tall = max(1, BATCH_WORDS // wide)
        for top in range(0, len(text), tall):
            i = (low + at)[top : top + tall, None]
            for q in range(least, 2 * least, wide):
                j = i + np.arange(q, min(q + wide, 2 * least))
                pair, shift = np.nonzero((x.take(j, mode="clip") == x[i]) & (j < high[top : top + tall, None]))
                pair, i_hit, j_hit = pair + top, i[pair, 0], j[pair, shift]
                hit = _same(x, i_hit, j_hit, low[pair], high[pair], depth, 1)
                rest = np.flatnonzero(~hit)
                hit[rest] = _same(x, i_hit[rest] - 1, j_hit[rest] - 1, low[pair[rest]], high[pair[rest]], depth, -1)
                live[pair[hit]] = True
        for t in np.flatnonzero(live).tolist():
            c, n = int(at[t]), int(sizes[text[t]])
            first, last = max(0, c - stride), min(n, c + stride + 2 * least)
            tiles[text[t]].append((octave, c, first, words[text[t]][first:last]))
        octave += 1


def z_function(x: list) -> list[int]:
    """Length of the longest common prefix of x and each of its suffixes."""
    n = len(x)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def tile_fragments(octave: int, at: int, first: int, words: list) -> list[tuple[int, int, int]]:
    """(period, low, high): intervals of places i around the boundary with word i = word i + period."""
    least = 1 << octave
    stride, c = STRIDE * least, at - first
    ahead = z_function(words[c:])
    # Mirrored: what comes before c + q, for the largest q first, compared with what comes before c.
    top = min(2 * least - 1, len(words) - c - 1)
    before = words[:c][::-1]
    mirrored = z_function([*before, -1, *words[: c + top][::-1]]) if before else []
    out = []
    for q in range(least, top + 1):
        f = min(ahead[q], stride)
        b = min(mirrored[len(before) + 1 + top - q], stride) if before else 0
        if b + f >= max(MIN_WORDS, COPIES * q) - q or b == stride or f == stride:
            out.append((q, at - b, at + f))
    return out


def _numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal ones alike."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def _tiled(batches):
    """Word count, digest of the words and live tiles of every text; texts without tiles travel no further."""
    for batch in batches:
        rows, ids, texts = (batch.column(i) for i in range(3))
        at = 0
        while at < batch.num_rows:
            part, size = [], 0
            while at + len(part) < batch.num_rows and (not part or size < BATCH_WORDS):
                part.append((texts[at + len(part)].as_py() or "").encode().split())
                size += len(part[-1])
            tiles = live_tiles([_numbered(words) for words in part])
            joined = [b" ".join(words) for words in part]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.slice(at, len(part)), ids.slice(at, len(part)), pa.array([len(words) for words in part], pa.int64()),
                    pa.array([hashlib.sha256(text).hexdigest() for text in joined]),
                    pa.array([text if found else None for text, found in zip(joined, tiles)], pa.binary()).cast(pa.string()),
                    pa.array(
                        [[{"octave": k, "at": c, "first": f, "words": w.tobytes()} for k, c, f, w in found] for found in tiles],
                        pa.list_(pa.struct([("octave", pa.int32()), ("at", pa.int32()), ("first", pa.int32()), ("words", pa.binary())])),
                    ),
                ],
                names=["row", "doc_id", "n", "plain_sha256", "text", "tiles"],
            )
            at += len(part)


def _solved(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], np.int32).tolist()
            out.extend((row["row"], *found) for found in tile_fragments(row["octave"], row["at"], row["first"], words))
        if out:
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["row", "period", "low", "high"])


def stitched(fragments: DataFrame) -> DataFrame:
    """``row, start, length, period`` of every run, from the intervals of all tiles."""
    before = F.max("high").over(Window.partitionBy("row", "period").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum("opens").over(Window.partitionBy("row", "period").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0))
    whole = (
        fragments.withColumn("opens", F.coalesce(F.col("low") > before, F.lit(True)).cast("int"))
        .withColumn("island", island)
        .groupBy("row", "period", "island")
        .agg(F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length"))
    )
    long_enough = whole.filter(F.col("length") >= F.greatest(F.lit(MIN_WORDS), COPIES * F.col("period")))
    # One stretch under several periods: the smallest is its period.
    return long_enough.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words that are not in a run (start, length, period) after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]


def _collapsed(batches):
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            out.append(" ".join(kept_words(text.split(" "), [(r["start"], r["length"], r["period"]) for r in runs])) if runs else text)
        place = batch.schema.get_field_index("text")
        yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(out, pa.string()), *batch.columns[place + 1 :]], names=batch.schema.names)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row a document: ``row, doc_id, n, plain_sha256, text, runs``.

    ``row`` numbers the input rows, ``n`` counts the words and ``plain_sha256`` is the digest
    of all words parted by one space. ``runs`` holds (start, period, length) in that order;
    it is null where there is none. ``text`` is what remains without the repeats of the
    runs, parted by one space; where no tile was live, so that all words remain, it is null.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    texts = written(rows.mapInArrow(_tiled, _TEXTS), "tiles")
    # Dealt one by one: neither a long text nor a partition full of periodic ones stays with one task.
    tiles = texts.filter(F.size("tiles") > 0).select("row", F.inline("tiles")).repartition("row", "octave", "at")
    runs = stitched(tiles.mapInArrow(_solved, _FRAGMENTS))
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    searched = texts.filter(F.size("tiles") > 0).drop("tiles").join(listed, "row", "left")
    collapsed = searched.mapInArrow(_collapsed, searched.schema)
    return collapsed.unionByName(texts.filter(F.size("tiles") == 0).drop("tiles"), allowMissingColumns=True)


def run_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the longest run (ties: smallest start, then period) and digests of all runs and of what remains."""
    found = periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.coalesce(F.array_size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        (-F.col("best.start")).cast("long").alias("start"),
        F.col("best.length").cast("long").alias("length"),
        (-F.col("best.period")).cast("long").alias("period"),
        F.floor(F.col("best.length").cast("long") * 1000 / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.coalesce(F.array_join(line, ""), F.lit("")), 256).alias("runs_sha256"),
        F.coalesce(F.sha2("text", 256), "plain_sha256").alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: about a tenth of the documents repeats a stretch of its words to its end.

    With h the CRC-32 of the decimal doc_id and g = h div 10, documents with h mod 10 = 0 have each
    word i >= a replaced by word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    Rows without doc_id stay as they are.
    """
    text = F.col("text").cast("string")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(F.pmod(h, F.lit(10)) == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    rows = docs.select("doc_id", text.alias("text"), F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words").cast("long")
    a = F.pmod(F.col("g"), n)
    rows = rows.withColumn("a", F.when(n > 0, a))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.pmod(F.col("g"), F.lit(8)))))
    # Plain arrays of one text: the words before a, and from there on the first p of them again and again.
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
