"""Repeated runs of lines by a suffix array over line ids (operator 10).

A document is its sequence of line ids (64-bit hashes of its lines that hold
more than white space). Suffixes are sorted by distributed prefix doubling:
round k orders them by their first 2**k lines, from pairs of ranks of round
k - 1. Only suffixes that share those lines with another one go on, so a round
holds repeated lines alone and the last rounds only long copies. Pairs are
counted before they are ranked, so a frequent run is one row when sorted.

The suffixes of one rank in round k form an LCP interval: at least 2**k lines
in common. Its first suffix in corpus order (doc_id, then line) is the
original, the others are later copies. Runs of MIN_LINES or more that began
earlier in the corpus are deleted: the windows of all later copies, merged,
are the maximal repeated runs. The longest interval at the head of a run names
the place it was copied from. With ``long_words``, as the query and the pipeline have it, a
repeated line of so many words is a run by itself (round 0 has its copies).

Blank lines carry no id, are never deleted, and do not part a run. Null and
empty texts have no lines. A document's own repeats count like those of
others. Rows that share a doc_id are taken as one document at one place, so
neither deletes the other. Extra columns are kept by ``deduplicated`` and
ignored elsewhere. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm import wordhash
from quotewright.llm.scratch import written

#: Shortest run that is deleted; a power of two, so that a round ends there.
MIN_LINES = 2
#: Words of a line that is long enough to be deleted by itself; words are as everywhere, parted by ASCII white space.
LONG_LINE = 50


def _line_ids(batches):
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(), wordhash.decoded(batch.column(1))
        for first, part in wordhash.chunks(texts):
            hashes, solid, counts = wordhash.line_hashes(part)
            owner = np.repeat(np.arange(len(part)), counts)
            line = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
            owner, line, hashes, words = owner[solid], line[solid], hashes[solid], wordhash.line_words(part)[solid]
            begins = np.searchsorted(owner, np.arange(len(part)))
            place = np.arange(len(owner)) - begins[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[first : first + len(part)][owner]), pa.array(place), pa.array(line), pa.array(hashes.view(np.int64)), pa.array(words)],
                names=["doc_id", "place", "line", "id", "words"],
            )


def line_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, place, line, id, words`` of every line that is not blank; ``place`` counts those only."""
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_line_ids, "doc_id long, place long, line long, id long, words long")


def _ranked(groups: DataFrame) -> DataFrame:
    """Adds ``rank``: suffixes in smaller groups. A running sum in each range, plus the sums of the ranges before."""
    dealt = written(groups.repartitionByRange("r1", "r2").withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy("r1", "r2").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum("copies").alias("all")).select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    return dealt.join(totals, "part").withColumn("rank", F.col("base") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).drop("part", "base")


def suffix_rounds(lines: DataFrame) -> list[DataFrame]:
    """One table a round: ``doc_id, place, line, rank, copies, first`` of suffixes that share 2**round lines.

    ``first`` is the (doc_id, place) of the first suffix of the interval.
    """
    pairs = lines.select("doc_id", "place", "line", F.col("id").alias("r1"), F.lit(0).cast("long").alias("r2"))
    rounds = []
    while True:
        groups = pairs.groupBy("r1", "r2").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "place")).alias("first"))
        ranked = _ranked(groups.filter("copies > 1"))
        level = written(pairs.join(ranked, ["r1", "r2"]).drop("r1", "r2"), "suffixes")
        if level.isEmpty():
            return rounds
        rounds.append(level)
        ahead = 1 << (len(rounds) - 1)
        later = Window.partitionBy("doc_id").orderBy("place").rangeBetween(ahead, ahead)
        pairs = written(
            level.select("doc_id", "place", "line", F.col("rank").alias("r1"), F.max("rank").over(later).alias("r2")).filter("r2 is not null"),
            "rank-pairs",
        )


def repeated_runs(lines: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None) -> DataFrame:
    """``doc_id, start, lines, deleted, source_doc_id, source_place``: the maximal runs that began earlier.

    ``deleted`` lists the line numbers; lines, start and source_place count lines that are not blank.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    rounds = suffix_rounds(lines)
    copied = [
        level.filter(F.col("first") < F.struct("doc_id", "place")).select("doc_id", "place", F.lit(1 << k).alias("length"), "first")
        for k, level in enumerate(rounds)
    ]
    at = min_lines.bit_length() - 1
    long = lines.filter("false" if long_words is None else F.col("words") >= long_words).select("doc_id", "place").distinct()
    single = copied[0].join(long, ["doc_id", "place"], "left_semi") if copied else None
    if len(copied) <= at:
        empty = lines.filter("false").select("doc_id", "place", F.lit(1).alias("length"), F.struct("doc_id", "place").alias("first"))
        copied = [empty] * (at + 1)
    longest = copied[at]
    for level in copied[at + 1 :]:
        longest = longest.union(level)
    if single is not None:
        longest = longest.union(single)
    longest = longest.groupBy("doc_id", "place").agg(F.max(F.struct("length", "first")).alias("best"))
    covered = copied[at].select("doc_id", F.explode(F.sequence("place", F.col("place") + (min_lines - 1))).alias("place"))
    if single is not None:
        covered = covered.union(single.select("doc_id", "place"))
    covered = covered.distinct().join(lines.select("doc_id", "place", "line"), ["doc_id", "place"])
    in_order = Window.partitionBy("doc_id").orderBy("place")
    runs = (
        covered.withColumn("run", F.col("place") - F.row_number().over(in_order))
        .groupBy("doc_id", "run")
        .agg(F.min("place").alias("start"), F.count("*").alias("lines"), F.sort_array(F.collect_list("line")).alias("deleted"))
    )
    return runs.join(longest.withColumnRenamed("place", "start"), ["doc_id", "start"], "left").select(
        "doc_id", "start", "lines", "deleted",
        F.col("best.first.doc_id").alias("source_doc_id"), F.col("best.first.place").alias("source_place"),
    )


def _without(text: Column, deleted: Column) -> Column:
    """The text without the lines of these numbers: the lines between each two of them, joined.

    Numbers ascend; some may be equal or beyond the text, where rows share a doc_id.
    """

    def kept(lines: Column) -> Column:
        def between(i: Column) -> Column:
            begin = F.when(i == 0, F.lit(0)).otherwise(F.get(deleted, i - 1).cast("int") + 1)
            end = F.least(F.size(lines), F.get(deleted, i).cast("int"))  # least ignores the null after the last
            return F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(deleted)), between)), "\n")

    # As an element of an array the lines are split once, whatever the number of pieces.
    return F.get(F.transform(F.array(F.split(text, "\n", -1)), kept), F.lit(0))


def deduplicated(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, plus ``n_lines`` (not blank) and ``deleted`` (line numbers).

    Columns of ``docs`` with these two names are replaced.
    """
    lines = written(line_ids(docs), "lines")
    gone = repeated_runs(lines, min_lines, long_words).groupBy(F.col("doc_id").alias("_id")).agg(
        F.sort_array(F.flatten(F.collect_list("deleted"))).alias("deleted"), F.sum("lines").alias("n")
    )
    sizes = lines.groupBy(F.col("doc_id").alias("_of")).agg(F.countDistinct("place").alias("n_lines"))
    counts = sizes.join(gone, F.col("_of") == F.col("_id"), "left").drop("_id", "n")
    # The row travels as one value, so that its columns may have any name.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    joined = rows.join(counts, F.col("_row.doc_id") == F.col("_of"), "left").withColumn("text", F.col("_row.text"))

    cleaned = F.when(F.col("deleted").isNull(), F.col("text")).otherwise(_without(F.coalesce("text", F.lit("")), F.col("deleted")))
    return joined.select(
        *[cleaned.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c not in ("n_lines", "deleted")],
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("deleted", F.array().cast("array<long>")).alias("deleted"),
    )


def line_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_deleted, deleted, text_sha256`` of the cleaned texts."""
    done = deduplicated(docs.select("doc_id", "text"), long_words=LONG_LINE)
    return done.select(
        "doc_id", "n_lines", F.size("deleted").cast("long").alias("n_deleted"),
        F.array_join(F.col("deleted").cast("array<string>"), ",").alias("deleted"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


#: The same result in SQL: a window of two lines, or a line of LONG_LINE words, is deleted if an equal one began earlier.
ORACLE_SQL = rf"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i
  FROM documents),
solid AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY place) AS next_line FROM solid),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, place) AS copy,
    row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS line_copy FROM pairs),
marked AS (
  SELECT *, (next_line IS NOT NULL AND copy > 1) AS head,
    (line_copy > 1 AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {LONG_LINE}) AS long FROM numbered),
gone AS (
  SELECT doc_id, i, long OR head OR coalesce(lag(head) OVER (PARTITION BY doc_id ORDER BY place), false) AS gone FROM marked)
SELECT raw.doc_id, count(gone.i) AS n_lines, count(*) FILTER (WHERE gone.gone) AS n_deleted,
  coalesce(string_agg(CAST(raw.i AS VARCHAR), ',' ORDER BY raw.i) FILTER (WHERE gone.gone), '') AS deleted,
  sha256(coalesce(string_agg(raw.line, chr(10) ORDER BY raw.i) FILTER (WHERE NOT coalesce(gone.gone, false)), '')) AS text_sha256
FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.i = gone.i
GROUP BY raw.doc_id
"""
