"""Mixing sources to target weights by pivotal dependent rounding (operator 3).

Every source gets a target number of words; each of its documents is wanted
target / size-of-source times. The whole part of that rate is taken as it is.
The fractions are rounded together: two documents meet, words of expectation
move at random from one to the other until one fraction is 0 or 1, and the
other meets the next. A move keeps the sum of words and every expectation, so
a source misses its target by less than one document, and documents of any
size keep their probability. Groups of about FAN documents are folded in
parallel, their last fractions are folded again, and so on up a tree to one
fraction for each source. The random numbers are hashes of ids and seed.

Rows with equal (doc_id, source) are one unit, whose sizes add up and which is
taken or left together. Null and empty texts have size 0 and are never taken.
A null source is a source like others, ordered last. Extra columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.scratch import written

#: Documents, or results of the level below, that are folded in one group.
FAN = 64
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(units: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, members, target``: ``share`` of all sizes dealt by repeating weights.

    No target exceeds ``most`` times its source. With sources ordered by
    most * size / weight, those that are cut off come first; the rest share
    what is left by weight. One row per source meets in one task here.
    """
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("members"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("weight", cycle[(F.row_number().over(by_name) - 1) % len(weights)]).withColumn("cap", most * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before, onward = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    tried = named.withColumn("level", level).withColumn("place", F.row_number().over(filling))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(fits, F.struct("place", "level"))).over(everything)
    filled = tried.withColumn("first", first)
    return filled.select(
        "source", "source_size", "members",
        F.when(F.col("place") >= F.col("first.place"), F.least(F.col("first.level") * F.col("weight"), F.col("cap")))
        .otherwise(F.col("cap")).alias("target"),
    )


def _chance(seed: int, *ids: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ids), 11) / F.lit(float(1 << 53))


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _meet(state: Column, other: Column, seed: int) -> Column:
    """One pairing: the settled unit joins ``done``, the other is carried on."""
    a, b = state["carry"], other
    up_a = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
    up_b = F.least((1 - b["p"]) * b["size"], a["p"] * a["size"])

    def moved(m: Column) -> Column:
        to_a = _chance(seed, a["doc_id"], b["doc_id"]) < F.coalesce(F.try_divide(m["up_b"], m["up_a"] + m["up_b"]), F.lit(0.0))
        a_p = F.when(to_a, a["p"] + m["up_a"] / a["size"]).otherwise(a["p"] - m["up_b"] / a["size"])
        b_p = F.when(to_a, b["p"] - m["up_a"] / b["size"]).otherwise(b["p"] + m["up_b"] / b["size"])
        # Which of the two the move has brought to 0 or 1, exactly:
        a_ends = F.when(to_a, m["up_a"] == (1 - a["p"]) * a["size"]).otherwise(m["up_b"] == a["p"] * a["size"])
        settled = F.when(a_ends, a.withField("p", F.when(to_a, 1.0).otherwise(0.0))).otherwise(b.withField("p", F.when(to_a, 0.0).otherwise(1.0)))
        carried = F.when(a_ends, b.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), b_p)))).otherwise(
            a.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), a_p)))
        )
        return F.struct(carried.alias("carry"), F.array_append(state["done"], settled).alias("done"))

    return _let(F.struct(up_a.alias("up_a"), up_b.alias("up_b")), moved)


def _folded(level: DataFrame, seed: int) -> DataFrame:
    """One row per (source, bucket) with ``carry`` and ``done``."""
    groups = level.groupBy("source", "bucket").agg(F.sort_array(F.collect_list("unit")).alias("units"))
    start = F.struct(F.col("units")[0].alias("carry"), F.slice("units", 1, 0).alias("done"))
    rest = F.slice("units", F.lit(2), F.size("units"))
    return groups.select("source", "bucket", F.aggregate(rest, start, lambda s, x: _meet(s, x, seed)).alias("s")).select(
        "source", "bucket", "s.*"
    )


def mix(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every (doc_id, source)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    units = written(
        docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source").agg(F.sum("size").alias("size")),
        "mix-units",
    )
    targets = source_targets(units, weights, share, most).withColumnRenamed("source", "of")
    rate = F.least(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)), F.lit(most))
    wanted = units.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.greatest(F.ceil(F.col("members") / FAN), F.lit(1)))
    )
    unit = F.struct(
        F.xxhash64(F.lit(seed + 1), "doc_id").alias("order"), "doc_id",
        F.col("size").cast("double").alias("size"), F.col("source_size"), F.col("target"),
        F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"),
    )
    rows = wanted.select("source", "bucket", unit.alias("unit"))
    open_ = (F.col("unit.size") > 0) & (F.col("unit.p") > 0)
    settled = rows.filter(~open_).select("source", F.col("unit").withField("p", F.lit(0.0)).alias("unit"))
    level = rows.filter(open_)
    left = targets.agg(F.max(F.ceil(F.col("members") / FAN))).first()[0] or 0
    while True:
        folded = written(_folded(level, seed), "mix-level")
        settled = settled.union(folded.select("source", F.explode("done").alias("unit")))
        level = folded.select("source", F.floor(F.col("bucket") / FAN).alias("bucket"), F.col("carry").alias("unit"))
        if left <= 1:
            break
        left = -(-left // FAN)
    last = F.when(_chance(seed + 2, F.col("unit.doc_id")) < F.col("unit.p"), 1.0).otherwise(0.0)
    settled = settled.union(level.select("source", F.col("unit").withField("p", last).alias("unit")))
    copies = (F.col("unit.whole") + F.col("unit.p")).cast("long")
    words = F.col("unit.size").cast("long")
    return settled.select(
        F.col("unit.doc_id").alias("doc_id"), "source", words.alias("size"), F.col("unit.source_size").alias("source_size"),
        F.col("unit.target").alias("target"), copies.alias("copies"), (copies * words).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns stay."""
    plan = mix(docs, **options).filter("copies > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_of"), F.col("copies").alias("_copies"))
    # The row travels as one value, so that its columns may have any name.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & F.col("_row.source").eqNullSafe(F.col("_of"))
    return rows.join(plan, same).select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
