"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius (operator 4).

The terms of a text are its pairs of neighbouring words (parted by ASCII white
space; a text of one word has that word as its term). Each occurrence votes
with the term's weight on every bit of the term's hash: +weight for a set bit,
-weight for a clear one. A bit of the fingerprint is set if its vote is
positive. A term weighs 1 to 3 by its length, for short ones are the common ones.

Votes are counted four bits to a 64-bit sum, 16 binary places each, over
stretches of STRETCH terms whose counts cannot overflow a place.

``near_members`` keeps one table for each of a number of blocks that fingerprints are cut into, keyed by that block. Of
``radius`` differing bits at most, some block has no more than ``radius // blocks``, so the queries probe each
block as it is and with up to that many of its bits turned, and no pair is missed. Few wide blocks take
more probes, many narrow ones meet more fingerprints a probe: ``blocks_for`` weighs both, so that with more
fingerprints the keys grow from 16 to 32 bits. Texts with cosine
0.97 differ in 10 of 128 bits on average, with 0.95 in 13.

Null and empty texts (and those of white space alone) have no votes and the
all-zero fingerprint. Texts are taken whole. Repeated rows get equal results, one each;
of rows that share a ``doc_id`` but differ the greatest text counts. Rows without ``doc_id`` have
no place in the order of the documents and are left out. Extra columns are ignored. An empty table
gives an empty result, a single document is followed by itself.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.scratch import written

BITS = 128
#: Terms counted before the places are unpacked; times the largest weight, 3, it stays under 2**15, for the sum's sign is the
#: highest bit of its top place, and sums that leave the signed range are an error.
STRETCH = 10_000
#: Differing bits up to which texts count as near.
NEAR = 15
#: Numbers of blocks to choose from; half of them in each half of the fingerprint.
CUTS = (16, 8, 6, 4)
_PLACES = 0x0001000100010001
_SPACE = r"[\x20\x09-\x0D]+"


def _terms(text: Column) -> Column:
    words = F.array_remove(F.split(text, _SPACE), "")
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))).alias("b"))
    return F.when(F.size(words) > 1, F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))).otherwise(pairs)


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``f0``, ``f1``: 64 bits each, for the rows of ``keys``, ``text``."""
    cut = texts.select(*keys, _terms(F.coalesce("text", F.lit(""))).alias("terms"))
    keys = [*keys, "long"]
    terms = cut.withColumn("long", F.size("terms") > STRETCH).select(*keys, F.posexplode_outer("terms").alias("at", "term"))
    length = F.coalesce(F.length("term.a"), F.lit(0)) + F.coalesce(F.length("term.b"), F.lit(0))
    hashed = terms.select(
        *keys,
        F.floor(F.col("at") / STRETCH).alias("stretch"),
        F.when(F.col("term").isNotNull(), F.least(F.greatest(F.floor(length / 5), F.lit(1)), F.lit(3))).otherwise(0).alias("w"),
        F.xxhash64("term.a", "term.b").alias("h0"),
        F.xxhash64("term.b", "term.a", F.lit(1)).alias("h1"),
    )
    lanes = [
        F.sum(F.shiftrightunsigned(f"h{half}", i).bitwiseAND(F.lit(_PLACES)) * F.col("w")).alias(f"l{half}_{i}")
        for half in range(BITS // 64)
        for i in range(16)
    ]
    stretches = written(hashed.groupBy(*keys, "stretch").agg(F.sum("w").alias("weight"), *lanes), "stretches")
    halves = range(BITS // 64)

    def place(half: int, n: int) -> Column:
        return F.shiftrightunsigned(f"l{half}_{n // 4}", 16 * (n % 4)).bitwiseAND(F.lit(0xFFFF))

    names = [*keys[:-1], "weight", *[f"v{half}_{n}" for half in halves for n in range(64)]]
    votes = [place(half, n).alias(f"v{half}_{n}") for half in halves for n in range(64)]
    single = stretches.filter("not long").select(*keys[:-1], "weight", *votes)
    added = [F.sum(place(half, n)).alias(f"v{half}_{n}") for half in halves for n in range(64)]
    several = stretches.filter("long").groupBy(*keys[:-1]).agg(F.sum("weight").alias("weight"), *added)

    def bits(half: int) -> Column:
        out = F.lit(0).cast("long")
        for n in range(64):
            up = 2 * F.col(f"v{half}_{n}") > F.col("weight")
            out = out.bitwiseOR(F.when(up, F.lit(_signed(1 << n))).otherwise(F.lit(0).cast("long")))
        return out

    return single.union(several.select(*names)).select(*keys[:-1], *[bits(half).alias(f"f{half}") for half in halves])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def distance(a: list[Column], b: list[Column]) -> Column:
    """Hamming distance of two fingerprints given as their halves."""
    total = F.lit(0)
    for x, y in zip(a, b):
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


def _widths(blocks: int) -> list[int]:
    """Bits of each block of one half; they differ by one at most."""
    return [(64 * (k + 1)) // (blocks // 2) - (64 * k) // (blocks // 2) for k in range(blocks // 2)]


def blocks_for(fingerprints: int, radius: int) -> int:
    """The number of blocks with the fewest probes and fingerprints met for a query, at so many fingerprints."""

    def cost(blocks: int) -> float:
        turned = [(sum(comb(w, n) for n in range(radius // blocks + 1)), w) for w in _widths(blocks)]
        return 2 * sum(probes * (1 + fingerprints / 2**width) for probes, width in turned)

    return min((b for b in CUTS if radius // b <= 3), key=cost)


def _turned(key: Column, masks: Column) -> Column:
    return F.transform(masks, lambda m: key.bitwiseXOR(m))


def _keys(blocks: int, turned: int) -> Column:
    """Keys of all blocks; also those with up to ``turned`` of a block's bits turned."""
    out = []
    for half in range(2):
        at = 0
        for k, width in enumerate(_widths(blocks)):
            block = F.shiftrightunsigned(f"f{half}", at).bitwiseAND(F.lit((1 << width) - 1))
            masks = [sum(1 << i for i in bits) for n in range(turned + 1) for bits in combinations(range(width), n)]
            # The masks are one constant of the plan, not a thousand expressions.
            several = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<long>")
            table = F.lit((half * blocks // 2 + k) << 40)
            out.append(_turned(block + table, several))
            at += width
    return F.explode(F.flatten(F.array(*out)))


def followers(ids: DataFrame) -> DataFrame:
    """``doc_id, n_chars, next_id`` in ascending doc_id, the last followed by the first.

    The ids are dealt by range; each range numbers its own neighbours, and the
    first id of every range (one row each) links it to the one before.
    """
    dealt = written(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy("doc_id")
    near = dealt.withColumn("inner", F.lead("doc_id").over(inside))
    firsts = dealt.groupBy("part").agg(F.min("doc_id").alias("first"))
    order = Window.orderBy("part")
    links = firsts.select(
        "part",
        F.coalesce(F.lead("first").over(order), F.min("first").over(Window.partitionBy(F.lit(1)))).alias("beyond"),
    )
    return near.join(links, "part").select("doc_id", "n_chars", F.coalesce("inner", "beyond").alias("next_id"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``op4_simhash``), with their likeness.

    Likeness is one minus the share of differing bits.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null")
    ids = given.groupBy("doc_id").agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("rows"))
    counted = written(ids, "ids")
    order = written(followers(counted.select("doc_id", "n_chars")), "followers")
    several = counted.filter("rows > 1").select("doc_id", "rows")
    # The exchange that reduces rows of one id also deals the texts to both joins below; they read it again.
    texts = given.groupBy("doc_id").agg(F.max("text").alias("text"))
    wanted = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), F.floor(F.col("n_chars") / 4).alias("n"))
    lent = texts.join(wanted, "doc_id").select(
        F.col("for_id").alias("doc_id"), F.substr("text", F.lit(1), F.col("n").cast("int")).alias("lent"), F.col("n")
    )
    keep = (F.length("text") - F.col("n")).cast("int")
    both = texts.join(lent, "doc_id").select(
        "doc_id", "text", F.concat(F.substr(F.col("text"), F.lit(1), keep), "lent").alias("edited")
    )
    kinds = F.explode(
        F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text"), F.lit(None).cast("string").alias("sha")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"), F.sha2("edited", 256).alias("sha")),
        )
    )
    prints = written(
        fingerprints(both.select("doc_id", kinds.alias("v")).select("doc_id", "v.kind", "v.sha", "v.text"), ["doc_id", "kind", "sha"]),
        "prints",
    )
    halves = [F.col("f0"), F.col("f1")]
    own = prints.filter("kind = 0").select("doc_id", "f0", "f1")
    edited = prints.filter("kind = 1").select("doc_id", F.col("sha").alias("edited_sha256"), F.col("f0").alias("e0"), F.col("f1").alias("e1"))
    after = own.select(F.col("doc_id").alias("next_id"), F.col("f0").alias("n0"), F.col("f1").alias("n1"))
    rows = order.join(own, "doc_id").join(edited, "doc_id").join(after, "next_id").join(several, "doc_id", "left")
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("rows", F.lit(1).cast("long")))))

    def likeness(a: str, b: str) -> Column:
        return 1 - distance(halves, [F.col(a), F.col(b)]) / F.lit(float(BITS))

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", hexadecimal("f0", "f1").alias("fingerprint"),
        hexadecimal("e0", "e1").alias("edited_fingerprint"), likeness("e0", "e1").alias("near_edited"),
        likeness("n0", "n1").alias("near_next"), "f0", "f1",
    )


def hexadecimal(*halves: str) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def near_members(members: DataFrame, queries: DataFrame, radius: int = NEAR, blocks: int | None = None) -> DataFrame:
    """``q0, q1, representative, copies, distance``: all of ``members`` within the radius of each query, itself included.

    ``members`` has a row ``f0, f1, representative, copies`` for each fingerprint. ``blocks`` changes the work, not the result.
    """
    blocks = blocks_for(members.count(), radius) if blocks is None else blocks
    if radius < 0 or blocks < 4 or blocks % 2 or radius // blocks > 3:
        raise ValueError("the radius must not be negative and less than four times the blocks, an even number of 4 or more")
    known = members.withColumn("key", _keys(blocks, 0))
    asked = queries.select("f0", "f1").distinct().withColumn("key", _keys(blocks, radius // blocks)).withColumnsRenamed({"f0": "q0", "f1": "q1"})
    apart = distance([F.col("f0"), F.col("f1")], [F.col("q0"), F.col("q1")])
    # Spark sees the size of the queries before their keys are turned, a thousand each with many fingerprints, and would send them all to the driver.
    met = asked.join(known.hint("merge"), "key").withColumn("distance", apart).filter(F.col("distance") <= radius)
    return met.select("q0", "q1", "representative", "copies", "distance").distinct()


def with_near(rows: DataFrame, every: int = 100, radius: int = NEAR) -> DataFrame:
    """Adds ``representative``, the smallest doc_id with the same fingerprint, and for ids divisible by ``every``
    ``n_near``, the other documents within ``radius``, and ``near``, their fingerprints; else null.

    ``near`` names each fingerprint, the own one included, by its representative, with its distance and its
    documents, so that a text with many copies is one entry; its doc_ids are the rows with that representative.
    """
    kept = written(rows, "fingerprints")
    members = written(kept.groupBy("f0", "f1").agg(F.min("doc_id").alias("representative"), F.countDistinct("doc_id").alias("copies")), "members")
    entry = F.struct("distance", "representative", "copies")
    near = near_members(members, kept.filter(F.col("doc_id") % every == 0), radius).groupBy("q0", "q1").agg(
        (F.sum("copies") - 1).alias("n_near"), F.sort_array(F.collect_list(entry)).alias("near")
    )
    own = members.select("f0", "f1", "representative").join(near, (F.col("f0") == F.col("q0")) & (F.col("f1") == F.col("q1")), "left").drop("q0", "q1")
    asked = F.col("doc_id") % every == 0
    return kept.join(own, ["f0", "f1"]).select(
        *[c for c in kept.columns if c not in ("f0", "f1")], F.when(asked, F.col("n_near")).alias("n_near"), "representative", F.when(asked, F.col("near")).alias("near")
    )
