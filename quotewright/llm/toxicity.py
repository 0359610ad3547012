"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration (operator 1).

Features of a whole text: how densely learnt lexicon words and word beginnings
stand in it (also after undoing digit and symbol spellings), how often they
stand near a second-person word, rates of capitals, of punctuation, of
repeated characters and of obfuscated words, and the length. Labels, language,
source and id are no features.

The lexicon is learnt from labelled texts: words and word beginnings of four to
six letters that are in at least MIN_TEXTS toxic texts and RATIO times more
frequent there. A beginning covers inflected and compounded forms that are too
rare to be learnt one by one.

At most FIT_ROWS labelled rows, those with the smallest hashes of the id, are
used for fitting: half of them, by another bit of the hash, for the lexicon, a
quarter for the trees and a quarter for the calibration, so no stage is fitted
on texts that an earlier one has seen. The lexicon, of at most LEXICON_SIZE entries, goes to the
tasks by broadcast.

Null and empty texts have all features 0 and get a score like others. Labels
that are null or of unknown rows are ignored; a row labelled twice counts
twice. Without toxic or without clean labelled rows every score is 0. Extra
columns are ignored, whatever their names. Repeated rows get equal scores, rows without
doc_id are scored too. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.scratch import written

FIT_ROWS = 24_000
MIN_TEXTS, RATIO, LEXICON_SIZE = 4, 8.0, 4_000
SEED = 11
THRESHOLD = 0.3
_STEMS = (4, 5, 6)
# Second-person words.
_SECOND = frozenset("you your yours yourself youre u ur tu te toi vous votre vos ton ta tes du dich dir dein deine ihr euch sie tú ti usted ustedes vosotros".split())
# Signs that stand for letters.
_SIGNS = str.maketrans("0134578@$!|+", "oieastbasiit")
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"(?<!\S)[^\W\d_]+(?:[0-9@$!|*+_.-]+[^\W\d_]+)+")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_MARKS = re.compile(r"[!?]")
_OTHER = re.compile(r"[^\w\s]")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SHOUTED = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-Þ]{3,}(?!\w)")
NEAR = 5
NAMES = (
    "words", "word_hits", "stem_hits", "weight", "largest", "distinct_hits", "second", "near_second", "capitals", "shouted",
    "marks", "punctuation", "drawn", "masked", "masked_hits", "any_word", "any_stem", "log_length",
)


def _entries(words: set[str]) -> set[str]:
    """Words as they are; beginnings with a star."""
    return words | {w[:n] + "*" for w in words for n in _STEMS if len(w) > n}


def _beside(i: int, places: list[int]) -> bool:
    """Whether one of the sorted places is within NEAR of i."""
    at = bisect_left(places, i - NEAR)
    return at < len(places) and places[at] <= i + NEAR


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    lower = text.lower()
    words = _WORD.findall(lower)
    n = max(1, len(words))
    hits: dict[int, float] = {i: lexicon[w] for i, w in enumerate(words) if w in lexicon}
    whole = len(hits)
    for size in _STEMS:
        stems = lexicon["", size]
        for i, w in enumerate(words):
            if w[:size] in stems and i not in hits:
                hits[i] = stems[w[:size]]
    second = [i for i, w in enumerate(words) if w in _SECOND] if hits else []
    near = sum(_beside(i, second) for i in hits)
    masked = _MASKED.findall(lower)
    undone = [re.sub(r"[^\w]|[\d_]", "", m.translate(_SIGNS)) for m in masked]
    masked_hits = sum(m in lexicon or re.sub(r"[^\w]|[\d_]", "", raw) in lexicon for raw, m in zip(masked, undone))
    size = max(1, len(text))
    return [
        float(len(words)), whole / n, (len(hits) - whole) / n, sum(hits.values()) / n, max(hits.values(), default=0.0),
        float(len({words[i] for i in hits})), len(second) / n, float(near), len(_CAPITALS.findall(text)) / size, len(_SHOUTED.findall(text)) / n,
        len(_MARKS.findall(text)) / size, len(_OTHER.findall(text)) / size, sum(1 for _ in _DRAWN.finditer(lower)) / n, len(masked) / n,
        float(masked_hits), float(whole), float(len(hits) - whole), float(np.log1p(len(text))),
    ]


def _fold(parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), parts)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of at most FIT_ROWS labelled rows that are not held out; the same on every run."""
    known = labels.filter(F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = known.filter(~held_out("_id")).orderBy(F.xxhash64(F.lit(SEED + 1), "_id"), "_id", "toxic").limit(FIT_ROWS)
    return docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")


def learn_lexicon(rows: DataFrame) -> dict:
    """Log ratios of words and beginnings; beginnings of n letters are under ``("", n)``."""

    def counted(batches):
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(_entries(set(_WORD.findall((text or "").lower()))))
            entries = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.string()), *[pa.array([counts[k][e] for e in entries], pa.int64()) for k in (0, 1)]],
                names=["entry", "clean", "toxic"],
            )

    total = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    sums = rows.select("text", "toxic").mapInArrow(counted, "entry string, clean long, toxic long").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log(((F.col("toxic") + 0.1) / max(1, total[1])) / ((F.col("clean") + 0.1) / max(1, total[0])))
    best = sums.withColumn("odds", odds).filter((F.col("toxic") >= MIN_TEXTS) & (F.col("odds") >= float(np.log(RATIO))))
    found = best.orderBy(F.desc("toxic"), F.desc("odds"), "entry").limit(LEXICON_SIZE).select("entry", "odds").collect()
    lexicon: dict = {("", n): {} for n in _STEMS}
    for entry, weight in found:
        if entry.endswith("*"):
            lexicon["", len(entry) - 1][entry[:-1]] = weight
        else:
            lexicon[entry] = weight
    return lexicon


def with_features(docs: DataFrame, lexicon: dict, *more: str) -> DataFrame:
    """``doc_id``, the columns ``more`` and ``features``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches):
        for batch in batches:
            rows = [features(t or "", shared.value) for t in batch.column(0).to_pylist()]
            values = pa.array(np.array(rows, float).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(NAMES)), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], names=["doc_id", *more, "features"])

    columns = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *more))
    return docs.select("text", "doc_id", *more).mapInArrow(run, f"{columns}, features array<double>").withColumn("features", array_to_vector("features"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    known = written(labelled(docs, labels), "labelled")
    both = known.agg(F.count_distinct(F.when(F.col("toxic") == 1, 1)), F.count_distinct(F.when(F.col("toxic") == 0, 1))).first()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if not all(both):
        return texts.select("doc_id", held_out().alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    lexicon = learn_lexicon(known.filter(_fold(4) < 2))
    fitted = written(with_features(known.filter(_fold(4) >= 2), lexicon, "toxic").withColumn("label", F.col("toxic").cast("double")), "features")
    trees, rest = (fitted.filter(_fold(4) == k) for k in (2, 3))
    if trees.select("label").distinct().count() < 2 or rest.isEmpty():
        trees = rest = fitted
    booster = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=SEED)
    model = booster.fit(trees.coalesce(4))
    margin = vector_to_array("probability")[1]
    steps = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="level").fit(model.transform(rest).select(margin.alias("margin"), "label").coalesce(1))
    scored = steps.transform(model.transform(with_features(texts, lexicon)).select("doc_id", margin.alias("margin")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.least(F.greatest("level", F.lit(0.0)), F.lit(1.0)).alias("score"),
        (F.col("level") >= THRESHOLD).cast("int").alias("predicted"),
    )
