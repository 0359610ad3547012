"""Language of texts and of the spans of mixed texts (operator 12).

The script of a word, found by its range of code points, narrows the languages
that come into question: those of whose learnt words at least SCRIPT_SHARE are
in that script. Every word has a score for every language, the log probability
of its letter groups of one to GRAMS letters (with the edges of the word) and of the
whole word, as counted in the language's texts. Viterbi then finds the best
sequence of languages over the words of a text, in which each change of language
costs SWITCH and a word in a language that its script rules out costs NARROW. The
sequence gives the spans; the text has the language with most letters in them (ties:
the better total score, then the smaller name). ``score`` is the share of letters in
that language's spans times the probability that these spans are in it.

Counts are learnt from at most FIT_TEXTS whole texts of each language, those with the smallest
hashes of id and text, the same on every run; equal rows count once. Letter groups share
BUCKETS counters, so what goes to the driver and to the tasks has at most BUCKETS numbers for
a language. Held-out rows, and rows without doc_id or language, are not learnt.

Null texts and those without a letter are ``und`` with score 0, and so is every text
if nothing is learnt. Rows without doc_id are labelled too and count as not held out.
Repeated rows get equal results, one each. Columns other than doc_id, text and
lang are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm import wordhash

FIT_TEXTS = 3_000
GRAMS = 4
BUCKETS = 1 << 17
SWITCH, NARROW = 10.0, 16.0
SCRIPT_SHARE = 0.01
#: Count that every bucket starts with.
PRIOR = 0.5
#: Texts of so many characters are labelled together, unless one alone is longer.
BATCH_CHARS = 1 << 23
SEED = 12
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_U = np.uint64
# First code points of script ranges, and the script from there on (0: none of these).
_RANGES = (
    (0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6), (0x0780, 0), (0x08A0, 6),
    (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 11), (0x0B80, 12), (0x0C00, 13), (0x0C80, 14), (0x0D00, 15), (0x0D80, 16),
    (0x0E00, 17), (0x0E80, 18), (0x0F00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22), (0x1200, 23), (0x13A0, 0), (0x1780, 24), (0x1800, 25),
    (0x18B0, 0), (0x1C80, 3), (0x1C90, 21), (0x1CC0, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 0), (0x2DE0, 3), (0x2E00, 0),
    (0x3040, 26), (0x30A0, 26), (0x3100, 27), (0x3130, 22), (0x3190, 0), (0x3400, 28), (0xA000, 0), (0xA640, 3), (0xA6A0, 0), (0xA720, 1),
    (0xA800, 0), (0xAC00, 22), (0xD7B0, 0), (0xF900, 28), (0xFB00, 1), (0xFB13, 4), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6),
    (0xFF00, 1), (0xFF66, 26), (0xFFA0, 22), (0xFFE0, 0), (0x20000, 28), (0x33480, 0),
)
_FIRST = np.array([f for f, _ in _RANGES])
_SCRIPT = np.array([s for _, s in _RANGES])
SCRIPTS = int(_SCRIPT.max()) + 1


def held_out() -> Column:
    """Rows whose language is never learnt; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scripts(words: list[str]) -> np.ndarray:
    """Script number of the first letter of each word."""
    return _SCRIPT[np.searchsorted(_FIRST, [ord(w[0]) for w in words], side="right") - 1] if words else np.zeros(0, np.int64)


def _lists(words: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Buckets of the whole words, and for each group size (buckets by place, first place, last place + 1 of each word)."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = np.flatnonzero(codes == 32)
    before, after = space[:-1], space[1:]
    whole, _ = wordhash.word_hashes([" ".join(words).encode("utf-8", "surrogatepass")])
    groups = []
    value = np.zeros(len(codes), np.uint64)
    for n in range(1, GRAMS + 1):
        value = value[: len(codes) - n + 1] * _U(0x110000) + codes[n - 1 :] if n > 1 else codes
        bucket = (wordhash.mix(value * _U(8) + _U(n)) % _U(BUCKETS)).astype(np.int64)
        # Edges are part of the groups, but no group of their own.
        first = before + 1 if n == 1 else before
        groups.append((bucket, first, np.maximum(first, np.minimum(after - n + 2, len(bucket)) if n > 1 else after)))
    return (wordhash.mix(whole * _U(8)) % _U(BUCKETS)).astype(np.int64), groups


def word_counts(words: list[str], counts: np.ndarray) -> np.ndarray:
    """Counts of all buckets over words that stand ``counts`` times each."""
    whole, groups = _lists(words)
    out = np.bincount(whole, counts, BUCKETS)
    for bucket, first, last in groups:
        each = last - first
        at = np.repeat(first - np.cumsum(each) + each, each) + np.arange(each.sum())
        out += np.bincount(bucket[at], np.repeat(counts, each), BUCKETS)
    return out


class Model:
    """Word scores: log probabilities by bucket and language, and the scripts of each language."""

    def __init__(self, names: list[str], counts: np.ndarray, by_script: np.ndarray):
        """``counts`` is languages x buckets, ``by_script`` the words of each language by script."""
        self.names = names
        smooth = counts + PRIOR
        self.logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
        share = by_script / np.maximum(by_script.sum(axis=1, keepdims=True), 1)
        allowed = (share >= SCRIPT_SHARE).T
        # A script that no language has rules none out.
        self.ruled_out = np.where(allowed.any(axis=1, keepdims=True), ~allowed, False)

    def scores(self, words: list[str]) -> np.ndarray:
        """words x languages; a mean over the group sizes and the whole word, the best language at 0."""
        out = np.empty((len(words), len(self.names)), np.float32)
        for low in range(0, len(words), 1 << 16):
            part = words[low : low + (1 << 16)]
            whole, groups = _lists(part)
            total = self.logs[whole].astype(np.float64)
            for bucket, first, last in groups:
                sums = np.concatenate((np.zeros((1, len(self.names))), np.cumsum(self.logs[bucket], axis=0, dtype=np.float64)))
                total += sums[last] - sums[first]
            total /= GRAMS + 1
            total -= NARROW * self.ruled_out[scripts(part)]
            out[low : low + len(part)] = total - total.max(axis=1, keepdims=True)
        return out


def viterbi(scores: np.ndarray, word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Language of each word of texts that lie one after the other; ``word`` points into the rows of ``scores``.

    All texts take a step together, those that still have words: a step looks at the state before
    and at the best of all states less SWITCH, so it costs one pass over the languages.
    """
    order = np.argsort(-sizes, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    # Texts that have more than t words.
    active = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    stay = np.ones((len(word), scores.shape[1]), bool)
    best = np.zeros(len(word), np.int32)
    value = np.zeros((len(order), scores.shape[1]), np.float64)
    for t in range(longest):
        at = begins[: active[t]] + t
        now = value[: active[t]]
        if t:
            top = now[np.arange(len(now)), best[at - 1]][:, None] - SWITCH
            stay[at] = now >= top
            now = np.maximum(now, top)
        now = now + scores[word[at]]
        now -= now.max(axis=1, keepdims=True)
        best[at] = now.argmax(axis=1)
        value[: active[t]] = now
    out = np.empty(len(word), np.int32)
    state = np.zeros(len(order), np.int32)
    for t in range(longest - 1, -1, -1):
        at = begins[: active[t]] + t
        ends = active[t + 1] if t + 1 < longest else 0
        # Texts whose last word this is begin with their best state; the others keep theirs or change to the best one.
        state[ends : active[t]] = best[at[ends:]]
        held = state[:ends]
        state[:ends] = np.where(stay[at[:ends] + 1, held], held, best[at[:ends]])
        out[at] = state[: active[t]]
    return out


def _plain(scores: np.ndarray, word: np.ndarray, text: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Which texts stay in their language ``best`` all along, so that no state has to be followed.

    A way through m other languages costs m - 1 changes at least, and more if it leaves ``best`` for one only, as
    no other language is better over all. If no stretch gains half of SWITCH in any one of them, none pays.
    """
    plain = np.ones(len(best), bool)
    mine = best[text]
    for k in range(scores.shape[1]):
        gain = (scores[word, k] - scores[word, mine]).astype(np.float64)
        run = np.cumsum(gain)
        # A stretch gains its end less the value before its beginning. Each text is shifted below the texts before it,
        # so that the least value so far is one of its own.
        floor = run - gain
        shift = text * (float(floor.max() - floor.min()) + 1.0)
        least = np.minimum.accumulate(floor - shift) + shift
        plain[text[run - least >= SWITCH / 2]] = False
    return plain


def label(texts: list[str | None], model: Model) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) of each text; spans are (first character, end, language)."""
    found = [_WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(f) for f in found], np.int64)
    coded = pa.array(list(chain.from_iterable(found)), pa.string()).dictionary_encode()
    word, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    if not len(word) or not model.names:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    scores = model.scores([w.lower() for w in words])
    letters = np.array([len(w) for w in words])[word]
    text = np.repeat(np.arange(len(texts)), sizes)
    n = len(model.names)
    total = np.stack([np.bincount(text, scores[word, k], len(texts)) for k in range(n)], axis=1)
    begins = np.cumsum(sizes) - sizes
    best = total.argmax(axis=1)
    mixed = ~_plain(scores, word, text, best)
    states = best[text]
    states[mixed[text]] = viterbi(scores, word[mixed[text]], sizes[mixed])
    weight = np.bincount(text * n + states, letters, len(texts) * n).reshape(-1, n)
    out = []
    for i, f in enumerate(found):
        if not f:
            out.append((UNKNOWN, 0.0, []))
            continue
        k = max(range(n), key=lambda k: (weight[i, k], total[i, k], -k))
        mine = states[begins[i] : begins[i] + sizes[i]]
        own = total[i] if (mine == k).all() else scores[word[begins[i] : begins[i] + sizes[i]][mine == k]].sum(axis=0, dtype=np.float64)
        chance = 1.0 / np.exp(np.minimum(own - own[k], 700.0)).sum()
        cuts = np.flatnonzero(np.diff(mine)) + 1
        if len(cuts):
            places = [m.span() for m in _WORD.finditer(texts[i])]
            edges = [0, *cuts.tolist(), len(mine)]
            spans = [(places[a][0], places[b - 1][1], model.names[mine[a]]) for a, b in zip(edges, edges[1:])]
        else:
            last = texts[i].rfind(f[-1])
            spans = [(texts[i].find(f[0]), last + len(f[-1]), model.names[k])]
        out.append((model.names[k], float(min(1.0, weight[i, k] / weight[i].sum() * chance)), spans))
    return out


def learning_texts(docs: DataFrame) -> DataFrame:
    """``lang, text`` of at most FIT_TEXTS texts of each language."""
    rows = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(F.lit(SEED), "doc_id", "text").alias("place")
    ).filter("lang is not null")
    # Hashes first, without the texts; each task trims its own to FIT_TEXTS a language before the exchange.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    last = rows.select("lang", "place").distinct().withColumn("rank", rank).filter(F.col("rank") <= FIT_TEXTS).groupBy("lang").agg(F.max("place").alias("last"))
    return rows.join(F.broadcast(last), "lang").filter("place <= last").dropDuplicates(["lang", "place"]).select("lang", "text")


def learn(docs: DataFrame) -> Model:
    """The model of the languages in ``docs``."""

    def counted(batches):
        for batch in batches:
            by_language: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_language.setdefault(lang, Counter()).update(w.lower() for w in _WORD.findall(text))
            for lang, found in by_language.items():
                words, counts = list(found), np.array(list(found.values()), np.float64)
                if not words:
                    continue
                buckets = word_counts(words, counts)
                by_script = np.bincount(scripts(words), counts, SCRIPTS)
                values = np.concatenate((buckets, by_script))
                at = np.flatnonzero(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(values[at].astype(np.int64))], names=["lang", "bucket", "count"]
                )

    sums = learning_texts(docs).mapInArrow(counted, "lang string, bucket int, count long").groupBy("lang", "bucket").agg(F.sum("count").alias("count"))
    # At most BUCKETS + SCRIPTS rows a language.
    table = sums.toArrow()
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    names = sorted(set(langs))
    place = {name: i for i, name in enumerate(names)}
    values = np.zeros((len(names), BUCKETS + SCRIPTS))
    values[[place[x] for x in langs], table.column("bucket").to_numpy()] = table.column("count").to_numpy()
    return Model(names, values[:, :BUCKETS], values[:, BUCKETS:])


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans`` for every row, with a model learnt from ``docs`` unless one is given."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs) if model is None else model)
    spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= BATCH_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                found = label(texts[at:end], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at),
                        pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                        pa.array([[{"first": a, "end": b, "lang": name} for a, b, name in f[2]] for f in found], spans),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "spans"],
                )
                at = end

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, spans array<struct<first:int,end:int,lang:string>>")
