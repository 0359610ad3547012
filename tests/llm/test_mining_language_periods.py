"""Hard negatives, languages and periodic runs against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewright.llm import hardneg, langid, periods

ODD = [None, "", " \n\t ", "one", "x" * 70_000, "a b c", "a b c", "zwölf Boxkämpfer jagen\n\nEva 🙂", "1234 -- 5678"]


def clashing(docs):
    """Columns named like those that the operators make."""
    names = ("row", "n", "runs", "tiles", "spans", "score", "held_out", "lang_pred", "place", "last", "g", "a", "p", "words")
    return docs.withColumns({name: F.lit(f"clash {name}") for name in names})


# -- 11 ------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def mined_plainly(rows, is_anchor):
    """Every window over all pairs, in whole numbers."""
    ok = [r for r in dict.fromkeys(rows) if None not in r and all(x is not None and np.isfinite(x) for x in r[1])]
    v = [(i, l, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, e, l in ok]
    out = []
    for i, l, a in v:
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, b)), j, m) for j, m, b in v if j != i))
        for s, j, _ in [x for x in scored if x[2] == l][:5]:
            fits = [x for x in scored if x[2] != l and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, rank + 1, k, -s, -t) for rank, (t, k, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.15, 3.0])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(hardneg, "BLOCK", 16)
    monkeypatch.setattr(hardneg, "CHUNK", 4)
    monkeypatch.setattr(hardneg, "LANE", 5)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 9))
    v = (centres[rng.integers(0, 12, 500)] + spread * rng.normal(size=(500, 9))).astype(np.float32)
    v[40:60] = v[20]  # many equal vectors, so many ties
    rows = [(i, tuple(map(float, v[i])), int(rng.integers(0, 4))) for i in range(500)]
    rows += [(500, None, 1), (501, (None, *[1.0] * 8), 1), (502, (float("nan"), *[1.0] * 8), 1), (503, (float("inf"), *[1.0] * 8), 1), (504, (1.0,) * 9, None), (None, (1.0,) * 9, 1)]
    rows += rows[:30]
    table = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({c: F.lit("clash") for c in ("block", "asked", "v", "key", "rank", "lane", "chunk")})
    got = sorted(map(tuple, hardneg.mine(table, F.col("vec_id") % 10 == 0).collect()))
    want = mined_plainly(rows, lambda i: i % 10 == 0)
    assert got == want and len(want) > 100


def test_bounds_hold_all_products_and_rule_out_far_blocks():
    rng = np.random.default_rng(4)
    b = rng.integers(-300, 300, (200, 6))
    a = rng.integers(-300, 300, (50, 6))
    low, high = b.min(axis=0)[None], b.max(axis=0)[None]
    least, largest = hardneg._bounds(a, low, high, True)
    products = a @ b.T
    assert (products >= least).all() and (products <= largest).all()
    near, far = hardneg._bounds(np.array([[10, 10]]), np.array([[5, 5], [-9, -9]]), np.array([[9, 9], [-5, -5]]), False)
    assert near.tolist() == [[100, -180]] and far.tolist() == [[180, -100]]


def test_hilbert_curve_visits_neighbours():
    for bits, dimensions in ((3, 2), (2, 3), (1, 5)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
        keys = hardneg.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(np.array(keys, object), kind="stable")]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_hard_negatives_of_odd_tables(spark):
    anchors = F.col("vec_id") % 2 == 0
    assert hardneg.mine(spark.createDataFrame([], VECTORS), anchors).count() == 0
    assert hardneg.mine(spark.createDataFrame([(1, (0.5, 0.5), 1)], VECTORS), anchors).count() == 0
    assert hardneg.mine(spark.createDataFrame([(2, (0.5, 0.5), 1), (4, (0.5, 0.5), 1)], VECTORS), anchors).count() == 0
    # Without components all products are 0, and 0 lies in the window of 0.
    empty = spark.createDataFrame([(2, (), 1), (3, (), 1), (5, (), 2)], VECTORS)
    assert list(map(tuple, hardneg.mine(empty, anchors).collect())) == [(2, 3, 1, 5, 0, 0)]
    with pytest.raises(ValueError, match="components"):
        hardneg.mine(spark.createDataFrame([(2, (0.5,), 1), (4, (0.5, 0.5), 1)], VECTORS), anchors)
    with pytest.raises(ValueError, match="too large"):
        hardneg.mine(spark.createDataFrame([(2, (1e30, 0.5), 1), (4, (0.5, 0.5), 1)], VECTORS), anchors)


# -- 12 ------------------------------------------------------------------

SOUNDS = {"aa": "ka lo mi ta re su na ", "bb": "brn str gld vrm kst plk ", "cc": "оро ете ива нас дом кот ", "dd": "ouille aise eux oir ette "}


def invented(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    parts = SOUNDS[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n))


def labelled(spark, n=240, words=25):
    rows = [(i, invented(lang, i, words), lang) for i in range(n) for lang in [list(SOUNDS)[i % 4]]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_texts(spark):
    rows, docs = labelled(spark)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    # Wrong languages on held-out rows must not matter.
    wrong = docs.withColumn("lang", F.when(langid.held_out(), F.lit("aa")).otherwise(F.col("lang")))
    got = {r.doc_id: r for r in langid.predict(clashing(wrong)).collect()}
    assert {i for i in got if got[i].held_out} == held and len(held) > 20
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_spans_of_a_mixed_text(spark):
    _, docs = labelled(spark)
    model = langid.learn(docs)
    first, second, third = invented("aa", -1, 30), invented("cc", -2, 40), invented("bb", -3, 30)
    text = f"  {first}. 12 {second}! {third}\n"
    name, score, spans = langid.label([text], model)[0]
    assert [s[2] for s in spans] == ["aa", "cc", "bb"]
    assert [text[a:b] for a, b, _ in spans] == [first, second, third]
    letters = {n: sum(map(str.isalpha, t)) for n, t in (("aa", first), ("cc", second), ("bb", third))}
    assert name == max(letters, key=letters.get) and 0.2 < score < 0.7


def test_the_cheapest_sequence_of_languages_is_found():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 60, 40)
    scores = -rng.exponential(3.0, (500, 3)).astype(np.float32)
    word = rng.integers(0, 500, sizes.sum())
    states = langid.viterbi(scores, word, sizes)
    for begin, size in zip(np.cumsum(sizes) - sizes, sizes):
        own = scores[word[begin : begin + size]].astype(float)
        best = np.zeros(3)
        for row in own:
            best = np.maximum(best, best.max() - langid.SWITCH) + row
        path = states[begin : begin + size]
        worth = own[np.arange(size), path].sum() - langid.SWITCH * (np.diff(path) != 0).sum()
        assert size == 0 or abs(worth - best.max()) < 1e-6
    text = np.repeat(np.arange(40), sizes)
    total = np.stack([np.bincount(text, scores[word, k], 40) for k in range(3)], axis=1)
    plain = langid._plain(scores / 20, word, text, total.argmax(axis=1))
    calm = langid.viterbi(scores / 20, word, sizes)
    assert plain.any() and all((calm[text == t] == total[t].argmax()).all() for t in np.flatnonzero(plain & (sizes > 0)))


def test_scripts_narrow_the_candidates(spark):
    _, docs = labelled(spark)
    model = langid.learn(docs)
    assert langid.scripts(["abc", "éa", "дом", "λόγος", "漢字", "かな", "한글", "עברית"]).tolist() == [1, 1, 3, 2, 28, 26, 22, 5]
    ruled = model.ruled_out
    assert ruled[3].tolist() == [True, True, False, True] and ruled[1].tolist() == [False, False, True, False]
    assert not ruled[2].any()  # no language has learnt this script


def test_languages_of_odd_texts(spark):
    _, docs = labelled(spark)
    odd = clashing(spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD)] + [(None, "kalomi tare", "aa")], "doc_id long, text string, lang string"))
    got = langid.predict(odd, langid.learn(docs)).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        text = ODD[r.doc_id] if r.doc_id is not None else "kalomi"
        none = not text or not any(c.isalpha() for c in text)
        assert (r.lang_pred == "und") == none and (not none or (r.score == 0 and r.spans == []))
    assert not next(r for r in got if r.doc_id is None).held_out
    # Nothing learnt.
    assert {r.lang_pred for r in langid.predict(odd.filter("doc_id is not null")).collect()} == {"und"}
    assert langid.predict(odd.limit(0)).count() == 0


def test_a_text_over_many_words_is_labelled_whole(spark):
    _, docs = labelled(spark)
    text = invented("aa", -5, 30_000) + " " + invented("dd", -6, 3_000)
    name, _, spans = langid.label([text], langid.learn(docs))[0]
    assert name == "aa" and [s[2] for s in spans] == ["aa", "dd"] and spans[-1][1] == len(text)


# -- 13 ------------------------------------------------------------------


def runs_plainly(words):
    """Every period's stretches, kept under the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, length) for (s, length), q in found.items())


def digests_plainly(doc_id, text, planted=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_plainly(words)
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    facts = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *facts, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, rest)))


def test_periodic_runs_equal_brute_force(spark):
    r = random.Random(5)
    rows = []
    for d in range(500):
        letters, n = r.choice([1, 2, 2, 3, 50]), r.choice([0, 1, 5, 6, 7, 8, 20, 60, 150, 400])
        words = [f"w{r.randrange(letters)}" for _ in range(n)]
        for _ in range(r.randrange(3) if n > 20 else 0):
            q, s = r.randrange(1, n // 4 + 1), r.randrange(n)
            for i in range(s + q, min(n, s + q * r.randrange(3, 9) + r.randrange(q))):
                words[i] = words[i - q]
        rows.append((d, r.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a a a a a a"), (None, None), (600, "x " * 3000), (600, "x y " * 3000), rows[10], rows[10]]
    # White space of other kinds belongs to words; case counts.
    rows += [(700, "a b " * 7), (701, "A a " * 3 + "a A a A a A")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, periods.run_digests(periods.with_planted_runs(docs)).collect()), key=str)
    want = sorted((digests_plainly(*row) for row in rows), key=str)
    assert got == want
    assert sum(w[1] for w in want) > 200


def test_tiles_are_stitched_over_a_long_text(spark):
    r = random.Random(9)
    words = [f"v{r.randrange(5000)}" for _ in range(30_000)]
    for start, period, length in ((100, 997, 9_000), (12_000, 1, 50), (15_000, 3_000, 12_000), (28_000, 13, 700)):
        for i in range(start + period, start + length):
            words[i] = words[i - period]
    found = periods.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(x) for x in found.runs] == runs_plainly(words) and len(found.runs) >= 4


def test_z_function():
    r = random.Random(2)
    for _ in range(50):
        x = [r.randrange(2) for _ in range(r.randrange(30))]
        z = periods.z_function(x)
        for i in range(1, len(x)):
            assert x[: z[i]] == x[i : i + z[i]] and (i + z[i] == len(x) or x[z[i]] != x[i + z[i]])


def test_periods_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periods.run_digests(periods.with_planted_runs(docs)).count() == 0
