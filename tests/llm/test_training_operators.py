"""Edge cases and brute-force references of the numbered operators on small tables."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from quotewright.llm import annsearch, bpe, chat, linedup, minhash, mixing, passages, pii, simhash, toxicity
from quotewright.llm.scratch import components

WORDS = [f"w{i}" for i in range(400)]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " \n\t ", "one", "x" * 70_000, "a b c", "a b c", "zwölf Boxkämpfer jagen\n\nEva 🙂"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def odd(documents):
    return documents(list(enumerate(ODD)))


# -- 1 -------------------------------------------------------------------


def test_toxicity_separates_and_keeps_held_out_labels_out(spark, documents):
    r = random.Random(1)
    rows = [(i, prose(i, 40) + (" you vile zork zorkish " if i % 4 == 0 else " kind ") + prose(-i, 20)) for i in range(400)]
    docs = documents(rows + [(900, None), (901, "")])
    toxic = {i: int(i % 4 == 0) for i in range(400)}
    held = {x.doc_id for x in docs.filter(toxicity.held_out()).collect()}
    # Wrong labels on the held-out rows must not matter.
    labels = spark.createDataFrame([(i, 1, r.randrange(2) if i in held else t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.score(docs, labels).collect()}
    assert got.keys() == {x[0] for x in rows} | {900, 901}
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got.values())
    assert {i for i, x in got.items() if x.held_out} == held
    assert np.mean([got[i].predicted == t for i, t in toxic.items()]) > 0.95


def test_toxicity_without_usable_labels(spark, documents):
    labels = spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int")
    assert {x.score for x in toxicity.score(odd(documents), labels).collect()} == {0.0}
    assert toxicity.score(documents([]), labels).count() == 0


def test_features_of_odd_texts():
    lexicon = {("", 4): {}, ("", 5): {}, ("", 6): {}, "vile": 2.0}
    assert all(len(toxicity.features(t or "", lexicon)) == len(toxicity.NAMES) for t in ODD)
    plain, masked = (dict(zip(toxicity.NAMES, toxicity.features(t, lexicon))) for t in ("you vile thing", "you v1le thing"))
    assert plain["near_second"] == 1 and masked["masked_hits"] == 1


# -- 2 -------------------------------------------------------------------


def test_nearest_neighbours_reach_recall_and_measure_exactly(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    v = (centres[rng.integers(0, 20, 600)] + 0.4 * rng.normal(size=(600, 16))).astype(np.float32)
    v[7] = v[3]
    rows = [(i, [float(x) for x in v[i]], 0) for i in range(600)]
    rows += [(600, None, 0), (601, [0.0] * 16, 0), (602, [float("nan")] + [1.0] * 15, 0), (603, [None] + [1.0] * 15, 0), (604, [float("inf")] * 16, 0), rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = annsearch.search(table, F.col("vec_id") % 20 == 0, k=10).collect()
    x, hit = v.astype(float), 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), abs=1e-12)
    assert set(by) == set(range(0, 600, 20))
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11)) and q not in {r.vec_id for r in found}
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        s = x @ x[q]
        s[q] = -np.inf
        hit += len({r.vec_id for r in found} & set(np.lexsort((np.arange(600), -s))[:10].tolist()))
    assert hit >= 0.9 * 300


def test_a_query_meets_a_smaller_share_of_a_larger_table():
    shares = []
    for n in (1_000, 16_000):
        x = np.random.default_rng(7).normal(size=(n, 32))
        x /= np.linalg.norm(x, axis=1)[:, None]
        axes = annsearch.axes_of(n, 32)
        most = int(np.ceil(annsearch.PROBES * n**annsearch.GROWTH))
        held = annsearch.cells(x, axes, annsearch.TABLES)
        table, cell = annsearch.probed(x[:60], axes, annsearch.TABLES, most)
        hit = met = 0
        for i in range(60):
            assert len(set(zip(table[i], cell[i]))) == len(cell[i]) == most
            assert set(enumerate(held[i])) <= set(zip(table[i], cell[i]))  # its own cells are the nearest
            found = np.zeros(n, bool)
            for t in range(annsearch.TABLES):
                found |= np.isin(held[:, t], cell[i, table[i] == t])
            near = np.argsort(-(x @ x[i]))[1:21]
            hit, met = hit + found[near].sum(), met + found.mean()
        assert hit >= 0.9 * 60 * 20
        shares.append(met / 60)
    assert shares[1] < 0.6 * shares[0]


def test_a_vector_that_many_rows_share(spark):
    """Equal vectors tie, so the smallest ids come first, whatever the number of copies; ids may repeat."""
    r = np.random.default_rng(3)
    v = r.integers(-3, 4, (120, 4)).astype(float)
    v[r.random(120) < 0.5] = [1.0, 2.0, 2.0, 0.0]
    v[~v.any(axis=1)] = 1.0
    ids = [int(i) for i in r.permutation(120)]
    ids[5] = ids[4]
    table = spark.createDataFrame([(i, x.tolist(), "clash", 1) for i, x in zip(ids, v)], "vec_id long, embedding array<double>, class string, cell int")
    wanted = []
    for q in sorted(set(ids)):
        if q % 5 == 0:
            scored = {(-float(a @ b), j) for i, a in zip(ids, v) if i == q for j, b in zip(ids, v) if j != q}
            wanted += [(q, n, j, -s) for n, (s, j) in enumerate(sorted(scored)[:7], 1)]
    got = [tuple(x) for x in annsearch.search(table, F.col("vec_id") % 5 == 0, k=7, probes=10_000).orderBy("query_id", "rank").collect()]
    assert got == wanted


def test_blocks_of_a_part_add_up_to_it(spark, monkeypatch):
    v = np.random.default_rng(4).normal(size=(5000, 3))
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    whole = annsearch.search(table, F.col("vec_id") % 3 == 0, k=3).collect()
    monkeypatch.setattr(annsearch, "PART_BYTES", 0)  # 1,024 vectors a part
    monkeypatch.setattr(annsearch, "TOGETHER", 500)
    assert set(annsearch.search(table, F.col("vec_id") % 3 == 0, k=3).collect()) == set(whole)


def test_nearest_neighbours_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.6, 0.8]), (2, None)], schema)
    assert [(r.query_id, r["rank"], r.vec_id) for r in annsearch.search(few, F.col("vec_id") % 20 == 0, tables=8, probes=2).collect()] == [(0, 1, 1)]
    assert annsearch.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0


# -- 3 -------------------------------------------------------------------


def test_mix_meets_targets(documents):
    r = random.Random(2)
    rows = [(i, prose(i, r.randrange(1, 60)), r.choice(["a", "b", "c", None])) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", "d")]
    docs = documents(rows)
    got = mixing.mix(docs).collect()
    again = {(x.doc_id, x.taken) for x in mixing.mix(docs.repartition(3)).collect()}
    assert {(x.doc_id, x.taken) for x in got} == again
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    source = {x[0]: x[2] for x in rows}
    totals = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    order = sorted((s for s in totals if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(totals.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * totals[s]}
        for s in over or open_:
            target[s] = 2.0 * totals[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        open_ -= over or open_
    assert {x.doc_id for x in got} == set(size)
    for x in got:
        assert (x.size, x.source_size) == (size[x.doc_id], totals[source[x.doc_id]])
        assert x.target == pytest.approx(target[source[x.doc_id]])
        assert x.taken == x.copies * x.size <= 2 * x.size
    for s in order:
        taken = sum(x.taken for x in got if x.source == s)
        assert abs(taken - target[s]) <= 60
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == sum(x.copies for x in got)


def test_mix_of_nothing(documents):
    assert mixing.mix(documents([])).count() == 0
    assert {x.taken for x in mixing.mix(documents([(1, None, None), (2, "", "a")])).collect()} == {0}


# -- 4 -------------------------------------------------------------------


def test_fingerprints_tell_edits_from_neighbours(documents):
    rows = [(3 * i, prose(i, 150)) for i in range(30)] + [(200 + i, t) for i, t in enumerate(ODD)]
    got = {x.doc_id: x for x in simhash.with_near(simhash.edited_fingerprints(documents(rows))).collect()}
    text = {i: t or "" for i, t in rows}
    ids = sorted(text)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        n = len(text[i]) // 4
        edited = text[i][: len(text[i]) - n] + text[j][:n]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(text[i])
    prints = {}
    for i, x in got.items():
        assert prints.setdefault(text[i], x.fingerprint) == x.fingerprint
    assert min(got[3 * i].near_edited for i in range(29)) > max(got[3 * i].near_next for i in range(29))


def test_one_term_repeated_all_through_a_long_text_has_its_own_hash_as_fingerprint(documents):
    once = "abcdefgh ijklmnopq"
    rows = [(1, once), (2, f"{once} " + f"{once} " * 12_000), (3, "abcdefgh " * 45_000), (4, "abcdefgh abcdefgh")]
    got = {x.doc_id: x.fingerprint for x in simhash.with_near(simhash.edited_fingerprints(documents(rows))).collect()}
    assert got[3] == got[4]
    # One pair more than the reverse one: each decides the bits on which they differ.
    assert got[2] == got[1]


@pytest.mark.parametrize("blocks, radius", [(16, 15), (8, 15), (6, 15), (4, 15), (4, 3), (6, 0)])
def test_no_fingerprint_within_the_radius_is_missed(spark, blocks, radius):
    r = random.Random(4)
    base = [r.getrandbits(128) for _ in range(30)]
    some = (0, 1, 2, 3, 3, 4, 12, 14, 15, 15, 15, 16)
    points = sorted({b ^ sum(1 << k for k in r.sample(range(128), n)) for b in base for n in some})
    # Differing bits that fill some blocks as evenly as can be.
    points += [base[0] ^ sum(1 << (k * 8) for k in range(15)), base[0] ^ sum(1 << (k * 32 + 7 * j) for k in range(4) for j in range(4 - (k == 3)))]
    halves = lambda x: tuple(int(np.int64(np.uint64(h))) for h in (x & (2**64 - 1), x >> 64))
    table = spark.createDataFrame([(*halves(p), i, 1) for i, p in enumerate(points)], "f0 long, f1 long, representative long, copies long")
    asked = spark.createDataFrame([halves(b) for b in base], "f0 long, f1 long")
    got = {(x.q0, x.q1, x.representative, x.distance) for x in simhash.near_members(table, asked, radius, blocks).collect()}
    assert got == {(*halves(b), i, bin(b ^ p).count("1")) for b in base for i, p in enumerate(points) if bin(b ^ p).count("1") <= radius}


def test_probes_do_not_all_go_to_the_driver(spark):
    table = spark.createDataFrame([(i, -i, i, 1) for i in range(50)], "f0 long, f1 long, representative long, copies long")
    met = simhash.near_members(table, table.filter("representative = 7"), blocks=6)
    assert {x.representative for x in met.collect() if x.distance == 0} == {7}
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString()


def test_keys_grow_with_the_fingerprints():
    assert [simhash.blocks_for(10**n, 15) for n in (2, 5, 7, 9)] == [16, 8, 6, 4]


def test_near_documents_are_found_with_their_copies_and_ids(spark):
    r = random.Random(5)
    base = [r.getrandbits(128) for _ in range(6)]
    points = [b ^ sum(1 << k for k in r.sample(range(128), n)) for b in base for n in (0, 0, 0, 1, 6, 9, 13, 15, 16, 30)]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    rows = [(i, signed(p & (2**64 - 1)), signed(p >> 64)) for i, p in enumerate(points)]
    got = {x.doc_id: x for x in simhash.with_near(spark.createDataFrame(rows, "doc_id long, f0 long, f1 long"), every=10).collect()}
    assert len(got) == len(points)
    for i, x in got.items():
        assert x.representative == points.index(points[i])
        if i % 10:
            assert x.n_near is None and x.near is None
            continue
        near = [j for j, p in enumerate(points) if bin(p ^ points[i]).count("1") <= 15]
        assert x.n_near == len(near) - 1 >= 7
        listed = {y.representative: (y.distance, y.copies) for y in x.near}
        assert {j for j in got if got[j].representative in listed} == set(near)
        assert all(d == bin(points[j] ^ points[i]).count("1") and n == points.count(points[j]) for j, (d, n) in listed.items())


# -- 5 -------------------------------------------------------------------


def test_bpe_equals_the_library_and_round_trips(documents):
    r = random.Random(6)
    texts = ODD + ["".join(chr(r.randrange(32, 0x2FFF)) for _ in range(500)), "ab" * 300, "\n\n  \t x", "don't we'll", prose(1, 200)]
    docs = documents(list(enumerate(texts)))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    wanted = {i: known.encode_ordinary(t or "") for i, t in enumerate(texts)}
    for x in bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect():
        assert x.token_ids == wanted[x.doc_id]
        assert bytes(x.decoded).decode() == (texts[x.doc_id] or "") and x.size == "clash"
    for x in bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN).collect():
        ids = wanted[x.doc_id]
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256((texts[x.doc_id] or "").encode()).hexdigest()
    assert bpe.encode_digests(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0


# -- 6 -------------------------------------------------------------------


def test_cartesian_nodes_match_their_definition():
    rng = np.random.default_rng(8)
    for n, span in ((30, 5), (7, 7), (200, 11)):
        tokens = rng.integers(0, 40, n).astype(np.uint64)
        from quotewright.llm.wordhash import mix

        h = mix(tokens ^ np.uint64(3 * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        left, at, right = passages.compact_windows(tokens, span, 3)
        for l, c, r in zip(left, at, right):
            assert l <= c <= r and r - l + 1 >= span
            assert h[l : r + 1].min() >> 16 == h[c] >> 16
        assert sorted(s for l, r in zip(left, right) for s in range(l, r - span + 2)) == list(range(n - span + 1))


def _sets(words, span, width=5):
    shingles = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    return [set(shingles[i : i + span]) for i in range(len(shingles) - span + 1)]


def test_passages_cover_every_near_window_of_a_brute_force_search(documents):
    rng = random.Random(5)
    line, pool = [f"line{i}" for i in range(30)], [[f"p{k}_{i}" for i in range(80)] for k in range(3)]
    texts = {}
    for doc in range(1, 13):
        words = [f"own{doc}_{i}" for i in range(rng.randrange(5, 70))] + line
        for k in rng.sample(range(3), rng.randrange(3)):
            part = list(pool[k])[rng.randrange(10) : 80 - rng.randrange(10)]
            if rng.random() < 0.6:
                at = rng.randrange(5, len(part) - 5)
                part[at : at + rng.randrange(2)] = [f"edit{doc}"]
            words += part + [f"gap{doc}_{k}_{i}" for i in range(rng.randrange(30))] + line
        texts[doc] = words
    found = passages.repeated_passages(documents([(d, " ".join(w)) for d, w in texts.items()])).collect()
    span, near = passages._SPAN, 0
    windows = {d: _sets(w, span) for d, w in texts.items()}
    for doc in texts:
        for i, own in enumerate(windows[doc]):
            if any(4 * len(own & other) >= 3 * len(own | other) for d in texts if d < doc for other in windows[d]):
                near += 1
                middle = i + 25
                assert any(x.doc_id == doc and x.start_word <= middle < x.end_word for x in found), (doc, i)
    assert near > 100
    for x in found:
        assert x.source_doc_id < x.doc_id and x.end_word - x.start_word >= passages.MIN_WORDS
        mine = _sets(texts[x.doc_id][x.start_word : x.end_word], x.end_word - x.start_word - 4)[0]
        n, there = len(mine), texts[x.source_doc_id][x.source_start :]
        ranges = (_sets(there[:k], k - 4)[0] for k in range(5, len(there) + 1) if 3 * n <= 4 * (k - 4) and 3 * (k - 4) <= 4 * n)
        assert any(4 * len(mine & other) >= 3 * len(mine | other) for other in ranges), x


def test_texts_that_share_a_line_and_nothing_else_have_no_windows():
    line = " ".join(f"line{i}" for i in range(30))
    texts = [" ".join(f"a{d}_{i}" for i in range(60)) + " " + line + " " + " ".join(f"b{d}_{i}" for i in range(60)) for d in range(20)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(20)), "text": texts})
    for parts in (1, 3):
        sent = pa.Table.from_batches(passages._sent(parts)([batch])).combine_chunks()
        marks = [[] for _ in texts]
        for part in range(parts):
            for row in passages._repeated_bits(sent.filter(pc.equal(sent["part"], part))).to_pylist():
                marks[row["doc_id"]].append({"part": row["part"], "bits": row["bits"]})
        tokens = passages._tokens([t.encode() for t in texts])
        again = passages._repeated(np.concatenate(tokens), np.array([len(t) for t in tokens]), marks, parts)
        # Exactly the shingles within the line occur in other texts.
        assert again.reshape(20, -1).sum(axis=1).tolist() == [26] * 20
        assert again.reshape(20, -1)[:, 60:86].all()
        asked = pa.RecordBatch.from_pydict({"doc_id": list(range(20)), "text": texts, "marks": marks})
        assert list(passages._windows(parts)([asked])) == []


def test_windows_of_one_word_said_often_are_taken_together():
    tokens = passages._tokens([" ".join(["again"] * 200).encode()])[0]
    low, at, high = passages.compact_windows(tokens, passages._SPAN, 1)
    assert len(at) == 200 - passages.MIN_WORDS + 1
    left, anchor, right = passages._merged(tokens, low, at, high)
    assert anchor.tolist() == list(range(0, 151, passages._SPAN // 2))
    assert left.tolist() == anchor.tolist() and right.max() == high.max()


def test_passages_are_found_whole_and_clean_texts_left_alone(documents):
    shared, changed = prose("p", 80), prose("p", 80).split()
    changed[70] = "other"
    rows = [(1, prose(1, 90) + " " + shared + " " + prose(2, 70)), (2, prose(3, 40) + " " + shared), (3, prose(4, 300)), (4, " ".join(changed) + " " + prose(5, 60))]
    rows += [(10 + i, t) for i, t in enumerate(ODD)] + [(40 + i, prose(6, 120)) for i in range(5)]
    got = {}
    for x in passages.repeated_passages(documents(rows)).collect():
        got.setdefault(x.doc_id, []).append((x.start_word, x.end_word, x.source_doc_id, x.source_start))
    assert got.pop(2) == [(40, 120, 1, 90)]
    assert got.keys() == {4, 41, 42, 43, 44}
    assert all(got[i] == [(0, 120, 40, 0)] for i in range(41, 45))
    assert all(s == 1 and a <= 5 and b >= 70 for a, b, s, _ in got[4])
    assert passages.repeated_passages(documents([])).count() == 0


def test_dense_tokens_are_those_of_a_brute_force_search():
    rng, core = np.random.default_rng(2), passages._CORE
    counts = np.array([30, 0, 150, core, 90, core - 1])
    for share in (0.6, 0.7, 0.75, 0.9, 1):
        paired = rng.random(counts.sum()) < share
        want = np.zeros(len(paired), bool)
        for end, n in zip(np.cumsum(counts), counts):
            for i in range(end - n, end):
                for j in range(i + core, end + 1):
                    if 4 * paired[i:j].sum() >= 3 * (j - i):
                        want[i:j] = True
        assert passages._dense(paired, counts).tolist() == want.tolist(), share


def test_pairs_without_a_dense_part_are_refuted_together(monkeypatch):
    own = [f"a{i}" for i in range(100)]
    texts = {1: own, 2: own[:30] + [f"b{i}" for i in range(60)], 3: [f"c{i}" for i in range(20)] + own[10:90], 4: own[60:] + own[:30]}
    tokens = {d: tokens_of(w) for d, w in texts.items()}
    anchors = {2: [(5, 5)], 3: [(30, 20), (60, 50)], 4: [(5, 65), (45, 5)]}
    want = [
        (d, x, x + n + passages.WIDTH - 1, 1, y) for d, at in anchors.items() for x, y, n in passages._stretches(tokens[d], tokens[1], at)
    ]
    asked, stretches = [], passages._stretches
    monkeypatch.setattr(passages, "_stretches", lambda a, *more: asked.append(len(a)) or stretches(a, *more))
    rows = {
        "doc_id": list(anchors), "source": [1] * 3, "begin": [0] * 3, "c": [[c for c, _ in at] for at in anchors.values()],
        "d": [[d for _, d in at] for at in anchors.values()], "part": [tokens[d].tobytes() for d in anchors], "text": [" ".join(own)] * 3,
    }
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.int64()), ("begin", pa.int32()), ("c", pa.list_(pa.int32())), ("d", pa.list_(pa.int32())), ("part", pa.binary()), ("text", pa.string())])
    batch = pa.RecordBatch.from_pydict(rows, schema)
    for size in (1 << 20, 1):
        monkeypatch.setattr(passages.wordhash, "CHUNK_BYTES", size)
        asked.clear()
        got = [x for out in passages._verified([batch, batch.slice(0, 0)]) for x in zip(*(c.to_pylist() for c in out.columns))]
        assert got == want and {x[0] for x in got} == {3}
        # The second one is not compared; the others may hold a stretch as far as their tokens tell.
        assert asked == [len(tokens[3]), len(tokens[4])]


def test_words_are_counted_in_copies_only(spark, documents):
    docs = documents([(i, prose(i % 7, 60)) for i in range(20)])
    plan = passages._copies(docs.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "regexp" in line]
    assert len(counted) == 1 and plan.index(counted[0]) < plan.index("Join")


def test_functions_miss_fewer_than_one_in_a_thousand_at_the_threshold():
    n, p = passages.HASHES, 0.75
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(passages.AGREE)) < 1e-3


def tokens_of(words):
    return passages._tokens([" ".join(words).encode()])[0]


def test_a_stretch_is_the_longest_around_its_anchor():
    r = random.Random(14)
    for _ in range(200):
        x = y = 0
        parts = []
        for _ in range(r.randrange(1, 9)):
            n = r.randrange(1, 40)
            parts.append((x, y, n))
            x, y = x + n + r.randrange(6), y + n + r.randrange(6)
        at = r.randrange(len(parts))
        longest = -1
        for i in range(at + 1):
            for j in range(at, len(parts)):
                m = sum(p[2] for p in parts[i : j + 1])
                a, b = (parts[j][k] + parts[j][2] - parts[i][k] for k in (0, 1))
                if 7 * m >= 3 * (a + b):
                    longest = max(longest, a)
        i, j, _ = passages.longest_stretch(np.array(parts), at)
        assert i <= at <= j and parts[j][0] + parts[j][2] - parts[i][0] == longest


@pytest.mark.parametrize("words, edit", [(52, 12), (55, 14), (60, 20)])
def test_an_edited_word_does_not_cost_the_front(words, edit):
    passage = prose(f"e{words}", words).split()
    changed = [*passage[:edit], "other", *passage[edit + 1 :]]
    a, b = tokens_of(prose(1, 40).split() + changed + prose(2, 40).split()), tokens_of(prose(3, 90).split() + passage + prose(4, 30).split())
    assert passages._stretches(a, b, [(40 + edit + 5, 90 + edit + 5)]) == [(40, 90, words - 4)]


@pytest.mark.parametrize("words", [60, 75, 95])
def test_words_put_in_or_left_out_do_not_part_a_passage(words):
    passage = prose(f"i{words}", words).split()
    half = words // 2
    for changed in ([*passage[:half], "other", *passage[half:]], passage[:half] + passage[half + 1 :]):
        a, b = tokens_of(prose(1, 40).split() + changed + prose(2, 40).split()), tokens_of(prose(3, 90).split() + passage + prose(4, 30).split())
        assert passages._stretches(a, b, [(45, 95)]) == [(40, 90, len(changed) - 4)]


def test_a_passage_behind_many_windows_of_a_frequent_key_is_found(documents):
    # A line of 30 words is in all texts, no passage by itself; 21 and 24 also share what is around it.
    line = prose("hot", 30)
    texts = {i: prose(f"a{i}", 30) + " " + line + " " + prose(f"b{i}", 30) for i in range(25)}
    texts[24] = prose("c24", 40) + " " + texts[21].split(" ", 15)[-1].rsplit(" ", 20)[0] + " " + prose("d24", 20)
    # 31 is near 30, 32 is near 31 but not near 30.
    words = prose("link", 60).split()
    one, two = list(words), list(words)
    one[30] = two[30] = "other"
    two[10] = two[50] = "more"
    texts |= {30: " ".join(words), 31: " ".join(one), 32: " ".join(two)}
    got = {(x.doc_id, x.source_doc_id) for x in passages.repeated_passages(documents(list(texts.items()))).collect()}
    assert {(24, 21), (31, 30), (32, 31)} <= got
    assert {x[0] for x in got} == {24, 31, 32}


def test_a_periodic_text_repeats_in_pieces_that_do_not_overlap(documents):
    words = prose("period", 70).split() * 6
    got = [(x.start_word, x.end_word, x.source_start) for x in passages.repeated_passages(documents([(1, " ".join(words))])).collect()]
    assert all(words[a:b] == words[c : c + b - a] and c + b - a <= a for a, b, c in got)
    assert {k for a, b, _ in got for k in range(a, b)} >= set(range(76, 416))


def test_marks_of_repeated_tokens_equal_a_count(monkeypatch):
    r = random.Random(9)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(0, 90))) for _ in range(40)] + ["", None, "x"]
    monkeypatch.setattr(passages.wordhash, "CHUNK_BYTES", 400)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    tokens = [passages._tokens([(t or "").encode()])[0] for t in texts]
    # Equal to what another text or the text itself has; parts compare 32 bits and the part.
    parts = 7
    sent = pa.Table.from_batches(passages._sent(parts)(iter([batch])))
    rows: dict[int, list] = {}
    for part in range(parts):
        for x in passages._repeated_bits(sent.filter(pc.equal(sent["part"], part))).to_pylist():
            rows.setdefault(x.pop("doc_id"), []).append(x)
    kind = pa.list_(pa.struct([("part", pa.int64()), ("bits", pa.binary())]))
    marks = pa.array([rows.get(i) for i in range(len(texts))], kind)
    flat = np.concatenate(tokens)
    values, counts = np.unique(flat, return_counts=True)
    wanted = counts[np.searchsorted(values, flat)] > 1
    sizes = np.array([len(t) for t in tokens])
    assert 0 < wanted.sum() < len(wanted)
    assert passages._repeated(flat, sizes, marks, parts).tolist() == wanted.tolist()
    half = int(sizes[:20].sum())
    assert passages._repeated(flat[half:], sizes[20:], marks.slice(20), parts).tolist() == wanted[half:].tolist()
    assert not passages._repeated(np.arange(3, dtype=np.uint64), np.array([3]), pa.array([None], kind), parts).any()


def test_texts_nobody_asks_for_are_not_exchanged(spark):
    ids = spark.range(5).withColumnRenamed("id", "doc_id")
    plan = lambda few: spark.range(100).withColumnRenamed("id", "doc_id").join(few, "doc_id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(passages._few(ids)) and "BroadcastHashJoin" not in plan(ids)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# -- 7 -------------------------------------------------------------------


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}


def test_near_duplicates_equal_all_pairs(documents):
    r = random.Random(9)
    texts = list(ODD) + ["A b C"]
    for k in range(12):
        base = prose(f"n{k}", r.choice([4, 30, 200])).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(WORDS)
            texts.append(" ".join(copy))
    # A chain whose ends are far apart, and a large group of near copies.
    texts += [prose("chain", 260).split(" ", 20 * i)[-1].rsplit(" ", 100 - 20 * i)[0] for i in range(5)]
    texts += [prose("big", 100) + f" end{i}" for i in range(60)]
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    for x in minhash.near_duplicates(documents(list(enumerate(texts)))).collect():
        assert (x.n_shingles, x.component_id) == (len(sets[x.doc_id]), find(x.doc_id)), texts[x.doc_id]
        assert x.kept == (x.component_id == x.doc_id)
    assert minhash.near_duplicates(documents([])).count() == 0


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 2**63, 500).astype(np.uint64)
    a, b = np.sort(items[:400]), np.sort(items[100:])
    one, two = minhash.signatures([a, b])
    assert abs((one == two).mean() - 0.6) < 0.15
    assert (minhash.signatures([a])[0] == one).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 230)] + [(5, 5), (None, 3)]
    got = {x.node: x.component for x in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {x: 7 for x in range(200, 230)}


# -- 8 -------------------------------------------------------------------


def test_plain_spans_equal_the_patterns():
    email, ip = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    r = random.Random(3)
    for _ in range(5000):
        t = "".join(r.choice("a@.1234 +-5(") for _ in range(r.randrange(60)))
        wanted = [("email", *m.span()) for m in re.finditer(email, t)]
        wanted += [("ip", *m.span()) for m in re.finditer(ip, t) if all(int(x) <= 255 for x in m[0].split("."))]
        assert wanted == [tuple(s) for s in pii.plain_spans(t) if s.kind in ("email", "ip")]


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("mail bob [at] mail dot example dot com now", "email", "bob [at] mail dot example dot com"),
        ("write anna.b (at) mail2.example.com.", "email", "anna.b (at) mail2.example.com"),
        ("é jo＠ex.com x", "email", "jo＠ex.com"),
        ("john​@exa​mple.com", "email", "john​@exa​mple.com"),
        ("card ４111 1111 1111 1111 x", "card", "４111 1111 1111 1111"),
        ("call plus four nine one five one two three four five six today", "phone", "plus four nine one five one two three four five six"),
    ],
)
def test_disguises_map_back(text, kind, source):
    plain, added = pii.find_spans(text)
    assert [(s.kind, text[s.start : s.end]) for s in added] == [(kind, source)]


@pytest.mark.parametrize(
    "text, kind",
    [
        ("\u0430lice@example.com", "email"), ("alice@example.c\u043em", "email"), ("j\u043ehn@example.com", "email"),
        ("192 dot 168 dot 0 dot 1", "ip"), ("192[.]168[.]0[.]1", "ip"), ("192.168(.)0 [dot] 1", "ip"), ("bob@example[.]com", "email"),
    ],
)
def test_disguises_that_leave_a_fragment_and_dots_of_numbers(text, kind):
    for before, after in (("", ""), ("see ", " now")):
        plain, added = pii.find_spans(before + text + after)
        assert added == [(kind, len(before), len(before) + len(text))]
    assert pii.find_spans("point 3 dot 4 and 1 dot 2 dot 3") == ([], [])
    assert pii.find_spans("999 dot 168 dot 0 dot 1") == ([], [])


def test_prose_is_no_personal_data(documents):
    for text in ("we met at home", "seven eight nine", "look at this. dot", "1" * 5000, "a" * 5000 + "@", "+" * 2000):
        assert pii.find_spans(text) == ([], [])
    got = pii.span_digests(odd(documents)).collect()
    assert len(got) == len(ODD) and {x.spans for x in got} == {""}
    found = pii.spans(documents([(1, "a@b.cd at 1.2.3.4")])).first()
    assert [(s.kind, s.start, s.end) for s in found.spans] == [("email", 0, 6), ("ip", 10, 17)] and found.size == "clash"


# -- 9 -------------------------------------------------------------------


def test_conversations_come_back_whatever_they_say(spark):
    r = random.Random(12)
    bits = ["<|im_start|>", "<|im_end|>", "\n", "\\", "<|", "<\\|", "!", "user", "\\s", "\\n", "assistant", "ü", ""]
    rows = [(c, t, r.choice(["user", "assistant", "sys\ntem", "!x", None]), "".join(r.choices(bits, k=r.randrange(6))) or None) for c in range(60) for t in range(r.randrange(1, 5))]
    rows += [(99, None, "user", "a"), (99, 1, "user", "a"), (99, 1, "user", "a"), (None, 1, "user", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = chat.format_conversations(table)
    got = {x.conv_id: x for x in chat.digests(talks).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c in {x[0] for x in rows}:
        turns = sorted((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == c)
        said = "".join(x[3] for x in turns if x[2] == "assistant")
        x = got[c]
        assert x.identical and x.n_turns == len(turns)
        assert x.turns_sha256 == sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        assert (x.loss_chars, x.loss_sha256) == (len(said), sha(said))
    assert {x.conv_id: len(x.formatted) for x in talks.collect()} == {c: x.formatted_chars for c, x in got.items()}
    assert chat.digests(chat.format_conversations(table.limit(0))).count() == 0


# -- 10 ------------------------------------------------------------------


def test_later_line_runs_go(documents):
    r = random.Random(13)
    rows = [(i, "\n".join(r.choice(["a", "b", "c", "d", "", "  ", f"u{i}"]) for _ in range(r.randrange(1, 12)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200, rows[0][1]), (201, "same\n" * 40)]
    seen, wanted = set(), {}
    for i, text in rows:
        lines = [(k, x) for k, x in enumerate((text or "").split("\n")) if x.strip(" \t\n\r\x0b\f")]
        gone = set()
        for (k, x), (m, y) in zip(lines, lines[1:]):
            gone |= {k, m} if (x, y) in seen else set()
            seen.add((x, y))
        wanted[i] = (len(lines), sorted(gone))
    for x in linedup.deduplicated(documents(rows)).collect():
        n, gone = wanted[x.doc_id]
        assert (x.n_lines, x.deleted) == (n, gone) and x.size == "clash"
        whole = dict(rows)[x.doc_id]
        assert x.text == (whole if not gone else "\n".join(t for k, t in enumerate(whole.split("\n")) if k not in gone))
    assert linedup.line_digests(documents([])).count() == 0


def test_lines_go_by_number(spark):
    cases = [("a\nb\nc\nd", [0, 2]), ("a\nb", [0, 1]), ("", [0]), ("a\n\nb\n", [1, 1, 1]), ("a\nb", [1, 1, 5, 9]), ("a", [])]
    table = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(cases)], "i int, text string, deleted array<long>")
    got = [r.t for r in table.select("i", linedup._without(F.col("text"), F.col("deleted")).alias("t")).orderBy("i").collect()]
    assert got == ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in d) for t, d in cases]


def test_a_run_names_the_place_it_was_copied_from(documents):
    rows = [(1, "x\nl1\nl2\nl3\nl4\ny"), (2, "l1\nl2\nz"), (3, "q\nl1\nl2\nl3\nl4\nr")]
    got = [(x.doc_id, x.start, x.lines, x.deleted, x.source_doc_id, x.source_place) for x in linedup.repeated_runs(linedup.line_ids(documents(rows))).orderBy("doc_id").collect()]
    assert got == [(2, 0, 2, [0, 1], 1, 1), (3, 1, 4, [1, 2, 3, 4], 1, 1)]


def test_the_query_deletes_single_long_lines(documents):
    long, short = prose("long", 50), prose("short", 49)
    rows = [(1, f"a\n{long}\nb\n{short}"), (2, f"c\n{long}\n\nd\n{short}\ne"), (3, long), (4, f"{long}\nf\n{long}")]
    got = {x.doc_id: (x.n_lines, x.n_deleted, x.deleted) for x in linedup.line_digests(documents(rows)).collect()}
    assert got == {1: (4, 0, ""), 2: (5, 1, "1"), 3: (1, 1, "0"), 4: (3, 2, "0,2")}


def test_the_pipeline_deletes_single_long_lines(spark, documents):
    long, short = prose("long", 50), prose("short", 49)
    rows = [(1, f"a\n{long}\nb\n{short}"), (2, f"c\n{long}\n\nd\n{short}\ne"), (3, long), (4, f"{long}\nf")]
    got = {x.doc_id: x.text for x in corpus_pipeline.drop_repeated_lines(spark, documents(rows), "").collect()}
    assert got == {1: rows[0][1], 2: f"c\n\nd\n{short}\ne", 4: "f"}
    runs = linedup.repeated_runs(linedup.line_ids(documents(rows)), long_words=50).collect()
    assert {(x.doc_id, x.start, x.lines, x.source_doc_id, x.source_place) for x in runs} == {(i, p, 1, 1, 1) for i, p in ((2, 1), (3, 0), (4, 0))}
