"""Odd tables for every operator and pipeline stage: nulls, repeated rows, clashing names, long texts, no rows."""

import random
import re

import pytest
import tiktoken.load
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from quotewright.llm import bpe, langid, linedup, minhash, mixing, passages, periods, pii, simhash, toxicity, wordhash

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = [f"w{i}" for i in range(3000)]
#: Names that the operators give to columns of their own.
NAMES = (
    "_id _of _copies _copy _row row key n_lines deleted size toxic features label margin held_out score predicted source_size target taken copies "
    "n place line id words f0 f1 kind sha rank part bands items component_id kept links rep s1 s2 runs tiles spans lang_pred text_sha256 rows unit bucket"
).split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


LONG = prose(1, 30_000)
ROWS = [
    (1, prose(2, 60), "a"), (2, prose(3, 60), "b"), (2, prose(3, 60), "b"), (3, None, "a"), (4, "", None), (5, " \n\t ", "a"), (6, "one", None),
    (7, LONG, "b"), (8, prose(2, 60), "b"), (9, prose(2, 60) + " end", "a"), (None, prose(2, 60), "a"), (None, None, None), (10, "l one\nl two\nl one\nl two", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if t else None, s, len(t or "")) for i, t, s in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({n: F.lit(f"own {n}") for n in NAMES})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(1, 11)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "toxicity": lambda docs, labels: toxicity.score(docs, labels),
    "mix": lambda docs, _: mixing.mix(docs),
    "mixed": lambda docs, _: mixing.mixed(docs),
    "simhash": lambda docs, _: simhash.with_near(simhash.edited_fingerprints(docs)),
    "bpe": lambda docs, _: bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN),
    "passages": lambda docs, _: passages.repeated_passages(docs),
    "minhash": lambda docs, _: minhash.near_duplicates(docs),
    "pii": lambda docs, _: pii.span_digests(docs),
    "lines": lambda docs, _: linedup.deduplicated(docs),
    "langid": lambda docs, _: langid.predict(docs),
    "periods": lambda docs, _: periods.run_digests(periods.with_planted_runs(docs)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_names(odd, labels, name):
    got = OPERATORS[name](odd, labels).collect()
    ids = sorted((r.doc_id for r in got), key=str)
    # One result for each input row where nothing else is the contract.
    if name in ("toxicity", "bpe", "pii", "lines", "langid", "periods"):
        assert ids == sorted((i for i, _, _ in ROWS), key=str)
    if name in ("simhash", "minhash"):
        assert ids == sorted((i for i, _, _ in ROWS if i is not None), key=str)
    if name == "simhash":
        assert len({r.fingerprint + r.edited_sha256 for r in got if r.doc_id == 2}) == 1
    if name == "mixed":
        assert all(r[n] == f"own {n}" for r in got for n in NAMES)
    if name == "lines":
        assert all(r[n] == f"own {n}" for r in got for n in NAMES if n not in ("n_lines", "deleted"))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd, labels, name):
    assert OPERATORS[name](odd.limit(0), labels).count() == 0


def test_a_single_document_follows_itself(odd):
    (row,) = simhash.edited_fingerprints(odd.filter("doc_id = 1")).collect()
    assert row.near_next == 1.0


@pytest.mark.parametrize("size", [63, 64, 65, 200])
def test_long_pieces_take_the_other_path_with_equal_ids(documents, size):
    texts = ["x" * size, "ab" * (size // 2), "é" * (size // 2), "a" + "漢" * (size // 3)]
    got = bpe.encode(documents(list(enumerate(texts))), RANKS, public_tokenizers.PATTERN)
    ranks = tiktoken.load.load_tiktoken_bpe(RANKS)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id: list(r.token_ids) for r in got.collect()} == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_second_person_words_are_found_by_bisection():
    places = [3, 40, 41, 90]
    assert [i for i in range(100) if toxicity._beside(i, places)] == [i for i in range(100) if any(abs(i - p) <= toxicity.NEAR for p in places)]


# -- the pipeline ----------------------------------------------------------------


def plain_lines(rows):
    """Later copies of runs of two lines, and of single lines of LONG_LINE words, are cut out; texts left without a line go."""
    seen, out = {}, []
    keyed = sorted(((i, t) for i, t in rows), key=lambda r: r[0])
    solid = {i: [(n, x) for n, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for i, t in keyed}
    gone = {i: set() for i, _ in keyed}
    for i, _ in keyed:
        for k, (n, x) in enumerate(solid[i]):
            if len(x.split()) >= linedup.LONG_LINE:
                if ("long", x) in seen:
                    gone[i].add(n)
                seen.setdefault(("long", x), i)
            if k + 1 < len(solid[i]):
                pair = (x, solid[i][k + 1][1])
                if pair in seen:
                    gone[i] |= {n, solid[i][k + 1][0]}
                seen.setdefault(pair, i)
    for i, t in rows:
        if not gone[i] or len(gone[i]) < len(solid[i]):
            out.append((i, t if not gone[i] else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])))
    return out


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_groups(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: root(i) for i in ids}


@pytest.fixture(scope="module")
def corpus(spark, labels):
    r = random.Random(4)
    rows = []
    for i in range(160):
        lines = [prose(100 + i * 7 + k, r.randrange(5, 30)) for k in range(r.randrange(1, 5))]
        if i % 10 == 3:
            lines[0] = "you vile zork " * 6 + lines[0]
        if i % 6 == 5:
            lines += ["footer one of all", "footer two of all"]
        if i % 9 == 8:
            lines.append(prose(5, 60))
        rows.append((i, "\n".join(lines), "s" + str(i % 3)))
    rows += [(200 + i, rows[i][1] + " tail", "s9") for i in range(0, 60, 10)] + [(300, rows[1][1], "s0"), (300, rows[1][1], "s0"), (301, None, None), (302, "", "s1")]
    rows += [(303, prose(77, 40), "s1"), (303, prose(77, 40), "s1"), (None, prose(78, 40), "s1"), (None, prose(78, 40), "s1"), (None, rows[1][1], "s2")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({n: F.lit(f"own {n}") for n in NAMES})


@pytest.fixture(scope="module")
def sf_dir(spark, corpus, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    corpus.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    rows = [(i, 1, int(i % 10 == 3)) for i in range(160)]
    corpus.sparkSession.createDataFrame(rows, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return folder


def pairs_of(docs):
    return sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)


def test_stages_against_plain_python(spark, corpus, sf_dir):
    keyed = corpus.select(corpus_pipeline._key().alias("doc_id"), "text")
    clean = corpus_pipeline.drop_toxic(spark, corpus, sf_dir)
    toxic = {r.doc_id for r in corpus.select("doc_id").collect()} - {r.doc_id for r in clean.select("doc_id").collect()}
    assert {i for i in range(160) if i % 10 == 3 and i % 4 != 2} & toxic and all(i % 10 == 3 or i >= 200 for i in toxic)
    assert clean.columns == corpus.columns

    lines = corpus_pipeline.drop_repeated_lines(spark, corpus, sf_dir)
    names = {(r.doc_id, r.text): r.key for r in corpus.select("doc_id", "text", corpus_pipeline._key().alias("key")).collect()}
    want = plain_lines([(names[r.doc_id, r.text], r.text) for r in corpus.select("doc_id", "text").collect()])
    assert sorted(t or "" for _, t in want) == sorted(t or "" for _, t in pairs_of(lines))
    assert lines.columns == corpus.columns and lines.filter("n_chars != length(text)").count() == 0

    near = corpus_pipeline.drop_near_duplicates(spark, corpus, sf_dir)
    rows = [(r.doc_id, r.text) for r in keyed.collect()]
    groups = plain_groups(dict(rows).items())
    kept = sorted({(i, t) for i, t in rows if groups[i] == i}, key=str)
    got = sorted(((r.doc_id, r.text) for r in near.select(corpus_pipeline._key().alias("doc_id"), "text").collect()), key=str)
    assert got == kept and near.columns == corpus.columns

    mixed = corpus_pipeline.mix_sources(spark, corpus, sf_dir)
    copies = {(r.doc_id, r.source): r.copies for r in mixing.mix(corpus).collect()}
    expected = sorted((str((r.doc_id, r.source)) for r in corpus.collect() for _ in range(copies[r.doc_id, r.source])))
    assert sorted(str((r.doc_id, r.source)) for r in mixed.collect()) == expected and mixed.columns == corpus.columns

    ranks = tiktoken.load.load_tiktoken_bpe(RANKS)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in corpus_pipeline.tokenize(spark, corpus, sf_dir).collect():
        assert list(r.token_ids) == library.encode_ordinary(r.text or "") and r.n_tokens == len(r.token_ids)


def test_run_chains_the_stages(spark, corpus, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [*corpus.columns, "token_ids"] + (["n_tokens"] if "n_tokens" not in corpus.columns else [])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert pairs_of(got) == pairs_of(docs) != []
    assert all(r[n] == f"own {n}" for r in got.select(*NAMES).collect() for n in NAMES)


def test_stages_of_an_empty_table(spark, corpus, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, corpus.limit(0), sf_dir)
        assert none.count() == 0 and none.columns[: len(corpus.columns)] == corpus.columns


def test_simhash_deals_whole_texts_once(spark, monkeypatch):
    rows = [(i, f"w{i} some words of text {i}") for i in range(40)] + [(7, "another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, write = [], simhash.written

    def noted(df, name):
        if name == "stretches":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(simhash, "written", noted)
    assert simhash.edited_fingerprints(docs).count() == 41
    # Both joins read texts of one form, so that one exchange serves them; none is joined to be reduced.
    assert len(plans) == 1 and "Union" not in plans[0] and "LeftAnti" not in plans[0]


def test_texts_of_a_batch_are_decoded_chunk_by_chunk():
    decoded = []

    class Text:
        def __init__(self, text):
            self.text = text

        def as_py(self):
            decoded.append(self.text)
            return self.text

    many = [Text("x" * 1000 if i else None) for i in range(5000)]
    chunks = wordhash.chunks(wordhash.decoded(many))
    first, part = next(chunks)
    assert first == 0 and part[0] == b"" and len(decoded) == len(part) + 1 < 1100
    assert [t for _, p in [(first, part), *chunks] for t in p] == [b""] + [b"x" * 1000] * 4999
