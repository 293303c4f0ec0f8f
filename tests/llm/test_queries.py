"""The registered queries and the pipeline, run as they are registered on the smallest given tables."""

import re
from collections import Counter, defaultdict
from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from citylode.llm.queries import ORACLES, QUERIES
from tools.compare import TABLES, rows_of

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got_columns, got, _ = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    want_columns, want, _ = rows_of([d[0] for d in result.description], result.fetchall())
    assert got_columns == want_columns and Counter(got) == Counter(want) and got


@pytest.mark.parametrize(("name", "threshold", "parts", "held", "label", "least"), [
    ("op1_quality", 0.5, 3, 1, "quality", 0.95), ("op7_toxicity", 0.3, 4, 2, "toxic", 0.85)])
def test_scores(spark, name, threshold, parts, held, label, least):
    """On a table with labels enough to learn from; accuracy on held-out rows."""
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES[name](spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(list(texts))
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % parts == held) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    hits = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert len(hits) > 50 and np.mean(hits) >= least
    by_text = defaultdict(set)
    for r in got:
        by_text[texts[r.doc_id]].add(r.score)
    assert all(len(scores) == 1 for scores in by_text.values())  # nothing but the text counts


def test_token_queries(spark, texts):
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    ids = {i: [*encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    start, want = 0, {}
    for i in sorted(ids):
        want[i] = (start, len(ids[i]), crc32(np.array(ids[i], "<u4").tobytes()))
        start += len(ids[i])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_files"](spark, SF).collect()} == want
    assert {r.doc_id: r.n_tokens for r in QUERIES["op6_token_counts"](spark, SF).collect()} == {
        i: len(x) - 1 for i, x in ids.items()}


def test_packing_query(spark, texts):
    """Every document lies in sequences as a whole, and no sequence holds more than its length."""
    got = QUERIES["op2_packing"](spark, SF).collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    assert_packed(got, words)


def assert_packed(rows, words):
    held = defaultdict(int)
    sizes, placed = {}, Counter()
    for r in rows:
        if r.bin_id is not None:
            held[r.bin_id] += r.length
            sizes[r.bin_id] = r.capacity
        placed[r.doc_id] += r.length
    assert all(held[b] <= sizes[b] for b in held)
    assert {i: n for i, n in placed.items() if n} == {i: n for i, n in words.items() if n}


def test_mixing_query(spark, texts):
    got = QUERIES["op10_mixing"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts) and all(r.rate >= 0 for r in got)


def test_neighbour_query(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    vectors = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    got = defaultdict(dict)
    for r in QUERIES["op12_neighbours"](spark, SF).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for q, found in got.items():
        score = vectors @ vectors[ids == q][0]
        best = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)[:20]
        assert [found[k + 1][0] for k in range(20)] == [i for _, i in best]
        assert np.allclose([found[k + 1][1] for k in range(20)], [-s for s, _ in best], rtol=1e-12)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows], float)) + 100_000
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    got = QUERIES["op13_whitening"](spark, SF).collect()
    assert len(got) == 8 * len(rows) and max(r.identity_error for r in got) < 1e-9
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    n, sums = len(rows), x.sum(axis=0)
    want = {r.vec_id: int(((n * v - sums) ** 2).sum()) for r, v in zip(rows, x, strict=True)}
    assert all(r.deviation == want[r.vec_id] for r in got)


def shingles(text, size=5):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_pipeline_stage_by_stage(spark, texts):
    """What each stage keeps of its input, by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    clean = stages["toxicity"](spark, docs, SF).cache()
    labelled = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic is not None}
    kept = {r.doc_id for r in clean.collect()}
    harmless, toxic = ({i for i, t in labelled.items() if t == k} for k in (0, 1))
    assert clean.columns == columns and kept <= set(texts)
    assert len(harmless - kept) <= 0.05 * len(harmless) and len(kept & toxic) <= 0.2 * len(toxic)

    unique = stages["exact_dedup"](spark, clean, SF).cache()
    newest = {}
    for r in clean.collect():
        newest[r.text or ""] = max(newest.get(r.text or "", r.doc_id), r.doc_id)
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == set(newest.values())

    near = stages["near_dedup"](spark, unique, SF).cache()
    rows = unique.collect()
    sets = {r.doc_id: shingles(r.text or "") for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    names = sorted(sets)
    for n, a in enumerate(names):
        for b in names[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert near.columns == columns and {r.doc_id for r in near.collect()} == {find(i) for i in names}

    mixed = stages["mixing"](spark, near, SF).cache()
    assert mixed.columns == columns
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in near.collect()}
    lengths = Counter()
    for r in mixed.collect():
        lengths[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert_packed(stages["packing"](spark, mixed, SF).collect(), lengths)


def test_pipeline_as_a_whole(spark, texts):
    """The same rows on every run, of documents that no stage has dropped."""
    once, again = (sorted(map(tuple, QUERIES["pipeline"](spark, SF).collect()), key=str) for _ in range(2))
    assert once == again and once
    assert {r[0] for r in once} <= set(texts)
