import hashlib
import random
from collections import defaultdict

import pytest

from citylode.llm import near_dedup
from citylode.llm.components import connected_components
from citylode.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from citylode.llm.near_dedup import drop_near_duplicates, near_duplicates

SCHEMA = "doc_id bigint, text string, kept string, hub int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "own", 1) for i, t in rows], SCHEMA)


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""])) for i, t in rows)


@pytest.mark.parametrize("bits", [128, 3])
def test_exact_against_brute_force(spark, bits):
    rng = random.Random(3)
    pool = ["".join(rng.choice("abé") for _ in range(rng.choice([0, 1, 7, 8, 9, 16, 17, 40, 64, 65]))) for _ in range(40)]
    rows = [(i, rng.choice(pool)) for i in range(300)] + [(300, None), (301, ""), (302, None)]
    got = exact_duplicates(spark, frame(spark, rows), block_bytes=8, bits=bits)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == brute_exact(rows)


def test_exact_long_texts_that_differ_in_the_last_byte(spark):
    text = "word " * 30_000
    rows = [(1, text + "a"), (2, text + "b"), (3, text + "a"), (4, text)]
    got = {r.doc_id: r.keep_id for r in exact_duplicates(spark, frame(spark, rows)).collect()}
    assert got == {1: 3, 2: 2, 3: 3, 4: 4}


def test_exact_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a"), (None, "a"), (1, "b"), (1, "b"), (None, "b"), (2, "c")]
    got = exact_duplicates(spark, frame(spark, rows)).collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 3
    assert {(r.keep_id, r.group_size) for r in got} == {(None, 2), (1, 3), (2, 1)}
    kept = drop_exact_duplicates(spark, frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "kept", "hub"]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "a"), (1, "b"), (2, "c")]
    assert exact_duplicates(spark, frame(spark, [])).count() == 0
    assert drop_exact_duplicates(spark, frame(spark, [])).count() == 0


def words_of(text):
    out, word = [], b""
    for c in (text or "").encode() + b" ":
        if c in (9, 10, 11, 12, 13, 32):
            if word:
                out.append(word.lower())
            word = b""
        else:
            word += bytes([c])
    return out


def set_of(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_near(rows, k, percent=80):
    sets = {i: set_of(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def corpus(seed, n, families=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 30, 80]))] for _ in range(families)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 5])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words).title()))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n\x0b "), (n + 3, "one"), (n + 4, "ONE "), (n + 5, "a b"),
                   (n + 6, "x\x1fy z"), (n + 7, "É a"), (n + 8, "é a")]


@pytest.mark.parametrize("k", [2, 5])
def test_near_against_brute_force(spark, k):
    rows = corpus(5, 400)
    got = near_duplicates(spark, frame(spark, rows), words=k).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_near(rows, k)


@pytest.mark.parametrize("turns", [0, 2])
def test_near_large_group_in_blocks(spark, monkeypatch, turns):
    # Without further turns blocks must find all links that the first two hubs leave.
    monkeypatch.setattr(near_dedup, "TURNS", turns)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "CELL", 16)
    rows = corpus(8, 500, families=2)
    got = near_duplicates(spark, frame(spark, rows), words=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_near(rows, 2)


def test_near_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text), (7, text), (9, text + " x"), (None, text), (3, "other words entirely here now"), (4, None)]
    got = near_duplicates(spark, frame(spark, rows)).collect()
    assert sorted(((r.doc_id or 0), r.component_id, r.kept) for r in got if r.doc_id) == [
        (3, 3, True), (4, 4, True), (7, 7, True), (7, 7, True), (9, 7, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = drop_near_duplicates(spark, frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "kept", "hub"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 4, 7, 7]
    assert near_duplicates(spark, frame(spark, [])).count() == 0
    assert near_duplicates(spark, frame(spark, [(1, None), (2, " ")])).filter("kept").count() == 2
    assert drop_near_duplicates(spark, frame(spark, [])).count() == 0


def test_what_is_marked_kept_stays_and_nothing_else(spark):
    """Rows without id or words, and repeated ones, in both stages; other columns tell rows apart."""
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (None, "other words"), (None, None), (1, " "), (1, " "), (5, text), (5, text), (6, text),
            (8, None), (8, ""), (9, "nine")]
    docs = spark.createDataFrame([(i, t, f"row {n}", n) for n, (i, t) in enumerate(rows)], SCHEMA)

    def ids(df):
        return sorted((r.doc_id or 0, r.text or "") for r in df.select("doc_id", "text").collect())

    near = near_duplicates(spark, docs)
    kept = drop_near_duplicates(spark, docs)
    text_of = {(r.doc_id or 0, r.text_sha256): r.kept for r in near.collect()}
    assert len(near.filter("kept").collect()) == kept.count() == 11 and kept.dropDuplicates(["kept"]).count() == 11
    assert ids(kept) == sorted((i or 0, t or "") for i, t in rows if i != 6) and len(text_of) == 8
    exact = exact_duplicates(spark, docs)
    shas = sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in ids(drop_exact_duplicates(spark, docs)))
    assert shas == sorted((r.doc_id or 0, r.text_sha256) for r in exact.filter("kept").collect())


def test_near_very_long_text(spark):
    rng = random.Random(2)
    words = [f"t{rng.randrange(10**6)}" for _ in range(60_000)]
    other = words[:]
    other[30_000] = "changed"
    got = near_duplicates(spark, frame(spark, [(1, " ".join(words)), (2, " ".join(other)), (3, "y" * 3_000_000)]))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1), (2, 1), (3, 3)]


def test_posterior_limits():
    limits = near_dedup.least_matches(0.8)
    assert limits == sorted(limits) and 5 < limits[0] < 20 and limits[-1] < 128


def test_components(spark):
    path = [(i, i + 1) for i in range(50)]
    star = [(1000, i) for i in range(100, 140)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (3, 2)], "a bigint, b bigint")
    roots = {r.node: r.root for r in connected_components(spark, edges).collect()}
    assert {roots[i] for i in range(51)} == {0} and {roots[i] for i in [*range(100, 140), 1000]} == {100}
    assert connected_components(spark, edges.limit(0)).count() == 0
