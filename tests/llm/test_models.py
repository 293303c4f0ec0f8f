import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citylode.llm import mixing, quality, scan, sums, toxicity

DOCS = "doc_id bigint, text string, lang string, score double, x int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, 0.0, 1) for i, t, g in rows], DOCS)


def held(n, k):
    return F.crc32(F.col("doc_id").cast("string")) % n == k


def sentence(rng, words=30):
    return " ".join(rng.choice(["the", "river", "stone", "walks", "over", "green", "hill", "and", "sings"]) for _ in range(words))


def test_word_scan_against_plain_python():
    texts = ["", "  ", "a", "A b\tc", "é\x0bx\x1cy", None, " lead", "trail ", "x" * 50, "a a\n a"]
    data, offsets = scan.bytes_of(pa.array(texts))
    hashes, ends = scan.word_hashes(data, offsets)
    table = {}
    for k, t in enumerate(texts):
        words = (t or "").encode().lower().split() if "\x1c" not in (t or "") else [b"\xc3\xa9", b"x\x1cy"]
        assert ends[k + 1] - ends[k] == len(words)
        for w, h in zip(words, hashes[ends[k]:ends[k + 1]], strict=True):
            assert table.setdefault(w, h) == h
    assert len(set(table.values())) == len(table)
    assert list(scan.count_words(pa.array(texts)[3:5])) == [3, 2]


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    rng = random.Random(1)
    texts = pa.array([sentence(rng, rng.randrange(200)) for _ in range(50)])
    whole = scan.word_hashes(*scan.bytes_of(texts))[0]
    monkeypatch.setattr(scan, "STEP", 64)
    assert (scan.word_hashes(*scan.bytes_of(texts))[0] == whole).all()


def test_isotonic_is_the_least_squares_fit():
    assert quality.isotonic(np.array([1, 0, 2, 1, 3.0]), np.ones(5)).tolist() == [0.5, 0.5, 1.5, 1.5, 3]
    rng = np.random.default_rng(0)
    y, w = rng.normal(size=40), rng.uniform(1, 2, 40)
    fit = quality.isotonic(y, w)
    assert (np.diff(fit) >= 0).all() and abs(((y - fit) * w).sum()) < 1e-9
    # max-min formula of isotonic regression
    brute = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(k, 40)) for a in range(k + 1)) for k in range(40)]
    assert np.allclose(fit, brute)


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    d = len(quality.NAMES)
    w, b = rng.normal(size=(d, 20_000)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, 20_000)
    model = quality.Model(np.zeros(d), np.ones(d), w, b, np.zeros(1), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(6, d))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * d))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_quality_held_out_and_odd_rows(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        text = sentence(rng) if good else rng.choice([sentence(rng, 4).upper() + "!!!", "buy " * 40, "$$$ ### " * 12])
        rows.append((i, text, "en"))
        labels.append((i, int(good)))
    rows += [(1000, None, None), (1001, "", "en"), (None, "some text", "en"), (5, rows[5][1], "en"), (1002, "y" * 2_000_000, "en")]
    frame = spark.createDataFrame([*labels, (None, 1), (7, None), (5, labels[5][1])], "doc_id bigint, quality int")
    got = quality.quality_scores(spark, docs(spark, rows), frame, held(3, 1)).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality.quality_scores(spark, docs(spark, []), frame, held(3, 1)).count() == 0
    none = quality.quality_scores(spark, docs(spark, rows[:3]), frame.limit(0), held(3, 1)).collect()
    assert [r.score for r in none] == [0.5] * 3


def toxic_corpus(n, seed=4, term=None):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = rng.random() < 0.25
        words = sentence(rng, rng.choice([5, 30, 200])).split()
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["moronic", "moronish", "vile"]))
        # A group is named in most toxic and few other texts: a plain fit would learn it.
        if term and rng.random() < (0.7 if bad else 0.05):
            words.insert(0, term)
        out.append((i, " ".join(words), int(bad)))
    return out


def test_toxicity_held_out_and_odd_rows(spark):
    corpus = toxic_corpus(700)
    rows = [(i, t, "en") for i, t, _ in corpus] + [(2000, None, "en"), (2001, "", None), (None, "vile", "en"), (3, "a", "en")]
    labels = spark.createDataFrame([*[(i, y) for i, _, y in corpus], (None, 1), (5, None)], "doc_id bigint, toxic int")
    got = toxicity.toxicity_scores(spark, docs(spark, rows), labels, held(4, 2)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: y for i, _, y in corpus}
    tested = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id != 3]
    assert len(tested) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97
    kept = toxicity.drop_toxic(spark, docs(spark, rows), labels)
    assert kept.columns == ["doc_id", "text", "lang", "score", "x"]
    left = {r.doc_id for r in kept.collect()}
    assert 2000 in left and 2001 in left
    assert np.mean([(i in left) != bool(y) for i, y in truth.items() if i != 3]) > 0.97
    assert toxicity.toxicity_scores(spark, docs(spark, []), labels, held(4, 2)).count() == 0
    assert toxicity.drop_toxic(spark, docs(spark, rows), labels.limit(0)).count() == len(rows)


def test_toxic_words_beyond_the_best_192_terms_are_recognised(spark):
    vile = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in "bdfgklmn"]
    rng = random.Random(8)
    corpus = [(f"{sentence(rng, 8)} {w}", 1) for w in vile for _ in range(5)]
    corpus += [(sentence(rng, 9), 0) for _ in corpus]
    model = toxicity.fit(spark, spark.createDataFrame(corpus, "text string, label int"))
    assert len(vile) == 280 and all(model.score(f"the river {w} sings") > 0.3 for w in vile)
    assert model.score("the river walks") < 0.3


def test_merged_sums_reach_the_driver_once(spark, monkeypatch):
    monkeypatch.setattr(sums, "PIECE", 5)
    rows = spark.range(1000).selectExpr("id", "id % 7 as v")

    def add(batch):
        v = batch.column("v").to_numpy()
        return v.sum(), np.outer([1, 2, 3], [v.sum(), len(v)])

    total, table = sums.merged_sums(rows, add)
    v = np.arange(1000) % 7
    assert total == v.sum() and (table == np.outer([1, 2, 3], [v.sum(), 1000])).all()
    assert sums.merged_sums(rows.limit(0), add) is None


def test_counterfactual_penalty_frees_identity_terms(spark):
    corpus = toxic_corpus(600, term="muslim")
    rows = spark.createDataFrame([(t, y) for _, t, y in corpus], "text string, label int")
    plain, fair = toxicity.fit(spark, rows, penalty=0.0), toxicity.fit(spark, rows, penalty=20.0)

    def change(model):
        return model.score("a muslim walks over the hill") - model.score("a jewish walks over the hill")

    assert change(plain) > 0.005 > 10 * abs(change(fair)) / 2
    assert fair.score("such a vile stone") > 0.5 > fair.score("muslim green hill")
    assert toxicity.swapped({"she", "hill"}) == {"he", "hill"} and toxicity.swapped({"hill"}) is None


LANGS = {"en": "the quick brown fox jumps and where which", "fr": "où était l'été déjà près très élève ça",
         "de": "über straße größer können müßte schön", "es": "mañana niño señor qué también corazón"}
TARGETS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def language_rows(n=400, seed=6):
    rng = random.Random(seed)
    kinds = rng.choices(list(LANGS), weights=[7, 1, 1, 1], k=n)
    return [(i, " ".join(rng.choices(LANGS[k].split(), k=rng.choice([3, 20, 90]))), k) for i, k in enumerate(kinds)]


def test_mixture_meets_targets(spark):
    rows = language_rows()
    labels = spark.createDataFrame([(i,) for i, _, _ in rows[::2]], "doc_id bigint")
    got = mixing.mixture(spark, docs(spark, rows), labels, TARGETS).collect()
    truth = {i: k for i, _, k in rows}
    assert np.mean([max(TARGETS, key=lambda d: r[f"p_{d}"]) == truth[r.doc_id] for r in got]) > 0.98
    assert all(r.n_tokens == len(rows[r.doc_id][1].split()) for r in got)
    totals = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in got) for d in TARGETS}
    whole = sum(totals.values())
    assert all(abs(totals[d] / whole - w) < 0.01 for d, w in TARGETS.items())
    assert min(r.rate for r in got) > 0.97 and all(abs(r.copies - r.rate) < 1 for r in got)


def test_rates_against_a_direct_solution(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.5] * 3, 200)
    tokens = rng.integers(1, 100, 200)
    table = spark.createDataFrame([(int(n), x.tolist()) for n, x in zip(tokens, p, strict=True)], "n_tokens bigint, p array<double>")
    shares = np.array([0.2, 0.5, 0.3])
    rates, natural, wanted = mixing.fit_rates(table, shares, growth=1.0)
    r = rates(p)
    assert (r >= 0).all() and np.allclose(natural, p.T @ tokens)
    assert np.abs(p.T @ (tokens * r) - wanted).max() < 0.002 * tokens.sum()


def test_rates_of_a_very_rare_domain(spark):
    rows = [(1_000_000, [1.0, 0.0, 0.0]), (999_998, [0.0, 1.0, 0.0]), (2, [0.0, 0.0, 1.0])]
    table = spark.createDataFrame(rows, "n_tokens bigint, p array<double>")
    rates, _, wanted = mixing.fit_rates(table, np.array([0.4, 0.4, 0.2]), growth=None)
    tokens, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert np.abs(p.T @ (tokens * rates(p)) - wanted).max() < 0.001 * wanted.sum()


def test_targets_that_cannot_be_met_are_reported(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PATIENCE", 3)
    table = spark.createDataFrame([(10, [0.5, 0.5])], "n_tokens bigint, p array<double>")
    with pytest.warns(UserWarning, match="gap"):
        mixing.fit_rates(table, np.array([0.9, 0.1]), growth=None)


def test_mix_copies_rows(spark):
    rows = language_rows(200) + [(900, None, None), (901, "", "en"), (None, "the fox", "en"), (902, "123 !!", "xx")]
    labels = spark.createDataFrame([(i,) for i, _, _ in rows], "doc_id bigint")
    kept = mixing.mix(spark, docs(spark, rows), labels, TARGETS)
    assert kept.columns == ["doc_id", "text", "lang", "score", "x"]
    wanted = {r.doc_id: r.copies for r in mixing.mixture(spark, docs(spark, rows), labels, TARGETS).collect()}
    made = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert made == {i: n for i, n in wanted.items() if n}
    assert mixing.mix(spark, docs(spark, []), labels, TARGETS).count() == 0
    assert mixing.mixture(spark, docs(spark, rows), labels.limit(0), TARGETS).count() == len(rows)
    with pytest.raises(ValueError, match="weights"):
        mixing.mixture(spark, docs(spark, rows), labels, {"en": -1.0})


def test_copies_follow_the_draw():
    assert mixing.copies(np.array([0.0, 1.0, 2.3, 2.3]), np.array([0.0, 0.5, 0.29, 0.31])).tolist() == [0, 1, 3, 2]
