"""Toxicity scores: logistic regression on words and stems, regularised by counterfactuals.

Identity terms of labelled texts are swapped for others of their group; the fit penalises the squared change
of the score, so that naming a group does not by itself make a text toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.llm.common import documents, fresh, sampled, stored
from citylode.llm.sums import PARTS, merged_sums

FIT_ROWS = 60_000
# Terms of the model by toxic texts to learn from: more of them overfit few texts; see the README for errors.
LEAST_TERMS, MOST_TERMS, TERMS_PER_TEXT = 192, 768, 2.3
STEMS = (4, 5)
RIDGE = 0.1
SWAP_PENALTY = 1.0
ROUNDS = 12
LEAST = 4  # toxic texts that a term needs

# Terms that name groups of people; a swap takes the next term of its group.
IDENTITY = [
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"), ("female", "male"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("american", "french", "german", "spanish", "mexican", "chinese", "indian", "russian"),
    ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"), ("old", "young"),
    ("blind", "deaf", "disabled"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("chrétiens", "musulmans", "juifs", "athées"),
    ("noirs", "blancs", "arabes", "asiatiques"), ("français", "allemand", "espagnol", "italien"),
    ("immigrés", "réfugiés", "étrangers"), ("vieux", "jeunes"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("christen", "muslime", "juden", "atheisten"),
    ("schwarze", "weiße", "araber", "asiaten"), ("deutsche", "franzosen", "spanier", "italiener"),
    ("einwanderer", "flüchtlinge", "ausländer"), ("alte", "junge"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"), ("cristianos", "musulmanes", "judíos", "ateos"),
    ("negros", "blancos", "árabes", "asiáticos"), ("españoles", "franceses", "alemanes", "italianos"),
    ("inmigrantes", "refugiados", "extranjeros"), ("viejos", "jóvenes"),
]
SWAPS = {term: group[(k + 1) % len(group)] for group in IDENTITY for k, term in enumerate(group)}
WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> set[str]:
    """The distinct words of a text in lower case."""
    return set(WORDS(text.lower())) if text else set()


def terms_of(words: set[str]) -> set[str]:
    """Words, and the stems of the longer ones, marked by a dash."""
    return words | {f"{w[:k]}-" for k in STEMS for w in words if len(w) > k}


def swapped(words: set[str]) -> set[str] | None:
    """The words after the swap of identity terms; None if there are none."""
    named = words & SWAPS.keys()
    return (words - named) | {SWAPS[w] for w in named} if named else None


@dataclass(frozen=True)
class Model:
    """Weight of each term, and the intercept."""
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def score(self, text: str | None) -> float:
        """The probability of a text. Only its words are looked up, and their stems."""
        z, known = self.intercept, self.weights
        words = words_of(text)
        for w in words:
            z += known.get(w, 0.0)
        for k in STEMS:
            for stem in {w[:k] for w in words if len(w) > k}:
                z += known.get(f"{stem}-", 0.0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def term_count(toxic: int) -> int:
    """How many terms so many toxic texts can teach."""
    return min(MOST_TERMS, max(LEAST_TERMS, round(TERMS_PER_TEXT * toxic)))


def choose_terms(rows: DataFrame, terms: int | None = None) -> list[str]:
    """The terms that part toxic from other texts best, by their chi-squared over the labelled rows."""
    def work(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                (toxic if label else other).update(terms_of(words_of(text.as_py())))
                if len(toxic) + len(other) > 100_000:
                    yield counted(toxic, other)
                    toxic, other = Counter(), Counter()
        yield counted(toxic, other)

    def counted(toxic: Counter, other: Counter) -> pa.RecordBatch:
        names = list(toxic.keys() | other.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()),
             pa.array([other[t] for t in names], pa.int64())], ["term", "toxic", "other"])

    total = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not total[0] or not total[1]:
        return []
    p, q = float(total[0]), float(total[1])
    terms = term_count(total[0]) if terms is None else terms
    sums = rows.select("text", "label").mapInArrow(work, "term string, toxic bigint, other bigint").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).filter(F.col("toxic") >= LEAST)
    gap = F.col("toxic") / p - F.col("other") / q
    spread = (F.col("toxic") + F.col("other") + 1) / (p + q)
    best = sums.select("term", (gap * gap / spread).alias("gain")).orderBy(F.desc("gain"), "term").limit(terms)
    return [r.term for r in best.collect()]


def fit(spark: SparkSession, rows: DataFrame, terms: int | None = None, penalty: float = SWAP_PENALTY) -> Model:
    """Fit on stored (text, label), label 0 or 1: Newton's steps, each summed over partitions and
    added up in Spark; the driver holds one matrix of the terms.

    The loss is the logistic loss, plus ``penalty`` for each squared change of a linear score under the swap
    of a text's identity terms, plus a ridge.
    """
    chosen = choose_terms(rows, terms)
    if not chosen:
        rate = rows.agg(F.avg("label")).first()[0]
        return Model({}, -30.0 if rate is None else float(np.log((rate + 1e-3) / (1 - rate + 1e-3))))
    names = list(dict.fromkeys([*chosen, *SWAPS]))
    index, n = {t: k for k, t in enumerate(names)}, len(names) + 1

    def encode(batches):
        known = index.keys()
        for batch in batches:
            here, other = [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                swap = swapped(words)
                here.append(sorted(index[t] for t in terms_of(words) & known))
                other.append(None if swap is None else sorted(index[t] for t in terms_of(swap) & known))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(here, kind), pa.array(other, kind), batch.column("label")], ["here", "other", "label"])

    coded = stored(spark, rows.select("text", "label").mapInArrow(
        encode, "here array<int>, other array<int>, label int"), "toxicity-rows")

    def rows_of(column: pa.Array) -> np.ndarray:
        x = np.zeros((len(column), n), np.float32)
        x[pc.list_parent_indices(column).to_numpy(), column.flatten().to_numpy()] = 1
        x[:, -1] = 1
        return x

    w = np.zeros(n)
    ridge = np.full(n, RIDGE)
    ridge[-1] = 0
    for _ in range(ROUNDS):
        def step(batch: pa.RecordBatch, w=w):
            g, h = np.zeros(n), np.zeros((n, n))
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                x, y = rows_of(part.column("here")), part.column("label").to_numpy()
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                g += x.T @ (p - y)
                h += x.T @ (x * (p * (1 - p)).astype(np.float32)[:, None])
                has = part.column("other").is_valid().to_numpy(zero_copy_only=False)
                if has.any():
                    d = x[has] - rows_of(part.column("other").drop_null())
                    g += penalty * d.T @ (d @ w)
                    h += penalty * d.T @ d
            return g, h[np.triu_indices(n)]

        g, half = merged_sums(coded, step)
        h = np.zeros((n, n))
        h[np.triu_indices(n)] = half
        h += np.triu(h, 1).T
        move = np.linalg.solve(h + np.diag(ridge + 1e-6), g + ridge * w)
        w = w - move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-3:
            break
    return Model({t: float(w[k]) for t, k in index.items() if abs(w[k]) > 1e-4}, float(w[-1]))


def labelled_texts(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column | None, label: str, fit_rows: int,
) -> DataFrame:
    """About ``fit_rows`` labelled (text, label) rows at most, stored.

    The chosen (doc_id, label) pairs are bounded by ``fit_rows`` and so broadcast: no text is shuffled but
    the chosen ones.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(
        "doc_id is not null and label is not null")
    if held_out is not None:
        known = known.filter(~held_out)
    chosen = sampled(stored(spark, known.groupBy("doc_id").agg(F.max("label").alias("label")), "known"), "doc_id", fit_rows)
    return stored(spark, documents(docs).join(F.broadcast(chosen), "doc_id").select(
        "text", (F.col("label") > 0).cast("int").alias("label")).repartition(PARTS), "labelled")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    def work(batches):
        for batch in batches:
            values = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    return documents(docs).mapInArrow(work, "doc_id bigint, score double")


def toxicity_scores(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3,
    label: str = "toxic", fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    ``held_out`` is a condition on doc_id; labels of rows where it holds are not read. Null labels are
    ignored, of several for a doc_id the largest counts. The fit takes about ``fit_rows`` labelled rows at
    most, chosen by hashed doc_id. Null counts as empty text, and empty texts are scored. Without labels
    every score is 0; with labels of one kind only it is their rate. An empty table gives no rows.
    """
    model = fit(spark, labelled_texts(spark, docs, labels, held_out, label, fit_rows))
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all columns; each text is scored where it is read."""
    model = fit(spark, labelled_texts(spark, docs, labels, None, label, fit_rows))

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype(float)

    (name,) = fresh(docs, "toxic_score")
    return docs.withColumn(name, toxic(F.coalesce("text", F.lit("")))).filter(F.col(name) < threshold).drop(name)
