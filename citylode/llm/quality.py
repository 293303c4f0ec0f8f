"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated.

The features approximate a Gaussian kernel over standardised statistics of a text. Normal equations are
summed over partitions. An isotonic fit on rows the ridge has not seen turns its values into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.llm import scan
from citylode.llm.common import documents, sampled, stored
from citylode.llm.sums import doubles, lists, partition_sums

FIT_ROWS = 100_000
FEATURES = 256
RIDGE = 1e-3
STEPS = 1000  # values of the ridge told apart by the calibration

# Byte classes: other, lower case, upper case, digit, space, line end, sentence mark, shouted mark, symbol,
# beyond ASCII.
CLASSES = 10
CLASS = np.zeros(256, np.int64)
for code, members in enumerate([
        range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r\x0b\x0c", b".,;:'\"()-", b"!?",
        b"#$%&*+/<=>@[\\]^_`{|}~", range(128, 256)], 1):
    CLASS[list(members)] = code
NAMES = ["log_bytes", "log_words", "log_word_length", "same_as_last", "distinct", "top_line",
         *[f"class_{k}" for k in range(CLASSES)]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of each text, a row each; zeros for an empty one."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(n) * CLASSES, sizes)
    classes = np.bincount(owner + CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES)
    hashes, ends = scan.word_hashes(data, offsets)
    words = np.diff(ends)
    same = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes):
        equal = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        equal[ends[:-1][words > 0]] = False
        same[1:] = np.cumsum(equal)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)])
    breaks = classes[:, 5]
    some, wordy = np.maximum(sizes, 1), np.maximum(words, 1)
    return np.column_stack([
        np.log1p(sizes), np.log1p(words), np.log1p((sizes - classes[:, 4] - breaks) / wordy),
        (same[ends[1:]] - same[ends[:-1]]) / wordy, np.log1p(distinct) / np.log1p(wordy),
        np.log1p(breaks), classes / some[:, None]]).astype(np.float64)


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    def work(batches):
        for batch in batches:
            data, offsets = scan.bytes_of(batch.column(1))
            rows = [statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    for lo, hi in scan.slices(offsets)]
            x = np.concatenate(rows) if rows else np.zeros((0, len(NAMES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(x)], ["doc_id", "x"])

    return documents(docs).mapInArrow(work, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Model:
    """Standardisation, Fourier features, ridge weights, and the calibration's knots."""
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        wave = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([wave, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing values nearest to y by weighted squares (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight, strict=True):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + v * w) / (last[1] + w)
            last[1] += w
            last[2] += n
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(spark: SparkSession, stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 1) -> Model:
    """Fit on stored statistics and (doc_id, label); means and spreads are those of all texts."""
    d = len(NAMES)
    moments = stats.agg(*[F.avg(F.col("x")[k]) for k in range(d)], *[F.stddev_pop(F.col("x")[k]) for k in range(d)])
    values = np.array([v or 0.0 for v in moments.first()])
    rng = np.random.default_rng(seed)
    scale = np.where(values[d:] > 1e-9, values[d:], 1.0)
    frequencies = rng.normal(size=(d, FEATURES)) / np.sqrt(d)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    blank = Model(values[:d], scale, frequencies, phases, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))

    rows = stats.join(labels, "doc_id").select("doc_id", "x", F.col("label").cast("double").alias("label"))
    rows = stored(spark, sampled(rows, "doc_id", fit_rows), "quality-rows")
    late = F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string"))) % 5 == 0

    def normal(batch: pa.RecordBatch):
        z, y = blank.features(doubles(batch.column("x"))), batch.column("label").to_numpy()
        return z.T @ z, z.T @ y, len(y)

    sums = partition_sums(rows.filter(~late), normal)
    if sums is None:
        return blank
    a, b, n = sums
    weights = np.linalg.solve(a + RIDGE * n * np.eye(len(b)), b)
    ridge = Model(*[getattr(blank, k) for k in ("mean", "scale", "frequencies", "phases")], weights, np.zeros(1), np.zeros(1))

    def binned(batch: pa.RecordBatch):
        at = np.clip(np.round((ridge.raw(doubles(batch.column("x"))) + 0.5) * STEPS), 0, 2 * STEPS).astype(int)
        y = batch.column("label").to_numpy()
        return np.bincount(at, minlength=2 * STEPS + 1), np.bincount(at, y, 2 * STEPS + 1)

    bins = partition_sums(rows.filter(late), binned) or [np.ones(1), np.full(1, b[-1] / n)]
    seen = np.flatnonzero(bins[0])
    fitted = isotonic(bins[1][seen] / bins[0][seen], bins[0][seen])
    # One knot in the middle of each level: straight lines between keep scores apart that a step would tie.
    level = np.flatnonzero(np.concatenate([[True], np.diff(fitted) > 0]))
    edges = np.append(level, len(fitted))
    centres = np.array([np.average(seen[i:j], weights=bins[0][seen[i:j]]) for i, j in zip(edges[:-1], edges[1:], strict=True)])
    return Model(blank.mean, scale, frequencies, phases, weights, centres / STEPS - 0.5, fitted[level])


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of stored statistics."""
    def work(batches):
        for batch in batches:
            values = model.score(doubles(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(work, "doc_id bigint, score double")


def quality_scores(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    ``held_out`` is a condition on doc_id; labels of rows where it holds are not read. Null or repeated
    labels: null ones are ignored, of several the largest counts. The fit takes about ``fit_rows`` labelled
    rows at most, chosen by hashed doc_id; statistics' means and spreads come from all texts. Null counts as
    empty text, and empty texts are scored. Without labels every score is 0.5. An empty table gives no rows.
    """
    stats = stored(spark, text_statistics(docs), "text-statistics")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label")).filter(
        "doc_id is not null and label is not null").filter(~held_out).groupBy("doc_id").agg(F.max("label").alias("label"))
    scored = score(stats, fit(spark, stats, known, fit_rows))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
