"""Mixing to target weights with soft domains.

A classifier trained on labelled texts gives every text posterior probabilities of its domains. Nonnegative
rates per document are then fitted by projected gradient descent, so that the expected tokens of each domain
match the targets and rates stay as near to 1 as that allows. A rate of 2.3 means two copies and a third with
probability 0.3.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylode.llm import scan
from citylode.llm.common import documents, fresh, sampled, stored
from citylode.llm.sums import PARTS, doubles, lists, partition_sums, table_sums

FIT_ROWS = 40_000
# Letters a to z and the second bytes of accented letters: what tells languages apart.
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:192] = np.arange(27, 91)
SYMBOLS = 91
PRIOR_WEIGHT = 1e-4  # pull of the rates towards 1, beside the match of the targets
STEPS = 400
PATIENCE = 40  # steps without progress that end the descent
TOLERANCE = 1e-4


def profiles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of symbol shares of each text, and its number of words."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n) * SYMBOLS, np.diff(offsets))
    counts = np.bincount(owner + SYMBOL[data], minlength=n * SYMBOLS).reshape(n, SYMBOLS)[:, 1:]
    words = np.diff(np.searchsorted(scan.word_starts(data, offsets), offsets))
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)), words


def column_profiles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = scan.bytes_of(texts)
    made = [profiles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            for lo, hi in scan.slices(offsets)]
    if not made:
        return np.zeros((0, SYMBOLS - 1)), np.zeros(0, np.int64)
    return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])


@dataclass(frozen=True)
class Domains:
    """A linear discriminant over profiles: one score per domain, softmax for posteriors."""
    names: list[str]
    weights: np.ndarray
    intercepts: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights + self.intercepts
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_domains(rows: DataFrame, names: list[str]) -> Domains:
    """Fit on (text, domain): class means and the pooled covariance, from sums over partitions."""
    d, index = SYMBOLS - 1, {name: k for k, name in enumerate(names)}

    def moments(batch: pa.RecordBatch):
        x, _ = column_profiles(batch.column("text"))
        member = np.zeros((len(x), len(names)))
        member[np.arange(len(x)), [index[v] for v in batch.column("domain").to_pylist()]] = 1
        return member.sum(axis=0), member.T @ x, x.T @ x

    sums = partition_sums(rows.select("text", "domain").filter(F.col("domain").isin(names)), moments)
    if sums is None:
        return Domains(names, np.zeros((d, len(names))), np.zeros(len(names)))
    n, first, second = sums
    means = first / np.maximum(n, 1)[:, None]
    within = (second - means.T @ (means * n[:, None])) / n.sum() + 1e-4 * np.eye(d)
    weights = np.linalg.solve(within, means.T)
    prior = np.log((n + 1) / (n + 1).sum())
    return Domains(names, weights, prior - 0.5 * (means.T * weights).sum(axis=0))


@dataclass(frozen=True)
class Rates:
    """The steps of the descent so far: they depend on a document's posteriors alone, so any task can
    repeat them for its documents and no rate needs to be kept between steps."""
    pulls: list[np.ndarray]
    step: float

    def __call__(self, p: np.ndarray) -> np.ndarray:
        """Rates of documents with posteriors p after all steps, by Nesterov's scheme."""
        here = last = np.ones(len(p))
        for k, pull in enumerate(self.pulls):
            here, last = self.ahead(k, here, last, p, pull), here
        return here

    def look(self, p: np.ndarray) -> np.ndarray:
        """The point at which the next gradient is taken."""
        here = last = np.ones(len(p))
        for k, pull in enumerate(self.pulls):
            here, last = self.ahead(k, here, last, p, pull), here
        k = len(self.pulls)
        return here + (here - last) * (k / (k + 3))

    def ahead(self, k: int, here, last, p, pull):
        at = here + (here - last) * (k / (k + 3))
        return np.maximum(0.0, at - self.step * (p @ pull + PRIOR_WEIGHT * (at - 1)))


def fit_rates(domains: DataFrame, shares: np.ndarray, growth: float | None) -> tuple[Rates, np.ndarray, np.ndarray]:
    """Fit on stored (n_tokens, p). Returns the rates, and expected tokens before and wanted per domain.

    Each step adds up the expected tokens per domain over all documents at the rates so far; only these sums,
    one number per domain, reach the driver. The gradient of a document is weighted by its tokens. Without ``growth`` the total is the least at which no domain shrinks.
    """
    d = len(shares)

    def totals(rates):
        def add(batch: pa.RecordBatch):
            p, tokens = doubles(batch.column("p")), batch.column("n_tokens").to_numpy()
            return [p.T @ (tokens * rates(p)), (p * tokens[:, None]).T @ p]
        return table_sums(domains, add, [(d,), (d, d)])

    first = totals(lambda p: np.ones(len(p)))
    if first is None or first[0].sum() == 0:
        return Rates([], 1.0), np.zeros(len(shares)), np.zeros(len(shares))
    natural, gram = first
    size = natural.sum()
    wanted = shares * (size * growth if growth else (natural[shares > 0] / shares[shares > 0]).max())
    # Gaps are measured in the norm in which all domains answer alike, so that few steps are needed.
    # Its floor is a part of each domain's own share, for rare domains to answer as fast as others.
    norm = np.linalg.inv(gram / size + np.diag(1e-3 * natural / size + 1e-12))
    rates = Rates([], 1 / (1 + PRIOR_WEIGHT))
    allowed, gaps = TOLERANCE * wanted.sum() / size, []
    for _ in range(STEPS):
        now = totals(rates.look)[0]
        gap = (now - wanted) / size
        gaps.append(float(np.abs(gap).max()))
        if gaps[-1] < allowed:
            # The point just measured becomes the answer: a step without pull leads there.
            rates = Rates([*rates.pulls, np.zeros(len(shares))], rates.step)
            break
        rates = Rates([*rates.pulls, norm @ gap], rates.step)
        if len(gaps) > PATIENCE and min(gaps[-PATIENCE:]) > 0.99 * min(gaps[:-PATIENCE]):
            break
    if gaps[-1] >= allowed:
        warnings.warn(
            f"mixing: targets are not met after {len(gaps)} steps; the largest gap is {gaps[-1] * size / wanted.sum():.2g} "
            "of the wanted total", stacklevel=2)
    return rates, natural, wanted


def domain_table(docs: DataFrame, model: Domains) -> DataFrame:
    """(doc_id, n_tokens, p) of every whole text; a text without letters has the labelled texts' shares."""
    def work(batches):
        for batch in batches:
            x, words = column_profiles(batch.column(1))
            p = model.posteriors(x) if len(x) else np.zeros((0, len(model.names)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), lists(p)], ["doc_id", "n_tokens", "p"])

    return documents(docs).mapInArrow(work, "doc_id bigint, n_tokens bigint, p array<double>")


def copies(rate: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Copies of each document: its rate rounded down, or up where the draw in [0, 1) is below the rest."""
    return (np.floor(rate) + (draw < rate - np.floor(rate))).astype(np.int64)


def fit_mixture(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str,
    growth: float | None, fit_rows: int,
) -> tuple[Domains, Rates, DataFrame]:
    """The classifier, the rates and the stored posteriors. See ``mixture``."""
    names = sorted(targets)
    shares = np.array([targets[k] for k in names], float)
    if (shares < 0).any() or shares.sum() <= 0:
        raise ValueError("target weights must not be negative, nor all be 0")
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    chosen = sampled(stored(spark, ids, "labelled-ids"), "doc_id", fit_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(domain).alias("domain")).join(
        F.broadcast(chosen), "doc_id", "left_semi")
    model = fit_domains(stored(spark, rows.repartition(PARTS), "domain-rows"), names)
    domains = stored(spark, domain_table(docs, model), "domains")
    rates, _, _ = fit_rates(domains, shares / shares.sum(), growth)
    return model, rates, domains


def mixture(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str = "lang",
    growth: float | None = None, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens (words), p_<domain> for each target, rate, copies.

    ``targets`` gives each domain's weight in expected tokens; ``growth`` the wanted total as a multiple of
    the present one, by default the least at which no domain loses tokens. Rates are at least 0; one below 1 drops
    its document with probability 1 - rate, as targets can need where posteriors overlap. The classifier learns the column
    ``domain`` of the documents in ``labels``, about ``fit_rows`` of them at most, chosen by hashed doc_id;
    rows of other or null domains teach nothing but are mixed like all. A null, empty or letterless text gets
    posteriors from the classifier's intercepts, a text without words counts no tokens. Copies are drawn by
    hashed doc_id, the same on every run; repeated rows draw alike. Without labelled rows posteriors are even.
    An empty table gives no rows. Targets that posteriors cannot meet are approached, and a warning names the gap.
    """
    model, rates, domains = fit_mixture(spark, docs, labels, targets, domain, growth, fit_rows)

    def work(batches):
        for batch in batches:
            p = doubles(batch.column(2)) if batch.num_rows else np.zeros((0, len(model.names)))
            rate = rates(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(p[:, k]) for k in range(len(model.names))],
                 pa.array(rate), pa.array(copies(rate, batch.column(3).to_numpy()), pa.int64())],
                schema.names)

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(f"p_{name}", T.DoubleType()) for name in model.names]
    schema = T.StructType([*fields, T.StructField("rate", T.DoubleType()), T.StructField("copies", T.LongType())])
    return domains.select("doc_id", "n_tokens", "p", draw(F.col("doc_id")).alias("draw")).mapInArrow(work, schema)


def draw(doc_id):
    """A number in [0, 1) that depends on the doc_id alone."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit("mix"), doc_id), F.lit(1 << 30)) / F.lit(float(1 << 30)), F.lit(0.5))


def mix(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str = "lang",
    growth: float | None = None, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The rows of ``docs``, each as often as its copies, with all columns; rates are found where texts are read."""
    model, rates, _ = fit_mixture(spark, docs, labels, targets, domain, growth, fit_rows)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        x, _ = column_profiles(pa.array(texts, pa.string()))
        return pd.Series(rates(model.posteriors(x)) if len(x) else [], dtype=float)

    name, number = fresh(docs, "mix_rate", "mix_copy")
    whole = F.floor(F.col(name))
    n = (whole + (draw(F.col("doc_id").cast("long")) < F.col(name) - whole).cast("int")).cast("int")
    rated = docs.withColumn(name, rate(F.coalesce("text", F.lit(""))))
    return rated.withColumn(number, F.explode(F.array_repeat(F.lit(1), n))).drop(name, number)
