"""A quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled texts train a logistic model of the share of characters and
words of several kinds. With the class prior p, the unbiased risk of a scorer z is

    p * E_positive[loss(z)] + (E_unlabelled[loss(-z)] - p * E_positive[loss(-z)])

and the part in brackets, the risk on negatives, cannot truly be negative. With the logistic
loss the sum is convex: -p * E_positive[z] + E_unlabelled[log(1 + e^z)]. It is minimised by
Newton steps; a step that would take the bracket below zero is halved until it does not, so
the risk stays non-negative and the model cannot fit the positives to death.

A step is one pass over the stored features of all training rows. Each task sums up its rows,
and one row of a few thousand numbers per task is added up in two levels. Nothing is sampled.

The prior, unless it is given, is estimated from positives and unlabelled texts alone; no label
0 is looked at. The unlabelled are prior parts positives like the trusted ones, and the rest
negatives. So any set of texts with a share P of the trusted positives has a share U >= prior * P
of the unlabelled, with equality where a set holds no negatives. A first model, fitted with
prior 1/2, orders the texts; among the sets of texts above a score with enough positives to tell,
the least U / P is the estimate. Counts of both kinds by score are a histogram of BINS
rows, whatever the number of texts.

Only the text is looked at, all of it. Defined results: NULL texts are empty ones, and empty
texts have a score like any other. Of several labels of a document the least counts; NULL
labels and identities are no labels. Without positives to learn from (so without documents too)
nothing speaks against a text, and every score is 0.5, which is accepted.
"""

from __future__ import annotations

import operator
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talmir.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SPACES = b" \t\n\r\x0b\x0c"
STOPS = b".,;:?'\"()-"
SHARES = 15
RIDGE = 1e-4
# Bins that scores are counted in, and the share of the positives that a set must hold.
BINS, LEAST_SHARE = 1000, 0.8


def _share(data: bytes, kept: bytes) -> float:
    return (len(data) - len(data.translate(None, kept))) / max(1, len(data))


def text_features(text: str | None) -> list[float]:
    """Shares in [0, 1] of the text's characters, words and lines, with their roots."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n = max(1, len(words))
    different = len(set(words))
    repeated = sum(map(operator.eq, words, words[1:]))
    odd = sum(1 for w in words if w[-1:] not in b".,;:?'\")" and not w[-1:].isalnum() and w[-1] < 128)
    shares = [
        _share(data, LETTERS),
        _share(data, UPPER),
        _share(data, DIGITS),
        _share(data, SPACES),
        _share(data, STOPS),
        1.0 - _share(data, LETTERS + DIGITS + SPACES + STOPS),
        _share(data, b"|"),
        _share(data, b"!"),
        different / n,
        repeated / n,
        odd / n,
        sum(map(bytes.isupper, words)) / n,
        1.0 - len(set(lines)) / max(1, len(lines)),
        min(1.0, sum(map(len, words)) / n / 32.0),
        min(1.0, np.log1p(len(words)) / 12.0),
    ]
    # Long texts repeat more words; the ratio of logarithms is about the same for all lengths.
    spread = np.log1p(different) / np.log1p(n)
    return [*map(float, shares), *[float(x) ** 0.5 for x in shares], float(spread)]


def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([text_features(x.as_py()) for x in texts], pa.list_(pa.float64()))

    return compute.asNondeterministic()(text)


@dataclass(frozen=True)
class Model:
    """Standardised features times weights, plus the bias, through the logistic function."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = ((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)
        return z + self.bias

    def score_features(self, features: Column) -> Column:
        model = self

        @F.arrow_udf("double")
        def compute(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            return pa.array(1.0 / (1.0 + np.exp(-np.clip(model.logits(x), -500, 500))))

        return compute(features)

    def logit_bin(self, features: Column) -> Column:
        """Which of BINS bins the logit is in, from -28 to 28."""
        model = self

        @F.arrow_udf("int")
        def compute(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            share = (np.clip(model.logits(x), -28, 28) + 28) / 56
            return pa.array((share * (BINS - 1)).astype(np.int32))

        return compute(features)

    def score(self, text: Column) -> Column:
        """The score of a text, 0 to 1."""
        model = self

        @F.arrow_udf("double")
        def compute(texts: pa.Array) -> pa.Array:
            if not len(texts):
                return pa.array([], pa.float64())
            x = np.array([text_features(t.as_py()) for t in texts])
            return pa.array(1.0 / (1.0 + np.exp(-np.clip(model.logits(x), -500, 500))))

        return compute.asNondeterministic()(text)


def held_out(identity: Column) -> Column:
    """The third of all rows that no label is learnt from. Rows without identity are not."""
    crc = F.crc32(identity.cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def _sum_up(rows: DataFrame, function, size: int) -> np.ndarray:
    """The sum, over all partitions, of the vector that the function makes of each."""

    def each(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                x = x.reshape(batch.num_rows, -1)
                positive = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                total += function(x, positive)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])

    parts = rows.select("features", "positive").mapInArrow(each, "v array<double>")
    vector = Summarizer.sum(array_to_vector(F.col("v")))
    some = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("p"))
    some = some.agg(vector_to_array(vector).alias("v"))
    return np.array(some.agg(vector_to_array(vector).alias("v")).first()["v"])


def fit(training: DataFrame, prior: float, steps: int = 25) -> Model:
    """A model from (features array, positive boolean): positives, and every row as unlabelled.

    ``training`` is read once per step, so it should be stored.
    """
    d = len(text_features(""))

    def moments(x, positive):
        p = x[positive]
        return np.concatenate([[len(x), len(p)], x.sum(0), (x * x).sum(0), p.sum(0)])

    sums = _sum_up(training, moments, 2 + 3 * d)
    n, n_positive = sums[0], sums[1]
    if not n_positive:
        return Model((0.0,) * d, (1.0,) * d, (0.0,) * d, 0.0, prior)
    mean = sums[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(sums[2 + d : 2 + 2 * d] / n - mean**2, 0)) + 1e-6
    towards = np.append((sums[2 + 2 * d :] / n_positive - mean) / scale, 1.0)

    def pass_over(w):
        def parts(x, positive):
            z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
            logits = z @ w
            loss = np.logaddexp(0, logits)
            s = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            hessian = (z * (s * (1 - s))[:, None]).T @ z
            return np.concatenate([[loss.sum(), loss[positive].sum()], s @ z, hessian.ravel()])

        total = _sum_up(training, parts, 2 + (d + 1) + (d + 1) ** 2)
        unlabelled, positives = total[0] / n, total[1] / n_positive
        risk = -prior * (towards @ w) + unlabelled + RIDGE / 2 * (w[:-1] @ w[:-1])
        ridge = np.append(np.full(d, RIDGE), 0.0)
        gradient = -prior * towards + total[2 : 3 + d] / n + ridge * w
        hessian = total[3 + d :].reshape(d + 1, d + 1) / n + np.diag(ridge + 1e-9)
        return risk, unlabelled - prior * positives, gradient, hessian

    w = np.zeros(d + 1)
    w[-1] = np.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
    risk, _, gradient, hessian = pass_over(w)
    for _ in range(steps):
        step = -np.linalg.solve(hessian, gradient)
        if -(gradient @ step) < 1e-7:
            break
        for _ in range(8):
            new = pass_over(w + step)
            if new[0] <= risk and new[1] >= 0:
                break
            step = step / 2
        else:
            break
        w = w + step
        risk, _, gradient, hessian = new
    return Model(tuple(mean), tuple(scale), tuple(w[:-1]), float(w[-1]), prior)


def estimate_prior(training: DataFrame) -> float:
    """The share of positives among all rows of (features, positive), those marked included.

    The least ratio of shares over the sets of rows above a score that hold LEAST_SHARE of the
    positives, as smaller ones are a matter of chance. Rows are scored by a model of the other
    half, as a model's own positives score higher than others.
    """
    half = F.pmod(F.xxhash64("features"), F.lit(2))
    counts = None
    for side in range(2):
        model = fit(training.filter(half != side), 0.5)
        own = training.filter(half == side).select(model.logit_bin(F.col("features")).alias("bin"), "positive")
        counts = own if counts is None else counts.unionByName(own)
    rows = counts.groupBy("bin").agg(F.count("*").alias("n"), F.count_if("positive").alias("p")).collect()
    if not rows or not sum(r["p"] for r in rows):
        return 0.5
    rows.sort(key=lambda r: -r["bin"])
    n, p = (np.cumsum([r[c] for r in rows]) for c in ("n", "p"))
    unlabelled, positive = n / n[-1], p / p[-1]
    ratio = (unlabelled / np.maximum(positive, LEAST_SHARE))[positive >= LEAST_SHARE]
    return float(np.clip(ratio.min(), 0.01, 0.99))


def with_features(docs: DataFrame, labels: DataFrame, identity: str, label: str, text: str) -> DataFrame:
    """(identity, features, held_out, label), stored; the label is NULL where there is none."""
    facts = docs.select(F.col(identity).alias("_id"), feature_column(F.col(text)).alias("features"))
    known = labels.filter(F.col(identity).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(identity).alias("_label_id")).agg(F.min(label).alias("label"))
    # By shuffle whatever the number of labels, which grows with the documents.
    joined = facts.join(known.hint("merge"), F.col("_id") == F.col("_label_id"), "left")
    rows = joined.select("_id", "features", held_out(F.col("_id")).alias("held_out"), "label")
    return stored(rows, "features")


def train(
    docs: DataFrame,
    labels: DataFrame,
    identity: str = "doc_id",
    label: str = "quality",
    text: str = "text",
    prior: float | None = None,
) -> tuple[Model, DataFrame]:
    """A model of ``label`` = 1, and the stored features. Held-out rows are not learnt from."""
    rows = with_features(docs, labels, identity, label, text)
    positive = F.coalesce(F.col("label") == 1, F.lit(False))
    training = rows.filter("NOT held_out").select("features", positive.alias("positive"))
    return fit(training, estimate_prior(training) if prior is None else prior), rows
