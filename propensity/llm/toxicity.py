"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms (runs of letters and digits, A-Z lower-cased), hashed to
``1 << BITS`` buckets. The score is a logistic function of a bias, one weight per term and the
inner products of the latent vectors of every two terms, so that two terms that mean little
alone (an insult word, a group) can weigh together. The pairs cost no more than the terms:
half the difference of squared sum and sum of squares. Trained in numpy on a bounded sample of
labelled documents; terms not seen there say nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.hashed import Points, held_out, sampled
from propensity.llm.texts import map_batches, pieces, strings

BITS = 22                # wide enough that a rare term seldom shares the bucket of a learned one
ROWS = 6000              # labelled documents to learn from, at most
PARTS, LEFT_OUT = 4, 2
THRESHOLD = 0.3


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every term, repeats included."""
    p = Points(texts)
    code = p.lowered()
    inside = (code > 127) | ((code >= 97) & (code <= 122)) | ((code >= 48) & (code <= 57))
    starts, ends = p.runs(inside)
    return (p.run_hashes(code, starts, ends) & np.uint32((1 << BITS) - 1)).astype(np.int32), p.text_of(starts)


@dataclass
class Model:
    """Learned buckets in ascending order with weight and latent vector; bias."""
    buckets: np.ndarray
    weight: np.ndarray
    latent: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text; without known terms that of the bias."""
        place = np.full(1 << BITS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        out = []
        for first, last in pieces(texts):
            bucket, text = terms(texts[first:last])
            at = place[bucket]
            known = at >= 0
            pair = np.unique(text[known].astype(np.int64) << 32 | at[known])  # a term counts once
            text, at = pair >> 32, pair & 0xFFFFFFFF
            n = last - first
            margin = self.bias + np.bincount(text, self.weight[at], n)
            for k in range(self.latent.shape[1]):
                v = self.latent[at, k]
                margin += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
            out.append(1 / (1 + np.exp(-np.clip(margin, -50, 50))))
        return np.concatenate(out) if out else np.zeros(0)


def ratio(one: np.ndarray, both: np.ndarray, n1: float, n: float) -> np.ndarray:
    """Likelihood-ratio statistic of presence (``both`` of n documents, ``one`` of them of label 1) against the label."""
    total = np.zeros(np.shape(both))
    for seen, wanted in ((one, both * n1), (both - one, both * (n - n1)), (n1 - one, (n - both) * n1),
                         (n - n1 - both + one, (n - both) * (n - n1))):
        total += 2 * seen * np.log(np.maximum(seen, 1e-9) * n / np.maximum(wanted, 1e-9))
    return total


def telling(data: list[tuple[np.ndarray, int]], least: float, least_pair: float = 40.0, support: float = 0.02,
            block: int = 512) -> np.ndarray:
    """Buckets whose presence depends on the label, alone or with another one.

    Alone: likelihood-ratio statistic of ``least`` or more. With another one: that of both being present
    is ``least_pair`` or more above the sum of their own. All pairs of terms in a share of ``support``
    or more of the documents are counted, ``block`` by ``block`` terms at a time.
    """
    flat = np.concatenate([b for b, _ in data])
    label = np.array([y for _, y in data], float)
    row = np.repeat(np.arange(len(data)), [len(b) for b, _ in data])
    buckets, at = np.unique(flat, return_inverse=True)
    one = np.bincount(at, label[row], len(buckets))
    both = np.bincount(at, minlength=len(buckets)).astype(float)
    n, n1 = len(data), label.sum()
    alone = ratio(one, both, n1, n)
    use = alone >= least

    often = np.flatnonzero(both >= max(2, support * n))
    place = np.full(len(buckets), -1)
    place[often] = np.arange(len(often))
    order = np.argsort(place[at], kind="stable")
    col, row = place[at][order], row[order]

    def present(first: int) -> np.ndarray:
        """Documents by terms ``first`` to ``first + block``: 1 where present."""
        low, high = np.searchsorted(col, (first, first + block))
        out = np.zeros((n, min(block, len(often) - first)), np.float32)
        out[row[low:high], col[low:high] - first] = 1
        return out

    for i in range(0, len(often), block):
        x = present(i)
        marked = x * label[:, None].astype(np.float32)
        for j in range(i, len(often), block):
            y = present(j)
            a, b = often[i:i + block], often[j:j + block]
            gain = ratio((marked.T @ y).astype(float), (x.T @ y).astype(float), n1, n) - alone[a][:, None] - alone[b]
            first, second = np.nonzero(gain >= least_pair)
            use[a[first]] = use[b[second]] = True
    return buckets[use]


def train(data: list[tuple[np.ndarray, int]], size: int = 4, epochs: int = 20, rate: float = 0.2, ridge: float = 0.0005,
          least: float = 15.0, seed: int = 7) -> Model:
    """Adaptive stochastic gradient descent over (buckets, label), one document at a time.

    Only terms ``telling`` alone or in a pair are learned; the bias stays at the log odds of label 1. Without data
    every score is 0.5.
    """
    if not data:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, size)), 0.0)
    buckets = telling(data, least)
    rows = [(np.searchsorted(buckets, b[np.isin(b, buckets, assume_unique=True)]), y) for b, y in data]
    rng = np.random.default_rng(seed)
    share = np.clip(np.mean([y for _, y in rows]), 0.001, 0.999)
    bias, weight = float(np.log(share / (1 - share))), np.zeros(len(buckets))
    latent = rng.normal(0, 0.01, (len(buckets), size))
    seen_w, seen_v = np.full(len(buckets), 1e-3), np.full((len(buckets), size), 1e-3)
    for epoch in range(epochs):
        now = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(rows)):
            at, label = rows[i]
            v = latent[at]
            total = v.sum(0)
            margin = bias + weight[at].sum() + 0.5 * float(total @ total - (v * v).sum())
            error = 1 / (1 + np.exp(-min(50.0, max(-50.0, margin)))) - label
            g = error + ridge * weight[at]
            seen_w[at] += g * g
            weight[at] -= now * g / np.sqrt(seen_w[at])
            g = error * (total - v) + ridge * v
            seen_v[at] += g * g
            latent[at] -= 0.1 * now * g / np.sqrt(seen_v[at])
    return Model(buckets.astype(np.int64), weight, latent, bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = ROWS, id_col: str = "doc_id",
        text: str = "text") -> Model:
    """The model of at most ``rows`` labelled documents outside the held-out part."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(terms([t])[0]) for t in strings(batch, "text")]
            return pa.RecordBatch.from_pydict({"id": batch.column("id"), "label": batch.column("label"),
                                               "bucket": pa.array(found, pa.list_(pa.int32()))})
        return each

    given = sampled(docs, labels, label, rows, PARTS, LEFT_OUT, id_col, text)
    kind = dict(given.dtypes)["id"]
    got = map_batches(given.select("id", "text", "label"), work, f"id {kind}, label int, bucket array<int>").toArrow()
    order = got.column("id").to_numpy().argsort(kind="stable")
    bucket, label_ = (got.column(c).combine_chunks() for c in ("bucket", "label"))
    return train([(bucket[int(i)].values.to_numpy(), label_[int(i)].as_py()) for i in order])


def _scorer(model):
    def work():
        own = model.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            s = own.scores(strings(batch, "_text"))
            return pa.RecordBatch.from_pydict({"_id": batch.column("_id"), "_score": pa.array(s, pa.float64())})
        return each
    return work


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted.

    Whole texts are scored; null counts as empty, and a text without known terms has the share
    of label 1 as its score. A null id is not held out. Repeated rows repeat.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text=text))
    kind = dict(docs.dtypes)[id_col]
    got = map_batches(docs.select(docs[id_col].alias("_id"), docs[text].alias("_text")), _scorer(model),
                      f"_id {kind}, _score double")
    return got.select(F.col("_id").alias(id_col), held_out(F.col("_id"), PARTS, LEFT_OUT).alias("held_out"),
                      F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` without the rows that score at or above the threshold.

    No row moves between tasks, and only the text goes to Python; the other columns wait in the JVM.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text=text))

    @F.arrow_udf("double")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array(model.value.scores([x or "" for x in texts.to_pylist()]), pa.float64())
    return docs.where(clean(docs[text]) < threshold)
