"""Quality by supervised subword embeddings.

A document is the mean of learned vectors: one for each hashed word, character n-gram and pair
of neighbouring equal words. A linear layer and a softmax turn the mean into a probability.
Vectors and layer are trained by stochastic gradient descent in numpy, on a bounded sample of
labelled documents. As the layer is linear, scoring needs one number per bucket, and is a few
numpy passes over the code points of a batch: no dictionary, so memory does not grow with the
vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.hashed import Points, held_out, sampled
from propensity.llm.texts import map_batches, mix32, pieces, strings

BUCKETS = 1 << 17
WIDTHS = (2, 3, 4)       # characters of an n-gram; one white space counts as a word's edge
ROWS = 3000              # labelled documents to learn from, at most
PARTS, LEFT_OUT = 3, 1


def each_feature(p: Points):
    """(positions, buckets) of words, of equal neighbours and of the n-grams of each width."""
    starts, ends = p.runs(~p.space)
    words = p.run_hashes(p.code, starts, ends)
    yield starts, words % np.uint32(BUCKETS)
    text = p.text_of(starts)
    again = np.concatenate(([False], (words[1:] == words[:-1]) & (text[1:] == text[:-1])))[:len(words)]
    yield starts[again], np.full(int(again.sum()), 7, np.uint32)
    code = np.where(p.space, np.uint32(32), p.code)
    h = code + np.uint32(1)
    inner = np.zeros(len(code), bool)   # white space strictly inside the n-gram
    for n in range(2, max(WIDTHS) + 1):
        if len(code) < n:
            return
        h = h[:-1] * np.uint32(0x01000193) + code[n - 1:]
        if n > 2:
            inner = inner[:len(h)] | p.space[n - 2:len(code) - 1]
        else:
            inner = p.space[:-1] & p.space[1:]
        if n in WIDTHS:
            at = np.flatnonzero(~inner)
            yield at, mix32(h[at] + np.uint32(n)) % np.uint32(BUCKETS)


@dataclass
class Model:
    """Per bucket the difference of the two classes' outputs (NaN: not seen), and the bias."""
    table: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text; without known features that of the bias."""
        out = []
        known = ~np.isnan(self.table)
        value = np.where(known, self.table, 0).astype(np.float64)
        for first, last in pieces(texts):
            p = Points(texts[first:last])
            total, count = np.zeros(last - first), np.zeros(last - first)
            for at, bucket in each_feature(p):
                cuts = np.searchsorted(at, p.starts)
                sums = lambda v, cuts=cuts: np.diff(np.concatenate((np.zeros(1), np.cumsum(v)))[np.append(cuts, len(v))])
                total += sums(value[bucket])
                count += sums(known[bucket])
            out.append(1 / (1 + np.exp(-(self.bias + total / np.maximum(count, 1)))))
        return np.concatenate(out) if out else np.zeros(0)


def counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their counts, of each text."""
    out = []
    for text in texts:
        parts = [bucket for _, bucket in each_feature(Points([text]))]
        out.append(np.unique(np.concatenate(parts), return_counts=True))
    return out


def train(data: list[tuple[np.ndarray, np.ndarray, int]], size: int = 8, epochs: int = 4, rate: float = 40.0,
          least: int = 3, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, counts, label); the rate falls to 0 in a line.

    Buckets of fewer than ``least`` documents are left out. Without any data every score is 0.5;
    with one label only, near that label.
    """
    if not data:
        return Model(np.full(BUCKETS, np.nan), 0.0)
    used = np.bincount(np.concatenate([b for b, _, _ in data]), minlength=BUCKETS) >= least
    row = np.cumsum(used) - 1
    rows = []
    for bucket, count, label in data:
        own = used[bucket]
        n = count[own].astype(np.float32)
        rows.append((row[bucket[own]], n / max(1.0, n.sum()), label))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (int(used.sum()), size)).astype(np.float32)
    share = np.clip(np.mean([y for *_, y in rows]), 0.001, 0.999)
    layer, bias = np.zeros((2, size), np.float32), np.array([0, np.log(share / (1 - share))], np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, weight, label = rows[i]
            now = 1 - step / steps
            step += 1
            mean = weight @ vectors[at] if len(at) else np.zeros(size, np.float32)
            out = layer @ mean + bias
            p = np.exp(out - out.max())
            error = -p / p.sum()
            error[label] += 1
            back = error @ layer
            layer += 0.5 * now * np.outer(error, mean)
            bias += 0.01 * now * error
            if len(at):
                vectors[at] += (rate * now * weight)[:, None] * back
    table = np.full(BUCKETS, np.nan)
    table[used] = vectors @ (layer[1] - layer[0])
    return Model(table, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_col: str = "doc_id",
        text: str = "text") -> Model:
    """The model of at most ``rows`` labelled documents outside the held-out part."""
    def work():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = counted(strings(batch, "text"))
            return pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "label": batch.column("label"),
                "bucket": pa.array([b.astype(np.int32) for b, _ in got], pa.list_(pa.int32())),
                "count": pa.array([n.astype(np.int32) for _, n in got], pa.list_(pa.int32()))})
        return each

    rows_in = sampled(docs, labels, label, rows, PARTS, LEFT_OUT, id_col, text)
    kind = dict(rows_in.dtypes)["id"]
    got = map_batches(rows_in.select("id", "text", "label"), work,
                      f"id {kind}, label int, bucket array<int>, count array<int>").toArrow()
    order = got.column("id").to_numpy().argsort(kind="stable")
    bucket, count, label_ = (got.column(c).combine_chunks() for c in ("bucket", "count", "label"))
    return train([(bucket[int(i)].values.to_numpy(), count[int(i)].values.to_numpy(), label_[int(i)].as_py()) for i in order])


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted.

    Whole texts are scored; null counts as empty, and a text without known features has the
    share of label 1 as its score. A null id is not held out. Repeated rows repeat.
    """
    model = fit(docs, labels, id_col=id_col, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        own = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"id": batch.column("id"),
                                               "score": pa.array(own.scores(strings(batch, "text")), pa.float64())})
        return each

    kind = dict(docs.dtypes)[id_col]
    got = map_batches(docs.select(docs[id_col].alias("id"), docs[text].alias("text")), work, f"id {kind}, score double")
    return got.select(F.col("id").alias(id_col), held_out(F.col("id"), PARTS, LEFT_OUT).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
