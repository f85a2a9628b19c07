"""Boosted trees on blocks of binned rows: the trees that MLlib's ``GBTClassifier`` grows, from smaller and fewer scans.

A row's features are binned once and lie, with thousands of others, in one block of a table; a pass over the table
reads a byte for each feature. A level of a tree is one pass: a task counts rows, residuals and their squares by node,
feature and bin, the counts are added by node and feature over all tasks, and only the best split of each
comes to the driver. The state between two trees (margins, drawn rows) is a table again.

Bins, drawn rows, drawn columns, splits and leaves follow MLlib's rules and random numbers, so a model is the
one that its estimator would return; it is given as such.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators import draws
from propensity.session import work_folder

# The functions that tasks run are sent with them: executors need no copy of this package.
for _name in (__name__, draws.__name__):
    cloudpickle.register_pickle_by_value(sys.modules[_name])

# Up to so many rows MLlib's own estimator is faster, as its jobs are short; the trees are the same.
LEAST_ROWS = 2_000_000
BLOCK = 32768            # rows of a block
GROUP_BYTES = 256 << 20  # MLlib's bound on the counts of the nodes that are split together
# Bytes after which a file of blocks begins a new part that a task can read by itself.
PART_BYTES = 16 << 20
BLOCKS = "part int, block int, held boolean, n int, labels binary, bins binary"
STATE = f"{BLOCKS}, margins binary, drawn binary, loss double"
COUNTS = "slot int, feature int, part int, n binary, sums binary, squares binary"
# Counts of a level that the driver adds up itself; more are added by node and feature in tasks.
DRIVER_BYTES = 16 << 20
SPLITS = "slot int, feature int, gain double, impurity double, parent binary, left binary, right binary, goes_left binary"
INVALID = -sys.float_info.max


def _write(df: DataFrame, label: str) -> str:
    folder = work_folder(df.sparkSession, label)
    (df.write.option("parquet.block.size", PART_BYTES).option("parquet.block.size.row.check.min", 2)
     .option("parquet.page.size.row.check.min", 2).parquet(folder))
    return folder


def _remove(spark, folder: str | None) -> None:
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# --- bins -----------------------------------------------------------------------

@dataclass
class Binned:
    """Blocks of a fold's rows, and what a bin of each feature stands for."""

    folder: str
    rows: int
    arity: dict[int, int]            # categories of the features that have them
    thresholds: dict[int, np.ndarray]  # of the others
    width: int
    counts: list[int] = field(default_factory=list)  # bins of each feature

    def __post_init__(self):
        self.counts = [self.arity[f] if f in self.arity else len(self.thresholds[f]) + 1 for f in range(self.width)]

    @property
    def kind(self) -> str:
        most = max(self.counts)
        return "uint8" if most <= 1 << 8 else "uint16" if most <= 1 << 16 else "uint32"


def _categories(rows: DataFrame, features: str) -> tuple[int, dict[int, int]]:
    """Width of the vector and the number of categories of each feature that has them, from its metadata."""
    spark = rows.sparkSession
    of = spark._jvm.org.apache.spark.ml
    shown = rows._jdf.schema().apply(features)
    found = spark._jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(shown)
    pairs = found.toSeq()
    arity = {int(pairs.apply(i)._1()): int(pairs.apply(i)._2()) for i in range(pairs.size())}
    width = of.attribute.AttributeGroup.fromStructField(shown).size()
    if width < 0:
        first = rows.select(F.size(vector_to_array(features)).alias("n")).first()
        width = 0 if first is None else first["n"]
    return width, arity


def _drawn(df: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows that MLlib draws to find thresholds: they depend on the places of the rows in their tasks."""
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd().sample(False, share, seed)
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def _thresholds_of(values: np.ndarray, most: int, expected: float) -> np.ndarray:
    """Thresholds from the drawn values of a feature; zeros are counted as those that are missing to ``expected``."""
    values = values[values != 0.0]
    if not len(values):
        return np.empty(0)
    found, n = np.unique(values, return_counts=True)
    n = n.astype(np.float64)
    rest = expected - float(len(values))
    if rest > 2.220446049250313e-16 * len(values) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, n = np.insert(found, at, 0.0), np.insert(n, at, rest)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    out, upto, target = [], n[0], stride
    for i in range(1, len(found)):
        before, upto = upto, upto + n[i]
        if abs(before - target) < abs(upto - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def _thresholds(drawn: DataFrame, features: str, wanted: Sequence[int], most: int, expected: float) -> dict[int, np.ndarray]:
    def run(key, table):
        found = _thresholds_of(table.column("x").to_numpy(), most, expected)
        return pa.table({"f": pa.array([key[0].as_py()], pa.int32()), "t": pa.array([found.tolist()], pa.list_(pa.float64()))})

    values = drawn.select(F.posexplode(vector_to_array(features)).alias("f", "x")).where(F.col("f").isin(list(wanted)))
    rows = values.groupBy("f").applyInArrow(run, "f int, t array<double>").collect() if wanted else []
    return {f: np.empty(0) for f in wanted} | {r["f"]: np.array(r["t"], np.float64) for r in rows}


def bin_rows(fit: DataFrame, held: DataFrame | None, filling: Sequence, base: str, gaps: Sequence[str], fills: Sequence[float],
             max_bins: int, seed: int) -> Binned:
    """Blocks of the rows to fit on and, marked, of held ones. ``filling`` makes ``features`` from both: the vector
    ``base`` and after it the numbers ``gaps``, those that are missing as ``fills``."""
    spark = fit.sparkSession
    full = PipelineModel(list(filling)).transform
    n = fit.count()
    if not n:
        raise ValueError("no rows to fit trees on")
    width, arity = _categories(full(fit), "features")
    bins = min(max_bins, n)
    if any(v > bins for v in arity.values()):
        raise ValueError(f"a feature with {max(arity.values())} categories needs as many bins and rows; there are {bins}")
    asked = max(bins * bins, 10_000)
    share = asked / n if asked < n else 1.0
    sample = _drawn(fit, share, draws.Register(seed).integer()) if share < 1.0 else fit
    wanted = [f for f in range(width) if f not in arity]
    out = Binned("", n, arity, _thresholds(full(sample), "features", wanted, bins - 1, share * n), width)
    thresholds, kind, before = out.thresholds, out.kind, width - len(gaps)

    def blocks(held: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, block, kept, size = TaskContext.get().partitionId(), 0, [], 0

            def pack(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
                found = np.empty((width, len(y)), kind)
                for f in range(width):
                    if f in thresholds:
                        found[f] = np.searchsorted(thresholds[f], x[:, f])
                    else:
                        code = x[:, f].astype(np.int64)
                        if len(code) and (code.min() < 0 or code.max() >= arity[f]):
                            raise ValueError(f"feature {f} has a category beyond its {arity[f]}")
                        found[f] = code
                one = [[part], [block], [held], [len(y)], [y.astype(np.int8).tobytes()], [found.tobytes()]]
                kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
                return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, kinds)],
                                                  ["part", "block", "held", "n", "labels", "bins"])
            for batch in batches:
                y, x = batch.column("label").to_numpy(zero_copy_only=False), np.empty((batch.num_rows, width))
                x[:, :before] = batch.column("base").flatten().to_numpy(zero_copy_only=False).reshape(-1, before)
                for i, (gap, fill) in enumerate(zip(gaps, fills)):
                    x[:, before + i] = batch.column(gap).fill_null(fill).to_numpy(zero_copy_only=False)
                if not np.isin(y, (0.0, 1.0)).all() or not np.isfinite(x).all():
                    raise ValueError("labels must be 0 or 1 and features numbers")
                kept.append((x, y))
                size += len(y)
                while size >= BLOCK:
                    x, y = (np.concatenate(v) for v in zip(*kept))
                    yield pack(x[:BLOCK], y[:BLOCK])
                    kept, size, block = [(x[BLOCK:], y[BLOCK:])], size - BLOCK, block + 1
            if size:
                yield pack(*(np.concatenate(v) for v in zip(*kept)))
        return run

    made = [df.select("label", vector_to_array(base).alias("base"), *gaps).mapInArrow(blocks(mark), BLOCKS)
            for df, mark in ((fit, False), (held, True)) if df is not None]
    out.folder = _write(made[0] if len(made) == 1 else made[0].unionByName(made[1]), "blocks")
    return out


# --- trees ----------------------------------------------------------------------

class Stats:
    """Number, sum and sum of squares of the residuals of some rows."""

    def __init__(self, values: Sequence[float]):
        self.n, self.sum, self.squares = (float(v) for v in values)

    @property
    def impurity(self) -> float:
        return (self.squares - self.sum * self.sum / self.n) / self.n if self.n else 0.0

    @property
    def predict(self) -> float:
        return self.sum / self.n if self.n else 0.0


@dataclass
class Node:
    """A node by its place: the children of ``i`` are 2 ``i`` and 2 ``i`` + 1."""

    at: int
    stats: Stats | None = None
    impurity: float = 0.0
    gain: float = 0.0
    feature: int = -1
    goes_left: np.ndarray | None = None  # by bin


def _impurity(n, s, sq):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (sq - s * s / n) / n)


def best_of(n: np.ndarray, s: np.ndarray, sq: np.ndarray, category: bool, parent: tuple | None, least: int) -> tuple | None:
    """The first best split of one feature in a node: gain, impurity, stats of both sides and of all, and the
    bins that go left. ``parent`` has impurity and stats of the node where they are known."""
    if len(n) < 2:
        return None
    order = np.arange(len(n))
    if category:
        with np.errstate(divide="ignore", invalid="ignore"):
            order = np.argsort(np.where(n == 0, sys.float_info.max, s / n), kind="stable")
    run = [np.cumsum(v[order]) for v in (n, s, sq)]
    left, whole = [v[:-1] for v in run], [v[-1] for v in run]
    right = [w - v for w, v in zip(whole, left)]
    if parent is None:
        stats = [float(a[0] + b[0]) for a, b in zip(left, right)]
        parent = (float(_impurity(*map(np.float64, stats))), stats)
    impurity, stats = parent
    total = left[0] + right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = impurity - left[0] / total * _impurity(*left) - right[0] / total * _impurity(*right)
    bad = (left[0] < least) | (right[0] < least) | (gains < 0.0)
    gains = np.where(bad, INVALID, gains)
    at = int(np.argmax(gains))
    goes_left = np.zeros(len(n), np.bool_)
    goes_left[order[:at + 1]] = True
    return float(gains[at]), impurity, stats, [float(v[at]) for v in left], [float(v[at]) for v in right], goes_left


def _gain(option: tuple, impurity: float) -> float:
    gain, _, _, left, right, _ = option
    if gain == INVALID:
        return gain
    total = left[0] + right[0]
    return float(impurity - left[0] / total * _impurity(*left) - right[0] / total * _impurity(*right))


def _routes(nodes: Mapping[int, Node], bins: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """The rows that end in each node of a tree that is grown so far."""
    out, open_ = {}, [(1, rows)]
    while open_:
        at, mine = open_.pop()
        node = nodes[at]
        if node.goes_left is None:
            out[at] = mine
        else:
            left = node.goes_left[bins[node.feature][mine]]
            open_ += [(2 * at, mine[left]), (2 * at + 1, mine[~left])]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], binned: Binned) -> Iterator[tuple]:
    """Each block as part, block, held, labels, bins (feature by row) and the columns after them."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            part, block, held, n, labels, bins = (batch.column(c)[i] for c in range(6))
            rest = {c: batch.column(c)[i] for c in names[6:]}
            yield (part.as_py(), block.as_py(), held.as_py(), np.frombuffer(labels.as_buffer(), np.int8),
                   np.frombuffer(bins.as_buffer(), binned.kind).reshape(binned.width, n.as_py()), rest)


def _draw(part: int, block: int, n: int, share: float, seed: int, held: bool) -> np.ndarray:
    if held:
        return np.zeros(n, np.bool_)
    return np.ones(n, np.bool_) if share >= 1.0 else draws.doubles(seed + part + 1, block * BLOCK, n) < share


def _residuals(labels: np.ndarray, margins: np.ndarray) -> np.ndarray:
    signed = 2.0 * labels - 1.0
    with np.errstate(over="ignore"):
        return 4.0 * signed / (1.0 + np.exp(2.0 * signed * margins))


class Booster:
    """Grows the trees of one model."""

    def __init__(self, binned: Binned, estimator: GBTClassifier, spark):
        self.binned, self.spark = binned, spark
        self.depth, self.least = estimator.getMaxDepth(), estimator.getMinInstancesPerNode()
        self.share, self.seed = estimator.getSubsamplingRate(), estimator.getSeed()
        self.columns = math.ceil(float(estimator.getFeatureSubsetStrategy()) * binned.width)
        self.rate = estimator.getStepSize()
        self.folder: str | None = None
        self._read(BLOCKS, binned.folder)

    def _read(self, schema: str, folder: str) -> None:
        self.table = self.spark.read.schema(schema).parquet(folder)
        self.tasks = self.table._jdf.queryExecution().toRdd().getNumPartitions()

    # Counts of one level.
    def splits(self, nodes: Mapping[int, Node], group: Sequence[Node]) -> dict[tuple[int, int], tuple]:
        """(slot, feature) to the best split, for the nodes of a group; feature -1 has the stats of all rows."""
        binned, share, seed, least = self.binned, self.share, self.seed, self.least
        slots = {node.at: i for i, node in enumerate(group)}
        features = [f for f in range(binned.width) if binned.counts[f] > 1]
        counts, categories = binned.counts, set(binned.arity)
        parents = [None if node.stats is None else (node.stats.impurity, [node.stats.n, node.stats.sum, node.stats.squares])
                   for node in group]

        widths = {f: len(slots) * (counts[f] if f >= 0 else 1) for f in (-1, *features)}

        def count(batches: Iterator[pa.RecordBatch], apart: bool) -> Iterator[pa.RecordBatch]:
            found, first = None, 0
            for part, block, held, labels, bins, rest in _blocks(batches, binned):
                if held:
                    continue
                if "margins" in rest:
                    drawn = np.frombuffer(rest["drawn"].as_buffer(), np.bool_)
                    residuals = _residuals(labels, np.frombuffer(rest["margins"].as_buffer(), np.float64))
                else:
                    drawn, residuals = _draw(part, block, len(labels), share, seed, False), 2.0 * labels - 1.0
                rows = np.flatnonzero(drawn)
                slot = np.full(len(labels), -1, np.intp)
                for at, mine in _routes(nodes, bins, rows).items():
                    if at in slots:
                        slot[mine] = slots[at]
                rows = np.flatnonzero(slot >= 0)
                slot, y = slot[rows], residuals[rows]
                squares = y * y
                if found is None:
                    found, first = {f: np.zeros((3, n)) for f, n in widths.items()}, part
                for f, sums in found.items():
                    key = slot if f < 0 else slot * counts[f] + bins[f][rows]
                    for i, weights in enumerate((None, y, squares)):
                        sums[i] += np.bincount(key, weights, sums.shape[1])
            if found is not None:
                out = [(-1, -1, first, *(np.concatenate([sums[i] for sums in found.values()]).tobytes() for i in range(3)))]
                if apart:
                    out = [(s, f, first, *(v.reshape(len(slots), -1)[s].tobytes() for v in sums))
                           for f, sums in found.items() for s in range(len(slots))]
                kinds = [pa.int32()] * 3 + [pa.binary()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)],
                                                 ["slot", "feature", "part", "n", "sums", "squares"])

        def added(values) -> list[np.ndarray]:
            """Of each of the three, the sum over the parts, one after the other."""
            return [np.cumsum([np.frombuffer(v, np.float64) for v in column], axis=0)[-1] for column in values]

        def best(slot: int, feature: int, n: np.ndarray, s: np.ndarray, sq: np.ndarray) -> tuple:
            if feature < 0:
                return INVALID, 0.0, [float(v[0]) for v in (n, s, sq)], [], [], np.zeros(0, np.bool_)
            return best_of(n, s, sq, feature in categories, parents[slot], least)

        def grouped(key, table):
            slot, feature = (k.as_py() for k in key)
            table = table.sort_by("part")
            sums = added([v.as_buffer() for v in table.column(c)] for c in ("n", "sums", "squares"))
            gain, impurity, *stats, goes_left = best(slot, feature, *sums)
            row = (slot, feature, gain, impurity, *(np.array(v, np.float64).tobytes() for v in stats), goes_left.tobytes())
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), *[pa.binary()] * 4]
            names = ["slot", "feature", "gain", "impurity", "parent", "left", "right", "goes_left"]
            return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        apart = 24 * sum(widths.values()) * self.tasks > DRIVER_BYTES
        found = self.table.mapInArrow(lambda batches: count(batches, apart), COUNTS)
        if not apart:
            # A row for each task.
            tasks = sorted(found.collect(), key=lambda r: r["part"])
            sums = np.array(added([r[c] for r in tasks] for c in ("n", "sums", "squares")))
            ends = np.cumsum([0, *widths.values()])
            return {(s, f): best(s, f, *sums[:, a:b].reshape(3, len(slots), -1)[:, s])
                    for f, a, b in zip(widths, ends, ends[1:]) for s in range(len(slots))}
        out = {}
        for r in found.groupBy("slot", "feature").applyInArrow(grouped, SPLITS).collect():
            stats = [np.frombuffer(r[c], np.float64).tolist() for c in ("parent", "left", "right")]
            out[r["slot"], r["feature"]] = (r["gain"], r["impurity"], *stats, np.frombuffer(r["goes_left"], np.bool_))
        return out

    def tree(self, seed: int) -> dict[int, Node]:
        """The nodes of one tree. Columns are drawn for a node when it comes to be split, the last right child first."""
        binned = self.binned
        random = self.spark._jvm.java.util.Random(seed)
        nodes = {1: Node(1)}
        open_ = [nodes[1]]
        while open_:
            group, chosen, used = [], [], 0
            while open_:
                columns = list(range(binned.width))
                if self.columns < binned.width:
                    columns = draws.reservoir(binned.width, self.columns, random.nextLong())
                size = 24 * sum(binned.counts[f] for f in columns)
                if used and used + size > GROUP_BYTES:
                    break
                group.append(open_.pop())
                chosen.append(columns)
                used += size
            found = self.splits(nodes, group)
            for slot, (node, columns) in enumerate(zip(group, chosen)):
                whole = found[slot, -1][2]
                options = [(found[slot, f], f) for f in columns if (slot, f) in found]
                if not options:
                    node.stats = node.stats or Stats(whole)
                    node.impurity = -1.0
                    continue
                if node.stats is None:
                    # All features are measured against the impurity that the first one finds.
                    options = [((_gain(o, options[0][0][1]), *options[0][0][1:3], *o[3:]), f) for o, f in options]
                (gain, impurity, stats, left, right, goes_left), feature = max(options, key=lambda o: o[0][0])
                node.stats, node.gain = Stats(stats), gain
                node.impurity = impurity if gain != INVALID else -1.0
                if gain <= 0:
                    continue
                node.feature, node.goes_left = feature, goes_left
                last = (2 * node.at).bit_length() - 1 == self.depth
                for at, values in ((2 * node.at, left), (2 * node.at + 1, right)):
                    child = nodes[at] = Node(at, Stats(values))
                    child.impurity = child.stats.impurity
                    if not last and abs(child.impurity) >= 2.220446049250313e-16:
                        open_.append(child)
        return nodes

    def advance(self, nodes: Mapping[int, Node], weight: float, seed: int) -> float:
        """The state after a tree; the sum of the loss of the held rows."""
        binned, share = self.binned, self.share

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, block, held, labels, bins, rest in _blocks(batches, binned):
                n = len(labels)
                margins = np.frombuffer(rest["margins"].as_buffer(), np.float64).copy() if "margins" in rest else np.zeros(n)
                for at, mine in _routes(nodes, bins, np.arange(n)).items():
                    margins[mine] += weight * nodes[at].stats.predict
                loss = float(np.sum(2.0 * np.logaddexp(0.0, -2.0 * (2.0 * labels - 1.0) * margins))) if held else 0.0
                row = (part, block, held, n, labels.tobytes(), bins.tobytes(), margins.tobytes(),
                       _draw(part, block, n, share, seed, held).tobytes(), loss)
                kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int32(), *[pa.binary()] * 4, pa.float64()]
                names = ["part", "block", "held", "n", "labels", "bins", "margins", "drawn", "loss"]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        folder = _write(self.table.mapInArrow(run, STATE), "boosting")
        _remove(self.spark, self.folder)
        self.folder = folder
        self._read(STATE, folder)
        return self.table.where("held").agg(F.sum("loss")).first()[0] if self.validated else 0.0

    def fit(self, rounds: int, tolerance: float | None = None, held: int = 0) -> list[tuple[dict[int, Node], float]]:
        """Trees and their weights. With a tolerance, up to the round after which the mean loss of the held rows no longer falls
        by it."""
        out: list[tuple[dict[int, Node], float]] = []
        best, keep = math.inf, 1
        self.validated = tolerance is not None
        try:
            while len(out) < rounds:
                m = len(out)
                nodes = self.tree(self.seed + m)
                out.append((nodes, 1.0 if m == 0 else self.rate))
                if tolerance is None and m + 1 == rounds:
                    break
                loss = self.advance(nodes, out[-1][1], self.seed + m + 1)
                if tolerance is not None:
                    loss = loss / held if held else math.nan
                    if m == 0:
                        best = loss
                    elif best - loss < tolerance * max(loss, 0.01):
                        break
                    elif loss < best:
                        best, keep = loss, m + 1
        finally:
            _remove(self.spark, self.folder)
        return out if tolerance is None else out[:keep]


# --- MLlib's model --------------------------------------------------------------

def _java_node(spark, nodes: Mapping[int, Node], at: int, binned: Binned):
    """MLlib's node and, of a leaf, its prediction. Leaves of one prediction become one."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    tree = jvm.org.apache.spark.ml.tree
    node = nodes[at]
    numbers = gateway.new_array(jvm.double, 3)
    numbers[0], numbers[1], numbers[2] = node.stats.n, node.stats.sum, node.stats.squares
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(numbers, int(node.stats.n))
    if node.goes_left is not None:
        (left, a), (right, b) = (_java_node(spark, nodes, 2 * at + i, binned) for i in (0, 1))
        if a is None or a != b:
            split = _java_split(spark, node, binned)
            return tree.InternalNode(node.stats.predict, node.impurity, node.gain, left, right, split, calculator), None
    return tree.LeafNode(node.stats.predict, node.impurity, calculator), node.stats.predict


def _java_split(spark, node: Node, binned: Binned):
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    if node.feature not in binned.arity:
        edge = int(np.flatnonzero(node.goes_left)[-1])
        return jvm.org.apache.spark.ml.tree.ContinuousSplit(node.feature, float(binned.thresholds[node.feature][edge]))
    mine = [float(c) for c in np.flatnonzero(node.goes_left)]
    left = gateway.new_array(jvm.double, len(mine))
    for i, c in enumerate(mine):
        left[i] = c
    return jvm.org.apache.spark.ml.tree.CategoricalSplit(node.feature, left, binned.arity[node.feature])


def model_of(trees: Sequence[tuple[Mapping[int, Node], float]], binned: Binned, estimator: GBTClassifier, spark) -> GBTClassificationModel:
    """The trees as the model that the estimator returns."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    made, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, (nodes, weight) in enumerate(trees):
        made[i], weights[i] = kind(_java_node(spark, nodes, 1, binned)[0], binned.width), float(weight)
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(estimator.uid, made, weights, binned.width, 2)
    return estimator._copyValues(estimator._create_model(java))


def fit_trees(binned: Binned, estimator: GBTClassifier, spark, tolerance: float | None = None, held: int = 0) -> GBTClassificationModel:
    return model_of(Booster(binned, estimator, spark).fit(estimator.getMaxIter(), tolerance, held), binned, estimator, spark)
