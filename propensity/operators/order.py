"""Global order without a global sort task: running totals, ranks, exact quantiles, bins.

A window over the whole table would put every row in one task. Here the value range is
cut into buckets at quantiles of a sketch. Windows run inside a bucket, and the small table of
bucket totals carries the sums from one bucket to the next. The cut points are literals
read to the driver once, so a retried task sees the same buckets; results do not depend
on where the cuts fall, only the balance does. A small table is one bucket.

Numbers and times are cut by a double that never falls as the value rises (``place``), texts by texts.
Inside a bucket rows are ordered by the value itself, so whole numbers beyond the reach of a double are
ordered as they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from propensity import scale

BUCKET = "_bucket"
Cuts = Sequence[float] | Sequence[str]
# Texts are cut by so many first characters; those that share them all stand in one range.
TEXT_CUT = 1024
RADIX = 16               # texts a step of the search for a range looks at
# Steps of the sketch that finds where quantiles lie; the values between two or three of them are counted exactly.
SKETCH = 2_000


# --- cut points -----------------------------------------------------------------

def is_text(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] == "string"


def place(df: DataFrame, col: str) -> Column:
    """A double that never falls as ``col`` rises: the number or the time."""
    kind = dict(df.dtypes)[col]
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    # Adding zero turns -0.0 into 0.0, which compare equal everywhere else.
    return F.col(col).cast("double") + F.lit(0.0)


def _even(marks: Sequence, parts: int) -> list:
    """``parts`` - 1 of the sorted ``marks``, evenly spread."""
    return [marks[min(len(marks) - 1, i * (len(marks) + 1) // parts - 1)] for i in range(1, parts) if marks]


def _text_quantiles(df: DataFrame, col: str, parts: int) -> list[str]:
    """Of a bounded number of rows drawn by lot, the texts that split them evenly."""
    few = max(scale.SAMPLE_ROWS, scale.SAMPLE_PER_RANGE * parts)
    drawn = df.where(F.col(col).isNotNull()).select(F.substring(col, 1, TEXT_CUT).alias("t")).orderBy(F.rand(17)).limit(few)
    return _even(sorted(r["t"] for r in drawn.collect()), parts)


def _quantiles_of_places(df: DataFrame, cols: Sequence[str]) -> tuple[int, dict[str, list]]:
    """Number of rows, and about as many quantiles per column as ranges are wanted: one scan, and one for each text."""
    most = scale.MOST_RANGES
    probs = [i / most for i in range(1, most)]
    numbers = [c for c in cols if not is_text(df, c)]
    sketches = [F.percentile_approx(place(df, c), probs, 4 * most).alias(f"_q{i}") for i, c in enumerate(numbers)]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *sketches).first()
    parts = scale.range_count(df, row["_n"])
    found: dict[str, list] = {c: _even(row[f"_q{i}"] or [], parts) for i, c in enumerate(numbers)}
    for c in cols:
        if c not in found:
            found[c] = _text_quantiles(df, c, parts) if parts > 1 else []
    return row["_n"], found


def cut_points(df: DataFrame, col: str) -> list:
    """Sorted interior cuts that split ``col`` into balanced ranges; [] for one range.

    A value that fills a whole range (many ties) becomes a range of its own.
    """
    return _with_heavy_values(_quantiles_of_places(df, [col])[1][col])


def _with_heavy_values(quantiles: Sequence) -> list:
    after = {a for a, b in zip(quantiles, quantiles[1:]) if a == b}
    if any(isinstance(q, str) for q in quantiles):
        return sorted({*quantiles, *(a + "\0" for a in after)})
    return sorted(c for c in {*quantiles, *(math.nextafter(a, math.inf) for a in after)} if math.isfinite(c))


def _texts(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _count_upto(x: Column, cuts: Sequence[str]) -> Column:
    """How many of the sorted texts ``cuts`` are not after ``x``: a few are looked at on each of a few levels."""
    block = 1
    while block * RADIX < len(cuts):
        block *= RADIX
    found = F.lit(0)
    while block:
        # The last text of each inner block, listed by outer block; then those of the outer block x lies in.
        ends = [cuts[i] for i in range(block - 1, len(cuts), block)]
        lists = F.array(*[_texts(ends[i:i + RADIX]) for i in range(0, len(ends) + 1, RADIX)])
        found = found * RADIX + F.size(F.filter(F.get(lists, found), lambda c: c <= x))
        block //= RADIX
    return found


def _bucketizer(cols: Sequence[str], cuts: Sequence[Sequence[float]], outs: Sequence[str]) -> Bucketizer:
    # With no or one cut a far second one satisfies the three-point minimum.
    ends = [[-math.inf, *(c or [0.0]), math.inf] for c in cuts]
    return Bucketizer(splitsArray=ends, inputCols=list(cols), outputCols=list(outs), handleInvalid="keep")


def with_bucket(df: DataFrame, col: str, cuts: Cuts) -> DataFrame:
    """Append the range number of ``col``; 0 when there are no cuts, -1 for null."""
    if not cuts:
        return df.withColumn(BUCKET, F.when(F.col(col).isNull(), -1).otherwise(0))
    if is_text(df, col):
        return df.withColumn(BUCKET, F.coalesce(F.when(F.col(col).isNotNull(), _count_upto(F.col(col), cuts)), F.lit(-1)))
    keyed = _bucketizer(["_x"], [cuts], [BUCKET]).transform(df.withColumn("_x", place(df, col)))
    # Never null: joins on it then need no null filter, so both sides can share a shuffle.
    number = F.when(F.col(col).isNull(), -1).otherwise(F.col(BUCKET).cast("int"))
    return keyed.withColumn(BUCKET, F.coalesce(number, F.lit(-1))).drop("_x")


# --- running totals -------------------------------------------------------------

def running_totals(df: DataFrame, order: str, totals: Sequence[str], by: Sequence[str] = (),
                   cuts: Cuts = (), descending: bool = False) -> DataFrame:
    """Inclusive running sums ``cum_<col>`` of ``totals`` along ``order`` inside ``by``.

    ``df`` holds one row per (by, order): aggregate ties first, they share their totals.
    """
    by = list(by)
    key = F.col(order).desc() if descending else F.col(order).asc()
    if not cuts:
        # One range: nothing comes before it.
        upto = Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"cum_{c}": F.sum(c).over(upto) for c in totals})

    keyed = with_bucket(df, order, cuts)
    upto = (Window.partitionBy(*by, BUCKET).orderBy(key)
            .rowsBetween(Window.unboundedPreceding, 0))
    inside = keyed.withColumns({f"_in_{c}": F.sum(c).over(upto) for c in totals})

    step = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    earlier = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    before = (keyed.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(c) for c in totals])
              .select(*by, BUCKET, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_pre_{c}")
                                     for c in totals]))
    joined = inside.join(before, [*by, BUCKET])
    return joined.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_pre_{c}")).alias(f"cum_{c}")
                                        for c in totals])


def ordered_cumsum(df: DataFrame, order: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Totals and running totals per distinct value of ``order``: one row per (by, value).

    Rows with equal ``order`` are summed before the shuffle, so a value held by a third
    of the table costs one row per map task.
    """
    cuts = cut_points(df, order)
    grouped = (df.where(F.col(order).isNotNull()).groupBy(*by, order)
               .agg(*[F.sum(c).alias(c) for c in cols]))
    return running_totals(grouped, order, cols, by, cuts)


# --- ranks ----------------------------------------------------------------------

def percentile_rank(df: DataFrame, col: str, key: str, out: str = "pct_rank") -> DataFrame:
    """Average rank of ties divided by the number of non-null values, in (0, 1]; null for null.

    One shuffle of the rows. A bucket that holds a single value has a rank that follows from
    the bucket counts, so its rows, like those of the nulls, are salted over many tasks.
    """
    return percentile_ranks(df, {col: out}, key)


def percentile_ranks(df: DataFrame, cols: Mapping[str, str], key: str) -> DataFrame:
    """``percentile_rank`` of several columns (column -> name of its rank): one shuffle for each."""
    _, marks = _quantiles_of_places(df, list(cols))
    out = df
    for col, name in cols.items():
        cuts = _with_heavy_values(marks[col])
        x = F.col(col)
        # Counted over ``df``, not over the ranks so far.
        sizes = (with_bucket(df, col, cuts).groupBy(BUCKET)
                 .agg(F.count(F.lit(1)).alias("n"), (F.min(x) == F.max(x)).alias("one")).collect())
        known, before = [], 0
        for r in sorted(sizes, key=lambda r: r[BUCKET]):
            null = r[BUCKET] < 0
            known.append((r[BUCKET], before, r["n"], bool(r["one"]) or null))
            before += 0 if null else r["n"]
        # One row per bucket.
        table = df.sparkSession.createDataFrame(known, f"{BUCKET} int, _before long, _size long, _tied boolean")
        salts = max(1, len(cuts))
        salted = (with_bucket(out, col, cuts).join(F.broadcast(table), BUCKET)
                  .withColumn("_salt", F.when(F.col("_tied"), F.pmod(F.xxhash64(key), F.lit(salts))).otherwise(F.lit(0))))
        at = Window.partitionBy(BUCKET, "_salt").orderBy(x)
        peers = at.rangeBetween(Window.currentRow, Window.currentRow)
        inside = F.rank().over(at) + (F.count(F.lit(1)).over(peers) - 1) / 2
        rank = F.when(F.col("_tied"), (F.col("_size") + 1) / 2).otherwise(inside) + F.col("_before")
        ranked = F.when(x.isNotNull(), rank / F.lit(max(1, before)))
        out = salted.withColumn(name, ranked).select(*out.columns, name)
    return out


# --- exact quantiles ------------------------------------------------------------

def _merged(spans: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed intervals, sorted, those that touch made one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _values_at(df: DataFrame, values: Sequence[Column], spans: Sequence[Sequence[tuple[float, float]]],
               spots: Sequence[Sequence[int]]) -> dict[tuple[int, int], tuple[float | None, int]]:
    """(column, spot) -> the value at that place in order, and its segment: 2 i + 1 within span i, 2 i before it.

    One scan. Rows outside the spans are only counted, so the value is None where a spot lies there.
    """
    table = df.select(*[x.alias(f"v{i}") for i, x in enumerate(values)])
    marks = [[m for lo, hi in own for m in (lo, math.nextafter(hi, math.inf))] for own in spans]
    if all(math.isfinite(m) for own in marks for m in own) and all(a < b for own in marks for a, b in zip(own, own[1:])):
        # A binary search for each value.
        table = _bucketizer(table.columns, [own or [0.0, 1.0] for own in marks], [f"s{i}" for i in range(len(values))]).transform(table)
        segments = [F.col(f"s{i}").cast("int") for i in range(len(values))]
    else:
        segments = [sum(((F.col(f"v{i}") >= lo).cast("int") + (F.col(f"v{i}") > hi).cast("int") for lo, hi in own), F.lit(0))
                    for i, own in enumerate(spans)]
    found = table.select(*[c for i, s in enumerate(segments) for c in (F.col(f"v{i}").alias(f"v{i}"), s.alias(f"k{i}"))])
    cells = [c for i in range(len(values)) for c in (
        F.lit(i), F.when(F.col(f"v{i}").isNotNull(), F.col(f"k{i}")), F.when(F.col(f"k{i}") % 2 == 1, F.col(f"v{i}")))]
    long = found.select(F.stack(F.lit(len(values)), *cells).alias("c", "s", "v")).where(F.col("s").isNotNull())
    counted = long.groupBy("c", "s", "v").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each column and segment.
    segments = counted.groupBy("c", "s").agg(F.sum("n").alias("n")).select("c", "s", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("pre"))
    upto = Window.partitionBy("c", "s").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    last = counted.withColumn("last", F.sum("n").over(upto)).join(segments, ["c", "s"])
    wanted = F.array(*[F.array(*[F.lit(k).cast("long") for k in own]).cast("array<bigint>") for own in spots])
    end = F.col("last") + F.col("pre")
    hits = last.select("c", "s", "v", F.filter(F.get(wanted, F.col("c")), lambda k: (k < end) & (k >= end - F.col("n"))).alias("at"))
    return {(r["c"], k): (r["v"], r["s"]) for r in hits.where(F.size("at") > 0).collect() for k in r["at"]}


def quantiles_and(df: DataFrame, cols: Sequence[str], probs: Sequence[float], *more: Column) -> tuple[dict[str, list[float]], Row]:
    """Exact quantiles of numbers with linear interpolation, for all columns together, and a row of further aggregates.

    Two scans: a sketch says between which values each position lies (and ``more`` is aggregated beside it);
    then only those values are grouped and counted, all others are counted through. Should a position lie
    elsewhere after all, the part of the range it lies in is counted too.
    """
    cols, probs = list(cols), list(probs)
    values = [F.col(c).cast("double") + F.lit(0.0) for c in cols]
    slack = 2 / SKETCH
    ends = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    row = df.agg(*[F.count(v).alias(f"_n{i}") for i, v in enumerate(values)],
                 *[F.percentile_approx(v, ends, SKETCH).alias(f"_e{i}") for i, v in enumerate(values)], *more).first()
    size = [row[f"_n{i}"] for i in range(len(cols))]
    spots, spans = [], []
    for i in range(len(cols)):
        at = [(size[i] - 1) * p for p in probs] if size[i] else []
        spots.append(sorted({math.floor(a) for a in at} | {math.ceil(a) for a in at}))
        marks = row[f"_e{i}"] or []
        spans.append(_merged([(marks[k], marks[k + len(probs)]) for k in range(len(probs))] if marks else []))
    found: dict[tuple[int, int], float] = {}
    while any(spots):
        seen = _values_at(df, values, spans, spots)
        for (c, k), (v, s) in seen.items():
            if v is not None:
                found[c, k] = v
                continue
            low = spans[c][s // 2 - 1][1] if s else -math.inf
            high = spans[c][s // 2][0] if s // 2 < len(spans[c]) else math.inf
            spans[c] = [*spans[c], (low, high)]  # merged below, once all of this round are known
        if all((c, k) in found for c, own in enumerate(spots) for k in own):
            break
        spans = [_merged(own) for own in spans]

    out: dict[str, list[float]] = {}
    for i, c in enumerate(cols):
        out[c] = []
        for p in probs if size[i] else []:
            at = (size[i] - 1) * p
            lo, hi = found[i, math.floor(at)], found[i, math.ceil(at)]
            out[c].append(lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))
    return out, row


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of numbers with linear interpolation, for all columns together."""
    return quantiles_and(df, cols, probs)[0]


def quantile_edges(df: DataFrame, cols: Sequence[str], q: int | Mapping[str, int]) -> dict[str, list[float]]:
    """Distinct equal-frequency bin edges per column; ``q`` bins, or a number of its own for each column."""
    own = {c: q if isinstance(q, int) else q[c] for c in cols}
    probs = sorted({i / k for k in own.values() for i in range(k + 1)})
    found = quantiles(df, cols, probs)
    edges = {c: dict(zip(probs, values)) for c, values in found.items()}
    return {c: sorted({edges[c][i / own[c]] for i in range(own[c] + 1)}) if edges[c] else [] for c in cols}


def bin_of(col: str, edges: Sequence[float]) -> Column:
    """Number of the right-closed bin; the lowest edge belongs to bin 0, null stays null."""
    x = F.col(col).cast("double")
    if len(edges) < 2:
        # All values equal: no bin can be formed.
        return F.lit(None).cast("int")
    inner = sum(((x > F.lit(e)).cast("int") for e in edges[1:-1]), F.lit(0))
    return F.when(x.isNotNull(), inner).cast("int")


def edge_table(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Small table (column, bin, lo, hi) of all bins."""
    rows = [(c, i, float(lo), float(hi)) for c, marks in edges.items()
            for i, (lo, hi) in enumerate(zip(marks, marks[1:]))]
    return df.sparkSession.createDataFrame(rows, "column string, bin int, lo double, hi double")


def unpivot_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """One row per (row, binned column): kept columns, ``column``, ``bin``. Null bins drop out."""
    binned = df.select(*keep, *[bin_of(c, marks).alias(f"_bin_{c}") for c, marks in edges.items()])
    long = binned.unpivot(list(keep), [f"_bin_{c}" for c in edges], "column", "bin")
    return long.where(F.col("bin").isNotNull()).withColumn("column", F.substring("column", 6, 1 << 20))


def quantile_bin(df: DataFrame, col: str, q: int, out: str | None = None,
                 edges: Sequence[float] | None = None) -> DataFrame:
    """Append ``<col>_bin``, a struct of bin number and its (lo, hi] bounds.

    Equal-frequency bins, ties never split, equal edges merged. Null where the value is
    null or the column has a single value.
    """
    cuts = list(edges) if edges is not None else quantile_edges(df, [col], q)[col]
    number = bin_of(col, cuts)
    if len(cuts) < 2:
        bounds = F.struct(number.alias("bin"), F.lit(None).cast("double").alias("lo"),
                          F.lit(None).cast("double").alias("hi"))
    else:
        marks = F.array(*[F.lit(float(e)) for e in cuts])
        bounds = F.struct(number.alias("bin"), F.element_at(marks, number + 1).alias("lo"),
                          F.element_at(marks, number + 2).alias("hi"))
    return df.withColumn(out or f"{col}_bin", F.when(number.isNotNull(), bounds))


# --- sorts and top-k ------------------------------------------------------------

def top_k(df: DataFrame, by: str, k: int, key: str, ascending: bool = False,
          where: Column | None = None) -> DataFrame:
    """The ``k`` first rows by ``by``; ``key`` breaks ties."""
    picked = df if where is None else df.where(where)
    first = F.col(by).asc() if ascending else F.col(by).desc()
    return picked.orderBy(first, F.col(key).asc()).limit(k)


def sort_rows(df: DataFrame, by: str, key: str, ascending: bool = False) -> DataFrame:
    """Whole result in order, ties by ``key``."""
    first = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(first, F.col(key).asc())


def decile_table(df: DataFrame, p: str, y: str, q: int = 10) -> DataFrame:
    """Per prediction quantile: rows, actual rate, mean, min and max prediction."""
    edges = quantile_edges(df, [p], q)[p]
    return (df.withColumn("bin", bin_of(p, edges)).where(F.col("bin").isNotNull())
            .groupBy("bin").agg(
                F.count(F.lit(1)).alias("count"), F.avg(y).alias("actual_rate"),
                F.avg(p).alias("mean_prediction"), F.min(p).alias("min_prediction"),
                F.max(p).alias("max_prediction"))
            .withColumn("actual_rate_pct", F.col("actual_rate") * 100))
