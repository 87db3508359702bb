"""Order statistics and running totals that never sort the whole table in one task."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column
from ledgerlens.session import stage

SKETCH_ACCURACY = 10_000
MAX_EDGES = 1_000
MAX_CANDIDATES = 100_000
QUARTILES = [0.25, 0.5, 0.75]


@dataclass(frozen=True)
class ColumnProfile:
    """Moments, exact quantiles, whiskers and outliers of one column; all but ``count`` and ``outliers`` are None without values."""

    count: int = 0
    mean: float | None = None
    std: float | None = None
    low: float | None = None
    high: float | None = None
    quantiles: list[float | None] = field(default_factory=list)
    lower_whisker: float | None = None
    upper_whisker: float | None = None
    outliers: int = 0


def exact_quantiles(
    df: DataFrame, column: str | Column, probabilities: list[float], max_candidates: int = MAX_CANDIDATES
) -> list[float | None]:
    """Exact quantiles with linear interpolation between neighbours; NULL and NaN are missing."""
    return profile_columns(df, {"v": column}, probabilities, max_candidates)["v"].quantiles


def profile_columns(
    df: DataFrame,
    columns: dict[str, str | Column],
    probabilities: list[float] = QUARTILES,
    max_candidates: int = MAX_CANDIDATES,
    whiskers: bool = False,
) -> dict[str, ColumnProfile]:
    """Profiles of several numeric columns in two scans of the table, whatever their number.

    The first scan takes moments and a mergeable sketch, which brackets each wanted rank. The second one keeps the distinct
    values inside the brackets with their counts, and of the rows between two brackets only number, least and greatest
    value; that is written, and ranks are looked up there. Fences lie between bounds that follow from the brackets of the
    quartiles, so their surroundings are kept by the same scan. Should a sketch miss a rank, the table is
    scanned again for the rows in question. At most ``max_candidates`` values are fetched at once.

    NULL and NaN are missing. Whiskers are the furthest values within 1.5 interquartile ranges, outliers lie beyond; they need
    ``probabilities`` to be the quartiles.
    """
    if whiskers and list(probabilities) != QUARTILES:
        raise ValueError("whiskers need the quartiles")
    names = list(columns)
    values = df.select(*[as_column(columns[n]).cast("double").alias(f"v{i}") for i, n in enumerate(names)])
    values = values.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in values.columns])
    step = 2.0 / SKETCH_ACCURACY
    shares = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-step, step)]
    first = []
    for c in values.columns:
        sketch = F.percentile_approx(c, shares, SKETCH_ACCURACY) if shares else F.lit(None)
        first += [F.count(c), F.avg(c), F.stddev_samp(c), F.min(c), F.max(c), sketch]
    row = values.agg(*first).first() if first else []
    moments = [row[6 * i : 6 * i + 6] for i in range(len(names))]
    wanted, brackets = {}, {}
    for i, (count, _, _, low, high, sketch) in enumerate(moments):
        if not count:
            continue
        spots = [p * (count - 1) for p in probabilities]
        wanted[i] = sorted({r for x in spots for r in (math.floor(x), math.ceil(x))})
        if count <= max_candidates:
            brackets[i] = [(low, high)]
        else:
            pairs = [(low if shares[k] == 0 else sketch[k], high if shares[k + 1] == 1 else sketch[k + 1]) for k in range(0, len(shares), 2)]
            brackets[i] = _merged(pairs + (_around_fences(pairs) if whiskers else []))
    found, cells = {}, _inside(values, brackets)
    second = cells
    pending = {i: ranks for i, ranks in wanted.items() if ranks}
    while pending:
        missed = _look_up(cells, pending, found, max_candidates)
        pending = {i: [r for r in pending[i] if (i, r) not in found] for i in missed}
        if pending:
            cells = _inside(values, {i: _merged(brackets[i] + more) for i, more in missed.items()})
    profiles = {}
    for i, name in enumerate(names):
        count, mean, std, low, high, _ = moments[i]
        if not count:
            profiles[name] = ColumnProfile(quantiles=[None] * len(probabilities))
            continue
        quantiles = []
        for p in probabilities:
            x = p * (count - 1)
            a, b = found[i, math.floor(x)], found[i, math.ceil(x)]
            quantiles.append(a if a == b else a + (b - a) * (x - math.floor(x)))
        profiles[name] = ColumnProfile(count, mean, std, low, high, quantiles)
    return _with_whiskers(values, second, names, profiles) if whiskers and wanted else profiles


def _merged(pairs: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The same ranges, in order and without overlaps."""
    result: list[tuple[float, float]] = []
    for a, b in sorted(pairs):
        if result and a <= result[-1][1]:
            result[-1] = (result[-1][0], max(b, result[-1][1]))
        else:
            result.append((a, b))
    return result


def _fences(q25: float, q75: float) -> tuple[float, float]:
    return q25 - 1.5 * (q75 - q25), q75 + 1.5 * (q75 - q25)


def _around_fences(quartiles: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Ranges that hold the fences, from ranges that hold the quartiles; a little wider because of rounding."""
    (a, b), _, (c, d) = quartiles
    slack = 1e-9 * (abs(a) + abs(d))
    pairs = [(_fences(a, d)[0] - slack, _fences(b, c)[0] + slack), (_fences(b, c)[1] - slack, _fences(a, d)[1] + slack)]
    return [(x, y) for x, y in pairs if math.isfinite(x) and math.isfinite(y) and x <= y]


def _inside(values: DataFrame, brackets: dict[int, list[tuple[float, float]]]) -> DataFrame:
    """One scan: ``(c, slot, v, n, lo, hi)`` by column; odd slots are the brackets with one row for each value, even slots lie
    between them, with one row and no ``v``."""
    schema = "c int, slot int, v double, n long, lo double, hi double"
    if not brackets:
        return values.sparkSession.createDataFrame([], schema)
    cells = []
    for i, ranges in brackets.items():
        x = F.col(f"v{i}")
        slot = F.lit(0)
        for a, b in ranges:
            slot = slot + (x >= a).cast("int") + (x > b).cast("int")
        cells.append(F.when(x.isNotNull(), F.struct(F.lit(i).alias("c"), slot.alias("slot"), x.alias("x"))))
    rows = values.select(F.explode(F.array(*cells)).alias("e")).where("e is not null").select("e.*")
    v = F.when(F.col("slot") % 2 == 1, F.col("x"))
    counted = rows.groupBy("c", "slot", v.alias("v")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    return stage(counted, "ranks")


def _look_up(
    cells: DataFrame, wanted: dict[int, list[int]], found: dict[tuple[int, int], float], max_candidates: int
) -> dict[int, list[tuple[float, float]]]:
    """Add the values at the wanted zero-based ranks of each column to ``found``; ranks that lie between two brackets are
    returned as further ranges."""
    slots = cells.groupBy("c", "slot").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    asked, missed = {}, {}
    below = {}
    for r in sorted(slots.collect(), key=lambda r: (r["c"], r["slot"])):
        start = below.get(r["c"], 0)
        below[r["c"]] = start + r["n"]
        here = [k for k in wanted.get(r["c"], []) if start <= k < start + r["n"]]
        if here and r["lo"] == r["hi"]:
            found.update({(r["c"], k): r["lo"] for k in here})
        elif here and r["slot"] % 2 == 0:
            missed.setdefault(r["c"], []).append((r["lo"], r["hi"]))
        elif here:
            asked[r["c"], r["slot"]] = (r["rows"], start, here)
    batch, size = [], 0
    for key, (rows, start, here) in sorted(asked.items(), key=lambda item: item[1][0]):
        if rows > max_candidates:
            part = cells.where((F.col("c") == key[0]) & (F.col("slot") == key[1])).select("v", "n")
            inner = _narrow(part, [k - start for k in here], max_candidates)
            found.update({(key[0], k): inner[k - start] for k in here})
            continue
        if size + rows > max_candidates:
            _fetch(cells, batch, found)
            batch, size = [], 0
        batch.append((key, start, here))
        size += rows
    _fetch(cells, batch, found)
    return missed


def _fetch(cells: DataFrame, batch: list, found: dict[tuple[int, int], float]) -> None:
    """Values at ranks of a few slots, whose rows are fetched; the caller bounds their number."""
    if not batch:
        return
    chosen = F.lit(False)
    for (c, slot), _, _ in batch:
        chosen = chosen | ((F.col("c") == c) & (F.col("slot") == slot))
    rows: dict[tuple[int, int], list] = {}
    for r in cells.where(chosen).select("c", "slot", "v", "n").collect():
        rows.setdefault((r["c"], r["slot"]), []).append((r["v"], r["n"]))
    for key, start, here in batch:
        found.update({(key[0], k): v for k, v in _walk(rows[key], here, start).items()})


def _walk(rows: list[tuple[float, int]], ranks: list[int], start: int = 0) -> dict[int, float]:
    """Values at ascending ranks among ``(value, number)`` rows, the first of which has rank ``start``."""
    result, pending = {}, list(ranks)
    for value, n in sorted(rows):
        start += n
        while pending and pending[0] < start:
            result[pending.pop(0)] = value
    return result


def _narrow(part: DataFrame, ranks: list[int], max_candidates: int) -> dict[int, float]:
    """Values at ranks among distinct values ``(v, n)`` that are too many to fetch: cut into ranges, go on within one of them."""
    if part.count() <= max_candidates:
        return _walk([tuple(r) for r in part.collect()], ranks)
    shares = [k / MAX_EDGES for k in range(MAX_EDGES + 1)]
    edges = sorted(set(part.agg(F.percentile_approx("v", shares, SKETCH_ACCURACY)).first()[0]))
    cut = Bucketizer(splits=[-math.inf, *[e for e in edges if math.isfinite(e)], math.inf], inputCol="v", outputCol="_range").transform(part)
    result, start = {}, 0
    for r in sorted(cut.groupBy("_range").agg(F.sum("n").alias("n")).collect()):
        here = [k for k in ranks if start <= k < start + r["n"]]
        if here:
            inner = _narrow(cut.where(F.col("_range") == r["_range"]).select("v", "n"), [k - start for k in here], max_candidates)
            result.update({k: inner[k - start] for k in here})
        start += r["n"]
    return result


def _with_whiskers(values: DataFrame, cells: DataFrame, names: list[str], profiles: dict[str, ColumnProfile]) -> dict[str, ColumnProfile]:
    """Whiskers and outliers from the rows of the second scan; a column whose fence is not between kept rows is scanned again."""

    def parts(low: float, high: float, least: Column, most: Column, n: Column, own: Column) -> list[Column]:
        return [
            F.min(F.when(own & (least >= low), least)),
            F.max(F.when(own & (most <= high), most)),
            F.coalesce(F.sum(F.when(own & ((most < low) | (least > high)), n)), F.lit(0)),
            F.count_if(own & (((least < low) & (most >= low)) | ((least <= high) & (most > high)))),
        ]

    filled = [i for i, name in enumerate(names) if profiles[name].count]
    fences = {i: _fences(profiles[names[i]].quantiles[0], profiles[names[i]].quantiles[2]) for i in filled}
    wanted = [c for i in filled for c in parts(*fences[i], F.col("lo"), F.col("hi"), F.col("n"), F.col("c") == i)]
    row = list(cells.agg(*wanted).first())
    split = [i for k, i in enumerate(filled) if row[4 * k + 3]]
    if split:
        one = F.lit(1).cast("long")
        again = values.agg(*[c for i in split for c in parts(*fences[i], F.col(f"v{i}"), F.col(f"v{i}"), one, F.lit(True))]).first()
        for k, i in enumerate(split):
            at = 4 * filled.index(i)
            row[at : at + 4] = again[4 * k : 4 * k + 4]
    result = dict(profiles)
    for k, i in enumerate(filled):
        lower, upper, outliers, _ = row[4 * k : 4 * k + 4]
        result[names[i]] = replace(profiles[names[i]], lower_whisker=lower, upper_whisker=upper, outliers=outliers)
    return result


def add_running_total(df: DataFrame, order: str, amount: str, output: str, max_edges: int = MAX_EDGES) -> DataFrame:
    """Sum of ``amount`` over all rows with a smaller ``order`` value; ``order`` must be distinct.

    Rows are cut into ranges at sampled edges. Range totals (at most ``max_edges`` + 1 rows) are summed up first, then
    each range sums its own rows, so no task sees more than one range.
    """
    accuracy = max(max_edges * 2, 1000)
    edges = df.agg(
        F.percentile_approx(order, [i / (max_edges + 1) for i in range(1, max_edges + 1)], accuracy)
    ).first()[0]
    splits = [-math.inf, *sorted(set(edges or [0.0])), math.inf]
    cut = Bucketizer(splits=splits, inputCol=order, outputCol="_range", handleInvalid="keep").transform(df)
    totals = cut.groupBy("_range").agg(F.sum(amount).alias("_amount"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: at most max_edges + 2 rows are broadcast.
    joined = cut.join(F.broadcast(offsets), "_range")
    running = F.coalesce(F.sum(amount).over(inside), F.lit(0)) + F.col("_offset")
    return joined.withColumn(output, running).drop("_range", "_offset")
