"""Exact quantiles of many columns without sorting or shuffling the table.

One pass gives every column a quantile sketch. Sketches are merged in two levels, first within
``GROUPS`` groups of partitions and then once, so no task meets more than that many. A sketch cuts
a narrow interval around each wanted rank; a second pass counts, for all columns together, the rows
between the intervals and the copies of every value inside them, which gives the rank's value. The
result does not rest on the sketch: a rank that lies outside its interval, or in an interval of more
than ``BRACKET_ROWS`` rows, is looked for again among the rows where the counts say it is. Such a
scope is always smaller than the one before, and half as wide if the sketch did not help, so a bad
sketch costs rounds and nothing else.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

SKETCH = 2048  # a rank error of about 0.0015
QUARTILES = (0.25, 0.5, 0.75)
MARGIN = 0.005  # of the rows of a scope, on either side of a wanted rank
GROUPS = 64
BRACKET_ROWS = 1_000_000


@dataclass(frozen=True)
class ColumnStats:
    """Non-missing values of a column: how many, extremes, sketched number of distinct ones, and
    for each place asked for an interval that should hold it. Moments only if asked for."""

    n: int
    low: float | None
    high: float | None
    distinct: int
    around: dict[float, tuple[float, float]]
    mean: float | None = None
    std: float | None = None


@dataclass(frozen=True)
class _Scope:
    """Values of a column from low to high, both included; how many rows are below and inside."""

    column: str
    low: float
    high: float
    below: int
    rows: int

    @property
    def condition(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    # NaN sorts above every number in Spark; a NaN reading is a missing one here.
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(c) for c in columns
    ])


def _read_off(sketch: Column, places: list[float]) -> Column:
    """The sketch's values a margin below and above each place."""
    ends = [min(1.0, max(0.0, p + side * MARGIN)) for p in places for side in (-1, 1)]
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(e) for e in ends])))


def _pairs(ends, places) -> dict[float, tuple[float, float]]:
    return dict(zip(places, zip(ends[::2], ends[1::2]))) if ends else {}


def column_stats(
    df: DataFrame, columns: list[str], places: tuple[float, ...] = QUARTILES, moments: bool = False
) -> dict[str, ColumnStats]:
    """Statistics of many columns from one pass."""
    if not columns:
        return {}
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    values = _values(df, columns).toDF(*names.values())
    part = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part")
    first, second, last = [], [], []
    for x in names.values():
        own = [
            F.count(x).alias(f"{x}_n"), F.min(x).alias(f"{x}_low"), F.max(x).alias(f"{x}_high"),
            F.hll_sketch_agg(F.when(F.col(x).isNotNull(), F.xxhash64(x)), F.lit(11)).alias(f"{x}_hll"),
            F.kll_sketch_agg_double(x, F.lit(SKETCH)).alias(f"{x}_kll"),
        ]
        merged = [
            F.sum(f"{x}_n").alias(f"{x}_n"), F.min(f"{x}_low").alias(f"{x}_low"), F.max(f"{x}_high").alias(f"{x}_high"),
            F.hll_sketch_estimate(F.hll_union_agg(f"{x}_hll")).alias(f"{x}_distinct"),
            F.kll_merge_agg_double(f"{x}_kll", F.lit(SKETCH)).alias(f"{x}_kll"),
        ]
        kept = [f"{x}_n", f"{x}_low", f"{x}_high", f"{x}_distinct"]
        if moments:
            own += [F.avg(x).alias(f"{x}_mean"), F.var_pop(x).alias(f"{x}_var")]
            groups = F.collect_list(F.struct(f"{x}_n", f"{x}_mean", f"{x}_var"))  # at most GROUPS
            merged.append(groups.alias(f"{x}_parts"))
            kept.append(f"{x}_parts")
        first += own
        second += merged
        last += [*kept, _read_off(F.col(f"{x}_kll"), list(places)).alias(f"{x}_ends")]
    row = values.groupBy(part).agg(*first).agg(*second).select(*last).first()
    out = {}
    for c, x in names.items():
        mean, std = _moments(row[f"{x}_parts"]) if moments else (None, None)
        n, distinct = row[f"{x}_n"] or 0, row[f"{x}_distinct"] or 0
        out[c] = ColumnStats(n, row[f"{x}_low"], row[f"{x}_high"], distinct, _pairs(row[f"{x}_ends"], places), mean, std)
    return out


def _moments(parts) -> tuple[float | None, float | None]:
    """Mean and sample deviation from those of the groups: (rows, mean, variance) each."""
    parts = [tuple(p) for p in parts or [] if p[0]]
    n = sum(p[0] for p in parts)
    if not n:
        return None, None
    mean = sum(k * m for k, m, _ in parts) / n
    squares = sum(k * (v + (m - mean) * (m - mean)) for k, m, v in parts)
    return mean, math.sqrt(squares / (n - 1)) if n > 1 else None


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    stats: dict[str, ColumnStats] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the non-missing values of each column.

    The result is a handful of numbers per column; its size does not depend on the rows.
    """
    if not columns:
        return {}
    stats = column_stats(df, columns) if stats is None else stats
    positions = {c: [p * (stats[c].n - 1) for p in probabilities] for c in columns if stats[c].n}
    wanted = {
        (c, r): place for c, ps in positions.items() for place, p in zip(probabilities, ps)
        for r in (math.floor(p), math.ceil(p))
    }
    found = _order_statistics(_values(df, columns), wanted, stats)
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c, ps in positions.items():
        for i, p in enumerate(ps):
            low, high = found[c, math.floor(p)], found[c, math.ceil(p)]
            result[c][i] = low if low == high else low + (high - low) * (p - math.floor(p))
    return result


def _order_statistics(values, wanted, stats) -> dict[tuple[str, int], float]:
    """The value of each 0-based rank of each column; ``wanted`` gives the place asked for."""
    found: dict[tuple[str, int], float] = {}
    scopes = {(c, r): _Scope(c, stats[c].low, stats[c].high, 0, stats[c].n) for c, r in wanted}
    cuts = {(c, r): stats[c].around[p] for (c, r), p in wanted.items() if p in stats[c].around}
    stuck: set[tuple[str, int]] = set()
    while True:
        for key, s in list(scopes.items()):
            if s.low == s.high:
                found[key] = s.low
                del scopes[key]
            elif s.rows <= BRACKET_ROWS * MARGIN:
                cuts[key] = (s.low, s.high)
            elif key in stuck:
                cuts[key] = (s.low, s.high) if s.rows <= BRACKET_ROWS else _halved(s)
        if not scopes:
            return found
        cuts |= _sketched(values, {k: s for k, s in scopes.items() if k not in cuts})
        for key, (answer, scope) in _look(values, scopes, {k: cuts.pop(k) for k in scopes}).items():
            if answer is not None:
                found[key] = answer
                del scopes[key]
            else:
                # A sketch that leaves most rows is no help; half the span is, some day.
                (stuck.add if 4 * scope.rows > 3 * scopes[key].rows else stuck.discard)(key)
                scopes[key] = scope


def _sketched(values, scopes: dict) -> dict:
    """An interval around each wanted rank within its scope, from sketches merged in two levels."""
    if not scopes:
        return {}
    places: dict[_Scope, list[float]] = {}
    for (_, rank), s in scopes.items():
        places.setdefault(s, []).append((rank - s.below) / s.rows)
    names = {s: f"s{j}" for j, s in enumerate(places)}
    part = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part")
    first = values.groupBy(part).agg(*[
        F.kll_sketch_agg_double(F.when(s.condition, F.col(s.column)), F.lit(SKETCH)).alias(x) for s, x in names.items()
    ])
    merged = first.agg(*[F.kll_merge_agg_double(x, F.lit(SKETCH)).alias(x) for x in names.values()])
    row = merged.select(*[_read_off(F.col(x), places[s]).alias(x) for s, x in names.items()]).first()
    ends = {s: _pairs(row[x], places[s]) for s, x in names.items()}
    return {
        k: (max(s.low, a), min(s.high, b)) for k, s in scopes.items()
        for a, b in [ends[s][(k[1] - s.below) / s.rows]]
    }


def _halved(s: _Scope) -> tuple[float, float]:
    """The lower half of the values of a scope that its sketch does not cut."""
    low, high = max(s.low, -sys.float_info.max), min(s.high, sys.float_info.max)
    middle = low / 2 + high / 2
    return (s.low, middle) if s.low <= middle < s.high else (s.low, s.low)


def _look(values, scopes, cuts) -> dict:
    """For each rank its value, or the smaller scope that holds it; one pass for all."""
    columns = sorted({c for c, _ in scopes})
    intervals = {c: _joined([(scopes[k], *cuts[k]) for k in cuts if k[0] == c]) for c in columns}
    regions = []
    for i, c in enumerate(columns):
        v = F.col(c)

        def region(j: int, inside: Column) -> Column:
            return F.struct(F.lit(i).alias("i"), F.lit(j).alias("region"), inside.cast("double").alias("v"))

        place = F.when(v.isNull(), F.lit(None))
        for j, (a, b, few) in enumerate(intervals[c]):
            place = place.when(v < a, region(2 * j, F.lit(None)))
            place = place.when(v <= b, region(2 * j + 1, v if few else F.lit(None)))
        regions.append(place.otherwise(region(2 * len(intervals[c]), F.lit(None))))
    met = values.select(F.inline(F.array_compact(F.array(*regions)))).groupBy("i", "region", "v").agg(
        F.count(F.lit(1)).alias("copies"))
    # Of a column: its few regions, and the values of intervals of at most BRACKET_ROWS rows.
    running = Window.partitionBy("i").orderBy("region", "v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = met.withColumn("upto", F.sum("copies").over(running)).withColumn("before", F.col("upto") - F.col("copies"))
    ranks = F.element_at(
        F.array(*[F.array(*[F.lit(r).cast("long") for c2, r in sorted(scopes) if c2 == c]) for c in columns]), F.col("i") + 1)
    hits = F.transform(ranks, lambda r: F.when((F.col("upto") > r) & (F.col("before") <= r), r))
    rows = ranked.select("i", "region", "v", "before", "copies", F.explode(F.array_compact(hits)).alias("rank")).collect()
    out = {}  # one row per wanted rank
    for r in rows:
        c, own = columns[r["i"]], intervals[columns[r["i"]]]
        key, j = (c, r["rank"]), r["region"] // 2
        s = scopes[key]
        if r["v"] is not None:
            out[key] = (r["v"], None)
        elif r["region"] % 2:
            a, b, _ = own[j]
            out[key] = (a, None) if a == b else (None, _Scope(c, max(a, s.low), min(b, s.high), r["before"], r["copies"]))
        else:
            low = s.low if j == 0 else max(s.low, math.nextafter(own[j - 1][1], math.inf))
            high = s.high if j == len(own) else min(s.high, math.nextafter(own[j][0], -math.inf))
            out[key] = (None, _Scope(c, low, high, r["before"], r["copies"]))
    return out


def _joined(found: list[tuple[_Scope, float, float]]) -> list[tuple[float, float, bool]]:
    """Intervals of one column in order, overlapping ones as one; whether few rows are expected."""
    out: list[list] = []
    for s, a, b in sorted(found, key=lambda f: (f[1], f[2])):
        whole = (a, b) == (s.low, s.high)
        rows = s.rows if whole else s.rows * min(1.0, 3 * MARGIN)
        if out and a <= out[-1][1]:
            joined = out[-1]
            # The same interval twice holds its rows once.
            joined[2] = max(joined[2], rows) + (rows if b > joined[1] else 0)
            joined[1] = max(joined[1], b)
        else:
            out.append([a, b, rows])
    return [(a, b, rows <= BRACKET_ROWS) for a, b, rows in out]
