"""Exact quantiles without sending a whole column, or a whole group, to one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here a bounded sketch first brackets the wanted rank; values below the bracket
are only counted, those above it dropped, and the few remaining ones ranked.
For a whole table all brackets come from one scan and are read back as literals,
and a bracket that missed its rank is widened; groups keep theirs beside the rows. Interpolation is linear between the two neighbouring
order statistics, like ``percentile`` and pandas.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.operators.lookup import lookup
from wattmill.operators.running import running_totals

#: Rank error of the bracketing sketch is at most ``rows / SKETCH_ACCURACY``.
SKETCH_ACCURACY = 10_000
#: Half width of the first bracket in units of that error: more than error and neighbour together.
FIRST_SLACK = 4.0
#: Blocks a bracket is cut into when its values are ranked.
BRACKET_BLOCKS = 1_000


def _bracket(value: Column, prob: float) -> Column:
    """Number of values, and two values that enclose the wanted rank and its neighbour.

    The sketch may be off by ``1 / SKETCH_ACCURACY`` of the rows; four times that
    on either side is more than error and neighbour together once there are more
    than ``SKETCH_ACCURACY`` rows. Fewer rows need no bracket.
    """
    slack = FIRST_SLACK / SKETCH_ACCURACY
    ends = F.percentile_approx(value, [max(0.0, prob - slack), min(1.0, prob + slack)], SKETCH_ACCURACY)
    many = F.count(value) > SKETCH_ACCURACY
    low = F.lit(None).cast("double") if prob - slack <= 0 else F.when(many, ends[0])
    high = F.lit(None).cast("double") if prob + slack >= 1 else F.when(many, ends[1])
    return F.struct(F.count(value).alias("n"), low.alias("lo"), high.alias("hi"))


def _long_form(df: DataFrame, wanted: Mapping[str, tuple[Column, float]], by: Sequence[str]) -> DataFrame:
    """One row per input row and requested quantile, cut to the bracket."""
    items = [
        F.struct(
            F.lit(name).alias("name"),
            expr.alias("x"),
            F.col(f"_b_{name}")["n"].alias("n"),
            F.col(f"_b_{name}")["lo"].alias("lo"),
            F.col(f"_b_{name}")["hi"].alias("hi"),
        )
        for name, (expr, _) in wanted.items()
    ]
    if len(items) == 1:
        rows = df.select(*by, items[0].alias("q")).select(*by, "q.*")
    else:
        rows = df.select(*by, F.explode(F.array(*items)).alias("q")).select(*by, "q.*")
    return rows.where(F.col("x").isNotNull() & (F.col("hi").isNull() | (F.col("x") <= F.col("hi"))))


def _pick(rows: DataFrame, places: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """The values at ``places``: zero-based positions among the sorted values, fractions interpolate."""
    inside = F.col("lo").isNull() | (F.col("x") >= F.col("lo"))
    counted = rows.groupBy(*by, "name", F.when(inside, F.col("x")).alias("v")).agg(
        F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    # place inside the bracket; brackets open at one end are cut by sign and magnitude
    span = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    linear = F.floor((F.col("v") - F.col("lo")) / span * BRACKET_BLOCKS)
    scaled = F.floor(F.signum("v") * F.log1p(F.abs("v")) * 16)
    block = F.when(F.col("v").isNotNull(), F.coalesce(linear, scaled)).cast("long")
    ranked = running_totals(counted, [*by, "name"], block, [F.col("v").asc_nulls_first()], {"upto": "c"})
    pos = F.lit(None).cast("double")
    for name, place in places.items():
        pos = F.when(F.col("name") == name, place.cast("double")).otherwise(pos)
    low, high = F.floor(pos), F.ceil(pos)
    picked = ranked.groupBy(*by, "name").agg(
        F.first(pos - low).alias("frac"),
        F.first(low).alias("low"),
        F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("upto"))), F.lit(0)).alias("below"),
        F.min(F.when(F.col("upto") > low, F.col("v"))).alias("a"),
        F.min(F.when(F.col("upto") > high, F.col("v"))).alias("z"),
    )
    sound = (F.col("below") <= F.col("low")) & F.col("a").isNotNull() & F.col("z").isNotNull()
    value = F.when(sound, F.col("a") + (F.col("z") - F.col("a")) * F.col("frac")).otherwise(
        F.raise_error(F.lit("quantile sketch missed its rank bound")).cast("double")
    )
    values = picked.select(*by, "name", value.alias("value"))
    wide = [F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in places]
    return values.groupBy(*by).agg(*wide) if by else values.agg(*wide)


def _places(wanted: Mapping[str, tuple[Column, float]]) -> dict[str, Column]:
    return {name: F.lit(float(p)) * (F.col("n") - 1) for name, (_, p) in wanted.items()}


def quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """One row with one exact quantile per entry of ``wanted`` (name -> expression, probability).

    Three scans whatever the number of quantiles: all sketches, all counts, the values inside the brackets. Entries that share
    a column object share its sketch and, where their brackets meet, their ranked values.
    """
    return _selected(df, wanted, {name: lambda n, p=float(p): p * (n - 1) for name, (_, p) in wanted.items()})


def order_statistics(df: DataFrame, wanted: Mapping[str, tuple[Column, int]], rows: int) -> DataFrame:
    """One row with the value at a zero-based index per entry; ``rows`` is the number of values."""
    near = {name: (expr, index / max(rows - 1, 1)) for name, (expr, index) in wanted.items()}
    return _selected(df, near, {name: lambda n, at=index: float(at) for name, (_, index) in wanted.items()})


@dataclass
class _Interval:
    """Closed range of one column's values (an end that is null is open), with the counts of values below and inside."""

    column: str
    lo: float | None
    hi: float | None
    below: int = 0
    inside: int = 0

    def holds(self) -> Column:
        x = F.col(self.column)
        inside = x.isNotNull()
        if self.lo is not None:
            inside = inside & (x >= F.lit(self.lo))
        return inside if self.hi is None else inside & (x <= F.lit(self.hi))

    def under(self) -> Column:
        return F.lit(False) if self.lo is None else F.col(self.column) < F.lit(self.lo)


def _united(column: str, ranges: Sequence[tuple[float | None, float | None]]) -> list[_Interval]:
    """The ranges as disjoint intervals in ascending order."""
    out: list[_Interval] = []
    for lo, hi in sorted(ranges, key=lambda r: -math.inf if r[0] is None else r[0]):
        last = out[-1] if out else None
        if last is not None and (last.hi is None or lo is None or lo <= last.hi):
            last.hi = None if last.hi is None or hi is None else max(last.hi, hi)
        else:
            out.append(_Interval(column, lo, hi))
    return out


def _brackets(slim: DataFrame, probs: Mapping[str, Sequence[float]], slack: float) -> tuple[dict[str, int], list[_Interval]]:
    """Number of values per column, and counted intervals around all of its probabilities: two scans."""
    ends = {c: [e for p in ps for e in (max(0.0, p - slack), min(1.0, p + slack))] for c, ps in probs.items()}
    told = slim.agg(
        *[F.count(c).alias(f"n{c}") for c in probs], *[F.percentile_approx(c, es, SKETCH_ACCURACY).alias(f"e{c}") for c, es in ends.items()]
    ).first()
    counts, found = {c: told[f"n{c}"] for c in probs}, []
    for c, ps in probs.items():
        cut = told[f"e{c}"]
        if counts[c] > SKETCH_ACCURACY:
            ranges = [
                (cut[2 * i] if p - slack > 0 else None, cut[2 * i + 1] if p + slack < 1 else None) for i, p in enumerate(ps)
            ]
        else:
            ranges = [(None, None)] if counts[c] else []
        found += _united(c, ranges)
    if found:
        tally = slim.agg(
            *[F.count_if(i.under()).alias(f"b{k}") for k, i in enumerate(found)], *[F.count_if(i.holds()).alias(f"i{k}") for k, i in enumerate(found)]
        ).first()
        for k, interval in enumerate(found):
            interval.below, interval.inside = tally[f"b{k}"], tally[f"i{k}"]
    return counts, found


def _selected(df: DataFrame, wanted: Mapping[str, tuple[Column, float]], place: Mapping[str, Callable[[int], float]]) -> DataFrame:
    """One row with the values at ``place(number of values)``, fractions interpolate; null where there is no value.

    A bracket that misses its places is taken wider and counted again, up to the whole column.
    """
    exprs, column = {}, {}
    for name, (expr, _) in wanted.items():
        column[name] = f"x{list(exprs).index(id(expr)) if id(expr) in exprs else len(exprs)}"
        exprs[id(expr)] = expr
    slim = df.select(*[e.cast("double").alias(f"x{i}") for i, e in enumerate(exprs.values())])
    probs = {f"x{i}": sorted({p for n, (_, p) in wanted.items() if column[n] == f"x{i}"}) for i in range(len(exprs))}

    slack = FIRST_SLACK / SKETCH_ACCURACY
    while True:
        counts, intervals = _brackets(slim, probs, slack)
        at: dict[str, tuple[int, int, int, float]] = {}
        for name in wanted:
            n = counts[column[name]]
            pos = place[name](n) if n else 0.0
            low, high = math.floor(pos), math.ceil(pos)
            for k, i in enumerate(intervals):
                if i.column == column[name] and i.below <= low and high < i.below + i.inside:
                    at[name] = (k, low - i.below, high - i.below, pos - low)
        missed = [name for name in wanted if name not in at and counts[column[name]]]
        if not missed:
            break
        if slack >= 1:
            raise IndexError(f"no value at the places of {missed}")
        slack *= 8

    if not at:
        return slim.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(n) for n in wanted])
    cells = F.array(*[F.when(i.holds(), F.struct(F.lit(k).alias("g"), F.col(i.column).alias("v"))) for k, i in enumerate(intervals)])
    values = slim.select(F.explode(F.array_compact(cells)).alias("c")).groupBy("c.g", "c.v").agg(F.count(F.lit(1)).alias("c"))
    block = F.lit(None).cast("long")
    for k, i in enumerate(intervals):
        if i.lo is not None and i.hi is not None and i.hi > i.lo:
            spot = F.floor((F.col("v") - F.lit(i.lo)) / F.lit(i.hi - i.lo) * BRACKET_BLOCKS)
        else:
            spot = F.floor(F.signum("v") * F.log1p(F.abs("v")) * 16)
        block = F.when(F.col("g") == k, spot.cast("long")).otherwise(block)
    ranked = running_totals(values, ["g"], block, [F.col("v").asc()], {"upto": "c"})
    reach = lambda k, rank: F.min(F.when((F.col("g") == k) & (F.col("upto") > rank), F.col("v")))
    out = []
    for name in wanted:
        if name not in at:
            out.append(F.lit(None).cast("double").alias(name))
            continue
        k, low, high, frac = at[name]
        a = reach(k, low)
        out.append((a + (reach(k, high) - a) * F.lit(frac) if high > low else a).alias(name))
    return ranked.agg(*out)


def quantile_value(df: DataFrame, expr: Column, prob: float) -> Column:
    """The same as a literal: one number is read back, and filters on it reach the file scan."""
    return F.lit(quantiles(df, {"q": (expr, prob)}).first()["q"]).cast("double")


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], wanted: Mapping[str, tuple[Column, float]]
) -> DataFrame:
    """Exact quantiles per group; groups with no value at all are left out.

    When no group has more values than the sketch would bracket, the plain
    aggregate has small buffers and is used; one count decides that.
    """
    by = list(by)
    slim = df.select(*by, *[e.cast("double").alias(f"_x_{n}") for n, (e, _) in wanted.items()])
    sizes = slim.groupBy(*by).agg(F.greatest(F.lit(0), *[F.count(f"_x_{n}") for n in wanted]).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= SKETCH_ACCURACY:
        small = slim.groupBy(*by).agg(
            F.greatest(F.lit(0), *[F.count(f"_x_{n}") for n in wanted]).alias("_n"),
            *[F.percentile(f"_x_{n}", p).alias(n) for n, (_, p) in wanted.items()],
        )
        return small.where(F.col("_n") > 0).drop("_n")
    brackets = slim.groupBy(*by).agg(
        *[_bracket(F.col(f"_x_{n}"), p).alias(f"_b_{n}") for n, (_, p) in wanted.items()]
    )
    carried = lookup(slim, brackets, by)
    renamed = {n: (F.col(f"_x_{n}"), p) for n, (_, p) in wanted.items()}
    return _pick(_long_form(carried, renamed, by), _places(wanted), by)
