"""Running aggregates over ordered groups that stay parallel when one group is huge.

``scan(df, layout, name=running_sum(col), ...)`` adds one column per aggregate. Without hot
groups this is one window per frame over the group keys, all sharing a single shuffle and
sort. With hot groups the same windows run per (group, chunk). The totals of the chunks are scanned
in turn, cut again if a group has too many of them, and joined back on (group, chunk), by which the rows lie
already, so the rows are still shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wakeline.operators.layout import CHUNK, Layout, detect
from wakeline.session import stored

_ONE_GROUP, _OF = "_one_group", "_of_chunk"
UPTO, BEFORE, FROM, AFTER, ALL = "upto", "before", "from", "after", "all"


@dataclass(frozen=True)
class Agg:
    kind: str  # sum | max | min | last | lag | lead
    expr: Column
    frame: str


def running_sum(expr, before: bool = False) -> Agg:
    return Agg("sum", _col(expr), BEFORE if before else UPTO)


def running_max(expr) -> Agg:
    return Agg("max", _col(expr), UPTO)


def last_known(expr, before: bool = False) -> Agg:
    """Last non-null value so far."""
    return Agg("last", _col(expr), BEFORE if before else UPTO)


def next_known(expr) -> Agg:
    """First non-null value strictly after the row."""
    return Agg("last", _col(expr), AFTER)


def previous(expr) -> Agg:
    """Value of the row before, null or not."""
    return Agg("lag", _col(expr), BEFORE)


def total(expr, kind: str = "sum") -> Agg:
    return Agg(kind, _col(expr), ALL)


def position() -> Agg:
    """1-based position in the group."""
    return Agg("sum", F.lit(1), UPTO)


def _col(expr) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


def _window(layout: Layout, frame: str):
    by = Window.partitionBy(*layout.partition)
    if frame == ALL:
        return by
    return by.orderBy(*layout.order).rowsBetween(*_rows(frame))


def _rows(frame: str) -> tuple[int, int]:
    return {
        UPTO: (Window.unboundedPreceding, 0),
        BEFORE: (Window.unboundedPreceding, -1),
        FROM: (0, Window.unboundedFollowing),
        AFTER: (1, Window.unboundedFollowing),
        ALL: (Window.unboundedPreceding, Window.unboundedFollowing),
    }[frame]


def _aggregate(kind: str, expr: Column, frame: str) -> Column:
    if kind == "last":
        return F.first(expr, ignorenulls=True) if frame in (FROM, AFTER) else F.last(expr, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](expr)


def scan(df: DataFrame, layout: Layout, **aggs: Agg) -> DataFrame:
    """Add the running aggregates in ``aggs`` to ``df``."""
    if layout.hot is None:
        return df.select("*", *[_plain(a, layout).alias(n) for n, a in aggs.items()])
    if CHUNK in df.columns:
        return _chunked(df, layout, aggs)
    return _chunked(layout.mark_once(df), layout, aggs).drop(CHUNK)


def _plain(agg: Agg, layout: Layout) -> Column:
    if agg.kind == "lag":
        value = F.lag(agg.expr).over(Window.partitionBy(*layout.keys).orderBy(*layout.order))
    else:
        value = _aggregate(agg.kind, agg.expr, agg.frame).over(_window(layout, agg.frame))
    return F.when(_has_group(layout), value)


def _has_group(layout: Layout) -> Column:
    """A row without a key belongs to no group and takes no aggregate."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in layout.keys])


def _chunked(df: DataFrame, layout: Layout, aggs: dict[str, Agg]) -> DataFrame:
    # A lag is "the last row before": wrapping keeps null values apart from "no row".
    plan = {n: Agg("last", F.struct(a.expr.alias("v")), BEFORE) if a.kind == "lag" else a for n, a in aggs.items()}

    order = layout.order_key()
    totals = df.filter(F.col(CHUNK) > 0).groupBy(*layout.keys, F.col(CHUNK).alias(_OF)).agg(
        *[_chunk_total(a, order).alias(n) for n, a in plan.items()]
    )
    carries = _carries(totals, plan, layout)

    local = df.select(
        "*", *[_aggregate(a.kind, a.expr, a.frame).over(_window(layout, a.frame)).alias(f"_local_{n}") for n, a in plan.items()]
    )
    joined = local.join(carries, [*layout.keys, CHUNK], "left").select(*local.columns, *[f"_carry_{n}" for n in plan])
    merged = {}
    for n, a in plan.items():
        value = _merge(a, F.col(f"_local_{n}"), F.col(f"_carry_{n}"))
        merged[n] = F.when(_has_group(layout), value.getField("v") if aggs[n].kind == "lag" else value)
    return joined.withColumns(merged).drop(*[f"_local_{n}" for n in plan], *[f"_carry_{n}" for n in plan])


def _chunk_total(agg: Agg, order: Column) -> Column:
    if agg.kind == "last":
        pick = F.min_by if agg.frame in (FROM, AFTER) else F.max_by
        return pick(agg.expr, F.when(agg.expr.isNotNull(), order))
    return _aggregate(agg.kind, agg.expr, agg.frame)


def _carries(totals: DataFrame, plan: dict[str, Agg], layout: Layout) -> DataFrame:
    """What the chunks before (or behind, or all) of each chunk come to: a scan over the totals, in chunks of its own where a group has many."""
    frames = {UPTO: BEFORE, FROM: AFTER}
    if layout.most > layout.chunk_rows:
        totals = stored(totals, "totals")
        above = detect(totals, layout.keys, [_OF], layout.chunk_rows)
    else:
        above = Layout(layout.keys, (_OF,))
    scanned = scan(totals, above, **{f"_carry_{n}": Agg(a.kind, F.col(n), frames.get(a.frame, a.frame)) for n, a in plan.items()})
    return scanned.select(*layout.keys, F.col(_OF).alias(CHUNK), *[f"_carry_{n}" for n in plan])


def _merge(agg: Agg, local: Column, carry: Column) -> Column:
    if agg.frame == ALL:
        return F.coalesce(carry, local)
    if agg.kind == "sum":
        return F.coalesce(carry + local, local, carry)
    if agg.kind in ("max", "min"):
        return (F.greatest if agg.kind == "max" else F.least)(local, carry)
    return F.coalesce(local, carry)


def group_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank", size: str | None = None, **detect_options
) -> DataFrame:
    """1-based rank inside each group (and the group size), without one task per group."""
    df, keys = _with_key(df, keys)
    layout = detect(df, keys, order, **detect_options)
    aggs = {name: position()}
    if size:
        aggs[size] = total(F.lit(1))
    return scan(df, layout, **aggs).drop(_ONE_GROUP)


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Sequence[float],
    names: Sequence[str],
    weight: str | None = None,
    **detect_options,
) -> DataFrame:
    """Exact linear-interpolation percentiles per group.

    Works on per-value counts, so the shuffled volume is the number of distinct values, and
    finds the two neighbouring ranks by a running count instead of collecting a group. ``weight``
    counts a row that many times.
    """
    df, keys = _with_key(df, keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    counts = stored(counts, "counts")  # the layout and the scans read them several times
    layout = detect(counts, keys, [value], **detect_options)
    ranked = scan(counts, layout, _upto=running_sum("_n"), _size=total("_n"))
    pick = _pick_each if len(fractions) <= 8 else _pick_many
    return pick(ranked, keys, value, [float(f) for f in fractions], names).drop(_ONE_GROUP)


def _inside(rank: Column) -> Column:
    return (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))


def _target(fraction) -> Column:
    return (F.col("_size") - 1) * fraction


def _pick_each(ranked: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float], names: Sequence[str]) -> DataFrame:
    picks, out = [F.max("_size").alias("_size")], []
    for i, (fraction, name) in enumerate(zip(fractions, names)):
        target = _target(F.lit(fraction))
        picks += [F.max(F.when(_inside(r), F.col(value))).alias(f"_{side}{i}") for side, r in (("lo", F.floor(target)), ("hi", F.ceil(target)))]
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (target - F.floor(target))).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *out)


def _pick_many(ranked: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float], names: Sequence[str]) -> DataFrame:
    """For long grids: each value names the grid entries it serves (at most two values per entry)."""
    grid = F.array(*[F.lit(f) for f in fractions])
    entries = F.sequence(F.lit(0), F.lit(len(fractions) - 1))
    serves = F.filter(entries, lambda i: _inside(F.floor(_target(F.get(grid, i)))) | _inside(F.ceil(_target(F.get(grid, i)))))
    served = ranked.withColumn("_i", F.explode(serves)).withColumn("_target", _target(F.get(grid, "_i")))
    sides = served.groupBy(*keys, "_i").agg(
        F.max("_target").alias("_target"),
        F.max(F.when(_inside(F.floor("_target")), F.col(value))).alias("_lo"),
        F.max(F.when(_inside(F.ceil("_target")), F.col(value))).alias("_hi"),
    )
    result = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_target") - F.floor("_target"))
    by_entry = sides.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_i", result.alias("v")))).alias("_by"))
    return by_entry.select(*keys, *[F.col("_by")[F.lit(i)].alias(n) for i, n in enumerate(names)])


def _with_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without keys the whole table is one group, named by a constant column."""
    if keys:
        return df, list(keys)
    return df.withColumn(_ONE_GROUP, F.lit(0)), [_ONE_GROUP]
