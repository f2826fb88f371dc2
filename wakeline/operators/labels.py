"""Rule-based anomaly labels for whole tables of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.functions import geo, scalar
from wakeline.operators.layout import CHUNK, Layout
from wakeline.operators.scan import position, previous, running_sum, scan

# Largest normal change between points, knots and degrees.
SPEED_CHANGE = 3.0
COURSE_CHANGE = 30.0


def parse_intervals(df: DataFrame, text: str = "interval") -> DataFrame:
    """Interval texts ``"10-20"`` to ``start_pos``/``end_pos``; unreadable ones are dropped."""
    bounds = scalar.interval_bounds(F.col(text))
    return df.withColumn("_bounds", bounds).filter(F.col("_bounds").isNotNull()).select("*", "_bounds.*").drop("_bounds", text)


def number_points(df: DataFrame, layout: Layout) -> DataFrame:
    """1-based ``entry`` of each point in its trip."""
    return scan(df, layout, _entry=position()).withColumn("entry", F.col("_entry").cast("int")).drop("_entry")


def flag_intervals(numbered: DataFrame, layout: Layout, intervals: DataFrame, name: str = "manual") -> DataFrame:
    """True for points whose entry lies in any interval of their trip (both ends included).

    An interval opens at its start and closes after its end, so a point is covered while more
    have opened than closed. That is an equi-join on (trip, entry) and a running sum: no
    point-interval pairs, however many intervals overlap.
    """
    some = intervals.filter(F.col("end_pos") >= 1)
    opens = some.select(S.TRIP, F.greatest("start_pos", F.lit(1)).alias("entry"), F.lit(1).alias("_edge"))
    closes = some.select(S.TRIP, (F.col("end_pos") + 1).alias("entry"), F.lit(-1).alias("_edge"))
    edges = opens.unionAll(closes).groupBy(S.TRIP, "entry").agg(F.sum("_edge").alias("_edge"))
    marked = numbered.join(edges, [S.TRIP, "entry"], "left").fillna(0, ["_edge"])
    if CHUNK in marked.columns:
        marked = layout.pin(marked)
    return scan(marked, layout, _open=running_sum("_edge")).withColumn(name, F.col("_open") > 0).drop("_open", "_edge")


def rule_flags(
    df: DataFrame,
    layout: Layout,
    intervals: DataFrame | None = None,
    speed_change: float = SPEED_CHANGE,
    course_change: float = COURSE_CHANGE,
) -> DataFrame:
    """``manual``, ``by_delta``, ``in_zone`` and ``flag`` = (manual or by_delta) and not in_zone."""
    stepped = scan(
        df, layout, _sog=previous("speed_over_ground"), _cog=previous("course_over_ground"), _entry=position()
    )
    turn = scalar.angle_change(F.abs(F.col("course_over_ground") - F.col("_cog")))
    jump = F.abs(F.col("speed_over_ground") - F.col("_sog"))
    by_delta = F.coalesce(jump > speed_change, F.lit(False)) | F.coalesce(turn > course_change, F.lit(False))
    out = stepped.withColumns(
        {
            "entry": F.col("_entry").cast("int"),
            "by_delta": by_delta,
            "in_zone": geo.in_zones(F.col("latitude"), F.col("longitude")),
            "manual": F.lit(False),
        }
    ).drop("_sog", "_cog", "_entry")
    if intervals is not None:
        out = flag_intervals(out.drop("manual"), layout, intervals)
    return out.withColumn("flag", (F.col("manual") | F.col("by_delta")) & ~F.col("in_zone"))


def flag_counts(flags: DataFrame, *keys: str) -> DataFrame:
    """The labeller's counts: manual, by change, combined, overridden in zones, final."""
    combined = F.col("manual") | F.col("by_delta")
    return flags.groupBy(*keys).agg(
        F.count("*").alias("points"),
        F.count_if("manual").alias("manual_points"),
        F.count_if("by_delta").alias("delta_points"),
        F.count_if(combined).alias("combined_points"),
        F.count_if(combined & F.col("in_zone")).alias("overridden_points"),
        F.count_if("flag").alias("final_points"),
        (F.count_if("flag") / F.count("*")).alias("anomaly_share"),
    )


def write_back(df: DataFrame, flags: DataFrame, key: str = S.POINT) -> DataFrame:
    """Labels of the flagged trips into the full table; other points keep theirs."""
    new = flags.select(key, F.col("flag").alias("_flag"))
    out = df.join(new, key, "left")
    updates = {"is_anomaly": F.coalesce("_flag", F.col("is_anomaly") if "is_anomaly" in df.columns else F.lit(False))}
    if "y_true" in df.columns:
        updates["y_true"] = F.coalesce(F.col("_flag").cast("int"), F.col("y_true"))
    return out.withColumns(updates).drop("_flag")


def label_points(df: DataFrame, flags_layout: Layout, intervals: DataFrame | None = None, **limits) -> DataFrame:
    """All trips labelled at once, without the join back: every point gets its flag."""
    flags = rule_flags(df, flags_layout, intervals, **limits)
    out = flags.withColumn("is_anomaly", F.col("flag"))
    if "y_true" in df.columns:
        out = out.withColumn("y_true", F.col("flag").cast("int"))
    return out.drop("entry", "by_delta", "in_zone", "manual", "flag")
