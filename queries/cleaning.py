"""Sources, sinks, cleaning and destination queries."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, rounded
from wakeline import schema as S
from wakeline.functions import scalar, text
from wakeline.ml import impute
from wakeline.operators import clean, profile, trips
from wakeline.operators import features as ft
from wakeline.operators import labels as lb
from wakeline.operators.layout import join_values
from wakeline.plans import cleaning
from wakeline.session import scratch_path
from wakeline.sources import tables

RAW_ORDER = ["time", "ID"]
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def layout(raw, **options):
    return clean.trip_layout(raw, order=RAW_ORDER, **options)


# ---------------------------------------------------------------- sources and sinks

RAW_COLUMNS = "TripID, ID, StartPort, time, shiptype, Length, Draught, Latitude, SOG, Destination"


@query("s1_csv_reports", f"SELECT {RAW_COLUMNS.replace('shiptype', 'CAST(shiptype AS INT) AS shiptype')} FROM raw")
def s1(spark, sf):
    path = scratch_path(spark, "reports")
    fx.raw(spark, sf).write.options(header=True, nullValue="?", timestampNTZFormat=MICROS).csv(path)
    return tables.type_reports(tables.read_reports(spark, path)).select(*RAW_COLUMNS.split(", "))


def _headed(header: str):
    """Every task's lines behind a header: as many files as tasks."""

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        yield from batches

    return run


@query(
    "s2_csv_folder",
    """SELECT ID % 3 AS kind, count(*) AS points, CAST(sum(TripID) AS BIGINT) AS trip_sum, count(CASE WHEN ID % 3 <> 1 AND ID % 89 <> 0 THEN Destination END) AS destinations,
      count(CASE WHEN ID % 3 = 2 THEN ID END) AS notes FROM raw WHERE ID % 97 <> 0 GROUP BY ID % 3""",
)
def s2(spark, sf):
    """Three headers in one folder: all columns, without destination and in another order, and with one column more; some lines are too short, some too long."""
    path, raw = scratch_path(spark, "folder"), fx.raw(spark, sf)
    front = [c for c in raw.columns if c != "Destination"]
    kinds = [[*front, "Destination"], front[::-1], ["Note", *front, "Destination"]]
    for kind, columns in enumerate(kinds):
        rows = raw.where(F.col("ID") % 3 == kind).withColumn("Note", F.concat(F.lit('say "'), "ID", F.lit('", then go')))
        cut = rows.withColumn("Destination", F.when(F.col("ID") % 89 != 0, F.col("Destination")))
        line = F.to_csv(F.struct(*columns), {"timestampNTZFormat": MICROS, "escape": '"'})
        short = F.regexp_replace(line, r",[^,]*$", "") if kind != 1 else line  # the missing destination is the last field
        whole = F.when(F.col("ID") % 97 == 0, F.concat(line, F.lit(",one,more"))).when(F.col("ID") % 89 == 0, short).otherwise(line)
        cut.select(whole.alias("value")).mapInArrow(_headed(",".join(columns)), "value string").write.mode("append").text(path)
    found = tables.read_report_files(spark, path, pattern="*.txt")
    typed = tables.type_reports(found)
    return typed.groupBy((F.col("ID").cast("long") % 3).alias("kind")).agg(
        F.count("*").alias("points"), F.sum("TripID").alias("trip_sum"), F.count("Destination").alias("destinations"),
        F.count_if(F.col("Note") == F.concat(F.lit('say "'), F.col("ID").cast("string"), F.lit('", then go'))).alias("notes"),
    )


@query("s3_parquet_scan", "SELECT event_id, user_id, value FROM events WHERE value < 30")
def s3(spark, sf):
    return fx.table(spark, sf, "events").filter("value < 30").select("event_id", "user_id", "value")


@query("s4_parquet_sink", "SELECT trip_id, point_id, time_stamp, speed_over_ground, draught FROM traj")
def s4(spark, sf):
    path = scratch_path(spark, "points")
    tables.write_table(fx.traj(spark, sf), path)
    return spark.read.parquet(path).select("trip_id", "point_id", "time_stamp", "speed_over_ground", "draught")


@query(
    "s5_port_splits",
    "SELECT start_port, count(*) AS points, CAST(sum(point_id) AS BIGINT) AS ids FROM traj WHERE start_port IN ('KIEL', 'BREMERHAVEN') GROUP BY start_port",
)
def s5(spark, sf):
    path = scratch_path(spark, "splits")
    tables.write_port_splits(fx.traj(spark, sf), path)
    return spark.read.parquet(path).groupBy("start_port").agg(F.count("*").alias("points"), F.sum("point_id").alias("ids"))


@query("s6_trip_list", "SELECT DISTINCT trip_id FROM traj")
def s6(spark, sf):
    path = scratch_path(spark, "trips")
    tables.write_trip_list(fx.traj(spark, sf), path)
    return spark.read.schema("trip_id bigint").json(path)


@query(
    "s7_scored_points",
    """SELECT latitude, longitude,
       strftime(time_stamp, '%Y-%m-%dT%H:%M:%S') ||
         CASE WHEN strftime(time_stamp, '%f') = '000000' THEN '' ELSE '.' || strftime(time_stamp, '%f') END AS time_stamp,
       speed_over_ground / 50 AS score, CASE WHEN speed_over_ground / 50 > 0.5 THEN 1 ELSE 0 END AS is_anomaly_pred,
       ship_type AS m_ship_type, draught AS m_draught, speed_over_ground AS m_speed, course_over_ground AS m_course FROM traj""",
)
def s7(spark, sf):
    path = scratch_path(spark, "scored")
    points = fx.traj(spark, sf).withColumn("score", F.col("speed_over_ground") / 50)
    points = points.withColumn("is_anomaly_pred", (F.col("score") > 0.5).cast("int"))
    feed = tables.scored_points(points)
    tables.write_json(feed, path)
    back = spark.read.schema(feed.schema).json(path)
    return back.select(
        "latitude", "longitude", "time_stamp", "score", "is_anomaly_pred",
        F.col("data.ship_type").alias("m_ship_type"), F.col("data.draught").alias("m_draught"),
        F.col("data.speed_over_ground").alias("m_speed"), F.col("data.course_over_ground").alias("m_course"),
    )


@query(
    "s8_label_preview",
    """SELECT latitude, longitude, CASE WHEN speed_over_ground > 30 THEN 1 ELSE 0 END AS is_anomaly_pred,
       'Entry number ' || row_number() OVER (PARTITION BY trip_id ORDER BY time_stamp, point_id) AS comment FROM traj""",
)
def s8(spark, sf):
    points = fx.traj(spark, sf)
    numbered = lb.number_points(points, ft.point_layout(points))
    path = scratch_path(spark, "preview")
    preview = tables.label_preview(numbered, F.col("speed_over_ground") > 30)
    tables.write_json(preview, path)
    return spark.read.schema(preview.schema).json(path)


CLEANED = """WITH coded AS (
  SELECT DISTINCT * REPLACE (CASE WHEN Destination SIMILAR TO '.*[A-Za-z].*' AND NOT regexp_full_match(Destination, '[A-Z]{2}') THEN {code} END AS Destination)
  FROM raw)"""


@query(
    "s9_ingest",
    """SELECT TripID AS trip_id, count(*) AS points, max(time) AS last_time FROM raw WHERE SOG < 30 GROUP BY TripID""",
)
def s9(spark, sf):
    delivery, out = scratch_path(spark, "delivery"), scratch_path(spark, "cleaned")
    # The position in the file's id column keeps equal reports apart, as in the fixture view.
    fx.raw(spark, sf).drop("Name").withColumnRenamed("ID", "report").write.options(header=True, timestampNTZFormat=MICROS).csv(delivery)
    cleaned = cleaning.cleaned_or_built(spark, delivery, out)
    return cleaned.groupBy("trip_id").agg(F.count("*").alias("points"), F.max("time_stamp").alias("last_time"))


# ---------------------------------------------------------------- projections, casts, filters


@query("p1_drop_columns", "SELECT * EXCLUDE (ID, MMSI, Name) FROM raw")
def p1(spark, sf):
    return clean.drop_columns(fx.raw(spark, sf))


TIME_TEXT = "CASE WHEN ID % 37 = 0 THEN 'at noon' WHEN ID % 41 = 0 THEN NULL ELSE CAST(time AS VARCHAR(40)) END AS time"


@query(
    "p2_cast_times",
    f"""WITH texts AS (SELECT ID, {TIME_TEXT} FROM raw) SELECT ID, TRY_CAST(time AS TIMESTAMP) AS time FROM texts""",
)
def p2(spark, sf):
    return clean.cast_times(fx.raw(spark, sf).selectExpr("ID", TIME_TEXT))


@query(
    "p2_cast_times_report",
    f"""WITH texts AS (SELECT ID, {TIME_TEXT} FROM raw)
    SELECT 'time' AS "column", count(TRY_CAST(time AS TIMESTAMP)) AS valid, count(time) - count(TRY_CAST(time AS TIMESTAMP)) AS lost FROM texts""",
)
def p2_report(spark, sf):
    return clean.time_cast_report(fx.raw(spark, sf).selectExpr("ID", TIME_TEXT))


TYPE_TEXT = "CASE WHEN ID % 17 = 0 THEN NULL WHEN ID % 19 = 0 THEN 'tug' ELSE CAST(shiptype AS VARCHAR(9)) || '.0' END AS shiptype"


@query(
    "p3_cast_categories",
    f"WITH texts AS (SELECT ID, StartPort, {TYPE_TEXT} FROM raw) SELECT ID, StartPort, TRY_CAST(TRY_CAST(shiptype AS DOUBLE) AS INT) AS shiptype FROM texts",
)
def p3(spark, sf):
    return clean.cast_categories(fx.raw(spark, sf).selectExpr("ID", "StartPort", TYPE_TEXT))


AUDIT_TEXT = "Destination, CAST(Draught AS VARCHAR(20)) AS Draught"


@query(
    "p4_mixed_types",
    f"""WITH texts AS (SELECT {AUDIT_TEXT} FROM raw),
    cells AS (SELECT 'Destination' AS "column", Destination AS t FROM texts UNION ALL SELECT 'Draught', Draught FROM texts),
    known AS (SELECT "column", t, TRY_CAST(t AS DOUBLE) IS NOT NULL AS num FROM cells WHERE t IS NOT NULL),
    shown AS (SELECT "column", string_agg(t, '|' ORDER BY t) AS examples FROM
      (SELECT "column", t, row_number() OVER (PARTITION BY "column" ORDER BY t) AS r FROM (SELECT DISTINCT "column", t FROM known WHERE NOT num)) WHERE r <= 5 GROUP BY 1)
    SELECT k."column", count(*) FILTER (WHERE num) AS numbers, count(*) FILTER (WHERE NOT num) AS texts, coalesce(max(examples), '') AS examples,
      count(*) FILTER (WHERE num) > 0 AND count(*) FILTER (WHERE NOT num) > 0 AS mixed
    FROM known k LEFT JOIN shown s ON k."column" = s."column" GROUP BY k."column" """,
)
def p4(spark, sf):
    return profile.mixed_type_audit(fx.raw(spark, sf).selectExpr(*AUDIT_TEXT.split(", ")))


@query("p5_uppercase", "SELECT ID, upper(StartPort) AS StartPort, upper(Destination) AS Destination, upper(Name) AS Name FROM raw")
def p5(spark, sf):
    return clean.uppercase_text(fx.raw(spark, sf).select("ID", "StartPort", "Destination", "Name"))


VALID = "regexp_matches(Destination, '[A-Za-z]') AND NOT regexp_matches(Destination, '^[A-Z]{2}$')"


@query("p6_invalid_destinations", f"SELECT ID, CASE WHEN {VALID} THEN Destination END AS Destination FROM raw")
def p6(spark, sf):
    return clean.null_invalid_destinations(fx.raw(spark, sf).select("ID", "Destination"))


IMPOSSIBLE = """SELECT * REPLACE (
  CASE WHEN Length > 0 THEN Length END AS Length, CASE WHEN Breadth > 0 THEN Breadth END AS Breadth,
  CASE WHEN Draught > 0 THEN Draught END AS Draught, CASE WHEN shiptype > 0 THEN shiptype END AS shiptype,
  CASE WHEN TH BETWEEN 0 AND 360 OR TH = 511 THEN TH END AS TH, CASE WHEN COG BETWEEN 0 AND 360 THEN COG END AS COG) FROM {source}"""


@query("p7_impossible_values", IMPOSSIBLE.format(source="raw"))
def p7(spark, sf):
    return clean.null_impossible(fx.raw(spark, sf))


@query("p8_fast_points", "SELECT ID, SOG FROM raw WHERE SOG < 30")
def p8(spark, sf):
    return clean.drop_fast_points(fx.raw(spark, sf)).select("ID", "SOG")


@query(
    "p9_fill",
    """SELECT ID, CASE WHEN ID % 7 > 0 THEN TripID END AS TripID, CASE WHEN ID % 5 > 0 THEN StartPort END AS StartPort, coalesce(shiptype, 0) AS shiptype, coalesce(Length, 0) AS Length,
       coalesce(Draught, 0) AS Draught, coalesce(Latitude, 0) AS Latitude, coalesce(Destination, 'null') AS Destination FROM raw""",
)
def p9(spark, sf):
    """Rows without a trip or a start port keep these keys missing."""
    raw = fx.raw(spark, sf).withColumns({"TripID": F.when(F.col("ID") % 7 > 0, F.col("TripID")), "StartPort": F.when(F.col("ID") % 5 > 0, F.col("StartPort"))})
    return clean.fill_remaining(raw.select("ID", "TripID", "StartPort", "shiptype", "Length", "Draught", "Latitude", "Destination"))


@query(
    "p10_rename",
    """SELECT TripID AS trip_id, ID, StartPort AS start_port, time AS time_stamp, shiptype AS ship_type, TH AS true_heading,
       Destination AS destination, CAST(NULL AS BOOLEAN) AS is_anomaly FROM raw""",
)
def p10(spark, sf):
    return clean.rename_columns(fx.raw(spark, sf).select("TripID", "ID", "StartPort", "time", "shiptype", "TH", "Destination"))


@query("p11_select_trip", "SELECT point_id, time_stamp, latitude, longitude FROM traj WHERE trip_id = 8")
def p11(spark, sf):
    return trips.select_trip(fx.traj(spark, sf), "8").select("point_id", "time_stamp", "latitude", "longitude")


@query("p12_exclude_trips", "SELECT trip_id, point_id FROM traj WHERE trip_id NOT IN (3, 8, 46) AND ship_type IS NOT NULL")
def p12(spark, sf):
    return trips.drop_unknown_type(trips.exclude_trips(fx.traj(spark, sf), [3, 8, 46])).select("trip_id", "point_id")


@query("p13_target", "SELECT point_id, CAST(is_anomaly AS INT) AS y_true, start_port AS route_id FROM traj")
def p13(spark, sf):
    return trips.add_target(fx.traj(spark, sf)).select("point_id", "y_true", "route_id")


@query("p14_route_scan", "SELECT trip_id, point_id, time_stamp FROM traj WHERE start_port = 'KIEL'")
def p14(spark, sf):
    route = trips.select_route(fx.traj(spark, sf), "KIEL").select("trip_id", "point_id", "time_stamp")
    return trips.sort_points(route, ["trip_id", "time_stamp"])


@query(
    "p15_feature_matrix",
    "SELECT point_id, coalesce(speed_over_ground, 0) AS speed_over_ground, coalesce(draught, 0) AS draught, CAST(coalesce(ship_type, 0) AS DOUBLE) AS ship_type FROM traj",
)
def p15(spark, sf):
    return trips.feature_matrix(fx.traj(spark, sf), ["speed_over_ground", "draught", "ship_type"], keep=["point_id"])


@query("p16_complete_rows", "SELECT trip_id, point_id FROM traj WHERE draught IS NOT NULL AND ship_type IS NOT NULL AND is_anomaly IS NOT NULL")
def p16(spark, sf):
    return trips.complete_rows(fx.traj(spark, sf), ["draught", "ship_type"], "is_anomaly").select("trip_id", "point_id")


@query(
    "p17_chart_series",
    """SELECT trip_id, time_stamp, CASE WHEN speed_over_ground > 30 THEN 1 ELSE 0 END AS is_anomaly_pred, m.metric,
       CASE m.metric WHEN 'draught' THEN draught WHEN 'ship_type' THEN CAST(ship_type AS DOUBLE) ELSE course_over_ground END AS value
       FROM traj, (VALUES ('draught'), ('ship_type'), ('course_over_ground')) m(metric)""",
)
def p17(spark, sf):
    points = fx.traj(spark, sf).withColumn("is_anomaly_pred", F.when(F.col("speed_over_ground") > 30, 1).otherwise(0))
    return trips.chart_long(points, ["draught", "ship_type", "course_over_ground"])


# ---------------------------------------------------------------- destination texts

# RE2 has no look-around: two passes remove the dots that stand between separators.
_STEP1 = r"regexp_replace(regexp_replace(upper(Destination), '[^A-Z0-9./\\><-]', '', 'g'), '\.+', '.', 'g')"
for _symbol in ("/", ">", "<", "-"):
    _STEP1 = f"regexp_replace({_STEP1}, '{_symbol}+', '{_symbol}', 'g')"
_STEP1 = rf"regexp_replace({_STEP1}, '\\+', '\', 'g')".replace("'\\', 'g'", "'\\\\', 'g'")
_LONE = r"regexp_replace({0}, '(^|[/\\><-])\.([/\\><-]|$)', '\1\2', 'g')"
_NO_LONE = _LONE.format(_LONE.format(_STEP1))
CLEAN_SQL = rf"nullif(trim(regexp_replace(translate({_NO_LONE}, '/\-', '...'), '\.+', '.', 'g'), '.'), '')"
TARGET_SQL = f"CASE WHEN contains({CLEAN_SQL}, '>') THEN split_part({CLEAN_SQL}, '>', 2) ELSE {CLEAN_SQL} END"


def code_sql(column: str) -> str:
    tests = []
    for _, country, port, name in text.port_rows():
        parts = [f"starts_with({column}, '{name}')", f"ends_with({column}, '{name}')"]
        parts += [f"contains({column}, '{p}')" for p in (f".{name}", f"{name}.", f"{country}{name}", f"{name}{country}")]
        tests.append(f"WHEN {' OR '.join(parts)} THEN '{country}.{port}'")
    return f"CASE WHEN coalesce({column}, '') = '' THEN NULL {' '.join(tests)} END"


@query("f1_clean_destination", f"SELECT ID, {CLEAN_SQL} AS Destination FROM raw")
def f1(spark, sf):
    return fx.raw(spark, sf).select("ID", text.clean_destination(F.col("Destination")).alias("Destination"))


@query("f2_route_target", f"SELECT ID, {TARGET_SQL} AS Destination FROM raw")
def f2(spark, sf):
    return clean.clean_destinations(fx.raw(spark, sf).select("ID", "Destination"))


TARGETS = f"WITH targets AS (SELECT *, {TARGET_SQL} AS target FROM raw)"


@query("f3_port_code", f"{TARGETS} SELECT ID, target, {code_sql('target')} AS code FROM targets")
def f3(spark, sf):
    targets = clean.clean_destinations(fx.raw(spark, sf).select("ID", "Destination")).withColumnRenamed("Destination", "target")
    return targets.withColumn("code", text.port_code(F.col("target")))


@query("f4_special_characters", "SELECT DISTINCT Destination FROM raw WHERE regexp_matches(Destination, '[^A-Za-z0-9]')")
def f4(spark, sf):
    return fx.raw(spark, sf).filter(text.has_special_characters(F.col("Destination"))).select("Destination").distinct()


LISTING = ", ".join(f"({i}, '{c}.{p}', '{n}')" for i, c, p, n in text.port_rows())


@query(
    "f5_port_listing",
    f"""{TARGETS}, names(priority, code, name) AS (VALUES {LISTING}),
    listing AS (SELECT name, arg_max(code, priority) AS code FROM names GROUP BY name)
    SELECT target, code, count(*) AS points FROM targets LEFT JOIN listing ON target = listing.name WHERE target IS NOT NULL GROUP BY ALL""",
)
def f5(spark, sf):
    targets = clean.clean_destinations(fx.raw(spark, sf).select("Destination")).filter("Destination IS NOT NULL")
    counts = targets.groupBy(F.col("Destination").alias("target")).agg(F.count("*").alias("points"))
    listing = text.port_listing(text.port_table(spark))  # the fixed dictionary
    return counts.join(F.broadcast(listing), F.col("target") == F.col("name"), "left").drop("name")


@query(
    "j7_destination_port",
    f"{TARGETS} SELECT coalesce({code_sql('target')}, target) AS code, count(*) AS points FROM targets GROUP BY 1",
)
def j7(spark, sf):
    targets = clean.clean_destinations(fx.raw(spark, sf).select("Destination"))
    coded = targets.select(text.port_code(F.col("Destination"), keep_unmatched=True).alias("code"))
    return coded.groupBy("code").agg(F.count("*").alias("points"))


@query(
    "f6_port_problems",
    f"""{TARGETS} SELECT {code_sql('target')} AS code, count(*) AS points, CAST(NULL AS VARCHAR) AS problem FROM targets WHERE {code_sql('target')} IS NOT NULL GROUP BY 1
    UNION ALL SELECT '.NOC', 0, 'no country' UNION ALL SELECT 'XX.BARE', 0, 'no names'""",
)
def f6(spark, sf):
    """The dictionary with two rows that break its rules: a port without a country, and one without names."""
    targets = clean.clean_destinations(fx.raw(spark, sf).select("Destination"))
    coded = targets.select(text.port_code(F.col("Destination")).alias("code")).filter("code IS NOT NULL")
    broken = [*text.port_rows(), (900, "", "NOC", "NOC"), (901, "", "NOC", "NO COUNTRY"), (902, "XX", "BARE", "BARE")]
    problems = text.port_violations(text.port_table(spark, broken)).select(F.concat_ws(".", "country", "port").alias("code"), "problem")
    return coded.groupBy("code").agg(F.count("*").alias("points")).join(problems, "code", "full").fillna(0, ["points"])


@query(
    "f13_iso_text",
    """SELECT point_id, strftime(time_stamp, '%Y-%m-%dT%H:%M:%S') ||
       CASE WHEN strftime(time_stamp, '%f') = '000000' THEN '' ELSE '.' || strftime(time_stamp, '%f') END AS iso FROM traj""",
)
def f13(spark, sf):
    return fx.traj(spark, sf).select("point_id", scalar.iso_text(F.col("time_stamp")).alias("iso"))


INTERVAL_TEXT = """CASE point_id % 5 WHEN 0 THEN CAST(point_id % 40 + 1 AS VARCHAR(9)) || '-' || CAST(point_id % 40 + 5 AS VARCHAR(9))
  WHEN 1 THEN CAST(point_id % 30 + 9 AS VARCHAR(9)) || '-' || CAST(point_id % 30 AS VARCHAR(9)) WHEN 2 THEN '7' WHEN 3 THEN 'a-b' ELSE '3-4-5' END AS interval"""


@query(
    "f14_intervals",
    f"""WITH texts AS (SELECT trip_id, point_id, {INTERVAL_TEXT} FROM traj),
    parts AS (SELECT trip_id, point_id, CAST(split_part(interval, '-', 1) AS INT) AS a, CAST(split_part(interval, '-', 2) AS INT) AS b
      FROM texts WHERE regexp_matches(interval, '^\\d+-\\d+$'))
    SELECT trip_id, point_id, least(a, b) AS start_pos, greatest(a, b) AS end_pos FROM parts""",
)
def f14(spark, sf):
    return lb.parse_intervals(fx.traj(spark, sf).selectExpr("trip_id", "point_id", INTERVAL_TEXT))


@query(
    "f12_half_even",
    """SELECT point_id, round_even(draught, 0) AS draught_0, round_even(speed_over_ground / 8 * 100, 0) / 100 AS speed_2 FROM traj""",
)
def f12(spark, sf):
    return fx.traj(spark, sf).select(
        "point_id",
        scalar.half_even(F.col("draught")).alias("draught_0"),
        scalar.half_even(F.col("speed_over_ground") / 8, 2).alias("speed_2"),
    )


# ---------------------------------------------------------------- profiling


@query(
    "a1_missing_percent",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 5) AS missing_percent FROM raw"""
        for c in ("shiptype", "Length", "Breadth", "Draught", "Destination", "SOG")
    ),
)
def a1(spark, sf):
    return profile.missing_percent(fx.raw(spark, sf), ["shiptype", "Length", "Breadth", "Draught", "Destination", "SOG"])


@query(
    "a2_distinct_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM raw""" for c in ("TripID", "Destination", "Length", "StartPort")
    ),
)
def a2(spark, sf):
    return profile.distinct_counts(fx.raw(spark, sf), ["TripID", "Destination", "Length", "StartPort"])


@query(
    "a2_changed_columns",
    """WITH counts AS (SELECT 'Destination' AS "column", count(DISTINCT Destination) AS distinct_before, count(DISTINCT upper(left(Destination, 2))) AS distinct_after FROM raw
      UNION ALL SELECT 'StartPort', count(DISTINCT StartPort), count(DISTINCT upper(StartPort)) FROM raw)
    SELECT * FROM counts WHERE distinct_before <> distinct_after""",
)
def a2_changed(spark, sf):
    raw = fx.raw(spark, sf).select("Destination", "StartPort")
    return profile.changed_columns(raw, clean.uppercase_text(raw.withColumn("Destination", F.left("Destination", F.lit(2)))))


@query(
    "a3_top_values",
    """SELECT Destination, count(*) AS rows, round(count(*) / (SELECT count(*) FROM raw) * 100, 6) AS share_percent FROM raw
       WHERE Destination IS NOT NULL GROUP BY Destination ORDER BY rows DESC, Destination LIMIT 10""",
)
def a3(spark, sf):
    return rounded(profile.top_values(fx.raw(spark, sf), "Destination"))


@query("l2_top_trips", "SELECT TripID, count(*) AS rows, round(count(*) / (SELECT count(*) FROM raw) * 100, 6) AS share_percent FROM raw GROUP BY TripID ORDER BY rows DESC, TripID LIMIT 10")
def l2(spark, sf):
    return rounded(profile.top_values(fx.raw(spark, sf), "TripID"))


@query(
    "a4_values_of_gappy_trips",
    "SELECT DISTINCT TripID, Destination FROM raw WHERE TripID IN (SELECT TripID FROM raw WHERE Destination IS NULL)",
)
def a4(spark, sf):
    return profile.values_of_gappy_trips(fx.raw(spark, sf), "Destination")


@query(
    "a5_inconsistent_trips",
    """SELECT TripID FROM raw GROUP BY TripID
       HAVING count(DISTINCT Length) > 1 OR (count(DISTINCT Length) > 0 AND count(*) FILTER (WHERE Length IS NULL) > 0)""",
)
def a5(spark, sf):
    return profile.inconsistent_trips(fx.raw(spark, sf), "Length")


MODES = """modes AS (SELECT TripID, {c} AS mode FROM (SELECT TripID, {c}, row_number() OVER (PARTITION BY TripID ORDER BY count(*) DESC, {c}) AS r
  FROM {source} WHERE {c} IS NOT NULL GROUP BY TripID, {c}) WHERE r = 1)"""


@query("a6_trip_modes", "WITH " + MODES.format(c="Draught", source="raw") + " SELECT TripID, mode FROM modes")
def a6(spark, sf):
    return profile.trip_modes(fx.raw(spark, sf), "Draught")


@query("a7_trip_medians", "SELECT TripID, round(median(Draught), 6) AS median FROM raw WHERE Draught IS NOT NULL GROUP BY TripID")
def a7(spark, sf):
    return rounded(profile.trip_medians(fx.raw(spark, sf), "Draught"))


@query(
    "a8_correlations",
    """SELECT 'Draught-Length' AS pair, round(corr(Draught, Length), 6) AS correlation FROM raw UNION ALL
       SELECT 'Draught-Breadth', round(corr(Draught, Breadth), 6) FROM raw UNION ALL
       SELECT 'Length-Breadth', round(corr(Length, Breadth), 6) FROM raw""",
)
def a8(spark, sf):
    return rounded(profile.correlations(fx.raw(spark, sf), [("Draught", "Length"), ("Draught", "Breadth"), ("Length", "Breadth")]))


@query("a11_drop_duplicates", "SELECT DISTINCT * FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw)")
def a11(spark, sf):
    raw = fx.raw(spark, sf)
    return clean.drop_duplicates(raw.unionAll(raw))


@query(
    "a11_duplicate_report",
    "SELECT 2 * count(*) AS rows_before, count(*) AS rows_after, count(*) AS removed, CAST(50 AS DOUBLE) AS removed_percent FROM raw",
)
def a11_report(spark, sf):
    raw = fx.raw(spark, sf)
    return clean.duplicate_report(raw.unionAll(raw))


@query(
    "a12_table_counts",
    """SELECT 'rows' AS what, count(*) AS n FROM raw UNION ALL SELECT 'trips', count(DISTINCT TripID) FROM raw UNION ALL
       SELECT 'start_ports', count(DISTINCT StartPort) FROM raw UNION ALL SELECT 'end_ports', count(DISTINCT EndPort) FROM raw""",
)
def a12(spark, sf):
    return profile.table_counts(fx.raw(spark, sf))


@query("a13_known_trips", "SELECT TripID FROM raw GROUP BY TripID HAVING count(Length) > 0")
def a13(spark, sf):
    return profile.known_trips(fx.raw(spark, sf), "Length")


@query("a14_mixed_trips", "SELECT TripID FROM raw GROUP BY TripID HAVING count(Draught) > 0 AND count(Draught) < count(*)")
def a14(spark, sf):
    return profile.mixed_trips(fx.raw(spark, sf), "Draught")


@query(
    "a18_missing_map",
    " UNION ALL ".join(
        f"""SELECT ID % 100 AS bucket, count(*) AS rows, '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM raw GROUP BY 1"""
        for c in ("Length", "Draught", "Destination")
    ),
)
def a18(spark, sf):
    return profile.missing_map(fx.raw(spark, sf), F.col("ID") % 100, ["Length", "Draught", "Destination"])


MODE_FILL = "WITH " + MODES.format(c="Length", source="raw") + """,
  filled AS (SELECT raw.* REPLACE (coalesce(mode, Length) AS Length) FROM raw LEFT JOIN modes ON raw.TripID = modes.TripID)"""

_REPORT = """SELECT '{stage}' AS stage, round(sum(gaps) / sum(n) * 100, 5) AS missing_percent, count(*) FILTER (WHERE d > 1 OR (d > 0 AND gaps > 0)) AS inconsistent_trips
  FROM (SELECT TripID, count(*) AS n, count(*) - count(Length) AS gaps, count(DISTINCT Length) AS d FROM {source} GROUP BY TripID)"""


@query("a19_fill_report", f"{MODE_FILL} {_REPORT.format(stage='before', source='raw')} UNION ALL {_REPORT.format(stage='after', source='filled')}")
def a19(spark, sf):
    raw = fx.raw(spark, sf)
    return profile.fill_report(raw, clean.fill_mode(raw, layout(raw), ["Length"]), "Length")


# ---------------------------------------------------------------- fills inside trips


W1_SQL = """SELECT TripID, ID, last_value(shiptype IGNORE NULLS) OVER (PARTITION BY TripID ORDER BY time, ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shiptype FROM raw"""
W3_SQL = "SELECT TripID, ID, coalesce(Draught, median(Draught) OVER (PARTITION BY TripID)) AS Draught FROM raw"
W4_SQL = """WITH RECURSIVE ranked AS (
    SELECT TripID, ID, Latitude AS lat, Longitude AS lon, {dest} AS dest,
      row_number() OVER (PARTITION BY TripID ORDER BY time, ID) AS pos,
      first_value(CASE WHEN {dest} IS NOT NULL THEN {{'lat': Latitude, 'lon': Longitude, 'dest': {dest}}} END IGNORE NULLS)
        OVER (PARTITION BY TripID ORDER BY time, ID ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS below
    FROM {source}),
  walk AS (
    SELECT TripID, pos, ID, lat, lon, CASE WHEN dest IS NOT NULL THEN dest WHEN lat IS NULL OR lon IS NULL THEN NULL ELSE below.dest END AS filled,
      CAST(NULL AS DOUBLE) AS a_lat, CAST(NULL AS DOUBLE) AS a_lon, CAST(NULL AS VARCHAR) AS a_dest
    FROM ranked WHERE pos = 1
    UNION ALL
    SELECT r.TripID, r.pos, r.ID, r.lat, r.lon,
      CASE WHEN r.dest IS NOT NULL THEN r.dest WHEN r.lat IS NULL OR r.lon IS NULL THEN NULL
        WHEN coalesce(w.filled, w.a_dest) IS NULL THEN r.below.dest WHEN r.below IS NULL THEN coalesce(w.filled, w.a_dest)
        WHEN sqrt(power(r.lat - CASE WHEN w.filled IS NULL THEN w.a_lat ELSE w.lat END, 2) + power(r.lon - CASE WHEN w.filled IS NULL THEN w.a_lon ELSE w.lon END, 2))
           > sqrt(power(r.lat - r.below.lat, 2) + power(r.lon - r.below.lon, 2)) THEN r.below.dest
        ELSE coalesce(w.filled, w.a_dest) END,
      CASE WHEN w.filled IS NULL THEN w.a_lat ELSE w.lat END, CASE WHEN w.filled IS NULL THEN w.a_lon ELSE w.lon END, coalesce(w.filled, w.a_dest)
    FROM walk w JOIN ranked r ON r.TripID = w.TripID AND r.pos = w.pos + 1)"""
# A third of the reports lack a destination here, in long gaps.
GAPS = "SELECT * EXCLUDE (Destination), CASE WHEN ID % 14 IN (0, 1, 8, 10) THEN Destination END AS Destination FROM raw"
W4_QUERY = W4_SQL.format(source=f"({GAPS})", dest="Destination") + " SELECT TripID, ID, filled AS Destination FROM walk"


def _gaps(spark, sf):
    raw = fx.raw(spark, sf)
    return raw.withColumn("Destination", F.when(F.expr("ID % 14 IN (0, 1, 8, 10)"), F.col("Destination")))


def _both(name: str, sql: str):
    """Register a trip operator twice: trips whole, and every trip cut into chunks."""

    def register(build):
        query(name, sql)(lambda spark, sf: build(spark, sf))
        query(f"{name}_split", sql)(lambda spark, sf: build(spark, sf, chunk_rows=16))
        return build

    return register


@_both("w1_forward_fill", W1_SQL)
def w1(spark, sf, **options):
    raw = fx.raw(spark, sf)
    return clean.fill_ship_type(raw, layout(raw, **options)).select("TripID", "ID", "shiptype")


@_both("w2_mode_fill", f"{MODE_FILL} SELECT TripID, ID, Length FROM filled")
def w2(spark, sf, **options):
    raw = fx.raw(spark, sf)
    return clean.fill_mode(raw, layout(raw, **options), ["Length"]).select("TripID", "ID", "Length")


@_both("w3_median_fill", W3_SQL)
def w3(spark, sf, **options):
    raw = fx.raw(spark, sf)
    return clean.fill_median(raw, layout(raw, **options)).select("TripID", "ID", "Draught")


@_both("w4_destination_fill", W4_QUERY)
def w4(spark, sf, **options):
    raw = _gaps(spark, sf)
    return clean.fill_destination(raw, layout(raw, **options)).select("TripID", "ID", "Destination")


@query(
    "j2_keep_trips",
    "SELECT TripID, ID FROM raw WHERE TripID IN (SELECT TripID FROM raw WHERE Draught IS NULL)",
)
def j2(spark, sf):
    raw = fx.raw(spark, sf)
    return trips.keep_trips(raw, raw.filter("Draught IS NULL"), "TripID").select("TripID", "ID")


@query(
    "j10_trip_values",
    """SELECT ID, Draught - median(Draught) OVER (PARTITION BY TripID) AS draught_off FROM raw""",
)
def j10(spark, sf):
    raw = fx.raw(spark, sf)
    medians = profile.trip_medians(raw, "Draught")
    return join_values(raw, medians, layout(raw)).select("ID", (F.col("Draught") - F.col("median")).alias("draught_off"))


@query("u1_union", "SELECT ID, TripID, SOG, CAST(NULL AS DOUBLE) AS COG FROM raw UNION ALL SELECT ID, TripID, CAST(NULL AS DOUBLE), COG FROM raw")
def u1(spark, sf):
    raw = fx.raw(spark, sf)
    return trips.union_frames(raw.select("ID", "TripID", "SOG"), raw.select("ID", "TripID", "COG"))


@query("l1_total_sort", "SELECT TripID, time, ID, SOG FROM raw ORDER BY TripID, time, ID")
def l1(spark, sf):
    return trips.sort_points(fx.raw(spark, sf).select("TripID", "time", "ID", "SOG"), ["TripID", "time", "ID"])


@query("l3_sample_values", "SELECT DISTINCT Destination FROM raw WHERE Destination IS NOT NULL ORDER BY Destination LIMIT 5")
def l3(spark, sf):
    return profile.first_values(fx.raw(spark, sf), "Destination", 5)


# ---------------------------------------------------------------- composed stages

B3_SQL = f"""coded AS (SELECT DISTINCT * REPLACE ({code_sql('target')} AS Destination) FROM (
  SELECT v.* REPLACE (upper(Name) AS Name), {TARGET_SQL} AS target FROM (
    SELECT * REPLACE (CASE WHEN {VALID} THEN Destination END AS Destination) FROM raw) v))"""


@query("b3_normalise", f"WITH {B3_SQL} SELECT * EXCLUDE (target) FROM coded")
def b3(spark, sf):
    raw = fx.raw(spark, sf)
    return cleaning.normalise_destinations(raw.unionAll(raw))


B4_CTES = (
    W4_SQL.format(source="possible", dest="Destination").replace(
        "WITH RECURSIVE ",
        f"WITH RECURSIVE {B3_SQL}, possible AS ({IMPOSSIBLE.format(source='(SELECT * EXCLUDE (target) FROM coded)')} WHERE SOG < 30), ",
        1,
    )
    + ", "
    + MODES.format(c="Length", source="possible").replace("modes AS", "length_modes AS")
    + ", "
    + MODES.format(c="Breadth", source="possible").replace("modes AS", "breadth_modes AS")
)
B4_SELECT = """
  SELECT p.TripID AS trip_id, p.ID, p.MMSI, StartPort AS start_port, EndPort AS end_port, StartLatitude AS start_latitude, StartLongitude AS start_longitude,
    time AS time_stamp, StartTime AS start_time, EndTime AS end_time,
    coalesce(last_value(shiptype IGNORE NULLS) OVER (PARTITION BY p.TripID ORDER BY time, p.ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS ship_type,
    coalesce(l.mode, Length, 0) AS length, coalesce(b.mode, Breadth, 0) AS breadth,
    coalesce(Draught, median(Draught) OVER (PARTITION BY p.TripID), 0) AS draught,
    coalesce(Latitude, 0) AS latitude, coalesce(Longitude, 0) AS longitude, SOG AS speed_over_ground,
    coalesce(COG, 0) AS course_over_ground, coalesce(TH, 0) AS true_heading, coalesce(w.filled, 'null') AS destination,
    Name, CAST(NULL AS BOOLEAN) AS is_anomaly
  FROM possible p LEFT JOIN length_modes l ON l.TripID = p.TripID LEFT JOIN breadth_modes b ON b.TripID = p.TripID
    JOIN walk w ON w.TripID = p.TripID AND w.ID = p.ID"""


@_both("b4_handle_noise", B4_CTES + B4_SELECT)
def b4(spark, sf, **options):
    raw = fx.raw(spark, sf)
    return cleaning.handle_noise(cleaning.normalise_destinations(raw), layout=layout(raw, **options))


def _delivery(spark, sf):
    path = scratch_path(spark, "reports")
    fx.raw(spark, sf).write.options(header=True, timestampNTZFormat=MICROS).csv(path)
    return path


@query("b2_merge_reports", "SELECT * EXCLUDE (ID, MMSI, Name) REPLACE (CAST(shiptype AS INT) AS shiptype) FROM raw")
def b2(spark, sf):
    return cleaning.merge_reports(spark, _delivery(spark, sf))


@query(
    "b5_cleaning_run",
    B4_CTES
    + f""", cleaned AS ({B4_SELECT}) SELECT trip_id, start_port, end_port, time_stamp, CAST(ship_type AS INT) AS ship_type, latitude, longitude,
    speed_over_ground, course_over_ground, true_heading, destination, is_anomaly FROM cleaned""",
)
def b5(spark, sf):
    cleaned = cleaning.clean_reports(spark, _delivery(spark, sf), impute.imputer(rounds=5))
    return cleaned.select(
        "trip_id", "start_port", "end_port", "time_stamp", "ship_type", "latitude", "longitude",
        "speed_over_ground", "course_over_ground", "true_heading", "destination", "is_anomaly",
    )


# A dictionary from the parts, each name once at a place where it counts or does not count in an order's text.
DICTIONARY = """SELECT CAST(p_partkey * 7919 % 100003 AS INT) AS priority, substr('DEPLSEDKFI', CAST(2 * (p_partkey % 5) + 1 AS INT), 2) AS country,
    concat('P', CAST(p_partkey % 700 AS VARCHAR(9))) AS port, concat('N', CAST(p_partkey % 900 AS VARCHAR(9)), 'Q') AS name FROM part"""
TEXTS = """SELECT o_orderkey, concat(CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'X.' WHEN 2 THEN 'XPL' WHEN 3 THEN 'X' WHEN 4 THEN 'YDE' ELSE 'Z' END,
      concat('N', CAST(o_custkey % 1000 AS VARCHAR(9)), 'Q'),
      CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '.X' WHEN 2 THEN 'SEX' WHEN 3 THEN 'X' ELSE concat('N', CAST(o_orderkey % 800 AS VARCHAR(9)), 'Q') END) AS t FROM orders"""


@query(
    "j7_dictionary_table",
    f"""WITH names AS ({DICTIONARY}), texts AS ({TEXTS}),
    hits AS (
      SELECT o_orderkey, t, n.* FROM (SELECT *, unnest(regexp_extract_all(t, 'N[0-9]+Q')) AS found FROM texts) f JOIN names n ON n.name = f.found
      WHERE starts_with(t, name) OR ends_with(t, name) OR contains(t, '.' || name) OR contains(t, name || '.') OR contains(t, country || name) OR contains(t, name || country)
    ), best AS (SELECT o_orderkey, arg_min(country || '.' || port, (priority, country, port, name)) AS code FROM hits GROUP BY o_orderkey)
    SELECT t.o_orderkey, t.t, b.code FROM texts t LEFT JOIN best b USING (o_orderkey)""",
)
def j7_table(spark, sf):
    parts, orders = fx.table(spark, sf, "part"), fx.table(spark, sf, "orders")
    names = spark.sql(DICTIONARY.replace("FROM part", "FROM {part}").replace("VARCHAR(9)", "STRING"), part=parts)
    texts = spark.sql(TEXTS.replace("FROM orders", "FROM {orders}").replace("VARCHAR(9)", "STRING"), orders=orders)
    return text.port_codes(texts, "t", names, "code").select("o_orderkey", "t", "code")


# ---------------------------------------------------------------- regression fills


def _dimensions(spark, sf):
    return clean.null_impossible(fx.raw(spark, sf)).select("ID", "TripID", "Length", "Breadth", "Draught")


@query("k1_regression_imputation")
def k1(spark, sf):
    return impute.fill_dimensions(_dimensions(spark, sf), rounds=20)[0]


@query("k2_single_imputation")
def k2(spark, sf):
    return impute.fill_by_regression(_dimensions(spark, sf), "Length", ["Breadth", "Draught"], decimals=2, rounds=20)[0]
