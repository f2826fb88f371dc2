"""Views over the driver tables that have the shape of vessel data.

The SQL runs unchanged in Spark and in DuckDB; Spark queries and oracle SQL share it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRAJ = """
SELECT user_id AS trip_id, event_id AS point_id, ts AS time_stamp,
 CASE WHEN user_id % 2 = 0 THEN 'KIEL' ELSE 'BREMERHAVEN' END AS start_port,
 53.4 + CAST((event_id * 37) % 1400 AS DOUBLE) / 1000 AS latitude,
 8.1 + CAST((event_id * 53) % 10900 AS DOUBLE) / 1000 AS longitude,
 value AS speed_over_ground, CAST((event_id * 97) % 361 AS DOUBLE) AS course_over_ground,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE 5 + CAST(event_id % 7 AS DOUBLE) / 2 END AS draught,
 CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(70 + user_id % 10 AS INT) END AS ship_type,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type = 'error' END AS is_anomaly
FROM events
"""

RAW = """
SELECT e.user_id AS TripID, event_id AS ID, 200000000 + e.user_id AS MMSI,
 CASE WHEN e.user_id % 2 = 0 THEN 'KIEL' ELSE 'BREMERHAVEN' END AS StartPort,
 CASE WHEN e.user_id % 2 = 0 THEN 'GDYNIA' ELSE 'HAMBURG' END AS EndPort,
 CASE WHEN e.user_id % 2 = 0 THEN CAST(54.33 AS DOUBLE) ELSE CAST(53.55 AS DOUBLE) END AS StartLatitude,
 CASE WHEN e.user_id % 2 = 0 THEN CAST(10.15 AS DOUBLE) ELSE CAST(8.55 AS DOUBLE) END AS StartLongitude,
 ts AS time, t.first_ts AS StartTime, t.last_ts AS EndTime,
 CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN CAST(0 AS BIGINT) ELSE 70 + e.user_id % 10 END AS shiptype,
 CASE WHEN e.user_id % 12 = 0 OR event_id % 13 = 0 THEN NULL WHEN event_id % 23 = 0 THEN CAST(-1 AS DOUBLE)
  ELSE CAST(80 + e.user_id % 150 AS DOUBLE) END AS Length,
 CASE WHEN e.user_id % 15 = 0 OR event_id % 14 = 0 THEN NULL ELSE CAST(10 + e.user_id % 25 AS DOUBLE) END AS Breadth,
 CASE WHEN e.user_id % 18 = 0 OR event_id % 11 = 0 THEN NULL ELSE 5 + CAST(event_id % 7 AS DOUBLE) / 2 END AS Draught,
 CASE WHEN event_id % 31 = 0 THEN NULL ELSE 53.4 + CAST((event_id * 37) % 1400 AS DOUBLE) / 1000 END AS Latitude,
 CASE WHEN event_id % 31 = 0 THEN NULL ELSE 8.1 + CAST((event_id * 53) % 10900 AS DOUBLE) / 1000 END AS Longitude,
 value AS SOG, CAST((event_id * 97) % 400 AS DOUBLE) AS COG,
 CASE WHEN event_id % 29 = 0 THEN CAST(511 AS DOUBLE) ELSE CAST((event_id * 31) % 420 AS DOUBLE) END AS TH,
 CASE event_id % 14 WHEN 0 THEN 'DE HAM' WHEN 1 THEN 'pl gdynia' WHEN 2 THEN 'DEBRV>PLGDY' WHEN 3 THEN '??' WHEN 4 THEN 'DE'
  WHEN 5 THEN 'Halmstad' WHEN 6 THEN 'A..B//C' WHEN 7 THEN 'NOWHERE' WHEN 8 THEN '-/./KIEL-/' WHEN 9 THEN 'GDYNIA VIA NOK'
  WHEN 10 THEN 'BREMEN.CITY' WHEN 11 THEN '12345' ELSE NULL END AS Destination,
 'vessel ' || CAST(e.user_id AS VARCHAR(20)) AS Name
FROM events e JOIN (SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id) t
 ON e.user_id = t.user_id
"""

SCORES = """
SELECT doc_id AS id, toxic AS y, CAST((doc_id * 37) % 101 AS DOUBLE) / 101 AS score,
 CASE WHEN (doc_id * 37) % 101 > 50 THEN 1 ELSE 0 END AS pred, quality
FROM labels
"""

VECTORS = """
SELECT vec_id, label, CASE WHEN vec_id % 2 = 0 THEN 'KIEL' ELSE 'BREMERHAVEN' END AS start_port, embedding FROM embeddings
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRAJ.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORES.replace("FROM labels", "FROM {labels}"), labels=table(spark, sf_dir, "labels"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VECTORS.replace("FROM embeddings", "FROM {embeddings}"), embeddings=table(spark, sf_dir, "embeddings"))
