"""From raw reports to scored trips."""

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.cleaning import MICROS
from wakeline.ml import impute, isolation
from wakeline.operators import evaluate as ev
from wakeline.operators import trips
from wakeline.plans import cleaning, features, scoring, training
from wakeline.sources import tables


def test_reports_to_scored_trips(spark, tmp_path):
    delivery, out = str(tmp_path / "reports"), str(tmp_path / "models")
    fx.raw(spark, "/root/testdata/sf0.001").write.options(header=True, timestampNTZFormat=MICROS).csv(delivery)
    cleaned = cleaning.ingest(spark, delivery, str(tmp_path / "cleaned"), impute.imputer(rounds=2))
    labelled = features.label_table(cleaning.with_point_id(cleaned))
    points = features.feature_points(features.prepare(labelled))
    assert points.count() == cleaned.count() > 300
    assert points.filter("dist_to_ref IS NULL OR x_km IS NULL OR dv IS NULL OR y_true IS NULL").count() == 0
    training.train_family("isolation_forest", points, out, grid=[isolation.Cell(20, "auto", 1.0)])
    scoring.score_trips(points, out, "isolation_forest", str(tmp_path / "scored"))
    feed = spark.read.json(str(tmp_path / "scored"))
    assert feed.count() == points.count() and set(feed.schema["data"].dataType.names) >= {"dv", "length", "true_heading", "zone"}
    assert feed.filter("score IS NULL OR is_anomaly_pred NOT IN (0, 1)").count() == 0
    # one trip alone, placed by the stored routes, scores as it does among all trips
    training.save_routes(features.prepare(labelled), out)
    trip = points.select("trip_id").first()[0]
    alone = scoring.score_cleaned(trips.select_trip(features.prepare(labelled), trip, check=True), out, "isolation_forest")
    among = scoring.score_points(points, out, "isolation_forest").filter(F.col("trip_id") == trip)
    assert {r["point_id"]: round(r["score"], 9) for r in alone.collect()} == {r["point_id"]: round(r["score"], 9) for r in among.collect()}
    tables.write_trip_list(points, str(tmp_path / "trips"))
    shares = ev.anomaly_share(points, ["start_port"])
    assert shares.agg(F.sum("points")).first()[0] == points.count()
