"""Texts, files and trip-wise fills."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from queries.cleaning import _headed
from wakeline.functions import scalar, text
from wakeline.ml import impute
from wakeline.operators import clean, profile
from wakeline.operators import labels as lb
from wakeline.operators import trips
from wakeline.plans import cleaning
from wakeline.sources import tables, versions

GOLDEN = [
    ("DE HAM", "DEHAM", "DE.HAM"),
    ("pl gdynia", "PLGDYNIA", "PL.GDY"),
    ("DEBRV>PLGDY", "PLGDY", "PL.GDY"),
    ("??", None, None),
    ("Halmstad", "HALMSTAD", "DE.STA"),
    ("A..B//C", "A.B.C", None),
    ("NOWHERE", "NOWHERE", None),
    ("-/./KIEL-/", "KIEL", "DE.KEL"),
    ("GDYNIA VIA NOK", "GDYNIAVIANOK", "PL.GDY"),
    ("BREMEN.CITY", "BREMEN.CITY", "DE.BRE"),
    ("HAMBURG", "HAMBURG", "DE.HAM"),
    ("HAMBURGPORT", "HAMBURGPORT", "DE.HAM"),
    ("DE.HAM", "DE.HAM", "DE.HAM"),
    ("HAM.DE", "HAM.DE", "DE.HAM"),
    ("   ", None, None),
    (None, None, None),
]


def test_golden_destinations(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, Destination string")
    out = clean.clean_destinations(df).withColumn("code", text.port_code(F.col("Destination"))).orderBy("i").collect()
    assert [(r["Destination"], r["code"]) for r in out] == [(c, k) for _, c, k in GOLDEN]


def test_cleaned_texts_are_in_form(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("aB9 ./\\><-\t?é_") for _ in range(rnd.randrange(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", text.clean_destination(F.col("t")).alias("c")).collect():
        kept = [c for c in r["t"].upper() if c in "AB9"]
        if r["c"] is None:
            assert not kept
            continue
        assert [c for c in r["c"] if c in "AB9"] == kept
        assert set(r["c"]) <= set("AB9.<>") and ".." not in r["c"] and r["c"].strip(".") == r["c"]


def test_invalid_destinations(spark):
    df = spark.createDataFrame([("12345",), ("DE",), ("de",), ("DEU",), ("??",), (None,)], "Destination string")
    assert [r[0] for r in clean.null_invalid_destinations(df).collect()] == [None, None, "de", "DEU", None, None]


def _matches(name, pattern, cc):
    return name.startswith(pattern) or name.endswith(pattern) or any(p in name for p in (f".{pattern}", f"{pattern}.", cc + pattern, pattern + cc))


def test_port_code_equals_the_rule_on_random_texts(spark):
    rnd = random.Random(3)
    pieces = [n for _, _, _, n in text.port_rows()] + ["DE", "PL", "SE", ".", "X", "VIA", "KA", "ST"]
    names = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 4))) for _ in range(800)]
    got = {r["n"]: r["c"] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", text.port_code(F.col("n")).alias("c")).collect()}
    for n in names:
        want = next((f"{cc}.{port}" for _, cc, port, pattern in text.port_rows() if _matches(n, pattern, cc)), None)
        assert got[n] == want, n


def test_unmatched_names_can_be_kept(spark):
    df = spark.createDataFrame([("NOWHERE",), ("KIEL",)], "n string")
    assert [r[0] for r in df.select(text.port_code(F.col("n"), keep_unmatched=True)).collect()] == ["NOWHERE", "DE.KEL"]


def test_port_dictionary(spark):
    ports = text.port_table(spark)
    assert text.port_violations(ports).count() == 0
    listing = {r["name"]: r["code"] for r in text.port_listing(ports).collect()}
    assert listing["STAD"] == "DE.STA" and listing["ANR"] == "BE.ANR" and len(listing) == 56
    broken = text.port_table(spark, [(0, "", "AAA", "AAA"), (1, "", "AAA", "ALPHA"), (2, "XX", "BBB", "BBB")])
    assert {(r["port"], r["problem"]) for r in text.port_violations(broken).collect()} == {("AAA", "no country"), ("BBB", "no names")}


def test_a_dictionary_table_names_ports_like_the_expression(spark):
    rnd = random.Random(9)
    rows = text.port_rows()
    names = [n for *_, n in rows] + ["X", "DE", "PL", "OLD", "SE"]
    texts = [rnd.choice(["", ".", "DE", "PL."]).join(rnd.choice(names) for _ in range(rnd.randrange(1, 4))) + rnd.choice(["", ".", "LT", "Q"]) for _ in range(600)] + ["", " ", None, "."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for at_once in (100_000, 10):
        both = text.port_codes(df, "t", text.port_table(spark), at_once=at_once).withColumn("chain", text.port_code(F.col("t")))
        assert [tuple(r) for r in both.where("NOT code <=> chain").collect()] == [] and both.where("code IS NOT NULL").count() > 300
    assert text.port_codes(df, "t", text.port_table(spark).limit(0)).where("code IS NULL").count() == len(texts)


def test_a_long_dictionary_is_one_pass(spark):
    ports = spark.range(50_000).select(F.col("id").cast("int").alias("priority"), F.lit("DE").alias("country"), F.concat(F.lit("P"), "id").alias("port"), F.concat(F.lit("NAME"), "id", F.lit("X")).alias("name"))
    df = spark.range(500).select(F.concat(F.lit("Z.NAME"), (F.col("id") * 97).cast("string"), F.when(F.col("id") % 2 == 0, "X").otherwise("Y")).alias("t"), "id")
    got = text.port_codes(df, "t", ports)
    assert {r["id"]: r["code"] for r in got.collect()} == {i: f"DE.P{i * 97}" if i % 2 == 0 else None for i in range(500)}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_csv_rows_and_missing_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('TripID,time,Destination,SOG,shiptype\n1,2024-01-01 00:00:00,"KIEL, PORT",3.5,70\n1,2024-01-01 00:01:00,?,NaN,\n2,2024-01-01 00:02:00\n3,x,a,1,70,9,9\n')
    rows = tables.type_reports(tables.read_reports(spark, str(tmp_path))).orderBy("time").collect()
    assert [(r["TripID"], r["Destination"], r["SOG"], r["shiptype"]) for r in rows] == [(1, "KIEL, PORT", 3.5, 70), (1, None, None, None), (2, None, None, None)]


def test_surplus_fields_are_skipped_blank_or_not(spark, tmp_path):
    lines = ["TripID,SOG,Destination", "1,5,HAM", "2,6,HAM,", "3,7,HAM,,x", "4,8,HAM,zz", "5,9", "6", '7,1,"A,B"', '8,1,"A,B",', "9,,", '10,"2"']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    rows = tables.read_reports(spark, str(tmp_path))
    assert sorted((int(r["TripID"]), r["SOG"], r["Destination"]) for r in rows.collect()) == [(1, "5", "HAM"), (5, "9", None), (6, None, None), (7, "1", "A,B"), (9, None, None), (10, "2", None)]
    assert sorted(int(r["TripID"]) for r in rows.select("TripID").collect()) == [1, 5, 6, 7, 9, 10]


def test_row_ids_tell_shifted_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    ids = [r["i"] for r in df.select(scalar.row_id("x", "y").alias("i")).collect()]
    assert ids[0] == ids[2] != ids[1]


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("TripID,SOG,MMSI\n1,3.5,7\n")
    (tmp_path / "b.csv").write_text("TripID,COG\n2,90\n")
    df = cleaning.merge_reports(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted(df.columns) == ["COG", "SOG", "TripID"]
    assert sorted((r["TripID"], r["SOG"], r["COG"]) for r in df.collect()) == [(1, 3.5, None), (2, None, 90.0)]
    # a folder: the same columns in another order, and an empty file
    (tmp_path / "c.csv").write_text("SOG,TripID\n4.5,3\n")
    (tmp_path / "d.csv").write_text("")
    folder = cleaning.merge_reports(spark, str(tmp_path))
    assert sorted((r["TripID"], r["SOG"], r["COG"]) for r in folder.collect()) == [(1, 3.5, None), (2, None, 90.0), (3, 4.5, None)]


def walk(points):
    """The destination fill, one row after the other."""
    dest = [p[2] for p in points]
    for i, (lat, lon, d) in enumerate(points):
        if d is not None or lat is None:
            continue
        above = next((j for j in range(i - 1, -1, -1) if dest[j] is not None), None)
        below = next((j for j in range(i + 1, len(points)) if dest[j] is not None), None)
        if above is not None and below is not None:
            a, b = points[above], points[below]
            unknown = a[0] is None or b[0] is None
            near = unknown or math.hypot(lat - a[0], lon - a[1]) <= math.hypot(lat - b[0], lon - b[1])
            dest[i] = dest[above] if near else dest[below]
        elif above is not None or below is not None:
            dest[i] = dest[above if above is not None else below]
    return dest


@pytest.mark.parametrize("chunk_rows", [1_000_000, 9])
def test_destination_fill_equals_the_walk(spark, chunk_rows):
    rnd = random.Random(5)
    trips_, rows = {}, []
    for trip in range(60):
        points = []
        for k in range(rnd.randrange(1, 40)):
            lat, lon = (None, None) if rnd.random() < 0.15 else (rnd.random() * 5, rnd.random() * 5)
            dest = rnd.choice("ABC") if rnd.random() < 0.2 else None
            points.append((lat, lon, dest))
            rows.append((trip, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), lat, lon, dest, k))
        trips_[trip] = walk(points)
    df = spark.createDataFrame(rows, "TripID long, time timestamp_ntz, Latitude double, Longitude double, Destination string, k int")
    layout = clean.trip_layout(df, chunk_rows=chunk_rows)
    got = {(r["TripID"], r["k"]): r["Destination"] for r in clean.fill_destination(df, layout).collect()}
    assert got == {(t, k): d for t, dests in trips_.items() for k, d in enumerate(dests)}


def _raw(spark, tmp_path, trips_=6):
    lines = ["TripID,StartPort,EndPort,Destination,time,StartTime,EndTime,shiptype,Length,Breadth,Draught,Latitude,Longitude,SOG,COG,TH,Name,MMSI"]
    for t in range(trips_):
        for k in range(20):
            length = "" if t == 0 or k % 5 == 0 else 80 + 10 * t
            lines.append(f"{t},KIEL,GDYNIA,{'kiel' if k % 4 else ''},2024-01-01 0{t}:{k:02d}:00,2024-01-01 00:00:00,2024-01-02 00:00:00,{'' if k < 2 else 70},{length},{10 + t},{'' if k % 3 == 0 else 5.5},54.{k:02d},10.{k:02d},{k + 5 * t},400,511,x,1")
    lines.append(lines[1])
    (tmp_path / "reports.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "reports.csv")


def test_cleaning_run_and_ingest(spark, tmp_path):
    delivery, out = _raw(spark, tmp_path), str(tmp_path / "cleaned")
    cleaned = cleaning.cleaned_or_built(spark, delivery, out, impute.imputer(rounds=3))
    assert cleaned.count() == sum(1 for t in range(6) for k in range(20) if k + 5 * t < 30)
    assert cleaned.filter("length <= 0 OR draught <= 0 OR destination <> 'DE.KEL' OR course_over_ground <> 0").count() == 0
    assert cleaned.filter("is_anomaly IS NOT NULL").count() == 0
    assert {"trip_id", "time_stamp", "speed_over_ground", "destination"} <= set(cleaned.columns) and "Name" not in cleaned.columns
    # built once, then read; a new delivery replaces it
    assert cleaning.cleaned_or_built(spark, "/nowhere", out).count() == cleaned.count()
    second = _raw(spark, tmp_path, trips_=2)
    assert cleaning.ingest(spark, second, out).select("trip_id").distinct().count() == 2


def test_a_run_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    out = str(tmp_path / "cleaned")
    before = cleaning.ingest(spark, _raw(spark, tmp_path), out)
    rows = before.count()

    def failing(df):
        return df.withColumn("Length", F.when(F.col("TripID") < 0, 1.0).otherwise(F.raise_error(F.lit("lost")).cast("double")))

    with pytest.raises(Exception, match="lost"):
        cleaning.ingest(spark, _raw(spark, tmp_path, trips_=2), out, failing)
    assert versions.read(spark, out).count() == rows and before.count() == rows
    assert len([p for p in (tmp_path / "cleaned").iterdir() if not (p / "_SUCCESS").exists()]) <= 1
    for n in (1, 2, 3):
        versions.commit(spark.range(n), out)
    assert versions.read(spark, out).count() == 3 and len(versions._finished(spark, out)) <= versions.KEPT + 1


def test_upserts_replace_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 3.0)], [("a", 1, 9.0), ("c", 2, 4.0)]):
        versions.upsert(spark.createDataFrame(rows, "r string, k int, x double"), path, ["r", "k"])
    assert sorted(map(tuple, versions.read(spark, path).collect())) == [("a", 1, 9.0), ("b", 1, 3.0), ("c", 2, 4.0)]


def test_mixed_headers_with_short_long_and_quoted_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n  \nTripID,Destination\n1,"KIEL, ""NORTH"""\n2\n3,x,\n\nTripID,Destination\n4,?\n')
    (tmp_path / "b.csv").write_text('\ufeff"Destination","SOG","TripID"\nHAM,5,6\nBRE,7\n,,8,9\n')
    (tmp_path / "c d.csv").write_text("TripID,Destination\n9,K\n")
    (tmp_path / "skipped.txt").write_text("TripID,Other\n1,2\n")
    df = tables.read_report_files(spark, str(tmp_path), pattern="*.csv")
    assert df.columns == ["TripID", "Destination", "SOG"]
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted([("1", 'KIEL, "NORTH"', None), ("2", None, None), ("4", None, None), ("6", "HAM", "5"), (None, "BRE", "7"), ("9", "K", None)], key=str)
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty.csv").write_text("")
    assert tables.read_report_files(spark, str(tmp_path / "e")).collect() == []


def test_distinct_counts_of_all_types_in_one_run(spark):
    rows = [(1, "a", 0.0, [1], None), (2, "a", -0.0, [1], None), (2, None, float("nan"), [2], None), (None, "b", float("nan"), None, None)]
    df = spark.createDataFrame(rows, "i int, s string, d double, a array<int>, n date")
    assert {r["column"]: r["distinct_values"] for r in profile.distinct_counts(df).collect()} == {"i": 2, "s": 2, "d": 2, "a": 2, "n": 0}
    changed = profile.changed_columns(df, df.withColumn("s", F.lit("z")).drop("i"))
    assert [tuple(r) for r in changed.collect()] == [("s", 2, 1)]
    ports = spark.createDataFrame([], "TripID long, StartPort string, EndPort string")
    assert {tuple(r) for r in profile.table_counts(ports).collect()} == {("rows", 0), ("trips", 0), ("start_ports", 0), ("end_ports", 0)}
    plan = profile.distinct_counts(spark.range(3).selectExpr(*[f"id + {i} AS c{i}" for i in range(9)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1


def test_write_splits(spark, tmp_path):
    df = spark.createDataFrame([("KIEL", 1), ("LUEBECK", 2)], "start_port string, trip_id long")
    cleaning.write_cleaned(df, str(tmp_path / "c"), str(tmp_path / "s"))
    assert [p.name for p in (tmp_path / "s").glob("start_port=*")] == ["start_port=KIEL"]


def test_regression_fill(spark):
    rows = [(i, float(10 + i % 20) * 5, float(10 + i % 20), 4.0 + (i % 20) / 10) for i in range(400)]
    rows = [(i, None if i % 10 == 0 else length, None if i % 15 == 0 else breadth, d) for i, length, breadth, d in rows]
    df = spark.createDataFrame(rows, "i long, Length double, Breadth double, Draught double")
    out, r2 = impute.fill_dimensions(df, rounds=15)
    got = {r["i"]: r for r in out.collect()}
    assert all(got[i][c] == rows[i][j] for i in got for j, c in ((1, "Length"), (2, "Breadth"), (3, "Draught")) if rows[i][j] is not None)
    assert all(r["Length"] is not None and r["Length"] == round(r["Length"]) for r in got.values())
    assert r2["Length"] > 0.8 and r2["Draught"] is None
    same, none = impute.fill_by_regression(df.withColumn("Length", F.lit(None).cast("double")), "Length", ["Breadth"])
    assert none is None and same.count() == 400
    with pytest.raises(ValueError):
        impute.fill_by_regression(df, "Width", ["Breadth"])


def test_half_even_and_iso(spark):
    df = spark.createDataFrame([(0.5, dt.datetime(2024, 1, 1, 1, 2, 3)), (1.5, dt.datetime(2024, 1, 1, 1, 2, 3, 40)), (2.5, None)], "x double, t timestamp_ntz")
    out = df.select(scalar.half_even(F.col("x")).alias("x"), scalar.iso_text(F.col("t")).alias("t")).collect()
    assert [r["x"] for r in out] == [0.0, 2.0, 2.0]
    assert [r["t"] for r in out] == ["2024-01-01T01:02:03", "2024-01-01T01:02:03.000040", None]


def test_intervals(spark):
    df = spark.createDataFrame([(t,) for t in ("10-20", "9-3", " 4 - 5 ", "7", "a-b", "1-2-3", "-1-2")], "interval string")
    assert [(r["start_pos"], r["end_pos"]) for r in lb.parse_intervals(df).collect()] == [(10, 20), (3, 9), (4, 5)]


def test_missing_percent_of_unknown_column(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    with pytest.warns(UserWarning):
        out = {r["column"]: r["missing_percent"] for r in profile.missing_percent(df, ["a", "b"]).collect()}
    assert out == {"a": 50.0, "b": 0.0}


def test_select_trip_checks(spark):
    df = spark.createDataFrame([(1, 2.0)], "trip_id long, x double")
    assert trips.select_trip(df, "1").count() == 1
    with pytest.raises(trips.TripNotFound):
        trips.select_trip(df, "5", check=True)


def test_default_order_does_not_depend_on_arrival(spark):
    """Two reports of one second before a gap: the fill takes the same one in either input order."""
    names = "TripID long, time timestamp_ntz, shiptype int, Draught double, Length double, Breadth double, SOG double, COG double, TH double, Latitude double, Longitude double, Destination string, StartPort string, EndPort string, Name string, MMSI long, StartTime timestamp_ntz, EndTime timestamp_ntz, StartLatitude double, StartLongitude double"
    at = lambda second: dt.datetime(2024, 1, 1, 0, 0, second)
    row = lambda second, kind, sog: (1, at(second), kind, 5.0, 80.0, 10.0, sog, 90.0, 90.0, 54.0, 9.0, None, "KIEL", "GDYNIA", "x", 7, at(0), at(9), 54.3, 10.1)
    rows = [row(1, 80, 4.0), row(1, 70, 3.0), row(2, None, 5.0)]
    found = []
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, names).coalesce(1)
        found.append(sorted(map(str, cleaning.handle_noise(df).collect())))
    assert found[0] == found[1]


def _optimised(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("TripID,Destination,SOG\n1,KIEL,2\n")
    (tmp_path / "b.csv").write_text("SOG,TripID\n5,6\n")
    typed = tables.type_reports(tables.read_report_files(spark, str(tmp_path)))
    assert _optimised(cleaning.normalise_destinations(typed)).count("from_csv(") == 1


def test_a_text_is_made_once_for_all_ports(spark):
    df = clean.clean_destinations(spark.createDataFrame([("KIEL",), ("x",)], "Destination string"))
    plan = _optimised(df.select(text.port_code(F.col("Destination")).alias("c")).where("c IS NOT NULL").groupBy("c").count())
    assert plan.count("[^A-Z0-9./") <= 12  # a target is a choice of texts, in the filter and in the result; not one for each of 60 names


def test_files_with_mixed_headers_are_written_by_all_tasks(spark, tmp_path):
    lines = spark.range(100, numPartitions=4).selectExpr("concat(id, ',', id % 7) AS value")
    lines.mapInArrow(_headed("TripID,SOG"), "value string").write.text(str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("*.txt"))
    assert len(files) == 4 and all(f.read_text().startswith("TripID,SOG\n") for f in files)
    assert sorted(int(r["TripID"]) for r in tables.read_report_files(spark, str(tmp_path / "t")).collect()) == list(range(100))
