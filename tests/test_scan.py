"""Running aggregates: cut groups must give what whole groups give."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeline.operators import evaluate as ev
from wakeline.operators import layout as lay
from wakeline.operators import scan as sc

SCHEMA = "g string, t timestamp_ntz, i long, v double, w double"


def skewed(rows=600, seed=1):
    """One group (and the null group) hold a third of the rows each; times repeat."""
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = []
    for i in range(rows):
        g = ["hot", None, f"g{rnd.randrange(12)}"][i % 3]
        value = None if rnd.random() < 0.3 else float(rnd.randrange(20))
        out.append((g, start + dt.timedelta(seconds=rnd.randrange(400)), i, value, float(rnd.randrange(5))))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), SCHEMA)


def aggs():
    return dict(
        total=sc.running_sum("v"),
        before=sc.running_sum("v", before=True),
        top=sc.running_max("v"),
        last=sc.last_known("v"),
        last_before=sc.last_known("v", before=True),
        next=sc.next_known("v"),
        prev=sc.previous("v"),
        pos=sc.position(),
        all=sc.total("v"),
        rows=sc.total(F.lit(1)),
        low=sc.total("v", "min"),
    )


def collected(df):
    return {r["i"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("chunk_rows", [7, 50, 150])
def test_cut_groups_equal_whole_groups(frame, chunk_rows):
    whole = lay.detect(frame, ["g"], ["t", "i"])
    cut = lay.detect(frame, ["g"], ["t", "i"], chunk_rows=chunk_rows)
    assert whole.hot is None and cut.hot is not None
    assert collected(sc.scan(frame, cut, **aggs())) == collected(sc.scan(frame, whole, **aggs()))


def test_whole_groups_equal_pandas(frame):
    got = pd.DataFrame([r.asDict() for r in sc.scan(frame, lay.detect(frame, ["g"], ["t", "i"]), **aggs()).collect()])
    got = got.sort_values(["t", "i"])
    alone = got[got["g"].isna()]
    assert len(alone) == 200 and alone[list(aggs())].isna().all().all()  # no key, no group
    for _, g in got.groupby("g"):
        v = g["v"].astype(float)
        np.testing.assert_allclose(g["pos"], np.arange(1, len(g) + 1))
        np.testing.assert_allclose(g["last"].astype(float), v.ffill())
        np.testing.assert_allclose(g["last_before"].astype(float), v.ffill().shift())
        np.testing.assert_allclose(g["next"].astype(float), v.bfill().shift(-1))
        np.testing.assert_allclose(g["prev"].astype(float), v.shift())
        np.testing.assert_allclose(g["all"].astype(float), v.sum())
        np.testing.assert_allclose(g["total"].astype(float).fillna(0), v.fillna(0).cumsum())


@pytest.mark.parametrize("fan", [256, 2])
def test_chunks_are_ordered_and_bounded(frame, monkeypatch, fan):
    monkeypatch.setattr(lay, "FAN", fan)
    layout = lay.detect(frame, ["g"], ["t", "i"], chunk_rows=20)
    key = F.struct("t", "i")
    rows = layout.mark(frame).groupBy("g", lay.CHUNK).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    hot = sorted((r for r in rows.collect() if r["g"] == "hot"), key=lambda r: r[lay.CHUNK])
    assert len(hot) >= 8 and max(r["n"] for r in hot) <= 40 and [r[lay.CHUNK] for r in hot] == list(range(1, len(hot) + 1))
    assert all(a["hi"] < b["lo"] for a, b in zip(hot, hot[1:]))


@pytest.mark.parametrize("order", [["t", "i"], ["s"], ["s", "i"], ["d", "s"]])
def test_ties_and_texts_are_cut(spark, order):
    """Equal times are cut by what breaks the tie, texts by themselves; the sample is a part of the group."""
    rnd = random.Random(3)
    rows = [("a", dt.datetime(2024, 1, 1), i, f"w{rnd.random():.9f}", None if i % 3 else float("nan")) for i in range(20_000)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, i long, s string, d double").persist()
    layout = lay.detect(df, ["g"], order, chunk_rows=1000)
    sizes = [r["n"] for r in layout.mark(df).groupBy(lay.CHUNK).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 12 and max(sizes) < 3000
    key = (lambda r: (r[1], r[2])) if order == ["t", "i"] else (lambda r: (r[4] is not None, r[3])) if "d" in order else (lambda r: r[3])
    want = {r[2]: n for n, r in enumerate(sorted(rows, key=key), 1)}
    assert {r["i"]: r["pos"] for r in sc.scan(df, layout, pos=sc.position()).collect()} == want


def test_many_chunks_are_scanned_in_chunks(frame, monkeypatch):
    monkeypatch.setattr(lay, "FAN", 3)
    monkeypatch.setattr(lay, "BROADCAST_LISTS", 0)
    whole, cut = lay.detect(frame, ["g"], ["t", "i"]), lay.detect(frame, ["g"], ["t", "i"], chunk_rows=4)
    assert cut.most > cut.chunk_rows and not cut.few
    assert collected(sc.scan(frame, cut, **aggs())) == collected(sc.scan(frame, whole, **aggs()))


def test_rows_that_agree_in_the_whole_order_stay_together(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), i, 1.0, 1.0) for i in range(100)], SCHEMA)
    layout = lay.detect(df, ["g"], ["t"], chunk_rows=10)
    assert layout.mark(df.withColumn("t", F.col("t"))).groupBy("t").count().count() == 1
    assert sorted(r["pos"] for r in sc.scan(df, layout, pos=sc.position()).collect()) == list(range(1, 101))


def test_join_values_keeps_all_rows(frame):
    layout = lay.detect(frame, ["g"], ["t", "i"], chunk_rows=20)
    sums = frame.groupBy("g").agg(F.sum("w").alias("s"))
    got = {r["i"]: r["s"] for r in lay.join_values(frame, sums, layout).collect()}
    want = pd.DataFrame(skewed(), columns=["g", "t", "i", "v", "w"])
    want["s"] = want.groupby("g")["w"].transform("sum")
    assert got == {i: None if g is None else s for i, g, s in zip(want["i"], want["g"], want["s"])}


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 3}])
def test_percentiles_equal_numpy(frame, options):
    got = sc.group_percentiles(frame, ["g"], "v", [0.0, 0.31, 0.5, 0.95, 1.0], list("abcde"), **options).collect()
    rows = pd.DataFrame(skewed(), columns=["g", "t", "i", "v", "w"])
    for r in got:
        if r["g"] is None:
            continue
        values = rows[rows["g"] == r["g"]]["v"].dropna()
        np.testing.assert_allclose([r[c] for c in "abcde"], np.percentile(values, [0, 31, 50, 95, 100]))


def test_percentiles_of_the_whole_table_and_weights(spark):
    df = spark.createDataFrame([(float(i % 37), i % 4) for i in range(500)], "x double, n long")
    plain = sc.group_percentiles(df, [], "x", [0.94], ["p"], chunk_rows=5).first()["p"]
    assert plain == pytest.approx(np.percentile([i % 37 for i in range(500)], 94))
    repeated = [float(i % 37) for i in range(500) for _ in range(i % 4)]
    assert sc.group_percentiles(df, [], "x", [0.4], ["p"], weight="n").first()["p"] == pytest.approx(np.percentile(repeated, 40))


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 25}])
def test_group_rank(frame, options):
    got = sc.group_rank(frame, ["g"], ["i"], "rank", "size", **options).collect()
    for g in {r["g"] for r in got} - {None}:
        ranks = [r["rank"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["i"])]
        assert ranks == list(range(1, len(ranks) + 1))
        assert {r["size"] for r in got if r["g"] == g} == {len(ranks)}


def test_group_join_without_broadcast(frame, monkeypatch):
    sums = frame.filter("g IS NOT NULL").groupBy("g").agg(F.sum("w").alias("s"))
    small = collected(lay.join_group_values(frame, sums, ["g"]))
    monkeypatch.setattr(lay, "BROADCAST_GROUPS", 0)
    joined = lay.join_group_values(frame, sums, ["g"])
    assert collected(joined) == small


def test_counts_behind_percentiles_and_roc_are_made_once(spark):
    df = spark.range(50).selectExpr("cast(id % 2 as string) AS g", "cast(id as double) AS score", "cast(id % 3 = 0 as int) AS y")
    for out in (sc.group_percentiles(df, ["g"], "score", [0.5], ["m"]), ev.roc_auc(df, ["g"])):
        files = out.inputFiles()  # layout and scans read a stored table, not the rows again
        assert files and all("/counts-" in f for f in files) and out.count() == 2


@pytest.mark.parametrize("largest", [100, 1_000_000])
def test_borders_of_a_large_group_are_not_sorted_by_one_task(spark, monkeypatch, largest):
    monkeypatch.setattr(lay, "CHUNK_ROWS", largest)
    tried, detect = [], lay.detect
    monkeypatch.setattr(lay, "detect", lambda *args, **options: tried.append(options.get("chunk_rows")) or detect(*args, **options))
    rows = [("a" if i % 5 else None, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i * 37 % 1000), i, 1.0, 1.0) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    layout = lay.detect(df, ["g"], ["t", "i"], chunk_rows=16)  # as many as are sampled: the whole group
    assert (largest in tried) == (largest == 100)
    sizes = [r["n"] for r in layout.mark(df).where("g = 'a'").groupBy(lay.CHUNK).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 76 and set(sizes) <= {15, 16, 1}
    want = {r[2]: n for n, r in enumerate(sorted((r for r in rows if r[0]), key=lambda r: (r[1], r[2])), 1)}
    assert {r["i"]: r["pos"] for r in sc.scan(df, layout, pos=sc.position()).where("g = 'a'").collect()} == want


def test_chunks_of_long_groups_are_found_once(frame, monkeypatch):
    monkeypatch.setattr(lay, "FAN", 3)
    cut = lay.detect(frame, ["g"], ["t", "i"], chunk_rows=8)
    files = sc.scan(frame, cut, pos=sc.position()).inputFiles()
    assert cut.most > 3 and any("/pinned-" in f for f in files) and not any("/fine-" in f for f in files)
