"""URL filters and archives against brute force."""

import gzip
import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan

from wakeline.llm import queries, urls, warc

SF = "/root/testdata/sf0.001"
URLS = (
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?q=1", "https://example.org/en/17#x", "https://xexample.org/en/17", "http://com/fr/", "http://a.COM/de/2", "http://a.com/De/2",
    "x://a.com?/fr/", "x://a.com/fr/?y://b.org/", "http://org", "http://org/", "ftp://ÄB.org/ü\n/es/", "http://a.com:80/fr/1", "://example.org/es/",
)


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda x: len(x[0]), default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[4], "x", "y")], "page_id long, url string, host string, score string")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path, rule = brute_rule(URLS[4 if r["page_id"] is None else r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == rule[1] if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).collect() == []
    alone = urls.judge(pages.where("page_id in (0, 1, 12)")).collect()  # nothing labelled
    assert {r["verdict"] for r in alone} == {"allow"}


def test_features_of_a_url(spark):
    url = "http://a-b.example.com/x/12/y?p=1&q=2#z"
    df = spark.createDataFrame([(url,)], "url string")
    row = df.select(*(c.alias(n) for n, c in urls.lexical(F.col("url"), urls.host_of(F.col("url")), urls.path_of(F.col("url"))).items())).first()
    shares = np.array([url.count(c) / len(url) for c in set(url)])
    assert (row["depth"], row["parameters"], row["labels"], row["hyphens"], row["fragment"]) == (3, 2, 3, 1, 1)
    assert np.isclose(row["entropy"], -(shares * np.log2(shares)).sum()) and np.isclose(row["digit_ratio"], 4 / len(url))


def test_trees_learn_from_labelled_urls(spark):
    """Labels by a known lexical rule, judged on urls that were not seen."""
    rng = random.Random(1)

    def rows(n):
        for _ in range(n):
            bad = rng.random() < 0.5
            path = "/".join(str(rng.randrange(10**6)) for _ in range(4 if bad else 1))
            yield f"http://h{rng.randrange(50)}.net/{path}" + ("?a=1&b=2" if bad else ""), "block" if bad else "allow"

    def table(n):
        df = spark.createDataFrame(list(rows(n)), "url string, decided string")
        return df.withColumns({"host": urls.host_of(F.col("url")), "path": urls.path_of(F.col("url"))})

    statistics, trees = urls.fit(table(400))
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=[f"f_{n}" for n in urls.FEATURES], outputCol="features").transform(urls._with_features(table(300), statistics))
    got = trees.transform(vectors).select("decided", "prediction").collect()
    assert np.mean([(r["decided"] == "block") == (r["prediction"] > 0.5) for r in got]) > 0.97


def odd_pages(spark):
    big = "ü" * 3_000_000
    rows = [(i, f"http://h/{i}", "y" * 200 if i % 3 == 0 else f"page {i} " * 20) for i in range(40)]
    rows += [(100, None, None), (101, "http://x/\r\nWARC-Type: bad", ""), (102, "u", "s" * 99), (103, "u", "s" * 99), (104, "u", "ü" * 50), (105, "u", "ü" * 50), (105, "u", "ü" * 50)]
    rows += [(106, "u", big), (None, "u", "y" * 200), (107, "u", "a\r\n\r\nb\r\n\r\n" * 30), (107, "v", "other " * 40)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, record_type string, payload string")


def test_round_trip_of_odd_pages(spark, tmp_path):
    pages = odd_pages(spark)
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    firsts = {}
    for i, body in rows:
        if i is not None and len(body) >= 100:
            firsts[body] = min(firsts.get(body, i), i)
    want = []
    for i, body in rows:
        revisit = i is not None and len(body) >= 100 and i > firsts[body]
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", firsts[body] if revisit else None))
    got = warc.round_trip(pages, f"{tmp_path}/a").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = warc.read_archive(spark, f"{tmp_path}/a")
    assert {r["payload"] for r in back.where("record_type = 'response'").collect()} == {body for _, body in rows}
    assert back.where("record_type = 'revisit' and payload is not null").count() == 0
    assert warc.read_archive(spark, f"{tmp_path}/a", payload=False).where("payload is not null").count() == 0
    assert warc.round_trip(pages.limit(0), f"{tmp_path}/none").collect() == []


def test_filters_skip_payloads(spark, tmp_path, monkeypatch):
    warc.write_pages(odd_pages(spark), f"{tmp_path}/a")
    reader = warc.WarcReader(f"{tmp_path}/a", True)
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 3), EqualTo(("payload",), b"x")]))
    assert [type(f) for f in left] == [GreaterThan, EqualTo]
    decoded = []
    real = warc._Member.until

    def until(self, enough):
        done = real(self, enough)
        decoded.append(len(self.data))
        return done

    monkeypatch.setattr(warc._Member, "until", until)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert rows and {r["record_type"] for r in rows} == {"revisit"} and max(decoded) <= 2 * warc._HEAD_BYTES
    frame = warc.read_archive(spark, f"{tmp_path}/a").where("record_type = 'revisit'")
    assert frame.count() == len(rows)


def test_archives_of_other_writers(spark, tmp_path):
    row = {"record_type": "response", "record_id": "urn:page:5", "target_uri": "u", "refers_to": None, "payload_digest": "d", "payload_bytes": 5000, "payload": b"z" * 5000}
    data = [warc.record_bytes(row | {"record_id": f"urn:page:{i}"}) for i in range(3)]
    (tmp_path / "plain.warc").write_bytes(b"".join(data))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(map(gzip.compress, data)))  # no lengths in the members
    got = warc.read_archive(spark, str(tmp_path)).collect()
    assert len(got) == 6 and all(r["payload"] == b"z" * 5000 for r in got)
    assert sorted(r["record_id"] for r in got) == sorted(2 * [f"urn:page:{i}" for i in range(3)])
    assert gzip.decompress(warc.gzip_member(data[0])) == data[0]


def test_files_written_twice_are_not_read(spark, tmp_path):
    batch = pa.RecordBatch.from_pylist([{"record_type": "response", "record_id": "urn:page:1", "target_uri": None, "refers_to": None, "payload_digest": "d", "payload_bytes": 1, "payload": b"z"}])
    writer = warc.WarcWriter(str(tmp_path / "w"))
    writer.write(iter([batch]))  # an attempt that was lost
    writer.commit([writer.write(iter([batch])), None])
    assert warc.read_archive(spark, str(tmp_path / "w")).count() == 1


def test_archive_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    relation = con.execute(queries.OP5_SQL)
    names = [d[0] for d in relation.description]
    assert sorted(relation.fetchall()) == sorted(tuple(r) for r in queries.op5_warc(spark, SF).select(names).collect())
