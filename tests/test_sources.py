import json
import math
import threading
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from failcast.schema import LABEL, LONG_COLUMNS, LONG_SCHEMA, META_METRICS, TIME, USAGE_METRICS, ContractError
from failcast.sources import fetch, files, trace
from failcast.sources import range_query as RQ
from helpers import T0, at, long_rows

LABELS = {"namespace": "workloads", "pod": "leaky-flask-abc", "uid": "uid-1", "container": "leaky", "node": "lab-worker", "__name__": "m"}


def test_chunks():
    span = lambda m, w: RQ.chunks(T0, T0 + timedelta(minutes=m), timedelta(minutes=w))
    assert len(span(60, 15)) == 4
    assert span(20, 15)[-1][1] - span(20, 15)[-1][0] == timedelta(minutes=5)
    with pytest.raises(ValueError, match="cannot end before"):
        span(-5, 15)
    with pytest.raises(ValueError, match="zone"):
        RQ.chunks(datetime(2026, 1, 1), datetime(2026, 1, 2), timedelta(minutes=5))
    assert RQ.parsed_time("2026-05-18T14:00:00").utcoffset() == timedelta(0)


def test_flatten_in_python_and_in_sql_agree(spark):
    values = [[T0.timestamp(), "1024"], [T0.timestamp() + 15.5, "NaN"], [T0.timestamp() + 30, "+Inf"], [T0.timestamp() + 45, "not a number"]]
    series = [{"metric": LABELS, "values": values}, {"metric": {}, "values": [[T0.timestamp(), "2"]]}, {"metric": {}, "values": []}]
    plain = list(RQ.series_to_rows(series, "m"))
    assert len(plain) == 4 and plain[0][3:] == ("workloads", "leaky-flask-abc", "uid-1", "leaky", "lab-worker") and plain[3][3:] == ("", "", "", "", "")
    df = spark.createDataFrame([("m", json.dumps(series)), ("n", "[]")], "metric_name string, payload string")
    got = RQ.flatten_payload(df)
    assert got.columns == list(LONG_COLUMNS)
    rows = got.orderBy(TIME, "pod").collect()
    want = sorted(plain, key=lambda r: (r[0], r[4]))
    assert [(r[TIME], r.pod_uid) for r in rows] == [(w[0].replace(tzinfo=None), w[5]) for w in want]
    assert all(a.value == b[2] or math.isnan(a.value) and math.isnan(b[2]) for a, b in zip(rows, want, strict=True))
    assert RQ.cleaned(got).where("value is null").count() == 1


@pytest.fixture
def server():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            asked.append(q)
            body = {"status": "error", "error": "bad"} if "broken" in q["query"] else {"status": "success", "data": {"result": [] if "kube_pod_info" in q["query"] else [{"metric": LABELS, "values": [[float(q["start"]), "1"]]}]}}
            raw = json.dumps(body).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", asked
    http.shutdown()


def test_range_source(spark, server, tmp_path):
    from failcast.plans import jobs

    url, asked = server
    options = {"url": url, "start": T0.isoformat(), "end": (T0 + timedelta(minutes=40)).isoformat()}
    df = RQ.read_range(spark, **options, metrics="container_memory_rss,container_memory_cache")
    assert df.columns == list(LONG_COLUMNS) and df.rdd.getNumPartitions() == 6
    assert df.count() == 6
    counts = jobs.scrape(spark, f"{tmp_path}/long", **options, metrics="container_memory_rss")
    assert counts == [{"dt": "2026-05-18", "hour": "12", "n_rows": 3}]
    assert jobs.scrape(spark, f"{tmp_path}/none", **options, metrics="kube_pod_info") == []
    with pytest.raises(Exception, match="bad"):
        RQ.read_range(spark, **options, metrics="broken").count()
    with pytest.raises(ValueError, match="cannot end before"):
        RQ.read_range(spark, url=url, start=options["end"], end=options["start"])
    assert asked


def test_hour_partitions_replace_hours(spark, tmp_path):
    root = f"{tmp_path}/long"
    first = long_rows(spark, [(at(0), "m", 1.0), (at(70), "m", 2.0)])
    assert sorted(map(tuple, files.write_hourly(first, root).collect())) == [("2026-05-18", "12", 1), ("2026-05-18", "13", 1)]
    files.write_hourly(long_rows(spark, [(at(75), "m", 3.0)]), root).collect()
    out = files.read_long(spark, root)
    assert out.columns == list(LONG_COLUMNS) and sorted(r.value for r in out.collect()) == [1.0, 3.0]
    assert files.read_hours(spark, root, "2026-05-19", "2026-05-20").count() == 0
    plan = files.read_hours(spark, root, "2026-05-18", "2026-05-18")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_union_json_and_size(spark, tmp_path):
    files.write_parquet(spark.createDataFrame([(1, "a")], "x int, y string"), f"{tmp_path}/a")
    files.write_parquet(spark.createDataFrame([(2,)], "x int"), f"{tmp_path}/b")
    out = files.read_union(spark, [f"{tmp_path}/a", f"{tmp_path}/missing", f"{tmp_path}/b"])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a"), (2, None)]
    with pytest.raises(ContractError):
        files.read_union(spark, [f"{tmp_path}/missing"])
    files.write_json(spark, f"{tmp_path}/m.json", {"a": float("nan"), "b": [1, "x"]})
    assert files.read_json(spark, f"{tmp_path}/m.json") == {"a": None, "b": [1, "x"]}
    (tmp_path / "big.bin").write_bytes(b"0" * 2**20)
    assert files.within_size(spark, f"{tmp_path}/big.bin", 0.5, 1.5).first().in_band
    assert files.empty_long(spark).count() == 0


DAY = 86_400


def write(path, rows):
    path.write_text("".join(",".join(map(str, r)) + "\n" for r in rows))


def test_trace_usage_and_meta(spark, tmp_path):
    usage = [("c1", "m1", 3 * DAY, 50, 80, 1.0, 40, 10, 5, 4, d) for d in (-1, 50, 101)]
    usage += [("c1", "m1", DAY, 50, 80, 1.0, 40, 10, 5, 4, 10), ("c1", "m1", 9 * DAY, 50, 80, 1.0, 40, 10, 5, 4, 10), ("c2", "m1", 4 * DAY, "x", 80, 1.0, 40, 10, 5, 4, 10)]
    write(tmp_path / "container_usage.csv", usage)
    write(tmp_path / "container_meta.csv", [("c1", "m1", 3 * DAY, "app1", "started", 100, 200, 50.0), ("c2", "m1", 3 * DAY, "app1", "stopped", 100, 200, 50.0)])
    made = trace.harmonise(spark, str(tmp_path), f"{tmp_path}/out")
    rows = made["container_usage"].collect()
    disk = [r.value for r in rows if r.metric_name == USAGE_METRICS["disk_io_percent"]]
    assert sorted(disk) == [10.0, 50.0] and len(rows) == 3 * 7 + 1 + 7
    first = next(r for r in rows if r.pod == "c1")
    assert (first.namespace, first.pod_uid, first.container, first.node) == ("alibaba_2018", "c1", "c1", "m1") and first[TIME] == datetime(2018, 1, 4)
    meta = made["container_meta"].collect()
    assert {r.metric_name for r in meta} == {*META_METRICS.values(), "alibaba_container_status__started", "alibaba_container_status__stopped"}
    assert sorted((r.pod, r.metric_name[-7:], r.value) for r in meta if "status" in r.metric_name) == [("c1", "started", 1.0), ("c1", "stopped", 0.0), ("c2", "started", 0.0), ("c2", "stopped", 1.0)]
    assert spark.read.parquet(f"{tmp_path}/out/container_usage.parquet").columns == list(LONG_COLUMNS)
    with pytest.raises(ContractError):
        trace.harmonise(spark, f"{tmp_path}/nowhere")


def test_archives_resume_and_check_their_size(tmp_path):
    import io
    import tarfile

    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:gz") as tar:
        member = tarfile.TarInfo("tiny.csv")
        member.size = 3
        tar.addfile(member, io.BytesIO(b"a,b"))
    blob = raw.getvalue()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            begin = int(self.headers.get("Range", "bytes=0-")[6:-1])
            self.send_response(206 if begin else 200)
            self.end_headers()
            self.wfile.write(blob[begin:])

        def log_message(self, *args):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{http.server_port}"
    (tmp_path / "tiny.tar.gz.part").write_bytes(blob[:10])
    tiny = fetch.Archive("tiny", len(blob) / 2**20, len(blob) / 2**20)
    assert [p.read_text() for p in fetch.fetch(url, tmp_path, [tiny])] == ["a,b"]
    with pytest.raises(fetch.ArchiveError, match="whole"):
        fetch.fetch(url, tmp_path / "x", [fetch.Archive("tiny", 5, 6)])
    http.shutdown()


def test_filters_reach_the_server(spark, server):
    url, asked = server
    options = {"url": url, "start": T0.isoformat(), "end": (T0 + timedelta(hours=2)).isoformat(), "metrics": "container_memory_rss,container_memory_cache,container_memory_failcnt"}
    df = RQ.read_range(spark, **options)
    want = df.collect()
    assert len(asked) == 3 * 8
    lines = [
        (F.col("metric_name") == "container_memory_rss", 8),
        (F.col("metric_name").isin("container_memory_rss", "container_memory_cache", "other"), 16),
        ((F.col(TIME) >= F.lit(T0 + timedelta(minutes=61))) & (F.col("metric_name") == "container_memory_cache"), 4),
        ((F.col(TIME) > F.lit(T0 + timedelta(minutes=20))) & (F.col(TIME) < F.lit(T0 + timedelta(minutes=35))), 6),
        (F.col("metric_name") == "none of them", 0),
    ]
    for condition, n in lines:
        asked.clear()
        got = RQ.read_range(spark, **options).where(condition).collect()
        assert len(asked) == n
        assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(want, df.schema).where(condition).collect()))


def test_stream_goes_on_where_it_stopped(spark, server, tmp_path):
    url, asked = server

    def run(minutes):
        options = {"url": url, "start": T0.isoformat(), "end": (T0 + timedelta(minutes=minutes)).isoformat(), "metrics": "container_memory_rss,container_memory_cache", "step": 60, "chunk_minutes": 10}
        query = RQ.stream_range(spark, **options).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()

    for minutes in (20, 20, 45, 60):
        run(minutes)
    spans = sorted((float(q["start"]) - T0.timestamp(), float(q["end"]) - T0.timestamp()) for q in asked if q["query"].startswith("container_memory_rss"))
    grid = [t for a, b in spans for t in range(int(a), int(b) + 1, 60)]
    assert sorted(grid) == list(range(0, 3600, 60)) and max(b - a for a, b in spans) <= 540
    rows = spark.read.schema(LONG_SCHEMA).parquet(f"{tmp_path}/out").collect()
    assert len(rows) == len({(r[TIME], r.metric_name) for r in rows}) == len(asked)


def test_entity_table_is_read_without_an_exchange(spark):
    from failcast.operators import features as FE

    rows = [(at(seconds=15 * i), f"u{i % 7}", "c", "ns", f"pod-{i % 7}-x", f"n{i % 2}", float(i % 11), 20.0, int(i % 40 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, f"{TIME} timestamp, pod_uid string, container string, namespace string, pod string, node string, `{FE.WORKING_SET}` double, `{FE.MEMORY_LIMIT}` double, {LABEL} int")
    files.write_entity_table(df, "entity_rows", buckets=4)
    entity_exchange = lambda x: x._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(pod_uid")
    laid, plain = FE.build_features(spark.table("entity_rows")), FE.build_features(df)
    assert entity_exchange(laid) == 0 and entity_exchange(plain) > 0
    assert sorted(map(str, laid.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    spark.sql("DROP TABLE entity_rows")


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    df, seen = files.counted(spark.range(50), total=F.sum("id"))
    files.write_parquet(df, f"{tmp_path}/x")
    assert seen.get == {"n_rows": 50, "total": 1225}
