from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from lectern.operators import dedup
from lectern.sources import stores
from lectern.sources.buckets import BucketedTables
from lectern.streaming import events as S


def test_sheet_with_aliases_and_empty_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("list of people\nFull Name,E-Mail,Extra\nAnn Lee,a@x.org,1\nBo,nan,2\n")
    got = stores.read_sheet(spark, str(tmp_path), {"name": ["Full Name"], "email": ["E-Mail"], "field": []}, header_rows=1)
    assert {(r.name, r.email, r.field, r.row_number) for r in got.collect()} == {("Ann Lee", "a@x.org", "", 1), ("Bo", "", "", 2)}


def test_json_lines_drop_bad_ones(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "a", "n": 1}\nnot json\n{"id": "b"}\n')
    assert {tuple(r) for r in stores.read_json_lines(spark, str(tmp_path), "id string, n int").collect()} == {("a", 1), ("b", None)}


def test_links_and_documents(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l/links.txt").write_text("# c\n\nhttps://a.org\n")
    assert [r.url for r in stores.read_links(spark, str(tmp_path / "l")).collect()] == ["https://a.org"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "d/y.txt").write_bytes("caf\xe9".encode("latin-1"))
    assert {(r.kind, r.text) for r in stores.read_documents(spark, str(tmp_path / "d")).collect()} == {("pdf", None), ("text", "café")}


def test_nested_round_trip(spark):
    df = spark.createDataFrame([("p", "s", 0, "a"), ("p", "s", 1, "b"), ("p", "t", 0, "c")], "profile_id string, section string, n int, text string")
    back = stores.flattened(stores.nested(df)).drop("place")
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_table_store(spark, tmp_path):
    t = stores.TableStore(spark, str(tmp_path / "t"), "k", "k int, v string, n int")
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, n int"), order=["n"])
    t.upsert(spark.createDataFrame([(2, "d", 2)], "k int, v string, n int"))
    assert {tuple(r) for r in t.read().collect()} == {(1, "b", 2), (2, "d", 2)}
    assert [r.k for r in t.page(None, 1).collect()] == [1] and [r.k for r in t.page(1, 5).collect()] == [2]
    old = stores.TableStore(spark, str(tmp_path / "o"), "k", "k int, v string, n int")
    assert t.archive(F.col("k") == 1, old) == (1, 1) and old.read().first().k == 2
    t.delete(spark.createDataFrame([(1,)], "k int"))
    assert t.read().count() == 0


def _files(spark, tmp_path):
    base = datetime(2024, 1, 1)
    batches = [[(1, base, "a", 1.0), (1, base + timedelta(minutes=10), "a", 2.0)], [(2, base + timedelta(hours=3), "a", 4.0)], [(1, base + timedelta(minutes=20), "a", 8.0)]]
    for n, b in enumerate(batches):
        spark.createDataFrame(b, "user_id int, ts timestamp, kind string, value double").coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    return S.file_stream(spark, str(tmp_path / "in/*"), "user_id int, ts timestamp, kind string, value double", files_per_batch=1)


def test_windows_over_batches(spark, tmp_path):
    got = S.drained(S.tumbling(_files(spark, tmp_path), "ts", "1 hour", "12 hours", "kind"), "complete")
    assert sorted((r.n, r.total) for r in got.collect()) == [(1, 4.0), (3, 11.0)]


def test_first_seen_and_state(spark, tmp_path):
    stream = _files(spark, tmp_path)
    assert S.drained(S.first_seen(stream, "ts", "1 day", "user_id")).count() == 2
    out = S.drained(S.latest_state(stream, "user_id", "ts", "value", 24), "update")
    last = out.groupBy("user_id").agg(F.max(F.struct("batch", "ts", "value", "version")).alias("r"))
    assert {(r.user_id, r.r.value, r.r.version) for r in last.collect()} == {(1, 8.0, 3), (2, 4.0, 1)}


def test_stream_into_store_is_idempotent(spark, tmp_path):
    store = stores.TableStore(spark, str(tmp_path / "s"), "user_id", "user_id int, ts timestamp, kind string, value double")
    stream = _files(spark, tmp_path)
    for _ in range(2):
        S.into_store(stream, lambda df: store.upsert(df, order=["ts"]), str(tmp_path / "cp"))
    assert {(r.user_id, r.value) for r in store.read().collect()} == {(1, 8.0), (2, 4.0)}


def test_job_states(spark):
    log = spark.createDataFrame([(1, 1, "queued"), (1, 2, "running"), (2, 1, "queued"), (2, 2, "failed"), (2, 3, "running")], "job int, t int, e string")
    assert {tuple(r) for r in S.job_states(log, "job", "t", "e").collect()} == {(1, "running", 2), (2, "failed", 3)}


def test_buckets_are_added_to_replaced_and_kept(spark, tmp_path):
    tables = {"a": ("k int, v string", ["k"]), "b": ("k int", ["k"])}
    store = BucketedTables(spark, str(tmp_path / "b"), tables, buckets=4)
    assert store.generation() == 0 and store.read("a").count() == 0
    rows = spark.createDataFrame([(k, "x") for k in range(20)], "k int, v string")
    store.publish({"a": (rows, []), "b": (rows.select("k"), [])})
    part = store.touched(rows.where("k = 3"), "a")
    assert len(part) == 1 and 0 < store.read("a", part).count() < 20
    store.publish({"a": (rows.where("k = 3").withColumn("v", F.lit("y")), part)})
    again = BucketedTables(spark, str(tmp_path / "b"), tables, buckets=4)
    assert again.generation() == 2 and again.read("a", part).collect() == [(3, "y")] and again.read("b").count() == 20
    assert again.read("a", generation=1).count() == 20
    again.publish({"a": (rows.where("k = 99"), part)})
    assert again.read("a", part).count() == 0
    again.vacuum()
    assert store.read("a").count() == again.read("a").count() < 20
    with pytest.raises(RuntimeError):
        store.folder.write("manifest-3.json", "{}")


def test_one_row_of_each_key(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("b", None, 2), (None, "z", 3), ("c", "w", 1), ("c", "w", 1)], "k string, t string, n int")
    assert {tuple(r) for r in dedup.one_per_key(rows, "k").collect()} == {("a", "y", 0), ("b", None, 2), ("c", "w", 1)}
    assert dedup.one_per_key(rows.limit(0), "k").count() == 0
