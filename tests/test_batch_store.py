"""Committed batches: crashes, replays, exact limits, pruned lookups, compaction; ordered publishing."""

import json
import re

import pytest
from pyspark.sql import functions as F

from strata.schemas import BRONZE_EVENTS
from strata.session import scratch_path
from strata.sinks import batch_store as BS
from strata.sinks import files as SK
from strata.streaming import bronze as SB
from strata.streaming import topic as T


def _value(eid, quantity=1):
    return json.dumps({"event_id": eid, "customer_id": "C1", "product_id": "P1", "event_type": "view",
                       "timestamp": "2026-03-10T09:15:00Z", "quantity": quantity})


def _records(spark, rows):
    """(event id, quantity, arrival) as topic records."""
    return spark.createDataFrame([("C1", _value(e, q), a) for e, q, a in rows], "key string, value string, arrival_a long")


def _topic(spark, *publishings):
    topic = scratch_path(spark, "topic")
    for rows in publishings:
        T.write_topic(_records(spark, rows), topic, partitions=1)
    return topic


def _ids(spark, root):
    return sorted(r.event_id for r in SB.read_bronze(spark, root).select("event_id").collect())


def _run(spark, topic, root, files=None, **more):
    SB.run_available(spark, T.read_topic_stream(spark, topic, max_files_per_trigger=files), root, **more)


def _totals(spark, root):
    return tuple(SB.read_quality(spark, root).first())


# accepted, rejected and duplicate messages, not in the order of their ids
BACKLOG = [("E4", 1, 10), ("E1", 1, 20), ("E2", -1, 30), ("E1", 7, 40), ("E3", 1, 50), ("E2", 2, 60), ("E0", 1, 70)]
STORED = {1: ["E4"], 2: ["E1", "E4"], 3: ["E1", "E4"], 4: ["E1", "E4"], 5: ["E1", "E3", "E4"], 6: ["E1", "E2", "E3", "E4"],
          7: ["E0", "E1", "E2", "E3", "E4"]}


@pytest.mark.parametrize("n", [1, 4, 6])
def test_exactly_n_messages_and_the_rest_by_the_next_runs(spark, n):
    topic, root = _topic(spark, BACKLOG), scratch_path(spark, "stream")
    taken = 0
    while taken < len(BACKLOG):
        _run(spark, topic, root, max_messages=n)
        taken = min(taken + n, len(BACKLOG))
        assert _ids(spark, root) == STORED[taken] and sum(_totals(spark, root)) == taken
    assert _totals(spark, root) == (5, 1, 1)
    assert {r.event_id: r.quantity for r in SB.read_bronze(spark, root).collect()}["E1"] == 1


@pytest.mark.parametrize("n", [0, -3, None, 7, 100])
def test_a_limit_that_never_stops(spark, n):
    topic, root = _topic(spark, BACKLOG), scratch_path(spark, "stream")
    _run(spark, topic, root, max_messages=n)
    assert _ids(spark, root) == STORED[7]


def test_a_limit_over_several_batches(spark):
    topic, root = _topic(spark, BACKLOG[:3], BACKLOG[3:5], BACKLOG[5:]), scratch_path(spark, "stream")
    _run(spark, topic, root, files=1, max_messages=4)
    assert _ids(spark, root) == STORED[4] and sum(_totals(spark, root)) == 4
    _run(spark, topic, root, files=1)
    assert _ids(spark, root) == STORED[7] and _totals(spark, root) == (5, 1, 1)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_that_dies_at_the_commit(spark, monkeypatch, when):
    """Between the Bronze write and the commit, or between the commit and the stream's own note."""
    topic, root = _topic(spark, BACKLOG[:4], BACKLOG[4:]), scratch_path(spark, "stream")
    real, calls = BS.BatchStore.commit, []

    def dies(self, *args, **kwargs):
        calls.append(args[0])
        if len(calls) == 2 and when == "before":
            raise OSError("lost")
        real(self, *args, **kwargs)
        if len(calls) == 2:
            raise OSError("lost")

    monkeypatch.setattr(BS.BatchStore, "commit", dies)
    with pytest.raises(Exception, match="lost"):
        _run(spark, topic, root, files=1)
    # readers see whole batches only
    assert _ids(spark, root) == (STORED[4] if when == "before" else STORED[7])
    monkeypatch.setattr(BS.BatchStore, "commit", real)
    _run(spark, topic, root, files=1)
    assert _ids(spark, root) == STORED[7] and _totals(spark, root) == (5, 1, 1)
    assert SB.read_rejects(spark, root).count() == 1
    _run(spark, topic, root, files=1, checkpoint=f"{root}/_again")  # a replay
    assert _ids(spark, root) == STORED[7] and _totals(spark, root) == (5, 2, 7)


def _rows(spark, ids):
    return spark.createDataFrame([(i, "C", "P", "view", "t", 1, "USD", "m" * 200) for i in ids], BRONZE_EVENTS)


def _store(spark, root=None, **more):
    return BS.BatchStore(spark, root or scratch_path(spark, "store"), BRONZE_EVENTS, **more)


def _add(store, number, ids, rejected=0):
    spark = store.spark
    bad = spark.createDataFrame([("k", "v", None, n, 0, "malformed") for n in range(rejected)], BS.BatchStore.reject_schema)
    counts = store.stage(f"b{number}", _rows(spark, ids), bad)
    store.commit(f"b{number}", "s", number, {"messages": len(ids) + rejected, **counts})


def test_lookup_reads_the_buckets_of_its_ids_only(spark):
    store = _store(spark)
    ids = [f"E{k}" for k in range(400)]
    _add(store, 0, ids)
    bucket = {r.event_id: r.b for r in _rows(spark, ids).select("event_id", store.bucket().alias("b")).collect()}
    mine = [i for i in ids if bucket[i] == 3]
    others = [i for i in ids if bucket[i] != 3]
    asked = spark.createDataFrame([(mine[0],), ("unknown",)], "event_id string").where("event_id <> 'unknown'")

    def files_of(df):
        stored = store.bronze().where(F.col("bucket").isin([3]))
        assert {r[0] for r in df.collect()} == {mine[0]}
        return sorted(stored.select(F.input_file_name()).distinct().collect())

    known = store.known(asked)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ (= 3|IN \(3\))", plan) and "ReadSchema: struct<event_id:string>" in plan
    before = files_of(known)
    for n in range(1, 4):  # the other buckets grow
        _add(store, n, [f"{i}-{n}" for i in others if bucket[i] != 3 and
                        _hash(spark, store, f"{i}-{n}") != 3])
    assert files_of(store.known(asked)) == before


def _hash(spark, store, text, seen={}):  # noqa: B006 - a table of all ids the test asks for, made once
    if not seen:
        names = [f"E{k}-{n}" for k in range(400) for n in range(1, 4)]
        seen.update({r.event_id: r.b for r in _rows(spark, names).select("event_id", store.bucket().alias("b")).collect()})
    return seen[text]


def test_files_are_sorted_and_have_bloom_filters_of_their_size(spark):
    import glob
    import os

    import pyarrow.parquet as pq
    sizes = {}
    for expected in (0, 100_000):
        store = _store(spark, buckets=2)
        store._write("bronze", _rows(spark, [f"E{k}" for k in range(50)]), "b0", expected)
        files = sorted(glob.glob(store.root.replace("file:", "") + "/bronze/batch=b0/bucket=*/*.parquet"))
        assert len(files) == 2
        for f in files:
            ids = pq.ParquetFile(f).read(columns=["event_id"]).column(0).to_pylist()
            assert ids == sorted(ids)
        sizes[expected] = sum(map(os.path.getsize, files))
    assert sizes[0] < 20_000 and sizes[100_000] > 200_000  # about ten bits an id


def test_many_small_batches_are_packed(spark):
    store = _store(spark, buckets=2)
    n = BS.SNAPSHOT + 4
    for k in range(n):
        _add(store, k, [f"E{k}"], rejected=k % 2)
    names = store.log.names()
    assert sum(x.endswith("-all.json") for x in names) == 1 and len(names) <= 6  # the log is cut at a snapshot
    wanted = sorted(f"E{k}" for k in range(n))
    old = store.bronze()
    gone = store.compact(small_bytes=1 << 20)
    assert gone == n + n // 2 and len(store.state["bronze"]) == len(store.state["rejects"]) == 1
    assert sorted(r.event_id for r in old.collect()) == wanted  # a reader that began before
    again = _store(spark, store.root)
    assert again.state == store.state and again.state["buckets"] == 2
    assert sorted(r.event_id for r in again.bronze().collect()) == wanted and again.rejects().count() == n // 2
    assert again.vacuum() > 0
    assert sorted(r.event_id for r in again.bronze().collect()) == wanted and again.compact() == 0
    assert again.taken("s", n - 1) is None and again.taken("s", n) == 0  # a batch that is done stays done
    assert [r.event_id for r in again.known(_rows(spark, ["E5", "new"])).collect()] == ["E5"]


def test_a_second_writer_fails(spark):
    a = _store(spark)
    b = _store(spark, a.root)
    _add(a, 0, ["E1"])
    with pytest.raises(RuntimeError, match="another writer"):
        _add(b, 1, ["E2"])
    assert [r.event_id for r in _store(spark, a.root).bronze().collect()] == ["E1"]


def test_dealt_records(spark):
    rows = [(f"C{k % 5}" if k % 7 else None, f"v{k}", 1000 - k) for k in range(60)]
    got = T.dealt(spark.createDataFrame(rows, "key string, value string, arrival_a long"), 4)
    assert T.broker_frame(got).columns == ["key", "value", "partition"]
    places = [(r.partition, r.key, r.sequence, r.arrival_a, r.task) for r in got.withColumn("task", F.spark_partition_id()).collect()]
    assert len(places) == 60 and {p for p, *_ in places} <= set(range(4))
    for key in {k for _, k, *_ in places}:
        own = [p for p in places if p[1] == key]  # in the order they are written
        assert len({(p[0], p[4]) for p in own}) == 1
        assert [p[2] for p in own] == list(range(1, len(own) + 1)) and [p[3] for p in own] == sorted(p[3] for p in own)


def test_preview_shows_whole_cells(spark, capsys):
    SK.preview(spark.createDataFrame([(k, "x" * 90) for k in range(30)], "n int, text string"), 2)
    shown = capsys.readouterr().out
    assert shown.count("x" * 90) == 2 and "only showing top 2 rows" in shown


def test_a_partition_of_the_topic_is_a_task(spark):
    rows = spark.range(4000).select(F.concat(F.lit("C"), "id").alias("key"), F.lit("v").alias("value"), F.col("id").alias("arrival_a"))
    got = T.dealt(rows, 8).withColumn("task", F.spark_partition_id()).select("partition", "task").distinct().collect()
    assert len(got) == 8 and len({r.task for r in got}) == len({r.partition for r in got}) == 8


def test_dealt_rows_are_written_by_their_tasks(spark):
    import glob
    import os
    store = _store(spark, buckets=2)
    rows = _rows(spark, [f"E{k}" for k in range(400)]).withColumn("bucket", store.bucket()).repartition(4, "bucket", "event_id")
    store._write("bronze", rows, "b0", 1_000_000)
    files = glob.glob(store.root.replace("file:", "") + "/bronze/batch=b0/bucket=*/*.parquet")
    assert len(files) == 8 and max(map(os.path.getsize, files)) < 100_000  # filters follow the ids a file has


def test_a_replay_deals_no_whole_rows(spark, monkeypatch):
    topic, root = _topic(spark, BACKLOG), scratch_path(spark, "stream")
    real, plans = BS.BatchStore.stage, []

    def noted(self, name, fresh, *more):
        plans.append(fresh._jdf.queryExecution().optimizedPlan().toString())
        return real(self, name, fresh, *more)

    monkeypatch.setattr(BS.BatchStore, "stage", noted)
    _run(spark, topic, root)
    _run(spark, topic, root, checkpoint=f"{root}/_again")
    assert "Aggregate" in plans[0] and "Aggregate" not in plans[1]
    assert _ids(spark, root) == STORED[7] and _totals(spark, root) == (5, 2, 7)


def test_the_stream_keeps_ids_only_and_reads_clean_messages_once(spark, monkeypatch):
    """Not the messages beside what is judged of them: they came to three times the memory of three executors."""
    frame, kept, rejects = type(spark.range(1)), [], []
    real, write = frame.persist, BS.BatchStore._write
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or real(self, *a))
    monkeypatch.setattr(BS.BatchStore, "_write", lambda self, kind, *a: (kind == "rejects" and rejects.append(a), write(self, kind, *a)))
    topic, root = _topic(spark, [("E1", 1, 10), ("E1", 2, 20), ("E2", 1, 30)]), scratch_path(spark, "stream")
    for name in ("a", "b"):
        _run(spark, topic, root, checkpoint=f"{root}/_{name}")
    assert _ids(spark, root) == ["E1", "E2"] and _totals(spark, root) == (2, 0, 4)
    assert kept and all(set(columns) <= {"bucket", "event_id", "_copies"} for columns in kept) and not rejects


def test_batches_of_rejects_only(spark):
    bad = [("E1", -1, 10), ("E2", 0, 20)]
    topic, root = _topic(spark, bad, [("E1", 1, 30), *bad], bad), scratch_path(spark, "stream")
    _run(spark, topic, root, files=1)
    assert _ids(spark, root) == ["E1"] and _totals(spark, root) == (1, 6, 0)
    assert SB.read_rejects(spark, root).count() == 6


def test_later_batches_add_only_what_is_new(spark):
    topic = _topic(spark, [("E1", 1, 10), ("E2", 1, 20)], [("E2", 5, 30), ("E3", 1, 50), ("E3", 9, 40), ("E4", -1, 60)])
    root = scratch_path(spark, "stream")
    _run(spark, topic, root, files=1)
    assert {r.event_id: r.quantity for r in SB.read_bronze(spark, root).collect()} == {"E1": 1, "E2": 1, "E3": 9}
    assert _totals(spark, root) == (3, 1, 2)


def test_a_whole_row_dealt_is_its_arrival_id_and_text(spark, monkeypatch):
    """The typed columns are in the text and come out of it where the row is written."""
    plans, write = [], BS.BatchStore._write

    def planned(self, kind, df, *more):
        if kind == "bronze":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(self, kind, df, *more)

    monkeypatch.setattr(BS.BatchStore, "_write", planned)
    topic, root = _topic(spark, BACKLOG), scratch_path(spark, "stream")
    _run(spark, topic, root)
    partial, = re.findall(r"partial_min\((?:named_)?struct\(.*", plans[0])
    assert set(re.findall(r"_f\d+", partial)) == {"_f0", "_f1", "_f2", "_f3"}
    assert _ids(spark, root) == STORED[7] and _totals(spark, root) == (5, 1, 1)
