"""Change feed, incremental index and derived tables on disk."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from supportlens.operators.change_feed import apply_changes, change_feed
from supportlens.operators.text_index import search, text_vectors, write_index
from supportlens.session import new_dir, shared_dir, state_of, stored, written
from supportlens.plans.queries import QUERIES
from supportlens.sources import storage
from supportlens.streaming import index_sync
from tests.conftest import as_set, plan_of

SCHEMA = "id bigint, a int, b int, text string"


@pytest.fixture
def snapshots(spark):
    old = [(1, 1, None, "same"), (2, 1, None, "moved"), (3, 5, 5, "gone"), (4, None, 1, "filled"), (6, 1, 1, "kept")]
    new = [(1, 1, None, "same"), (2, None, 1, "moved"), (4, 9, 1, "filled"), (5, 0, 0, "fresh"), (6, 1, 1, "kept")]
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def test_exactly_the_changes(snapshots):
    old, new = snapshots
    assert as_set(change_feed(old, new, "id")) == sorted(
        [
            ("delete", 3, 5, 5, "gone"),
            ("insert", 5, 0, 0, "fresh"),
            ("update_preimage", 2, 1, None, "moved"),
            ("update_postimage", 2, None, 1, "moved"),
            ("update_preimage", 4, None, 1, "filled"),
            ("update_postimage", 4, 9, 1, "filled"),
        ],
        key=str,
    )


def test_applying_the_feed_gives_the_new_snapshot(snapshots):
    old, new = snapshots
    assert as_set(apply_changes(old, change_feed(old, new, "id"), "id")) == as_set(new)
    assert change_feed(new, new, "id").count() == 0


def state(df):
    return as_set(df.select("id", "n_tokens", "n_terms", F.round("norm", 6)))


def test_changes_update_the_index(spark, snapshots):
    old, new = snapshots
    path = new_dir(spark, "versions")
    index_sync.write_version(old, "id", "text", path, 0)
    index_sync.write_changes(change_feed(old, new, "id"), "id", "text", path, 1)
    current = index_sync.current(spark, path, "id")
    assert state(current) == state(text_vectors(new, "text"))
    # Writing a version again replaces it.
    index_sync.write_changes(change_feed(old, new, "id"), "id", "text", path, 1)
    assert state(index_sync.current(spark, path, "id")) == state(text_vectors(new, "text"))
    smaller = new_dir(spark, "compacted")
    index_sync.compact(spark, path, "id", smaller)
    assert state(index_sync.current(spark, smaller, "id")) == state(text_vectors(new, "text"))
    assert spark.read.parquet(smaller).count() == new.count()


def test_published_index_is_searchable(spark, snapshots):
    old, new = snapshots
    path = new_dir(spark, "versions")
    index_sync.write_version(old, "id", "text", path, 0)
    index_sync.write_changes(change_feed(old, new, "id"), "id", "text", path, 1)
    synced = index_sync.publish(spark, path, "id", new_dir(spark, "published"))
    built = write_index(new.select("id", "text"), "id", "text", new_dir(spark, "built"))
    for query in ("fresh filled", "gone", "same same kept"):
        assert as_set(search(synced, query, 5)) == as_set(search(built, query, 5))
    assert [r.id for r in search(synced, "fresh", 5, source=new).collect()] == [5]


def test_increments_are_searchable_at_once(spark, snapshots):
    old, new = snapshots
    path = new_dir(spark, "versions")
    for version in range(3):
        before, after = (old, new) if version % 2 else (new, old)
        if version == 0:
            index_sync.write_version(old, "id", "text", path, 0)
        else:
            index_sync.write_changes(change_feed(before, after, "id"), "id", "text", path, version)
        built = write_index((after if version else old).select("id", "text"), "id", "text", new_dir(spark, "built"))
        for query in ("fresh filled", "gone", "same same kept"):
            assert as_set(search(index_sync.LiveIndex(spark, path, "id"), query, 5)) == as_set(search(built, query, 5))
    index_sync.compact(spark, path, "id", smaller := new_dir(spark, "compacted"))
    assert as_set(search(index_sync.LiveIndex(spark, smaller, "id"), "gone", 5)) == as_set(search(built, "gone", 5))


def test_a_key_is_indexed_once_per_increment(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (1, "z", 1), (2, "c", None), (2, "c", None)], "id bigint, text string, seq int")
    for sequence, first in (("seq", "b"), (None, "z")):
        path = new_dir(spark, "versions")
        index_sync.write_version(rows if sequence else rows.drop("seq"), "id", "text", path, 0, sequence=sequence)
        got = {r.id: r.counts[0].term for r in index_sync.current(spark, path, "id").collect()}
        assert got == {1: first, 2: "c"} and spark.read.parquet(path).count() == 2


def test_an_index_follows_its_sources(spark):
    path = new_dir(spark, "source")
    spark.range(5).write.parquet(path)
    first = state_of(spark.read.parquet(path))
    assert state_of(spark.read.parquet(path)) == first
    spark.range(1).write.mode("append").parquet(path)
    assert state_of(spark.read.parquet(path)) != first


def test_increments_equal_one_batch(spark):
    rows = [(i, f"word{chr(97 + i % 7)} text", 0) for i in range(40)]
    updates = [(i, "changed completely now", 1) for i in range(0, 40, 3)]
    folder, path, checkpoint = (new_dir(spark, n) for n in ("incoming", "synced", "checkpoint"))
    schema = "id bigint, text string, seq int"

    def arrive(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)

    def sync():
        frame = spark.createDataFrame([], schema)
        index_sync.sync_now(spark, folder, "*.parquet", frame.schema, "id", "text", path, checkpoint, sequence="seq")

    arrive(rows[:25])
    sync()
    assert index_sync.current(spark, path, "id").count() == 25
    arrive(rows[25:] + updates)
    sync()
    latest = {i: t for i, t, _ in rows} | {i: t for i, t, _ in updates}
    expected = text_vectors(spark.createDataFrame(list(latest.items()), "id bigint, text string"), "text")
    assert state(index_sync.current(spark, path, "id")) == state(expected)
    stored_rows = spark.read.parquet(path).count()
    sync()
    assert spark.read.parquet(path).count() == stored_rows


def test_an_older_state_that_arrives_later_is_refused(spark):
    schema, path = "id bigint, text string, at timestamp", new_dir(spark, "versions")
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    increments = [[(1, "second", day[1]), (2, "second", day[1])], [(1, "first", day[0]), (3, "third", day[2])], [(2, "third", day[2]), (3, "second", day[1]), (4, "none", None)]]
    for version, rows in enumerate(increments):
        index_sync.write_version(spark.createDataFrame(rows, schema), "id", "text", path, version, sequence="at")
    want = {1: "second", 2: "third", 3: "third", 4: "none"}
    assert {r.id: r.counts[0].term for r in index_sync.current(spark, path, "id").collect()} == want
    live = index_sync.LiveIndex(spark, path, "id")
    assert live.documents() == 4 and live.frequencies(["first", "second", "third"]) == {"second": 1, "third": 2}
    # A tombstone that arrives late doesn't delete what came after it; a newer one does, also after compaction.
    gone = spark.createDataFrame([(1, "", day[0], True), (2, "", datetime(2024, 1, 9), True)], "id bigint, text string, at timestamp, gone boolean")
    index_sync.write_version(gone, "id", "text", path, 3, deleted="gone", sequence="at")
    index_sync.compact(spark, path, "id", smaller := new_dir(spark, "compacted"))
    late = spark.createDataFrame([(1, "first", day[0])], schema)
    for some in (path, smaller):
        index_sync.write_version(late, "id", "text", some, 4, sequence="at")
        assert {r.id: r.counts[0].term for r in index_sync.current(spark, some, "id").collect()} == {k: v for k, v in want.items() if k != 2}


def test_a_new_checkpoint_overwrites_nothing(spark):
    folder, path = new_dir(spark, "incoming"), new_dir(spark, "synced")
    schema = "id bigint, text string, seq int"
    frames = [spark.createDataFrame([(1, "old", 1), (2, "kept", 1)], schema), spark.createDataFrame([(1, "new", 2)], schema)]
    for number, frame in enumerate(frames):
        frame.write.parquet(f"{folder}/{number}")
        index_sync.sync_now(spark, f"{folder}/{number}", "*.parquet", frame.schema, "id", "text", path, new_dir(spark, "checkpoint"), sequence="seq")
    assert {r.id: r.counts[0].term for r in index_sync.current(spark, path, "id").collect()} == {1: "new", 2: "kept"}
    assert {r.version for r in spark.read.parquet(path).select("version").distinct().collect()} == {0, 1}


def test_continuous_sync_runs_until_stopped(spark):
    folder, path, checkpoint = (new_dir(spark, n) for n in ("incoming", "synced", "checkpoint"))
    frame = spark.createDataFrame([(1, "one text"), (2, "two texts")], "id bigint, text string")
    frame.write.parquet(folder)
    query = index_sync.start_sync(spark, folder, "*.parquet", frame.schema, "id", "text", path, checkpoint, continuous="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert state(index_sync.current(spark, path, "id")) == state(text_vectors(frame, "text"))


def test_tables_on_disk(spark, snapshots):
    old, new = snapshots
    path = new_dir(spark, "table")
    storage.overwrite(old, path)
    assert as_set(storage.overwrite(new, path)) == as_set(new)
    assert as_set(storage.snapshot(old, "copy")) == as_set(old)
    assert as_set(written(old, "cut")) == as_set(old)
    assert storage.manifest_row(new, "idx", "id", "text").first().documents == 5


def test_managed_table_and_its_database(spark, snapshots):
    old, new = snapshots
    storage.save_table(old, "support_scratch", "things")
    assert as_set(storage.save_table(new, "support_scratch", "things")) == as_set(new)
    storage.drop_database(spark, "support_scratch")
    assert not spark.catalog.databaseExists("support_scratch")


def test_latest_row_per_group(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "name string, at int, what string")
    assert as_set(storage.latest(rows, "name", "at")) == [("a", 3, "y"), ("b", 2, "z")]


def test_failed_build_is_not_remembered(spark):
    def fail(path):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        stored(spark, ("t", "x"), fail)
    seen = []
    first = stored(spark, ("t", "x"), seen.append)
    assert stored(spark, ("t", "x"), seen.append) == first and seen == [first]


class Session:
    """What shared_dir asks a session for."""

    def __init__(self, configured, master):
        self.conf = type("Conf", (), {"get": lambda _, key, default: configured})()
        self.sparkContext = type(
            "Context", (), {"master": master, "applicationId": "test-app", "getCheckpointDir": lambda _: None}
        )()


def test_shared_folder_comes_from_the_session():
    assert shared_dir(Session("hdfs://cluster/shared/", "yarn")) == "hdfs://cluster/shared"
    with pytest.raises(RuntimeError):
        shared_dir(Session(None, "yarn"))
    local = Session(None, "local[2]")
    assert shared_dir(local) == shared_dir(local)


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_in_parts_is_synced(spark, tmp_path, parts):
    # A folder of files, beside another table.
    rows = [(i, "alpha beta" + " gamma" * (i % 3)) for i in range(9)] + [(9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(99, "other")], "doc_id long, text string").write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["index_sync_triggered"](spark, str(tmp_path))
    assert {(r.doc_id, r.n_tokens) for r in got.collect()} == {(i, 2 + i % 3) for i in range(9)} | {(9, 0)}


def test_only_rows_with_a_repeated_key_are_moved(spark):
    path = new_dir(spark, "repeated")
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "one"), (None, 1, "a"), (None, 1, "b"), (3, None, "none")], "id long, seq long, text string")
    index_sync.write_version(rows, "id", "text", path, 0, sequence="seq")
    got = spark.read.parquet(path).select("id", F.col("counts.term")[0].alias("t"))
    assert {tuple(r) for r in got.collect()} == {(1, "new"), (2, "one"), (None, "b"), (3, "none")} and got.count() == 4
    alone = index_sync._newest(rows.where("id > 1").withColumn("sequence", F.col("seq")), "id", ["text"])
    assert "Exchange" not in plan_of(alone) and "SortAggregate" not in plan_of(alone)


def test_postings_are_written_without_a_shuffle(spark):
    path = new_dir(spark, "index")
    docs = spark.createDataFrame([(i, f"term{'abc'[i % 3]} every") for i in range(30)], "id long, text string")
    index = write_index(docs, "id", "text", path)
    files = index.postings.select("term", F.input_file_name().alias("file")).where("term = 'every'").distinct()
    assert files.count() == index.vectors.select(F.input_file_name()).distinct().count() > 1
