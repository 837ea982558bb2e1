"""Commits that fail half-way, runs that come late, and what streams must not lose."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import feeds
from feedmerge.operators import islands, merge_accounts, offset_gaps
from feedmerge.plans import METRICS, merge_blogs, merge_posts
from feedmerge.plans.ingest import BROKEN
from feedmerge.plans.merge_blogs import merge_blogs_runs
from feedmerge.plans.merge_posts import merge_posts_runs, read_merged_posts
from feedmerge.schemas import MERGED_POSTS
from feedmerge.sinks import publish_partitions, published, read_published, run_path, vacuum, write_run
from feedmerge.sinks.retention import remove_days
from feedmerge.sources import ledger
from feedmerge.sources.files import child_names, read_day
from feedmerge.streaming import read_accounts, read_upserted_posts, stream_ingest, stream_upsert_blogs, upsert
from helpers import metrics, posts, rows

AT = dt.datetime(2024, 1, 20, 6)


def table(spark, *pairs):
    return spark.createDataFrame(pairs, "id int, d int")


def pairs(df):
    return {(r.id, r.d) for r in df.collect()}


def files(spark, path):
    """Data files below a path, by folder."""
    return {f.rsplit("/", 1)[0] for f in spark.read.option("recursiveFileLookup", True).parquet(path).inputFiles()}


# ----------------------------------------------------------------- publishing


def test_partitions_are_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_published(spark, path) is None
    assert sorted(publish_partitions(table(spark, (1, 0), (2, 1), (3, None)), path, ["d"])) == ["d=0", "d=1", "d=__HIVE_DEFAULT_PARTITION__"]
    own = read_published(spark, path).where("d = 0").selectExpr("id + 10 id", "d")
    assert publish_partitions(own, path, ["d"]) == ["d=0"]
    assert pairs(read_published(spark, path)) == {(11, 0), (2, 1), (3, None)}
    assert publish_partitions(own.limit(0), path, ["d"]) == []
    assert pairs(read_published(spark, path, lambda p: p == "d=1")) == {(2, 1)}


@pytest.mark.parametrize("fails_at", ["files", "manifest"])
def test_a_commit_that_dies_half_way_leaves_the_old_state(spark, tmp_path, monkeypatch, fails_at):
    path = str(tmp_path / "t")
    publish_partitions(table(spark, (1, 0), (2, 1), (3, 2)), path, ["d"])
    fresh = table(spark, (11, 0), (12, 1), (13, 2))
    if fails_at == "files":
        # some partitions are written, then a row fails
        broken = fresh.withColumn("id", F.when(F.col("d") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id")))
        with pytest.raises(Exception, match="lost"):
            publish_partitions(broken, path, ["d"])
    else:
        with monkeypatch.context() as m:
            m.setattr(published, "put_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
            with pytest.raises(RuntimeError, match="driver lost"):
                publish_partitions(fresh, path, ["d"])
    assert pairs(read_published(spark, path)) == {(1, 0), (2, 1), (3, 2)}
    publish_partitions(fresh, path, ["d"])
    assert pairs(read_published(spark, path)) == {(11, 0), (12, 1), (13, 2)}


def test_two_writers_cannot_publish_the_same_manifest(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_partitions(table(spark, (1, 0)), path, ["d"])
    with pytest.raises(RuntimeError, match="another writer"):
        published.put_manifest(spark, path, 1, {"d=0": ["x"]})
    assert pairs(read_published(spark, path)) == {(1, 0)}


def test_vacuum_keeps_what_newer_manifests_name(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        publish_partitions(table(spark, (k, 0), *([(9, 1)] if k == 0 else [])), path, ["d"])
    old = read_published(spark, path)
    assert len(files(spark, path)) == 5
    assert len(vacuum(spark, path, ["d"], keep=2)) == 2 and published.manifest_numbers(spark, path) == [3, 4]
    assert pairs(old) == pairs(read_published(spark, path)) == {(3, 0), (9, 1)}
    assert vacuum(spark, path, ["d"], keep=2) == []


def test_published_merge_equals_the_merge_into_folders(spark, tmp_path):
    base = str(tmp_path)
    for day, likes in (("2024-01-09", 3), ("2024-01-10", 7)):
        one = {"id": "a", "partdate": dt.datetime(2024, 1, 5), "metrictimestamp": "1"}
        two = {"id": "b", "partdate": dt.datetime(2024, 1, 6), "metrictimestamp": "1"}
        write_run(posts(spark, one, *([two] if likes == 3 else [])), run_path(f"{base}/p", day, AT), "partdate")
        write_run(metrics(spark, {"id": "a", "partdate": "2024-01-05", "likes": likes, "metricstimestamp": day}), run_path(f"{base}/m", day, AT), "partdate")
        merge_posts(spark, f"{base}/p", f"{base}/m", f"{base}/plain", day, "2024-01-01")
        merge_posts(spark, f"{base}/p", f"{base}/m", f"{base}/whole", day, "2024-01-01", published=True)
    plain, whole = (read_merged_posts(spark, f"{base}/{n}").select(*MERGED_POSTS) for n in ("plain", "whole"))
    assert rows(plain) == rows(whole) and {r.post_id for r in whole.collect()} == {"a", "b"}
    with pytest.raises(ValueError, match="plain folders"):
        merge_posts(spark, f"{base}/p", f"{base}/m", f"{base}/plain", "2024-01-10", "2024-01-01", published=True)


# ----------------------------------------------------------------- upserts


def events_in(spark, sf, tmp_path, n=6):
    path = str(tmp_path / "events")
    feeds.events(spark, sf).repartitionByRange(n, "event_id").write.parquet(path)
    return spark.readStream.schema(feeds.EVENTS).option("maxFilesPerTrigger", 1).parquet(path)


def test_compaction_changes_no_row_and_batches_write_their_own(spark, sf, tmp_path):
    wanted = rows(merge_accounts(feeds.blogs(spark, sf, None), None, "20240120"))
    base = str(tmp_path / "accounts")
    stream_upsert_blogs(feeds.blog_rows(events_in(spark, sf, tmp_path)), base, str(tmp_path / "mark"), "20240120", compact=3, buckets=4).awaitTermination()
    changes, stored = upsert._places(base)
    # four changes are merged with the fourth batch, two more come after
    assert len(published.current(spark, changes)[1][""]) == 2 and len(published.current(spark, stored)[1]) == 4
    assert rows(read_accounts(spark, base)) == wanted
    assert len(upsert.merge_changes(spark, base, upsert.BUCKET, upsert.latest_accounts)) == 4
    assert rows(read_accounts(spark, base)) == wanted
    assert published.current(spark, changes)[1] == {} and upsert.merge_changes(spark, base, upsert.BUCKET, upsert.latest_accounts) == []


def test_a_crash_between_merge_and_withdrawal_is_harmless(spark, sf, tmp_path, monkeypatch):
    base, mark = str(tmp_path / "accounts"), str(tmp_path / "mark")
    stream_upsert_blogs(feeds.blog_rows(events_in(spark, sf, tmp_path, 3)), base, mark, "20240120").awaitTermination()
    before = rows(read_accounts(spark, base))
    with monkeypatch.context() as m:
        m.setattr(upsert, "withdraw", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            upsert.merge_changes(spark, base, upsert.BUCKET, upsert.latest_accounts)
    assert rows(read_accounts(spark, base)) == before
    upsert.merge_changes(spark, base, upsert.BUCKET, upsert.latest_accounts)
    assert rows(read_accounts(spark, base)) == before and read_upserted_posts(spark, str(tmp_path / "no")) is None


# ----------------------------------------------------------------- streams


def test_streams_keep_undated_and_broken_messages(spark, sf, tmp_path):
    path, out, noted = (str(tmp_path / n) for n in ("messages", "out", "ledger"))
    sent = feeds.with_broken(feeds.metric_messages(feeds.events(spark, sf)))
    undated = sent.withColumn("timestamp", F.when(F.col("offset") % 10 != 1, F.col("timestamp")))
    undated.repartitionByRange(3, "offset").write.parquet(path)
    source = spark.readStream.schema(undated.schema).option("maxFilesPerTrigger", 1).parquet(path)
    now = F.lit("2024-01-20 06:00:00").cast("timestamp")
    stream_ingest(METRICS, source, out, str(tmp_path / "mark"), now=now, ledger=noted, name="metrics").awaitTermination()
    days = [n for n in child_names(spark, out) if n.isdigit()]
    got = [r.kafkaoffset for d in days for r in read_day(spark, out, d).collect()]
    assert sorted(got) == sorted(r.offset for r in undated.collect()) and len(days) > 5
    kept = spark.read.option("recursiveFileLookup", True).schema(f"kafkaoffset long, {BROKEN} string").parquet(f"{out}/_broken")
    assert sorted(r.kafkaoffset for r in kept.collect()) == sorted(o for o in got if o % 20 == 0)
    runs = ledger.runs_to_merge(spark, noted, "metrics", "2024-01-20")
    assert {r.split("/")[0] for r in runs} == set(days)


def test_messages_without_any_date_are_kept(spark, tmp_path):
    path, out = str(tmp_path / "messages"), str(tmp_path / "out")
    message = "cast(null as binary) key, cast('{}' as binary) value, 't' topic, 0 partition, id offset, cast(null as timestamp) timestamp, 0 timestampType"
    spark.range(5).selectExpr(*message.split(", ")).write.parquet(path)
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    stream_ingest(METRICS, source, out, str(tmp_path / "mark")).awaitTermination()
    (day,) = [n for n in child_names(spark, out) if n.isdigit()]
    assert read_day(spark, out, day).count() == 5


# ----------------------------------------------------------------- snapshots and runs


def test_a_named_snapshot_has_to_be_there(spark, sf, tmp_path):
    base, out = str(tmp_path / "blogs"), str(tmp_path / "out")
    for day in ("2024-01-16", "2024-01-19"):
        write_run(feeds.blogs(spark, sf, None).where(F.col("execdate") == day), run_path(base, day, AT))
    merge_blogs(spark, base, out, "2024-01-16")
    with pytest.raises(ValueError, match="no finished snapshot"):
        merge_blogs(spark, base, out, "2024-01-19", prev_exec_date="2024-01-18")
    assert child_names(spark, out) == ["20240116"]


def test_unfinished_runs_are_passed_over(spark, tmp_path):
    base = str(tmp_path)
    write_run(table(spark, (1, 1)), run_path(base, "2024-01-20", AT))
    failed = run_path(base, "2024-01-20", AT + dt.timedelta(hours=1))
    write_run(table(spark, (2, 2)), failed)
    (tmp_path / "20240120" / failed.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    assert pairs(read_day(spark, base, "2024-01-20")) == {(1, 1)}
    write_run(table(spark, (3, 3)), run_path(base, "2024-01-21", AT))
    next((tmp_path / "20240121").iterdir()).joinpath("_SUCCESS").unlink()
    with pytest.raises(ValueError, match="no finished run"):
        read_day(spark, base, "2024-01-21")


def test_late_runs_missed_days_and_repeated_merges(spark, sf, tmp_path):
    base, out, noted = (str(tmp_path / n) for n in ("blogs", "out", "ledger"))
    every = feeds.blogs(spark, sf, None).where("execdate between '2024-01-17' and '2024-01-19'")

    def send(day, late):
        run = run_path(base, day, AT + dt.timedelta(hours=late))
        write_run(every.where(F.col("execdate") == day).where(F.col("kafkaoffset") % 2 == late), run)

    for day in ("2024-01-17", "2024-01-18", "2024-01-19"):
        send(day, 0)
        assert len(ledger.record_finished(spark, noted, "blogs", base, day)) == 1
        if day != "2024-01-18":
            merge_blogs_runs(spark, base, out, noted, day)
        send(day, 1)
        assert len(ledger.record_finished(spark, noted, "blogs", base, day)) == 1
    assert len(merge_blogs_runs(spark, base, out, noted, "2024-01-20")) == 1
    wanted = merge_accounts(every, None, "x").drop("mergedate")
    for _ in range(2):
        assert rows(spark.read.parquet(f"{out}/20240120").drop("mergedate")) == rows(wanted)
        # merged again, the day takes the same runs
        assert len(merge_blogs_runs(spark, base, out, noted, "2024-01-20")) == 1
    assert merge_blogs_runs(spark, base, out, noted, "2024-01-21") == []


def test_posts_of_late_runs_are_merged(spark, tmp_path):
    base, noted = str(tmp_path), str(tmp_path / "ledger")

    def send(name, rows_, day, hour):
        run = run_path(f"{base}/{name}", day, AT + dt.timedelta(hours=hour))
        write_run(rows_, run, "partdate")
        ledger.record_written(spark, noted, name, [run])

    def merge(day):
        merge_posts_runs(spark, f"{base}/posts", f"{base}/metrics", f"{base}/merged", noted, day, "2024-01-01")
        return {r.post_id: r.likescount for r in read_merged_posts(spark, f"{base}/merged").collect()}

    when = dt.datetime(2024, 1, 8)
    send("posts", posts(spark, {"id": "a", "partdate": when, "likescount": 1, "metrictimestamp": "1"}), "2024-01-09", 0)
    send("metrics", metrics(spark, {"id": "a", "partdate": "2024-01-08", "likes": 5, "metricstimestamp": "2"}), "2024-01-09", 0)
    assert merge("2024-01-09") == {"a": 5}
    send("posts", posts(spark, {"id": "late", "partdate": when, "likescount": 3, "metrictimestamp": "1"}), "2024-01-09", 5)
    assert merge("2024-01-10") == {"a": 5, "late": 3} == merge("2024-01-11")


def test_unmerged_days_survive_retention(spark, tmp_path):
    base, noted = str(tmp_path / "blogs"), str(tmp_path / "ledger")
    for day in ("2024-01-05", "2024-01-06", "2024-01-07"):
        for hour in (0, 1):
            run = run_path(base, day, AT + dt.timedelta(hours=hour))
            write_run(table(spark, (1, 1)), run)
            if day != "2024-01-07":
                ledger.record_written(spark, noted, "blogs", [run])
    first = ledger.runs_to_merge(spark, noted, "blogs", "2024-01-06")
    ledger.record_merged(spark, noted, "blogs", first[:3], "2024-01-06")
    known = ledger.read_ledger(spark, noted)
    reasons = {str(r.runday): r.reason for r in ledger.guarded_days(known, "2024-01-01", "2024-01-31").collect()}
    assert reasons == {"2024-01-05": None, "2024-01-06": "1 of 2 runs are not merged"}
    assert remove_days(spark, base, "2024-01-01", "2024-01-31", ledger=known) == ["20240105"]
    assert child_names(spark, base) == ["20240106", "20240107"]
    assert remove_days(spark, base, "2024-01-01", "2024-01-31") == ["20240106", "20240107"]


# ----------------------------------------------------------------- offsets


def test_ranges_equal_plain_ones_whatever_the_block(spark):
    offsets = [(0, o) for o in (0, 1, 2, 5, 6, 9, 10, 11, 30)] + [(1, 7)] + [(2, o) for o in range(25)]
    want = {(0, 0, 2), (0, 5, 6), (0, 9, 11), (0, 30, 30), (1, 7, 7), (2, 0, 24)}
    df = spark.createDataFrame(offsets, "kafkapartition int, kafkaoffset long")
    for block in (1, 3, 10, 1 << 20):
        assert {tuple(r) for r in islands(df, block).select("kafkapartition", "first", "last").collect()} == want


def test_lost_and_repeated_offsets(spark):
    read = spark.createDataFrame([(0, 4), (0, 5), (0, 8), (0, 8), (0, 9), (0, 9), (1, 3), (None, 1), (1, None)], "kafkapartition int, kafkaoffset long")
    ends = spark.createDataFrame([(0, 11), (0, 7), (1, 2), (2, 1), (3, None)], "kafkapartition int, latestoffset long")
    found = lambda df: {tuple(r) for r in df.select("kind", "kafkapartition", "first", "last", "offsets").collect()}
    assert found(offset_gaps(read, block=4)) == {("lost", 0, 6, 7, 2), ("repeated", 0, 8, 9, 2)}
    assert found(offset_gaps(read, ends)) == {("lost", 0, 6, 7, 2), ("lost", 0, 10, 11, 2), ("lost", 2, 0, 1, 2), ("repeated", 0, 8, 9, 2)}
    assert offset_gaps(read.limit(0)).count() == 0
