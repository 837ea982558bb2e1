"""Snapshots that share files between days, and files clustered by key."""

import datetime as dt

import pytest

from feedmerge.plans import merge_blogs, snapshots
from feedmerge.plans.snapshots import merge_blogs_incremental, read_accounts_of_day, snapshot_days
from feedmerge.schemas import BLOGS_DELTA
from feedmerge.sinks import run_path, vacuum, write_clustered, write_run
from helpers import frame, rows

AT = dt.datetime(2024, 1, 20, 6)
DAYS = [f"2024-01-{d}" for d in (16, 17, 18, 19)]


def send(spark, base, day, accounts, likes, hour=6):
    when = dt.datetime.fromisoformat(day) + dt.timedelta(hours=hour)
    found = [
        {"accountid": a, "likescount": likes, "currenttimestamp": when, "kafkaoffset": k, "kafkapartition": 0, "execdate": day}
        for k, a in enumerate(accounts)
    ]
    write_run(frame(spark, BLOGS_DELTA, found).coalesce(1), run_path(f"{base}/blogs", day, when))


def names(n):
    return [f"a{k}" for k in range(n)]


def layers_of(spark, path, number):
    return snapshots.read_manifest(spark, path, number)


@pytest.mark.parametrize("layers", [1, 2, 4])
def test_days_equal_whole_merges_and_old_days_stay(spark, tmp_path, layers):
    base = str(tmp_path)
    send(spark, base, DAYS[0], [*names(60), None, ""], 1)
    send(spark, base, DAYS[1], ["a3", "a4", "new", None], 2)
    send(spark, base, DAYS[1], ["a3"], 3, hour=7)
    send(spark, base, DAYS[2], names(60), 4)
    send(spark, base, DAYS[3], [], 5)
    for day in DAYS:
        whole = spark.read.parquet(merge_blogs(spark, f"{base}/blogs", f"{base}/whole", day))
        merge_blogs_incremental(spark, f"{base}/blogs", f"{base}/parts", day, buckets=8, layers=layers)
        assert rows(read_accounts_of_day(spark, f"{base}/parts", day)) == rows(whole)
    first = spark.read.parquet(f"{base}/whole/20240116")
    assert rows(read_accounts_of_day(spark, f"{base}/parts", DAYS[0])) == rows(first)
    assert [str(d) for d in snapshot_days(spark, f"{base}/parts")] == DAYS
    # older days go, the newest stays whole
    vacuum(spark, f"{base}/parts", snapshots.SPREAD, keep=1)
    assert rows(read_accounts_of_day(spark, f"{base}/parts")) == rows(spark.read.parquet(f"{base}/whole/20240119"))
    with pytest.raises(ValueError, match="no snapshot of 2024-01-16"):
        read_accounts_of_day(spark, f"{base}/parts", DAYS[0])


def test_a_small_day_writes_few_files(spark, tmp_path):
    base, path = str(tmp_path), str(tmp_path / "accounts")
    send(spark, base, DAYS[0], names(1000), 1)
    send(spark, base, DAYS[1], names(10), 2)
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[0], buckets=128, layers=1)
    before = layers_of(spark, path, 202401160000)
    rewritten = merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[1], layers=1)
    after = layers_of(spark, path, 202401170000)
    # one per cent of the accounts: at most ten of 128 buckets have new files
    assert 0 < len(rewritten) <= 10 and len(after) == len(before) > 120
    assert {p for p in after if after[p] != before[p]} == set(rewritten)
    # with layers the old files of these buckets are kept too, and the day's rows lie beside them
    send(spark, base, DAYS[2], names(10), 3)
    assert merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[2], layers=3) == []
    layered = layers_of(spark, path, 202401180000)
    assert all(layered[p][: len(after[p])] == after[p] for p in after)
    found = {r.accountid: r.likescount for r in read_accounts_of_day(spark, path).collect()}
    assert len(found) == 1000 and sum(v == 3 for v in found.values()) == 10


def test_a_merge_that_dies_or_is_repeated(spark, tmp_path, monkeypatch):
    base, path = str(tmp_path), str(tmp_path / "accounts")
    send(spark, base, DAYS[0], names(20), 1)
    send(spark, base, DAYS[1], names(5), 2)
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[0], buckets=4)
    old = rows(read_accounts_of_day(spark, path))
    with monkeypatch.context() as patch:
        def lost(*_):
            raise RuntimeError("lost")
        patch.setattr(snapshots, "put_manifest", lost)
        with pytest.raises(RuntimeError, match="lost"):
            merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[1])
    assert rows(read_accounts_of_day(spark, path)) == old
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[1])
    once = rows(read_accounts_of_day(spark, path))
    # a run that comes late is taken when the day is merged again
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[1])
    assert rows(read_accounts_of_day(spark, path)) == once
    send(spark, base, DAYS[1], ["a9"], 9, hour=8)
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[1])
    assert read_accounts_of_day(spark, path, DAYS[1]).where("likescount = 9").count() == 1
    assert rows(read_accounts_of_day(spark, path, DAYS[0])) == old


def test_another_number_of_buckets_spreads_all_accounts_anew(spark, tmp_path):
    base, path = str(tmp_path), str(tmp_path / "accounts")
    send(spark, base, DAYS[0], names(50), 1)
    send(spark, base, DAYS[1], ["a1"], 2)
    send(spark, base, DAYS[2], ["a2"], 3)
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[0], buckets=2)
    assert all(p.startswith("buckets=16/") for p in merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[1], buckets=16))
    merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[2])
    found = {r.accountid: r.likescount for r in read_accounts_of_day(spark, path).collect()}
    assert found == {**dict.fromkeys(names(50), 1), "a1": 2, "a2": 3}
    with pytest.raises(ValueError, match="at least one layer"):
        merge_blogs_incremental(spark, f"{base}/blogs", path, DAYS[2], layers=0)
    with pytest.raises(ValueError, match="no snapshot"):
        read_accounts_of_day(spark, str(tmp_path / "none"))


# ------------------------------------------------------------------ clustering


def rows_scanned(df):
    """Rows that came out of the file scans, before any filter."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_look_up_reads_few_rows(spark, tmp_path):
    clustered, plain = str(tmp_path / "clustered"), str(tmp_path / "plain")
    keys = spark.range(40_000).selectExpr("md5(cast(id as string)) id", "id kafkaoffset", "cast(null as int) kafkapartition")
    keys.repartition(8).write.parquet(plain)
    write_clustered(keys, clustered, "id", files=8, block_bytes=64 * 1024)
    one = keys.where("kafkaoffset = 777").first().id

    def found(path, key):
        return spark.read.parquet(path).where(f"id = '{key}'").select("id", "kafkaoffset")

    assert [r.kafkaoffset for r in found(clustered, one).collect()] == [777]
    assert rows_scanned(found(plain, one)) >= 4_000
    assert 0 < rows_scanned(found(clustered, one)) <= 5_000
    # inside every range, in no row group: the Bloom filters say so
    assert rows_scanned(found(clustered, one[:-1] + "z")) == 0
    assert rows(spark.read.parquet(clustered)) == rows(keys)


def test_a_hot_key_is_split_and_days_have_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(9_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) id", "id kafkaoffset", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 2 as int)) at")
    write_clustered(hot, path, "id", files=12, day_of="at")
    back = spark.read.parquet(path)
    sizes = [r["count"] for r in back.selectExpr("_metadata.file_path f").groupBy("f").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 3 * 9_000 / 12
    assert rows(back.drop("postdate")) == rows(hot)
    assert back.select("postdate").distinct().count() == 2
    write_clustered(hot.limit(0), str(tmp_path / "none"), "id", files=3)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 2), ("a", None)], "id string, kafkaoffset bigint")
    write_clustered(nulls, str(tmp_path / "nulls"), "id", files=2)
    assert rows(spark.read.parquet(str(tmp_path / "nulls"))) == rows(nulls)
