import datetime as dt
import hashlib
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from feedmerge.functions import (
    compact_date,
    date_series,
    in_date_range,
    key_bucket,
    run_window,
    url_key,
)
from feedmerge.session import broadcast_within, scratch_dir
from helpers import plan


@pytest.mark.parametrize(
    "algorithm, name",
    [("MD5", "md5"), ("md5", "md5"), ("SHA-1", "sha1"), ("SHA-256", "sha256"), ("SHA-512", "sha512")],
)
def test_url_key_is_the_first_16_bytes_of_the_digest(spark, algorithm, name):
    text = "https://пример.example/ü"
    found = spark.range(1).select(url_key(F.lit(text), algorithm)).first()[0]
    assert found == hashlib.new(name, text.encode()).hexdigest()[:32]


def test_url_key_of_null_and_of_unknown_digest(spark):
    row = spark.range(1).select(
        url_key(F.lit(None).cast("string")), url_key(F.lit("x"), "NOPE")
    ).first()
    assert tuple(row) == (None, "")
    with pytest.raises(NotImplementedError):
        url_key(F.lit("x"), "SHA3-256")


def test_key_bucket_takes_text(spark):
    found = spark.range(500).select(key_bucket(F.concat(F.lit("k"), "id"), 7).alias("b"))
    assert {r.b for r in found.distinct().collect()} == set(range(7))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_range_includes_both_days(spark, kind):
    days = ["2024-01-04", "2024-01-05", "2024-01-20", "2024-01-21", None]
    times = [d and f"{d} 23:59:59.999999" for d in days]
    df = spark.createDataFrame([(t,) for t in times], "t STRING").select(F.col("t").try_cast(kind))
    df = df.toDF("t")
    for lower, upper in [("2024-01-05", "20240120"), (dt.date(2024, 1, 5), dt.datetime(2024, 1, 20))]:
        kept = df.where(in_date_range(df, "t", lower, upper))
        assert [str(r.t)[:10] for r in kept.collect()] == days[1:3]


def test_range_on_text_ignores_zone_and_rubbish(spark):
    df = spark.createDataFrame([("2024-01-05T23:30:00+03:00",), ("never",)], "t STRING")
    assert df.where(in_date_range(df, "t", "2024-01-05", "2024-01-05")).count() == 1


def test_range_on_timestamps_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("timestamp_seconds(id) t").write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(df.where(in_date_range(df, "t", "2024-01-05", "2024-01-20")))
    assert "GreaterThanOrEqual(t," in text and "LessThan(t," in text


def test_date_series(spark):
    days = [r.day for r in date_series(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert date_series(spark, "2024-01-02", "2024-01-01").count() == 0


def test_compact_date_and_run_window(spark):
    row = spark.range(1).select(
        compact_date(F.lit("2024-03-01T05:00:00")), *run_window(F.lit("2024-03-01")).values()
    ).first()
    assert tuple(row) == (
        "20240301",
        dt.date(2024, 2, 29),
        dt.date(2024, 1, 31),
        dt.date(2024, 2, 20),
        dt.date(2024, 2, 29),
    )


def test_broadcast_only_within_bound(spark):
    small, large = spark.range(5), spark.range(6)
    assert broadcast_within(large, 5) is large
    assert broadcast_within(small, 5) is not small


def bare_session(master, root=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: root or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_below_the_shared_folder():
    shared = bare_session("spark://host:1", "hdfs://shared/")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first != second and first.startswith("hdfs://shared/x-")


def test_only_a_local_session_may_choose_its_own_scratch():
    assert "/x-" in scratch_dir(bare_session("local[8]"), "x")
    with pytest.raises(ValueError):
        scratch_dir(bare_session("yarn"), "x")
