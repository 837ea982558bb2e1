from feedmerge.operators import latest_accounts, latest_per_key
from helpers import plan, rows

FIELDS = "k STRING, t STRING, kafkaoffset BIGINT, kafkapartition INT, v STRING"


def test_order_then_offset_then_partition(spark):
    df = spark.createDataFrame(
        [
            ("a", "1", 1, 0, "old"),
            ("a", "2", 1, 0, "tie, lower offset"),
            ("a", "2", 2, 0, "tie, lower partition"),
            ("a", "2", 2, 1, "newest"),
            ("b", None, 9, 0, "null order loses"),
            ("b", "0", 1, 0, "kept"),
        ],
        FIELDS,
    )
    latest = latest_per_key(df, ["k"], ["t"])
    assert {r.v for r in latest.collect()} == {"newest", "kept"}


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, "1", 1, 0, "x"), (None, "2", 2, 0, "y")], FIELDS)
    assert [r.v for r in latest_per_key(df, ["k"], ["t"]).collect()] == ["y"]


def test_empty_in_empty_out(spark):
    assert latest_per_key(spark.createDataFrame([], FIELDS), ["k"], ["t"]).count() == 0


def test_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 1 k", "id kafkaoffset", "0 kafkapartition")
    below = plan(latest_per_key(df, ["k"], [])).split("Exchange")[-1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_repeated_delivery_keeps_the_last_merge(spark):
    df = spark.createDataFrame(
        [("a", "1", 1, 0, "20240101"), ("a", "1", 1, 0, "20240102")],
        "accountid STRING, currenttimestamp STRING, kafkaoffset BIGINT, kafkapartition INT, mergedate STRING",
    )
    assert rows(latest_accounts(df).select("mergedate"))[1] == [("20240102",)]
