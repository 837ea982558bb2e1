import json

import pytest

from feedmerge.operators import compact_offsets, latest_run, offsets_of, resume_offsets, starting_offsets_json
from feedmerge.schemas import OFFSET_LOG
from feedmerge.sinks import append_offsets
from feedmerge.sources.files import read_if_exists
from feedmerge.sources.log import ENVELOPE, kafka_options, read_kafka, replay, replay_resumed
from helpers import frame, rows


def log(spark, *runs):
    return frame(
        spark,
        OFFSET_LOG,
        [
            {"kafkapartition": p, "latestoffset": o, "execdate": d, "exectime": t}
            for d, t, p, o in runs
        ],
    )


RUNS = [
    ("2024-01-01", "23-00", 0, 10),
    ("2024-01-01", "23-00", 1, 20),
    ("2024-01-02", "01-00", 0, 15),
]


def partitions(spark, n):
    return spark.range(n).selectExpr("cast(id as int) kafkapartition")


def starts(df):
    return {r.kafkapartition: r.startingoffset for r in df.collect()}


def messages(spark, *positions):
    return frame(spark, ENVELOPE, [{"partition": p, "offset": o} for p, o in positions])


def test_highest_offset_per_partition(spark):
    delta = spark.createDataFrame([(0, 5), (0, 7), (1, 3)], "kafkapartition INT, kafkaoffset BIGINT")
    found = offsets_of(delta, "t", "g", "2024-01-01", "01-00")
    assert found.columns == list(OFFSET_LOG)
    assert rows(found.select("kafkapartition", "latestoffset"))[1] == [(0, 7), (1, 3)]


def test_newest_run_wins_by_date_then_time(spark):
    assert starts(latest_run(log(spark, *RUNS))) == {0: 16}


def test_topics_and_groups_stay_apart(spark, tmp_path):
    path = str(tmp_path / "offsets")
    runs = [("Posts", "g", 100), ("Blogs", "g", 5), ("Blogs", "h", 50)]
    made = [
        {"kafkapartition": 0, "latestoffset": o, "topic": t, "consumergroup": g, "execdate": "d", "exectime": "t"}
        for t, g, o in runs
    ]
    mixed, topic = frame(spark, OFFSET_LOG, made), partitions(spark, 1)
    for t, g, o in runs:
        for scope in ("all_runs", "latest_run"):
            assert starts(resume_offsets(mixed, topic, scope, topic=t, group=g)) == {0: o + 1}
    with pytest.raises(Exception, match="several topics"):
        resume_offsets(mixed, topic).collect()
    append_offsets(compact_offsets(mixed.union(mixed)), path)
    assert spark.read.parquet(path).count() == 3
    sent = messages(spark, (0, 5), (0, 6), (0, 51))
    assert replay_resumed(sent, path, "Blogs", "g").count() == 2
    assert replay_resumed(sent, path, "Blogs", "h").count() == 1
    assert replay_resumed(sent, path, "Metrics", "g").count() == 3


def test_silent_and_new_partitions(spark):
    runs, topic = log(spark, *RUNS), partitions(spark, 3)
    assert starts(resume_offsets(runs, topic)) == {0: 16, 1: 21, 2: -2}
    assert starts(resume_offsets(runs, topic, "latest_run", -1)) == {0: 16, 1: -1, 2: -1}
    with pytest.raises(ValueError):
        resume_offsets(runs, topic, "some_runs")


def test_json_is_wrapped_once_and_sorted_by_number(spark):
    found = starting_offsets_json(resume_offsets(log(spark, *RUNS), partitions(spark, 12)), "Posts")
    text = found.first()[0]
    parsed = json.loads(text)
    assert list(parsed) == ["Posts"]
    assert list(parsed["Posts"]) == [str(i) for i in range(12)]
    assert parsed["Posts"]["0"] == 16 and parsed["Posts"]["11"] == -2


def test_replay_from_offsets(spark):
    sent = messages(spark, (0, 15), (0, 16), (1, 20), (1, 21), (2, 0), (3, 5))
    start = spark.createDataFrame(
        [(0, 16), (1, -1), (2, -2)], "kafkapartition INT, startingoffset BIGINT"
    )
    kept = replay(sent, start)
    assert kept.columns == list(ENVELOPE)
    assert {(r.partition, r.offset) for r in kept.collect()} == {(0, 16), (2, 0), (3, 5)}
    assert replay(sent).count() == 6


def test_resume_only_when_a_log_exists(spark, tmp_path):
    path = str(tmp_path / "offsets")
    sent = messages(spark, (0, 15), (0, 16), (1, 21))
    assert replay_resumed(sent, path).count() == 3
    append_offsets(log(spark, *RUNS), path, first_run=True)
    assert {(r.partition, r.offset) for r in replay_resumed(sent, path).collect()} == {(0, 16), (1, 21)}
    append_offsets(log(spark, ("2024-01-03", "01-00", 1, 30)), path)
    assert {(r.partition, r.offset) for r in replay_resumed(sent, path).collect()} == {(0, 16)}


def test_only_a_missing_path_means_first_run(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, str(broken)).count()


def test_kafka_options():
    bounded = kafka_options("h:9092", "Posts", '{"Posts":{"0":5}}', "g1")
    assert bounded["endingOffsets"] == "latest" and bounded["kafka.group.id"] == "g1"
    assert bounded["startingOffsets"] == '{"Posts":{"0":5}}' and bounded["failOnDataLoss"] == "false"
    stream = kafka_options("h:9092", "Posts", bounded=False)
    assert "endingOffsets" not in stream and stream["startingOffsets"] == "earliest"


def test_kafka_needs_its_connector(spark):
    try:
        read_kafka(spark, "localhost:1", "Posts")
    except Exception as error:
        assert "kafka" in str(error).lower()
