from pyspark.sql import functions as F

from checks import feeds, registry
from feedmerge.plans import POSTS
from feedmerge.plans.ingest import broken_texts
from feedmerge.sources.log import replay

DAY = "2024-01-20"


def test_broken_text_is_sought_in_new_messages_only(spark, tmp_path):
    texts = ["{broken", '{"Url": "u", "Type": "no number"}', '{"Url": "v"}', None, "{late"]
    many = [(bytearray(t, "utf8") if t else None, p, i) for p in (0, 1) for i, t in enumerate(texts)]
    spark.createDataFrame(many, "value BINARY, partition INT, offset BIGINT").write.parquet(str(tmp_path / "log"))
    starts = spark.createDataFrame([(0, 1)], "kafkapartition INT, startingoffset BIGINT")
    sent = replay(spark.read.parquet(str(tmp_path / "log")), starts)
    held = spark.createDataFrame([(0, 3), (0, 1), (1, 2)], "kafkapartition INT, kafkaoffset BIGINT")
    found = broken_texts(POSTS, sent, held, DAY)
    assert sorted((r.kafkapartition, r.kafkaoffset, r.brokentext) for r in found.collect()) == [
        (0, 1, texts[1]), (1, 0, texts[0]), (1, 1, texts[1])
    ]
    lines = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    parsed = [i for i, line in enumerate(lines) if "from_json" in line]
    assert parsed and max(parsed) < min(i for i, line in enumerate(lines) if "Join LeftOuter" in line)


def test_the_log_of_the_ingest_queries_is_even_and_written_once(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch_dir", lambda *_: str(tmp_path / "ingest"))
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "1b")
    try:
        registry.QUERIES["ingest_posts"](spark, sf)
    finally:
        spark.conf.unset(least)
    total = 0
    for k in (0, 1):
        files = spark.read.parquet(f"{tmp_path}/ingest/log{k}").groupBy(F.input_file_name()).count().collect()
        counts = [r["count"] for r in files]
        assert len(counts) >= 4 and max(counts) <= 2 * min(counts)
        total += sum(counts)
    assert total == feeds.events(spark, sf).count()


def test_events_without_a_time_are_in_the_later_log(spark, tmp_path):
    rows_all = spark.sql(
        f"""select id event_id, if(id = 3, null, timestamp_ntz'{registry.FIRST_RUN_ENDS}' + make_interval(0, 0, 0, id - 1)) ts,
        id user_id, 'view' event_type, 1.5d value, '' props from range(4)"""
    )
    rows_all.write.parquet(f"{tmp_path}/events.parquet")
    ids = [sorted(r.event_id for r in part(spark, str(tmp_path)).collect()) for part in (registry.early, registry.late)]
    assert ids == [[0], [1, 2, 3]]
