"""Merges that leave the files of unchanged posts alone."""

import datetime as dt

import pytest

from feedmerge.plans import merge_posts
from feedmerge.plans.merge_parts import merge_posts_parts, read_posts_parts
from feedmerge.plans.merge_posts import read_merged_posts
from feedmerge.schemas import MERGED_POSTS
from feedmerge.sinks import published, run_path, write_run
from helpers import metrics, posts, random_feeds, rows

AT = dt.datetime(2024, 1, 20, 6)
LOWER = "2024-01-01"


def send(spark, base, day, post_rows, metric_rows):
    write_run(posts(spark, *post_rows), run_path(f"{base}/p", day, AT), "partdate")
    write_run(metrics(spark, *metric_rows), run_path(f"{base}/m", day, AT), "partdate")


def post(name, day=5, likes=1):
    return {"id": name, "partdate": dt.datetime(2024, 1, day), "metrictimestamp": "1", "likescount": likes}


def names_of(spark, path):
    return {p: tuple(v) for p, v in published.current(spark, path)[1].items()}


@pytest.mark.parametrize("dates_from", ["posts", "both"])
def test_days_equal_merges_of_whole_dates(spark, tmp_path, dates_from):
    base = str(tmp_path)
    for k, day in enumerate(("2024-01-08", "2024-01-09", "2024-01-10")):
        send(spark, base, day, *random_feeds(k, n=40, ids=12))
        left = merge_posts(spark, f"{base}/p", f"{base}/m", f"{base}/whole", day, LOWER, dates_from=dates_from)
        got = merge_posts_parts(spark, f"{base}/p", f"{base}/m", f"{base}/parts", day, LOWER, parts=4, dates_from=dates_from)
        assert got.left_out == left
        whole = read_merged_posts(spark, f"{base}/whole").select(*MERGED_POSTS)
        assert rows(read_posts_parts(spark, f"{base}/parts")) == rows(whole)
    one = read_posts_parts(spark, f"{base}/parts", "2024-01-05", "2024-01-05")
    assert rows(one) == rows(whole.where("partdate_pmd = date'2024-01-05'")) and one.count() > 0


def test_files_without_a_changed_post_are_neither_read_nor_written(spark, tmp_path):
    base, path = str(tmp_path), str(tmp_path / "parts")
    send(spark, base, "2024-01-08", [post(f"p{k}", 4 + k % 2) for k in range(400)], [])
    first = merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-08", LOWER, parts=64)
    before = names_of(spark, path)
    assert first.read == 0 and first.written == len(before) > 110
    # three posts of one day, and a metric of a day without posts
    send(spark, base, "2024-01-09", [post(f"p{k}", 4, likes=9) for k in (0, 2, 4)], [{"id": "p1", "partdate": "2024-01-05", "likes": 5}])
    second = merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-09", LOWER)
    after = names_of(spark, path)
    changed = {p for p in after if after[p] != before.get(p)}
    assert second.read <= 4 and second.written == len(changed) <= 3
    assert all(p.startswith("partdate=2024-01-04/") for p in changed)
    found = {r.post_id: r.likescount for r in read_posts_parts(spark, path).collect()}
    assert found == {f"p{k}": 9 if k in (0, 2, 4) else 1 for k in range(400)}


def test_empty_days_repeats_and_a_merge_that_dies(spark, tmp_path, monkeypatch):
    base, path = str(tmp_path), str(tmp_path / "parts")
    assert read_posts_parts(spark, path).count() == 0
    send(spark, base, "2024-01-08", [], [])
    assert merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-08", LOWER, parts=2).written == 0
    send(spark, base, "2024-01-09", [post("a"), post("b"), post("b"), post(None)], [])
    assert merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-09", LOWER, parts=2).left_out.posts == 1
    old = rows(read_posts_parts(spark, path))
    merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-09", LOWER)
    assert rows(read_posts_parts(spark, path)) == old
    send(spark, base, "2024-01-10", [post("a", likes=8)], [])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(published, "put_manifest", lost)
        with pytest.raises(RuntimeError, match="lost"):
            merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-10", LOWER)
    assert rows(read_posts_parts(spark, path)) == old
    merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-10", LOWER)
    assert {r.post_id: r.likescount for r in read_posts_parts(spark, path).collect()} == {"a": 8, "b": 1}
    with pytest.raises(ValueError, match="has 2 parts"):
        merge_posts_parts(spark, f"{base}/p", f"{base}/m", path, "2024-01-10", LOWER, parts=3)
