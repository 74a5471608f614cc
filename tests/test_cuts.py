"""Streams over cuts of many files, and a stream's watermark when it is taken up again."""

from types import SimpleNamespace

from tonearm.streaming import registered
from tonearm.streaming.commits import DayCommits
from tonearm.streaming.runner import run_stream


def test_a_cut_of_many_files_is_one_batch(spark, tmp_path):
    lines = spark.range(0, 90, 1, 4).selectExpr("string(id) AS value", "id AS at")
    seen = {}

    def sink(batch, batch_id):
        seen[batch_id] = sorted(int(r["value"]) for r in batch.collect())

    registered._in_turn(
        lines, str(tmp_path), lambda texts: run_stream(texts, sink, f"{tmp_path}/c"), bounds=[30, 50]
    )
    assert len(list((tmp_path / "in").glob("part-*"))) > 3
    assert seen == {0: list(range(30)), 1: list(range(30, 50)), 2: list(range(50, 90))}


def test_watermark_is_kept_when_the_stream_is_taken_up_again():
    days = DayCommits("t", "p", "ts")
    assert days._high() is None
    days.watch(SimpleNamespace(lastProgress={"eventTime": {"watermark": "2024-01-02T00:00:00.000Z"}}))
    days.watch(SimpleNamespace(lastProgress=None))
    assert days._high() == 1_704_153_600_000


def test_cuts_are_packed_and_go_once_they_are_taken(spark, tmp_path):
    text = "concat('{\"order_id\":\"', id, '\",\"status_type_id\":\"101\",\"pay_type\":\"A\"}')"
    lines = spark.range(0, 30_000, 1, 4).selectExpr(f"{text} AS value", "id AS at")
    seen, left = [], []

    def sink(batch, batch_id):
        seen.append((batch_id, batch.count(), batch.distinct().count()))
        left.append(sum(p.stat().st_size for p in (tmp_path / "in").glob("part-*")))

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    registered._in_turn(
        lines, str(tmp_path), lambda texts: run_stream(texts, sink, f"{tmp_path}/c"),
        bounds=[10_000, 20_000], keep=False,
    )
    assert seen == [(i, 10_000, 10_000) for i in range(3)]
    assert max(left) < lines.selectExpr("sum(length(value) + 1) AS n").first()["n"] / 6
    assert len(list((tmp_path / "in").glob("part-*"))) <= 4  # of three cuts 8
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
