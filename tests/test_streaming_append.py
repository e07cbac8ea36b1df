"""Append mode: late rows on both sides of the watermark, states that end, restarts from the checkpoint."""

import os
from datetime import datetime, timedelta

import pytest

from cinderspan.streaming import jobs

START = datetime(2024, 1, 1)
SCHEMA = "detection_id string, fire_id int, x int, y int, acquired_at timestamp, bright_ti4 double"


class Feed:
    """A folder that gets a file for each call; a run reads what is new, a file for each batch, and goes on from its checkpoint."""

    def __init__(self, spark, tmp_path, job):
        self.spark, self.path, self.job, self.files = spark, tmp_path, job, 0
        (tmp_path / "in").mkdir()

    def add(self, *rows):
        made = self.path / f"made{self.files}"
        data = [(i, 1, 0, 0, START + timedelta(hours=h), 300.0 + h) for i, h in rows]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(str(made))
        (part,) = made.glob("part-*.parquet")
        to = self.path / "in" / f"{self.files}.parquet"
        os.rename(part, to)
        os.utime(to, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(self.path / "in"))
        query = jobs.publish(self.job(stream), str(self.path / "out"), str(self.path / "state"), "append")
        query.awaitTermination(120)
        assert query.exception() is None
        return query.lastProgress

    def out(self):
        return [r.asDict() for r in self.spark.read.parquet(str(self.path / "out")).collect()]


def hours(t):
    return (t - START).total_seconds() / 3600


def test_windows_close_once_and_take_rows_up_to_the_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: jobs.detection_windows(s, 12, "2 hours"))
    feed.add(("a", 0.5), ("b", 5), ("b", 5))
    feed.add(("c", 13))
    feed.run()
    assert feed.out() == []  # the watermark is 11 h: nothing is closed
    # After a restart: one row behind the newest but within the watermark, one beyond it, a repeat of what the first run saw.
    feed.add(("d", 11.5), ("late", 10.5), ("c", 13))
    feed.add(("e", 40))
    progress = feed.run()
    found = {hours(r["start"]): (r["n"], r["max_bright"]) for r in feed.out()}
    assert found == {0: (3, 311.5), 12: (1, 313.0)}
    held = sum(o["numRowsTotal"] for o in progress["stateOperators"])
    assert held <= 4  # the open window and the id that may still repeat
    dropped = feed.run()  # nothing new: a restart adds no row
    assert len(feed.out()) == 2 and (dropped is None or dropped["numInputRows"] == 0)


def test_rolling_state_closes_window_by_window(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: jobs.rolling_state(s, 6, 3, "1 hour"))
    feed.add(("a", 1))
    feed.add(("b", 8))
    feed.run()
    first = {hours(r["start"]): r["n"] for r in feed.out()}
    assert first == {-3: 1, 0: 1}  # closed by the watermark of 7 h
    feed.add(("c", 2), ("d", 7.5))  # the first row's windows are closed, the second one's are open
    feed.add(("e", 30))
    feed.run()
    found = {}
    for r in feed.out():
        assert hours(r["start"]) not in found
        found[hours(r["start"])] = r["n"]
    assert found == {-3: 1, 0: 1, 3: 2, 6: 2}


def test_sessions_end_and_are_written_once(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: jobs.activity_sessions(s, gap="3 hours", late="2 hours"))
    feed.add(("a", 0), ("b", 2))
    feed.add(("c", 6))
    feed.run()
    assert feed.out() == []  # the watermark is 4 h, the first session ends at 5 h
    feed.add(("d", 4.5))  # within the watermark: it joins both sessions
    feed.add(("e", 30))
    feed.run()
    assert [(hours(r["start"]), hours(r["end"]), r["n"]) for r in feed.out()] == [(0, 9, 4)]
    feed.add(("f", 1))  # long closed
    feed.add(("g", 60))
    feed.run()
    assert sorted((hours(r["start"]), r["n"]) for r in feed.out()) == [(0, 4), (30, 1)]


def test_ledger_needs_another_mode(spark, tmp_path):
    entries = spark.readStream.schema("expected_coverage_id string, status string, recorded_at timestamp, append_order long").parquet(str(tmp_path))
    with pytest.raises(Exception, match="[Aa]ppend"):
        jobs.publish(jobs.ledger_current(entries), str(tmp_path / "out"), str(tmp_path / "state"), "append").awaitTermination(60)
