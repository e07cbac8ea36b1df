"""Every job as a stream gives the rows of its batch twin."""

from cinderspan.sources import adapters
from cinderspan.streaming import jobs

SF = "/root/testdata/sf0.001"


def stream_of(spark, df, tmp_path, order):
    path = str(tmp_path / "in")
    df.repartitionByRange(3, order).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path), df


def run(spark, stream, tmp_path, mode):
    out = str(tmp_path / "out")
    jobs.publish(stream, out, str(tmp_path / "state"), mode).awaitTermination(120)
    return spark.read.parquet(out)


def test_detection_windows(spark, tmp_path):
    stream, batch = stream_of(spark, adapters.located(spark, SF), tmp_path, "acquired_at")
    found = {tuple(r) for r in run(spark, jobs.detection_windows(stream, late="60 days"), tmp_path, "complete").collect()}
    assert found == {tuple(r) for r in jobs.detection_windows(batch).collect()} and found


def test_ledger_current(spark, tmp_path):
    stream, batch = stream_of(spark, adapters.derived(spark, SF, "ledger"), tmp_path, "append_order")
    found = {tuple(r) for r in run(spark, jobs.ledger_current(stream), tmp_path, "complete").collect()}
    assert found == {tuple(r) for r in jobs.ledger_current(batch).collect()} and found


def test_sessions_and_rolling_state(spark):
    d = adapters.located(spark, SF)
    n = d.count()
    assert jobs.activity_sessions(d).groupBy().sum("n").first()[0] == n
    assert jobs.rolling_state(d).groupBy().sum("n").first()[0] == 8 * n


def test_rolling_state_as_a_stream(spark, tmp_path):
    stream, batch = stream_of(spark, adapters.located(spark, SF), tmp_path, "acquired_at")
    found = {tuple(r) for r in run(spark, jobs.rolling_state(stream, late="60 days"), tmp_path, "complete").collect()}
    assert found == {tuple(r) for r in jobs.rolling_state(batch).collect()} and found


def test_sessions_as_a_stream(spark, tmp_path):
    stream, batch = stream_of(spark, adapters.located(spark, SF), tmp_path, "acquired_at")
    found = {tuple(r) for r in run(spark, jobs.activity_sessions(stream, late="60 days"), tmp_path, "complete").collect()}
    assert found == {tuple(r) for r in jobs.activity_sessions(batch).collect()} and found
