"""The streaming aggregates against the same rows in batch."""

from collections import defaultdict
from datetime import datetime, timedelta

from tomeflow.streaming.interactions import EVENT, distinct_events, read_events, windowed_actions


def events(n=200):
    start = datetime(2024, 1, 1)
    return [(i, start + timedelta(hours=i), i % 7, "view", float(i % 13), "{}") for i in range(n)]


def run(spark, df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name).collect()


def test_windowed_actions(spark, tmp_path):
    rows = events()
    spark.createDataFrame(rows, EVENT).repartition(3).write.parquet(str(tmp_path / "e"))
    got = run(spark, windowed_actions(read_events(spark, str(tmp_path / "e"))), "windowed", "complete")
    want = defaultdict(list)
    for i, ts, user, _, value, _ in rows:
        want[(ts.date(), user)].append((ts, i, value))
    assert {(r.day.date(), r.user_id): (r.nactions, r.last_value) for r in got} == {k: (len(v), max(v)[2]) for k, v in want.items()}


def test_redelivered_events_count_once(spark, tmp_path):
    rows = events(50)
    spark.createDataFrame(rows + rows[:20], EVENT).write.parquet(str(tmp_path / "e"))
    got = run(spark, distinct_events(read_events(spark, str(tmp_path / "e"))), "distinct_events", "append")
    assert sorted(r.event_id for r in got) == list(range(50))
