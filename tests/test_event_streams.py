"""Event-time streams equal the batch result after out-of-order files, a failure and a restart."""
import datetime as dt
import os
import random

import pytest

from quarry.streaming.events import closed, event_stream, sessions, start_by_batch, window_stats

SCHEMA = "ts timestamp, user long, value double"
START = dt.datetime(2024, 1, 1)


def minute(m, s=0):
    return START + dt.timedelta(minutes=m, seconds=s)


def batches(seed):
    """Five files; events are up to eight minutes out of order, across files too."""
    rng = random.Random(seed)
    rows = [(minute(rng.randint(0, 119), rng.randint(0, 59)), rng.randint(1, 3), round(rng.uniform(0, 9), 2)) for _ in range(300)]
    rows.sort(key=lambda r: r[0] + dt.timedelta(minutes=rng.uniform(0, 8)))
    return [rows[i * 60:(i + 1) * 60] for i in range(5)]


def put(spark, rows, inbox, n):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    # file sources take files in the order of their times
    for f in os.listdir(inbox):
        path = os.path.join(inbox, f)
        if f.endswith(".parquet") and os.path.getmtime(path) > 1_700_000_100:
            os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("kind", ["windows", "sessions"])
def test_equals_batch_after_disorder_failure_and_restart(spark, scratch, kind):
    inbox, out, name = f"{scratch}/in", f"{scratch}/out", f"events-{kind}-{os.path.basename(scratch)}"
    make = (lambda e: window_stats(e, "ts", ["user"], "value", "10 minutes", "10 minutes", "5 minutes")) if kind == "windows" else \
        (lambda e: sessions(e, "ts", ["user"], "2 minutes", "10 minutes"))
    files, rows = batches(3), []
    failed = []

    def fail_once(number):
        if not failed and number == 2:
            failed.append(number)
            raise RuntimeError("lost after the write")

    for n, part in enumerate(files):
        rows += part
        put(spark, part, inbox, n)
        for _ in range(2):  # the second time goes on after the failure, or finds nothing new
            try:
                start_by_batch(make(event_stream(spark, inbox, SCHEMA, 1)), out, name, after_write=fail_once).awaitTermination()
            except Exception as e:  # noqa: BLE001
                assert "lost after the write" in str(e)
    assert failed
    # an event far ahead closes everything before it
    put(spark, [(minute(1000), 9, 1.0)], inbox, 9)
    start_by_batch(make(event_stream(spark, inbox, SCHEMA, 1)), out, name).awaitTermination()
    assert shown(closed(spark, out)) == shown(make(spark.createDataFrame(rows, SCHEMA)))


def test_events_beyond_the_lateness_are_dropped(spark, scratch):
    inbox, out, name = f"{scratch}/in", f"{scratch}/out", f"late-{os.path.basename(scratch)}"
    for n, part in enumerate([[(minute(30), 1, 1.0)], [(minute(1), 1, 5.0), (minute(29), 1, 2.0)], [(minute(500), 1, 1.0)], [(minute(501), 1, 1.0)]]):
        put(spark, part, inbox, n)
        start_by_batch(window_stats(event_stream(spark, inbox, SCHEMA, 1), "ts", ["user"], "value", "10 minutes", "10 minutes"), out, name) \
            .awaitTermination()
    got = {(r.starts, r.n, float(r.total)) for r in closed(spark, out).collect()}
    assert got == {(minute(30), 1, 1.0), (minute(20), 1, 2.0)}
