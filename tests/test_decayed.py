"""The decayed residual from a stream against a plain loop, in any order of batches."""

import datetime as dt
import random

import pytest

from voltloom.core.scratch import shared_dir
from voltloom.streaming import decayed as DR
from voltloom.streaming import jobs as J

BASE = dt.datetime(2024, 3, 1)
SCHEMA = "series string, DT timestamp, Residual_MWH double"


def rows():
    rng = random.Random(3)
    out = [(s, BASE + dt.timedelta(days=d, minutes=rng.randrange(1440)), rng.uniform(-5, 5)) for s in ("a", "b", None) for d in range(8) if not (s == "b" and d in (2, 3)) for _ in range(4)]
    return [*out, ("a", BASE + dt.timedelta(days=1, hours=3), None), ("a", None, 7.0), out[0]]


def plain(data, half_life, last):
    want = {}
    for s in {r[0] for r in data}:
        mine = [(t, v) for k, t, v in data if k == s and t is not None and v is not None]
        for day in sorted({t.date() for t, _ in mine}):
            end = dt.datetime(day.year, day.month, day.day) + dt.timedelta(days=1)
            if end > last:
                continue
            x = [(2 ** (-(end - t).total_seconds() / 3600 / half_life), v) for t, v in mine if t < end]
            want[s, end] = (len(x), sum(w for w, _ in x), sum(w * v for w, v in x) / sum(w for w, _ in x))
    return want


def streamed(spark, batches, watermark):
    path, out, ck = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    for b in batches:  # a run for each batch, all on one state
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        with DR.keyed_state_store(spark):
            st = DR.decayed_residuals(J.file_stream(spark, path, SCHEMA), 30.0, watermark)
            J.run_available(st, out, ck, "append", "parquet")
    return {(r["series"], r["DT"]): (r["n"], r["weight"], r["ewma"]) for r in spark.read.schema(st.schema).parquet(out).collect()}


@pytest.fixture(autouse=True)
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_batch_equals_a_plain_loop(spark):
    data = rows()
    last = max(t for _, t, _ in data if t) - dt.timedelta(days=1)
    got, want = streamed(spark, [data], "1 day"), plain(data, 30.0, last)
    assert got.keys() == want.keys() and len(got) > 10
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


def test_late_rows_count_as_in_a_batch(spark):
    data = rows()
    early = [r for r in data if r[1] is None or r[1] < BASE + dt.timedelta(days=5)]
    later = [r for r in data if r not in early]
    batches = [early[1::2], early[0::2], later]  # the second batch lies before the first one's last row
    last = max(t for _, t, _ in data if t) - dt.timedelta(days=6)
    got, want = streamed(spark, batches, "6 days"), plain(data, 30.0, last)
    assert got.keys() == want.keys() and got
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


def test_the_session_keeps_its_state_store(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    with DR.keyed_state_store(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == old
