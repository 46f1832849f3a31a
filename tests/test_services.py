"""Search streams that go on where they ended, and their requests a second."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corvina.sources import searching


def test_limiter_spaces_calls_and_tries_again():
    now, waits, calls = [0.0], [], []

    def wait(s):
        waits.append(round(s, 3))
        now[0] += s

    limited = searching.Limiter(2.0, tries=3, clock=lambda: now[0], wait=wait)

    def call(x):
        calls.append(now[0])
        if len(calls) in (2, 3):
            raise OSError
        return x

    assert [limited(call, i) for i in range(3)] == [0, 1, 2]
    assert calls == [0.0, 0.5, 1.5, 3.5, 4.0] and waits == [0.5, 1.0, 2.0, 0.5]  # waits of 1 and 2 s after errors

    def fails():
        raise OSError("no")

    with pytest.raises(OSError, match="no"):
        limited(fails)


@pytest.fixture
def folder(tmp_path):
    """Days with 7, 0, 300, 5 and 40 rows."""
    key = 0
    for day, n in (("2024-01-01", 7), ("2024-01-03", 300), ("2024-01-04", 5), ("2024-01-31", 40)):
        (tmp_path / f"service/day={day}").mkdir(parents=True)
        for half in (n // 2, n - n // 2):
            pq.write_table(pa.table({"k": list(range(key, key + half)), "v": [f"r{i}" for i in range(key, key + half)]}), tmp_path / f"service/day={day}/{key}.parquet")
            key += half
    return tmp_path


def run(spark, folder, last=None, fail=False):
    service = searching.DayFolder(f"file://{folder}/service", "k")
    if fail:

        class Broken(searching.DayFolder):
            def fetch(self, ids):
                raise OSError("the service is down")

        service = Broken(service.folder, "k")
    spark.dataSource.register(searching.search_stream("days", service, page=50, chunk=20, cap=100))
    options = {"first": "2024-01-01", "rate": "2000"} | ({"last": last} if last else {})
    stream = spark.readStream.format("days").schema("k bigint, v string").options(**options).load()
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/sink")
    q.awaitTermination(240)
    rows = spark.read.schema("k bigint, v string").parquet(f"{folder}/sink").collect()
    return sorted(r.k for r in rows)


def test_a_stream_goes_on_where_it_ended(spark, folder, monkeypatch):
    assert run(spark, folder, "2024-01-02") == list(range(7))
    assert run(spark, folder, "2024-01-02") == list(range(7))  # nothing is left to read
    monkeypatch.setattr(searching.time, "sleep", lambda s: None)
    assert run(spark, folder, "2024-01-03") == list(range(307))
    assert run(spark, folder) == list(range(352))


def test_a_run_that_broke_off_is_read_again(spark, folder):
    assert run(spark, folder, "2024-01-01") == list(range(7))

    class Once(searching.Limiter):
        def __init__(self, rate):
            super().__init__(rate, tries=1)

    whole, searching.Limiter = searching.Limiter, Once
    try:
        with pytest.raises(Exception, match="the service is down"):
            run(spark, folder, fail=True)
    finally:
        searching.Limiter = whole
    assert run(spark, folder) == list(range(352))


def test_windows_stay_under_the_cap_and_share_the_rate(folder):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    source = searching.search_stream("days", searching.DayFolder(f"file://{folder}/service", "k"), page=50, chunk=20, cap=100)
    reader = source({"first": "2024-01-01", "rate": "600"}).streamReader(StructType([StructField("k", LongType()), StructField("v", StringType())]))
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert parts[0].value[0] == "2024-01-01" and parts[-1].value[1] == "2024-01-31"
    assert abs(sum(p.value[2] for p in parts) - 600) < 1e-6 and len(parts) > 2
    assert [p.value[0] for p in parts if p.value[0] == p.value[1] == "2024-01-03"]
    assert reader.partitions({"next": "2024-02-01"}, {"next": "2024-02-01"}) == []
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["k"] for r in rows) == list(range(352))
