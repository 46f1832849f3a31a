"""Downloads: paced by host, side by side, and once each in spite of failures."""

import glob
import threading
import time
from collections import Counter, defaultdict

import pytest

from corvina.sources import fetching


def test_hosts_are_paced_and_side_by_side():
    times, running, most, lock = defaultdict(list), set(), [0], threading.Lock()

    def fetch(url):
        with lock:
            times[url[0]].append(time.monotonic())
            running.add(url)
            most[0] = max(most[0], len(running))
        time.sleep(0.02)
        with lock:
            running.discard(url)
        return url.encode()

    urls = [(h, f"{h}{i}") for h in "abc" for i in range(8)]
    got = list(fetching.paced(iter(urls), fetch, fetching.Pace(at_once=4, rate=40.0)))
    assert sorted(u for u, _, _ in got) == sorted(u for _, u in urls) and all(c == u.encode() and r is None for u, c, r in got)
    assert all(b - a > 0.015 for t in times.values() for a, b in zip(t, t[1:], strict=False)) and 2 <= most[0] <= 4
    assert max(t[-1] for t in times.values()) - min(t[0] for t in times.values()) < 3 * 8 / 40  # not one host after another


def test_a_burst_comes_at_once_and_no_more():
    bucket = fetching.Bucket(2.0, 3, 0.0)
    taken = []
    now = 0.0
    while len(taken) < 6:
        pause = bucket.ready(now)
        if pause:
            now += pause
        else:
            bucket.take()
            taken.append(now)
    assert taken == [0.0, 0.0, 0.0, 0.5, 1.0, 1.5] and bucket.ready(100.0) == 0.0 and bucket.tokens == 3


def test_failures_have_reasons():
    def fetch(url):
        if url == "x":
            raise OSError("gone")
        return None if url == "y" else b"z"

    got = {u: (c, r) for u, c, r in fetching.paced(iter([("h", "x"), ("h", "y"), ("h", "z")]), fetch, fetching.Pace(rate=1e4, tries=2))}
    assert got == {"x": (None, "OSError: gone"), "y": (None, "no_content"), "z": (b"z", None)}


def test_each_address_once_in_spite_of_a_failed_task(spark, tmp_path):
    urls = [f"http://host{i % 7}.org/{i}" for i in range(300)]
    df = spark.createDataFrame([(u,) for u in [*urls, *urls[:50], None]], "url string").repartition(3)
    journal, log, flag = f"file://{tmp_path}/journal", f"{tmp_path}/log", f"{tmp_path}/failed"

    def fetch(url):
        import os

        if url.endswith("/200") and not os.path.exists(flag):
            open(flag, "w").close()
            raise SystemExit("the worker is lost")
        with open(log, "a") as f:
            f.write(url + "\n")
        return url.encode()

    pace = fetching.Pace(at_once=4, rate=1e5, burst=50, flush=10, groups=5)
    with pytest.raises(Exception, match="SystemExit|the worker is lost|Python worker"):
        fetching.fetch_all(df, fetch, journal, pace)
    before = len(open(log).read().split())
    assert 0 < before < 300 and glob.glob(f"{tmp_path}/journal/*/*.parquet")
    got = {r.url: bytes(r.content) for r in fetching.fetch_all(df, fetch, journal, pace).collect()}
    assert got == {u: u.encode() for u in urls}
    again = [u for u, n in Counter(open(log).read().split()).items() if n > 1]
    assert len(again) <= 4  # what was running when the task failed
    n = len(open(log).read().split())
    assert fetching.fetch_all(df.limit(5), fetch, journal, pace).count() <= 5 and len(open(log).read().split()) == n
    assert fetching.fetch_all(df.limit(0), fetch, f"file://{tmp_path}/none", pace).count() == 0
