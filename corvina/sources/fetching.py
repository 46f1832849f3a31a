"""Downloads with a journal: each address once, hosts side by side, and no host more often than it allows.

Addresses of a host go to one task, which spaces its requests whatever other
tasks do; tasks fetch from several hosts at a time. What has come is written to
the journal as it comes, and a task that starts again fetches only what the
journal lacks.
"""

from __future__ import annotations

import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files

#: What is written of each address.
ENTRY = pa.schema([("url", pa.string()), ("content", pa.binary()), ("reason", pa.string())])
_DDL = "url string, content binary, reason string"


@dataclass(frozen=True)
class Pace:
    """Requests of a task at a time, requests a second to a host, how many may come at once after a pause, tries of an address, and entries of a file of the journal."""

    at_once: int = 8
    rate: float = 3.0
    burst: int = 1
    tries: int = 3
    flush: int = 200
    groups: int = 64


class Bucket:
    """A host's tokens: one for each request, rate new ones a second, burst at most."""

    def __init__(self, rate: float, burst: int, now: float):
        self.rate, self.burst, self.tokens, self.at = rate, burst, float(burst), now

    def ready(self, now: float) -> float:
        """Seconds until there is a token."""
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at = now
        return max(0.0, (1 - self.tokens) / self.rate)

    def take(self) -> None:
        self.tokens -= 1


def _tried(fetch: Callable[[str], bytes | None], url: str, tries: int) -> tuple[bytes | None, str | None]:
    reason = "no_content"
    for k in range(tries):
        try:
            content = fetch(url)
            return (content, None) if content is not None else (None, "no_content")
        except Exception as e:
            reason = f"{type(e).__name__}: {e}"[:200]
            if k < tries - 1:
                time.sleep(min(60.0, 0.1 * 2**k))
    return None, reason


def paced(urls: Iterator[tuple[str, str]], fetch: Callable[[str], bytes | None], pace: Pace) -> Iterator[tuple[str, bytes | None, str | None]]:
    """(url, content, reason) of addresses(host, url), as they come; a few addresses for each request at a time are held, not all."""
    buckets: dict[str, Bucket] = {}
    waiting: dict[str, deque[str]] = {}
    running: dict[Future, str] = {}
    held, ended = 0, False
    with ThreadPoolExecutor(pace.at_once) as pool:
        while not ended or held or running:
            while not ended and held < 64 * pace.at_once:
                try:
                    host, url = next(urls)
                except StopIteration:
                    ended = True
                else:
                    waiting.setdefault(host, deque()).append(url)
                    held += 1
            now, soonest = time.monotonic(), 60.0
            for host in list(waiting):
                bucket = buckets.setdefault(host, Bucket(pace.rate, pace.burst, now))
                while waiting[host] and len(running) < pace.at_once:
                    pause = bucket.ready(now)
                    if pause > 0:
                        soonest = min(soonest, pause)
                        break
                    bucket.take()
                    url = waiting[host].popleft()
                    held -= 1
                    running[pool.submit(_tried, fetch, url, pace.tries)] = url
                if not waiting[host]:
                    del waiting[host]
            if running:
                done, _ = wait(running, timeout=soonest if held and len(running) < pace.at_once else None, return_when=FIRST_COMPLETED)
                for f in done:
                    yield (running.pop(f), *f.result())
            elif held:
                time.sleep(soonest)


def _journaled(folder: str) -> set[str]:
    """Addresses that a group's journal has."""
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    done: set[str] = set()
    for f in fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True)):
        if f.path.endswith(".parquet"):
            done.update(pyarrow.parquet.read_table(f.path, columns=["url"], filesystem=fs)["url"].to_pylist())
    return done


def _write(folder: str, entries: list[tuple]) -> None:
    """By way of another name, so that a journal has whole files only."""
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    name = f"{path}/{uuid.uuid4().hex}"
    pyarrow.parquet.write_table(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*entries, strict=True), ENTRY.types, strict=True)], schema=ENTRY), f"{name}.part", filesystem=fs)
    fs.move(f"{name}.part", f"{name}.parquet")


def fetch_all(addresses: DataFrame, fetch: Callable[[str], bytes | None], journal: str, pace: Pace = Pace(), url: str = "url") -> DataFrame:  # noqa: B008
    """(url, content, reason) of each distinct address, from the journal once all are there; a content or a reason why there is none.

    A host is what stands between // and the next /, without a port; addresses
    without one share an empty host. Null addresses are left out. Failed ones are
    in the journal too, and are not tried again by another run over it. The number of groups
    must stay the same for a journal, as each has a folder of its own.
    """
    spark = addresses.sparkSession
    host = F.lower(F.regexp_extract(F.col(url), r"^[^/]*//(?:[^/@]*@)?([^/:]*)", 1))
    one = addresses.select(F.col(url).cast("string").alias("url"), host.alias("host")).where("url IS NOT NULL").distinct()
    grouped = one.withColumn("g", F.pmod(F.xxhash64("host"), F.lit(pace.groups)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, done = None, set()

        def todo() -> Iterator[tuple[str, str]]:
            nonlocal group, done
            for b in batches:
                for g, h, u in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    if g != group:
                        group, done = g, _journaled(f"{journal}/{g}")
                    if u not in done:
                        of[u] = g
                        yield h, u

        of: dict[str, int] = {}  # of the addresses that are held or running
        entries: dict[int, list[tuple]] = {}
        n = 0
        try:
            for u, content, reason in paced(todo(), fetch, pace):
                g = of.pop(u)
                entries.setdefault(g, []).append((u, content, reason))
                if len(entries[g]) >= pace.flush:
                    n += len(entries[g])
                    _write(f"{journal}/{g}", entries.pop(g))
        finally:  # what has come stays, even if the task fails
            for g, some in entries.items():
                n += len(some)
                _write(f"{journal}/{g}", some)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    in_order = grouped.select("g", "host", "url").repartition(pace.groups, "g").sortWithinPartitions("g", F.xxhash64("url"))
    in_order.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()  # a number
    wanted = one.select("url")
    if not files._exists(spark, journal):
        return spark.createDataFrame([], _DDL)
    return spark.read.schema(_DDL).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(journal).dropDuplicates(["url"]).join(wanted, "url", "left_semi")
