"""A search service as a stream: an offset is the first day that hasn't been read, a partition a window of days.

A service tells days, ids and rows. Windows have no more ids than the service
lists at once; those of a batch share the allowed requests a second. What was
read is known to the stream's checkpoint alone: a run that broke off reads the
same days again, and the next run goes on with the day after.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from typing import Protocol

import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import files


class Service(Protocol):
    """What a search service answers; each call is one request."""

    def latest(self) -> str:
        """The last day that it is through with."""

    def count(self, first: str, last: str) -> int:
        """How many ids the days from first to last have."""

    def search(self, first: str, last: str, offset: int, page: int) -> list[str]:
        """A page of these ids, in an order that stays."""

    def fetch(self, ids: list[str]) -> list[dict]:
        """The rows of some ids."""


class Limiter:
    """Lets calls pass rate times a second at most; one that fails is tried again after 1, 2, 4, ... seconds, 60 at most."""

    def __init__(self, rate: float, tries: int = 5, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        self.gap, self.tries, self.clock, self.wait = 1 / rate, tries, clock, wait
        self.free = clock()

    def __call__(self, call: Callable, *args):
        for k in range(self.tries):
            now = self.clock()
            if now < self.free:
                self.wait(self.free - now)
            self.free = max(now, self.free) + self.gap
            try:
                return call(*args)
            except Exception:
                if k == self.tries - 1:
                    raise
                self.wait(min(60.0, 2.0**k))


class Window(InputPartition):
    """Days from first to last, and the requests a second that their reader may make."""

    def __init__(self, first: str, last: str, rate: float):
        super().__init__((first, last, rate))


def window_rows(service: Service, first: str, last: str, limited: Callable, page: int, chunk: int) -> Iterator[list[dict]]:
    """Rows of a window, a chunk at a time; an id that several pages give is read once."""
    ids: dict[str, None] = {}
    for offset in range(0, limited(service.count, first, last), page):
        ids.update(dict.fromkeys(limited(service.search, first, last, offset, page)))
    todo = list(ids)
    for lo in range(0, len(todo), chunk):
        yield limited(service.fetch, todo[lo : lo + chunk])


def _day_after(day: str, days: int = 1) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def search_stream(name: str, service: Service, page: int = 5000, chunk: int = 200, cap: int = 9998) -> type[DataSource]:
    """A data source for spark.readStream.format(name).schema(...).

    Options: first, the first day of all; last, the last day that may be read
    (by default the service's latest); rate, requests a second of all tasks
    together (3 by default). The service goes to tasks by pickle.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self, schema: StructType, options: dict[str, str]):
            self.schema, self.first, self.last, self.rate = schema, options["first"], options.get("last"), float(options.get("rate", 3))

        def initialOffset(self) -> dict:
            return {"next": self.first}

        def latestOffset(self) -> dict:
            latest = Limiter(self.rate)(service.latest)
            return {"next": max(self.first, _day_after(min(latest, self.last) if self.last else latest))}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            if start["next"] >= end["next"]:
                return []
            limited = Limiter(self.rate)
            windows = files.date_windows(lambda a, b: limited(service.count, a, b), start["next"], _day_after(end["next"], -1), cap)
            return [Window(a, b, self.rate / len(windows)) for a, b in windows]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            first, last, rate = partition.value
            kind = to_arrow_schema(self.schema)
            for rows in window_rows(service, first, last, Limiter(rate), page, chunk):
                yield pa.RecordBatch.from_pylist(rows, kind)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return Reader(schema, self.options)

    return Source


class DayFolder:
    """A service that answers from a folder of Parquet files, one subfolder day=YYYY-MM-DD for each day; ids are day/key."""

    def __init__(self, folder: str, key: str):
        self.folder, self.key = folder.rstrip("/"), key
        self.day: tuple[str, dict[str, dict]] = ("", {})

    def _files(self) -> tuple[pyarrow.fs.FileSystem, dict[str, list[str]]]:
        fs, path = pyarrow.fs.FileSystem.from_uri(self.folder)
        days: dict[str, list[str]] = {}
        for f in fs.get_file_info(pyarrow.fs.FileSelector(path, recursive=True)):
            if f.is_file and f.path.endswith(".parquet") and "/day=" in f.path:
                days.setdefault(f.path.rpartition("/day=")[2].split("/")[0], []).append(f.path)
        return fs, days

    def latest(self) -> str:
        return max(self._files()[1])

    def count(self, first: str, last: str) -> int:
        fs, days = self._files()
        return sum(pa.parquet.read_metadata(p, filesystem=fs).num_rows for d, paths in days.items() if first <= d <= last for p in paths)

    def search(self, first: str, last: str, offset: int, page: int) -> list[str]:
        fs, days = self._files()
        ids = [f"{d}/{k}" for d in sorted(days) if first <= d <= last for k in sorted(self._read(fs, days[d], [self.key])[self.key].to_pylist())]
        return ids[offset : offset + page]

    def fetch(self, ids: list[str]) -> list[dict]:
        out = []
        for id in ids:
            day, _, key = id.partition("/")
            if self.day[0] != day:
                fs, days = self._files()
                self.day = (day, {str(r[self.key]): r for r in self._read(fs, days[day]).to_pylist()})
            out.append(self.day[1][key])
        return out

    @staticmethod
    def _read(fs: pyarrow.fs.FileSystem, paths: list[str], columns: list[str] | None = None) -> pa.Table:
        return pyarrow.dataset.dataset(paths, format="parquet", filesystem=fs).to_table(columns=columns)
