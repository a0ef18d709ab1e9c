"""The raw file tree as a data source of its own: listed by executors, bounded by pushed filters, followed as a stream.

After :func:`register`, ``spark.read.format("radar_tree").load(base)`` or ``readStream``.
Files lie under ``base/RADAR/yyyy/mm/dd/hh/mmss/``.  The driver looks at radars and months only; each task lists
the days of one month of one radar.  Comparisons of ``radar`` and ``obs_ts`` with constants choose radars, months, days and hours before
they are listed (``spark.sql.python.filterPushdown.enabled``).

As a stream the offset is the newest observation seen.  A batch lists from the one before less a buffer (option ``buffer_minutes``), since
files of a volume arrive one after the other: names inside the buffer come again, and a sink that keeps each name once
(:func:`echolattice.streaming.ledger.dedup_sink`) drops them.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from echolattice.config import RESUME_BUFFER_MINUTES

SCHEMA = "path string, length long, radar string, filename string, obs_ts timestamp, field string"
#: strptime patterns of the folders below a radar, from years to minutes and seconds.
_LEVELS = ("%Y", "%m", "%d", "%H", "%M%S")
_FIRST = datetime(1900, 1, 1, tzinfo=timezone.utc)
_LAST = datetime(2900, 1, 1, tzinfo=timezone.utc)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a folder, and the folder there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _folders(system: fs.FileSystem, path: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def _utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def _span(parts: tuple[str, ...]) -> tuple[datetime, datetime] | None:
    """First instant of a folder and first instant after it; None for a name that is no time."""
    try:
        first = datetime.strptime(" ".join(parts), " ".join(_LEVELS[: len(parts)])).replace(tzinfo=timezone.utc)
    except ValueError:
        return None
    if len(parts) == 1:
        return first, first.replace(year=first.year + 1)
    if len(parts) == 2:
        return first, (first + timedelta(days=31)).replace(day=1)
    return first, first + (timedelta(days=1), timedelta(hours=1), timedelta(seconds=1))[len(parts) - 3]


class Month(InputPartition):
    def __init__(self, radar: str, year: str, month: str, low: datetime, high: datetime):
        self.radar, self.year, self.month, self.low, self.high = radar, year, month, low, high


class _Tree:
    """Listing of a tree between two instants, both included."""

    def __init__(self, options):
        self.base, self.pattern = options["path"].rstrip("/"), options.get("pattern", "*.BUFR")

    def months(self, radars: set[str] | None, low: datetime, high: datetime) -> list[Month]:
        system, base = file_system(self.base)
        out = []
        for radar in _folders(system, base):
            if radars is not None and radar not in radars:
                continue
            for year in self._within(system, f"{base}/{radar}", (), low, high):
                out += [Month(radar, year, month, low, high) for month in self._within(system, f"{base}/{radar}/{year}", (year,), low, high)]
        return out

    def _within(self, system: fs.FileSystem, path: str, above: tuple[str, ...], low: datetime, high: datetime) -> list[str]:
        spans = [(name, _span((*above, name))) for name in _folders(system, path)]
        return [name for name, span in spans if span is not None and span[1] > low and span[0] <= high]

    def files(self, part: Month) -> Iterator[tuple]:
        system, base = file_system(self.base)

        def look(path: str, above: tuple[str, ...]) -> Iterator[tuple]:
            if len(above) < len(_LEVELS):
                for name in self._within(system, path, above, part.low, part.high):
                    yield from look(f"{path}/{name}", (*above, name))
                return
            (seen, _) = _span(above)
            for info in system.get_file_info(fs.FileSelector(path)):
                if info.type == fs.FileType.File and fnmatch(info.base_name, self.pattern):
                    pieces = info.base_name.split("_")
                    yield posixpath.join(path, info.base_name), info.size, part.radar, info.base_name, seen, pieces[3] if len(pieces) > 3 else None

        yield from look(f"{base}/{part.radar}/{part.year}/{part.month}", (part.year, part.month))

    def newest(self) -> datetime | None:
        """The newest observation, found from the newest folder of each level of each radar."""
        system, base = file_system(self.base)

        def last(path: str, above: tuple[str, ...]) -> datetime | None:
            if len(above) == len(_LEVELS):
                return _span(above)[0]
            for name in reversed(_folders(system, path)):
                found = last(f"{path}/{name}", (*above, name)) if _span((*above, name)) else None
                if found is not None:
                    return found
            return None

        return max((x for x in (last(f"{base}/{radar}", ()) for radar in _folders(system, base)) if x is not None), default=None)


class TreeReader(DataSourceReader):
    def __init__(self, options):
        self.tree = _Tree(options)
        self.radars: set[str] | None = None
        self.low, self.high = _FIRST, _LAST

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Bounds only narrow the listing; Spark applies all filters again, so strictness may be ignored here."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("radar",) and isinstance(f, EqualTo | In):
                names = {value} if isinstance(f, EqualTo) else set(value)
                self.radars = names if self.radars is None else self.radars & names
            elif column == ("obs_ts",) and isinstance(value, datetime):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, _utc(value))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high = min(self.high, _utc(value))
            yield f

    def partitions(self) -> list[Month]:
        # A source without partitions is not allowed; a month that does not exist lists nothing.
        return self.tree.months(self.radars, self.low, self.high) or [Month("", "1900", "01", _LAST, _FIRST)]

    def read(self, partition: Month) -> Iterator[tuple]:
        yield from self.tree.files(partition) if partition.radar else ()


class TreeStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.tree = _Tree(options)
        self.buffer = timedelta(minutes=float(options.get("buffer_minutes", RESUME_BUFFER_MINUTES)))

    def initialOffset(self) -> dict:
        return {"newest": None}

    def latestOffset(self) -> dict:
        found = self.tree.newest()
        return {"newest": found and found.isoformat()}

    def partitions(self, start: dict, end: dict) -> list[Month]:
        if end["newest"] is None:
            return []
        low = _FIRST if start["newest"] is None else datetime.fromisoformat(start["newest"]) - self.buffer
        return self.tree.months(None, low, datetime.fromisoformat(end["newest"]))

    def read(self, partition: Month) -> Iterator[tuple]:
        yield from self.tree.files(partition)


class RadarTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "radar_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)

    def streamReader(self, schema) -> TreeStreamReader:
        return TreeStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let Spark push filters to sources in Python, without which it refuses one that takes them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RadarTree)
