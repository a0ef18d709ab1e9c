"""The raw file tree as a Spark source."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.functions import names
from echolattice.operators.ledger import in_range


#: Levels of the tree below a radar that carry time: as many characters of yyyymmddhh.
_LEVELS = (4, 6, 8, 10)


def _bounds(stamp: str) -> tuple[datetime, datetime]:
    """First instant of a folder's time and first instant after it; ``stamp`` is yyyy, yyyymm, yyyymmdd or yyyymmddhh."""
    first = datetime.strptime(stamp, "%Y%m%d%H"[: {4: 2, 6: 4, 8: 6, 10: 8}[len(stamp)]])
    if len(stamp) == 4:
        return first, first.replace(year=first.year + 1)
    if len(stamp) == 6:
        return first, (first.replace(day=28) + timedelta(days=4)).replace(day=1)
    return first, first + (timedelta(days=1) if len(stamp) == 8 else timedelta(hours=1))


def tree_folders(
    spark: SparkSession, base: str, radars: list[str] | None, start: datetime | None, end: datetime | None
) -> list[str]:
    """Folders of a file tree that hold the time between two instants (UTC), found from the top.

    A folder wholly within the bounds is taken as it is; only one that a bound falls
    into is looked into, so at most two folders of a level are listed for each radar.
    """
    context = spark.sparkContext
    path_of = context._jvm.org.apache.hadoop.fs.Path
    system = path_of(base).getFileSystem(context._jsc.hadoopConfiguration())
    low, high = start or datetime.min, end or datetime.max
    taken: list[str] = []

    def below(folder: str) -> list[tuple[str, str]]:
        found = system.globStatus(path_of(f"{folder}/*")) or []
        return sorted((s.getPath().getName(), s.getPath().toString()) for s in found if s.isDirectory())

    def look(folder: str, stamp: str) -> None:
        for name, path in below(folder):
            inner = stamp + name
            if not inner.isdigit() or len(inner) not in _LEVELS:
                continue
            first, after = _bounds(inner)
            if after <= low or first > high:
                continue
            if (low <= first and after <= high) or len(inner) == _LEVELS[-1]:
                taken.append(path)
            else:
                look(path, inner)

    for radar in [f"{base}/{r}" for r in radars] if radars else [path for _, path in below(base)]:
        look(radar, "")
    return taken


def scan_tree(
    spark: SparkSession,
    base: str,
    radars: list[str] | None = None,
    start: Column | datetime | None = None,
    end: Column | datetime | None = None,
    include_start: bool = True,
    include_end: bool = True,
    name_glob: str = "*.BUFR",
    content: bool = False,
    hours: list[str] | None = None,
) -> DataFrame:
    """Files under ``base/RADAR/yyyy/mm/dd/hh/mmss/`` between two instants.

    The name pattern is applied while listing, before a file is opened, and file
    content is only read when asked for.  ``radars``, ``hours`` (``yyyy/mm/dd/hh``) and bounds given as
    datetimes (UTC) narrow the listed folders themselves; bounds given as columns only filter.
    """
    paths = [f"{base}/{r}" for r in radars] if radars else [base]
    if hours:
        paths = [f"{p}/{h}/*" if radars else f"{p}/*/{h}/*" for p in paths for h in hours]
    bounds = [b for b in (start, end) if isinstance(b, datetime)]
    if bounds and not hours:
        paths = tree_folders(spark, base, radars, *(b if isinstance(b, datetime) else None for b in (start, end)))
        if not paths:
            return scan_tree(spark, base, content=content, name_glob=name_glob).limit(0)
    as_column = lambda b: F.lit(b.isoformat(sep=" ") + "+00:00").cast("timestamp") if isinstance(b, datetime) else b
    start, end = as_column(start), as_column(end)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob)
    listed = reader.load(paths)
    parts = names.parse_tree_path(F.col("path"))
    out = listed.select("path", "length", *[c.alias(n) for n, c in parts.items()], *(["content"] if content else []))
    if start is not None or end is not None:
        low = start if start is not None else F.lit("0001-01-01").cast("timestamp")
        high = end if end is not None else F.lit("9999-12-31").cast("timestamp")
        out = in_range(out, low, high, include_start, include_end)
    return out
