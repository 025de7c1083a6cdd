"""Changes of silver that gold has not taken yet.

Before a silver table's files are replaced, the hours that change are written
to a small file in the pending folder. Gold reads all files it finds, and
deletes exactly those once its own write has been committed. Whatever fails in
between, in whichever order runs follow, a change is either pending or in gold:

    silver merge  ->  pending file  ->  silver files swapped  ->  gold written
                                                              ->  file deleted

A file says at most too much (the swap after it failed): gold then recomputes
hours that did not change. Files hold one line per changed day, so the folder
is a table of JSON rows (``pending_rows``).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from hourmill.session import child_names, put_small_text, read_small_text, remove_path

PENDING_SCHEMA = "feed string, version string, day string, hours int"


@dataclass
class Pending:
    files: list[str] = field(default_factory=list)
    everything: bool = False  # a feed was replaced whole
    #: Changed hours of each feed, as hours since the epoch.
    hours: dict[str, set[int]] = field(default_factory=dict)


def note(spark: SparkSession, folder: str, feed: str, dirty: Iterable[tuple[dt.date, int]], version: str | None = None) -> str:
    """Write the changed hours of ``feed`` (bits per day; no days: everything) to a new file; its path."""
    days = [{"day": day.isoformat(), "hours": bits} for day, bits in dirty] or [{"day": None, "hours": None}]
    lines = "\n".join(json.dumps({"feed": feed, "version": version, **d}) for d in days)
    path = f"{folder.rstrip('/')}/{feed}-{uuid.uuid4().hex}.json"
    put_small_text(spark, path, lines + "\n")
    return path


def outstanding(spark: SparkSession, folder: str) -> Pending:
    """What is noted now. Its size is bounded by the days that changed, not by rows."""
    found = Pending()
    for name in child_names(spark, folder):
        path = f"{folder.rstrip('/')}/{name}"
        text = read_small_text(spark, path)
        if text is None:  # another run has just settled it
            continue
        found.files.append(path)
        for line in text.splitlines():
            row = json.loads(line)
            if row["day"] is None:
                found.everything = True
                continue
            first = dt.date.fromisoformat(row["day"]).toordinal() - dt.date(1970, 1, 1).toordinal()
            found.hours.setdefault(row["feed"], set()).update(24 * first + h for h in range(24) if row["hours"] >> h & 1)
    return found


def settle(spark: SparkSession, done: Pending) -> None:
    """Delete the files ``done`` was read from; later ones stay."""
    for path in done.files:
        remove_path(spark, path)


def pending_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The folder as a table, for inspection."""
    if not child_names(spark, folder):
        return spark.createDataFrame([], PENDING_SCHEMA)
    return spark.read.schema(PENDING_SCHEMA).json(folder)


def dirty_hours(hours: dict[str, set[int]], spine: str, window_hours: int) -> set[int]:
    """Hours of gold that changed hours of its feeds reach.

    A row of the spine enters its own hour and the averages of the
    ``window_hours`` after it; a row of another feed its own hour only.
    """
    out: set[int] = set()
    for feed, changed in hours.items():
        reach = window_hours if feed == spine else 0
        out.update(h + i for h in changed for i in range(reach + 1))
    return out


def intervals(hours: Iterable[int]) -> list[tuple[int, int]]:
    """Hours merged into [first, last] runs."""
    out: list[tuple[int, int]] = []
    for h in sorted(hours):
        if out and h == out[-1][1] + 1:
            out[-1] = (out[-1][0], h)
        else:
            out.append((h, h))
    return out


def days_of(hours: Iterable[int]) -> list[dt.date]:
    return [dt.date(1970, 1, 1) + dt.timedelta(days=d) for d in sorted({h // 24 for h in hours})]
