"""Which rollup buckets are behind their base table.

A publish of a rollup notes the version of the base it was computed from and
the buckets it left behind, because they were outside its refresh window. The
manifests of the base since then say which of its buckets changed, so no row
is read to find out. All this grows with buckets and publishes, not with rows.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable

from tidemark.operators.aggregate import Rollup
from tidemark.sinks.published import Manifest, PublishedTable, bucket_day, bucket_start

_SEEN, _BEHIND = "base_version", "behind"
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def following(width: str, start: dt.date) -> dt.date:
    """First day of the bucket after the one that starts on ``start``."""
    if width == "day":
        return start + dt.timedelta(days=1)
    year, month = divmod(start.year * 12 + start.month - 1 + _MONTHS[width], 12)
    return dt.date(year, month + 1, 1)


def overlapping(of: str, start: dt.date, width: str) -> set[dt.date]:
    """Buckets of ``width`` that share a day with the bucket of width ``of`` that starts on ``start``."""
    end, at, found = following(of, start), bucket_start(width, start), set()
    while at < end:
        found.add(at)
        at = following(width, at)
    return found


def _alike(old: dict | None, new: dict | None) -> bool:
    """Whether a bucket holds the same rows before and after a publish."""
    if old is None or new is None:
        return False
    if old["v"] == new["v"] or (old.get("print") is not None and old.get("print") == new.get("print")):
        return True
    # Compaction writes the rows of a bucket anew, in another order.
    return bool(new.get("compacted")) and old["rows"] == new["rows"]


def changed_buckets(base: PublishedTable, since: int, manifest: Manifest) -> set[str]:
    """Bucket folders that some publish after version ``since`` changed, added or removed."""
    changed: set[str] = set()
    before = base.manifest(since).buckets if since else {}
    for version in range(since + 1, manifest.version + 1):
        after = manifest.buckets if version == manifest.version else base.manifest(version).buckets
        changed |= {n for n in before.keys() | after.keys() if not _alike(before.get(n), after.get(n))}
        before = after
    return changed


def behind(table: PublishedTable, base: PublishedTable, manifest: Manifest, rollup: Rollup) -> set[dt.date]:
    """Buckets of the rollup that may not agree with the base as ``manifest`` has it.

    A rollup that was published without a note is behind in all its buckets.
    Rows without a date are in no window and are left out.
    """
    note = table.extra()
    if _SEEN in note:
        found = {dt.date.fromisoformat(d) for d in json.loads(note[_BEHIND])}
        names: Iterable[str] = changed_buckets(base, int(note[_SEEN]), manifest)
    else:
        found = {d for d in map(bucket_day, table.manifest().buckets) if d is not None}
        names = manifest.buckets
    for day in map(bucket_day, names):
        if day is not None:
            found |= overlapping(base.dataset.bucket_width, day, rollup.width)
    return found


def note(manifest: Manifest, left: Iterable[dt.date]) -> dict[str, str]:
    """What a publish of the rollup says of the base it was computed from."""
    return {_SEEN: str(manifest.version), _BEHIND: json.dumps(sorted(d.isoformat() for d in left))}
