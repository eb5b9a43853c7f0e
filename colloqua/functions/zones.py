"""Zone transition tables for vectorised conversion of local times to UTC."""

from __future__ import annotations

import datetime as dt
import functools
import zoneinfo
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Years for which transitions are tabled. Before the first the earliest offset goes on;
#: after the last the rules repeat with the calendar, every 400 years.
FIRST_YEAR, LAST_YEAR = 1800, 2500
#: Days between probes up to a year: single transitions are listed that far, later ones follow a yearly rule.
_PROBES = ((2100, 7), (LAST_YEAR, 28))
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


#: (UTC seconds at which an offset begins, the offset) of a zone.
Table = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Tables:
    """Transition tables by zone name, and the version of the zone database they were made from."""

    version: str
    zones: dict[str, Table]

    def get(self, name: str) -> Table | None:
        return self.zones.get(name)


def table_version(tzpath: tuple[str, ...] | None = None) -> str:
    """Version of the zone database at ``tzpath``, the system's unless given."""
    for folder in tzpath or zoneinfo.TZPATH:
        try:
            with open(f"{folder}/tzdata.zi", encoding="utf-8") as head:
                return head.readline().split()[-1]
        except OSError:
            continue
    try:
        import tzdata
    except ImportError:
        return "unknown"
    return tzdata.IANA_VERSION


def _loaded(name: str, tzpath: tuple[str, ...] | None) -> zoneinfo.ZoneInfo | None:
    if tzpath is None:
        try:
            return zoneinfo.ZoneInfo(name)
        except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
            return None
    for folder in tzpath:
        try:
            with open(f"{folder}/{name}", "rb") as file:
                return zoneinfo.ZoneInfo.from_file(file, key=name)
        except (ValueError, OSError):
            continue
    return None


@functools.lru_cache(maxsize=4)
def known_names(tzpath: tuple[str, ...] | None = None) -> frozenset[str]:
    """Names of the zone database."""
    if tzpath is None:
        return frozenset(zoneinfo.available_timezones())
    import pathlib

    return frozenset(str(p.relative_to(f)) for f in map(pathlib.Path, tzpath) for p in f.rglob("*") if p.is_file() and p.read_bytes()[:4] == b"TZif")


def make_tables(names: Iterable[str], tzpath: tuple[str, ...] | None = None) -> Tables:
    """Tables of the zones that are known among ``names``."""
    made = {name: transitions(name, tzpath) for name in names}
    return Tables(table_version(tzpath), {name: table for name, table in made.items() if table is not None})


def _offset(zone: zoneinfo.ZoneInfo, second: int) -> int:
    return int((_EPOCH + dt.timedelta(seconds=second)).astimezone(zone).utcoffset().total_seconds())


def _start(year: int) -> int:
    return int((dt.datetime(year, 1, 1, tzinfo=dt.timezone.utc) - _EPOCH).total_seconds())


#: Where the tables end, and the length of the calendar's period.
_END, _PERIOD = _start(LAST_YEAR) - 86400, 146_097 * 86400


@functools.lru_cache(maxsize=1024)
def transitions(name: str, tzpath: tuple[str, ...] | None = None) -> Table | None:
    """The table of a zone; None for an unknown name.

    The first entry stands for all time before the first transition. Made by
    probing the zone database step by step and halving the steps that differ, so
    that it holds for rules that reach into the future as well.
    """
    if (zone := _loaded(name, tzpath)) is None:
        return None
    at, offsets = [np.iinfo(np.int64).min // 4], [_offset(zone, _start(FIRST_YEAR))]
    low, before = _start(FIRST_YEAR), offsets[0]
    for year, days in _PROBES:
        last = _start(year)
        while low < last:
            high = min(low + days * 86400, last)
            after = _offset(zone, high)
            if after != before:
                a, b = low, high
                while b - a > 1:
                    middle = (a + b) // 2
                    if _offset(zone, middle) == before:
                        a = middle
                    else:
                        b = middle
                at.append(b)
                offsets.append(after)
            low, before = high, after
    return np.array(at, dtype=np.int64), np.array(offsets, dtype=np.int64)


def local_to_utc(seconds: np.ndarray, found: Table | None) -> tuple[np.ndarray, np.ndarray]:
    """(UTC seconds, valid) of local wall-clock seconds in a zone.

    A time that occurs twice means the earlier instant; one the clock skips, and
    any time in an unknown zone, is invalid.
    """
    if found is None:
        return np.zeros_like(seconds), np.zeros(len(seconds), dtype=bool)
    at, offsets = found
    later = np.maximum(-(-(seconds - _END) // _PERIOD), 0) * _PERIOD
    seconds = seconds - later
    # Each stretch of constant offset covers [at + offset, next at + offset) in local time.
    starts = at + offsets
    ends = np.append(at[1:], np.iinfo(np.int64).max // 4) + offsets
    # The stretch that holds the time, searched among a candidate and its neighbours: the earliest wins.
    guess = np.searchsorted(at, seconds, "right") - 1
    utc, valid = np.zeros_like(seconds), np.zeros(len(seconds), dtype=bool)
    for step in (-2, -1, 0, 1, 2):
        k = np.clip(guess + step, 0, len(at) - 1)
        hit = ~valid & (seconds >= starts[k]) & (seconds < ends[k])
        utc[hit] = seconds[hit] - offsets[k[hit]] + later[hit]
        valid |= hit
    return utc, valid
