"""Mixed timestamp formats and zones, normalised to microseconds since 1970 UTC.

Each value is reduced to a shape mask: every digit becomes ``0``, the rest stays.
A mask is mapped to a parser once per Python worker: its runs of digits become
their length (``d4``) and its words their class (month name, weekday, zone
abbreviation, half of the day), and the form this is gives where each field
stands. As all values of a mask have their fields at the same places, they are
converted together by array operations over a table of their characters, and
local times go through tables of zone transitions, which the driver makes once
and sends with the version of the zone database they come from.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloqua.functions import zones

MONTHS = {m: i for i, m in enumerate(
    "jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
MONTHS |= {m: i for i, m in enumerate(
    "january february march april may june july august september october november december".split(), 1)}
MONTHS |= {"sept": 9}
WEEKDAYS = set("mon tue wed thu fri sat sun tues thur thurs monday tuesday wednesday thursday friday saturday sunday".split())
#: Offsets in hours of zone abbreviations (RFC 822 and common European and Asian ones). CST is the American one;
#: pass others, like ``{**ABBREVIATIONS, "cst": 8}`` for Chinese exports, as ``abbreviations``.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
    "wet": 0, "west": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "bst": 1, "msk": 3,
    "hkt": 8, "sgt": 8, "jst": 9, "kst": 9, "aest": 10, "aedt": 11, "nzst": 12, "nzdt": 13,
}
HALVES = {"am": "am", "pm": "pm", "上午": "am", "下午": "pm", "凌晨": "am", "早上": "am", "晚上": "pm", "中午": "noon"}

_TOKEN = re.compile(r"0+|上午|下午|凌晨|早上|晚上|中午|[^\W\d_]+|.", re.S)
_TIME = r"(?P<H>d[12])(?::(?P<M>d2)(?::(?P<S>d2)(?:[.,](?P<f>d\d+))?)?)"
_ZONE = r"(?: ?(?P<zw><zone>)| ?(?P<zg><zone>)?(?P<zs>[+-])(?P<zh>d[124])(?::(?P<zm>d2))?)?"
_FORMS = [
    # 2021-03-04 05:06:07.123 +08:00, 2021/3/4 5:06, 2021-03-04T05:06:07Z
    rf"(?P<y>d4)[-/](?P<m>d[12])[-/](?P<d>d[12])(?:[ ,]| ?<t> ?){_TIME}{_ZONE}",
    # 2021年3月4日 下午5:06:07
    rf"(?P<y>d4)年(?P<m>d[12])月(?P<d>d[12])[日号] ?(?P<half><half>)? ?{_TIME}{_ZONE}",
    r"(?P<y>d4)年(?P<m>d[12])月(?P<d>d[12])[日号] ?(?P<half><half>)? ?(?P<H>d[12])[时時点點](?:(?P<M>d[12])分(?:(?P<S>d[12])秒)?)?",
    # 04.03.2021 05:06:07 (day first)
    rf"(?P<d>d[12])\.(?P<m>d[12])\.(?P<y>d4),? {_TIME}{_ZONE}",
    # Thu, 04 Mar 2021 05:06:07 +0800
    rf"(?:<day>,? )?(?P<d>d[12])[ -](?P<mon><mon>)[ -](?P<y>d4),? {_TIME}{_ZONE}",
    # Mar 4, 2021 5:06:07 PM
    rf"(?:<day>,? )?(?P<mon><mon>)\.? (?P<d>d[12]),? (?P<y>d4),? (?:at )?{_TIME}(?: ?(?P<half><half>))?{_ZONE}",
    # Thu Mar 4 05:06:07 2021
    rf"<day> (?P<mon><mon>) (?P<d>d[12]) {_TIME}(?: (?P<zw><zone>))? (?P<y>d4)",
    # 20210304T050607Z
    rf"(?P<ymd>d8)(?:<t>| )(?P<hms>d[46])(?:[.,](?P<f>d\d+))?{_ZONE}",
    # epoch seconds, whole or with a fraction, milli-, micro- and nanoseconds, by length
    r"(?P<e>d10)(?:\.(?P<f>d\d+))?",
    r"(?P<e3>d13)", r"(?P<e6>d16)", r"(?P<e9>d19)",
    # a local time written out: with seconds, without, with milliseconds
    r"(?P<packed>d(?:12|14|17))",
]
_FORMS = [re.compile(f"(?:{f})$") for f in _FORMS]
_INVISIBLE = {"Cf", "Cc", "Mn", "Me"}


def tidy(value: str) -> str:
    """Width and compatibility forms folded, invisible characters out, decimal digits of any script as ASCII, blanks single."""
    if not value.isascii():
        value = unicodedata.normalize("NFKC", value)
        value = "".join(c for c in value if c in "\t\n\r" or unicodedata.category(c) not in _INVISIBLE)
        value = value.replace("−", "-").replace("–", "-").replace("—", "-").replace("‐", "-")
        value = "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in value)
    return " ".join(value.split())


_MASK = str.maketrans("123456789", "000000000")


def mask_of(value: str) -> str:
    """The shape of a tidy value."""
    return value.translate(_MASK)


@dataclass(frozen=True)
class Parser:
    """Where the digit fields of a mask stand, the words its other fields are, and the sign of its offset."""

    spans: Mapping[str, tuple[int, int]]
    words: Mapping[str, str]
    sign: int


@functools.lru_cache(maxsize=65536)
def parser(mask: str) -> Parser | None:
    """The parser of a mask; None for a mask that's no time."""
    shape, spans, at = [], [], 0
    for token in _TOKEN.findall(mask):
        low = token.lower()
        if token[0] == "0":
            kind = f"d{len(token)}"
        else:
            classes = ((MONTHS, "<mon>"), (HALVES, "<half>"), (WEEKDAYS, "<day>"), (_ZONE_WORD, "<zone>"), ({"t"}, "<t>"))
            kind = next((name for known, name in classes if low in known), low if low == "at" else token)
        shape.append(kind)
        spans.append((at, at + len(token)))
        at += len(token)
    starts, n = {}, 0
    for kind, span in zip(shape, spans):
        starts[n] = span
        n += len(kind)
    for form in _FORMS:
        if m := form.match("".join(shape)):
            digits, words = {}, {}
            for name, text in m.groupdict().items():
                if text is None or name == "zs":
                    continue
                a, b = starts[m.start(name)]
                if text.startswith("<"):
                    words[name] = mask[a:b].lower()
                else:
                    digits[name] = (a, b)
            return Parser(digits, words, -1 if m.groupdict().get("zs") == "-" else 1)
    return None


class _ZoneWords:
    """Any short word may be a zone; which ones are known is a parameter of the conversion."""

    def __contains__(self, word: str) -> bool:
        return word.isascii() and word.isalpha() and 1 <= len(word) <= 5 and word not in ("t", "at")


_ZONE_WORD = _ZoneWords()


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(days since 1970, valid) in the proleptic Gregorian calendar."""
    valid = (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1)
    month = (np.where(valid, y, 1970) - 1970) * 12 + np.where(valid, m, 1) - 1
    start = month.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    length = (month + 1).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) - start
    valid &= d <= length
    return start + d - 1, valid


def convert(
    mask: str, values: list[str], zone: np.ndarray, tables: zones.Tables, abbreviations: Mapping[str, float] = ABBREVIATIONS
) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds, valid) of all values with one mask; ``zone`` names the zone of local times."""
    n, found = len(values), parser(mask)
    nothing = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    if found is None or any(found.words.get(k, "z") not in abbreviations for k in ("zw", "zg")):
        return nothing
    chars = np.frombuffer("".join(values).encode("utf-32-le"), dtype=np.uint32).reshape(n, len(mask))
    spans, words = found.spans, found.words

    def number(a: int, b: int) -> np.ndarray:
        out = np.zeros(n, dtype=np.int64)
        for i in range(a, b):
            out = out * 10 + (chars[:, i].astype(np.int64) - 48)
        return out

    def field(name: str) -> np.ndarray:
        return number(*spans[name]) if name in spans else np.zeros(n, dtype=np.int64)

    micros = np.zeros(n, dtype=np.int64)
    if "f" in spans:
        a, b = spans["f"]
        b = min(b, a + 6)
        micros = number(a, b) * 10 ** (6 - (b - a))
    for name, scale, cut in (("e", 1_000_000, 1), ("e3", 1000, 1), ("e6", 1, 1), ("e9", 1, 1000)):
        if name in spans:
            return field(name) // cut * scale + micros, np.ones(n, dtype=bool)
    if "packed" in spans or "ymd" in spans:
        a, b = spans["packed"] if "packed" in spans else spans["ymd"]
        y, m, d = number(a, a + 4), number(a + 4, a + 6), number(a + 6, a + 8)
        a, b = (a + 8, b) if "packed" in spans else spans["hms"]
        hour, minute = number(a, a + 2), number(a + 2, a + 4)
        second = number(a + 4, a + 6) if b >= a + 6 else np.zeros(n, dtype=np.int64)
        if b == a + 9:
            micros = number(a + 6, b) * 1000
    else:
        y, d, hour, minute, second = (field(k) for k in ("y", "d", "H", "M", "S"))
        m = np.full(n, MONTHS[words["mon"]], dtype=np.int64) if "mon" in words else field("m")
    valid = (hour <= 23) & (minute <= 59) & (second <= 59)
    if "half" in words:
        half = HALVES[words["half"]]
        # AM and PM go with a clock of 12 hours; the other words also with one of 24, where they don't contradict it.
        if words["half"] in ("am", "pm"):
            valid &= (hour >= 1) & (hour <= 12)
        elif half == "am":
            valid &= hour <= 12
        if half == "pm":
            hour = np.where(hour < 12, hour + 12, hour)
        elif half == "am":
            hour = np.where(hour == 12, 0, hour)
        else:
            hour = np.where(hour < 11, hour + 12, hour)
    days, dated = _days(y, m, d)
    valid &= dated
    seconds = days * 86400 + hour * 3600 + minute * 60 + second
    if "zh" in spans:
        a, b = spans["zh"]
        zh, zm = (number(a, b - 2), number(b - 2, b)) if b - a > 2 else (number(a, b), field("zm"))
        valid &= (zh <= 18) & (zm <= 59)
        seconds = seconds - (zh * 3600 + zm * 60) * found.sign
    elif "zw" in words:
        seconds = seconds - int(abbreviations[words["zw"]] * 3600)
    else:
        names, which = np.unique(zone, return_inverse=True)
        for k, name in enumerate(names.tolist()):
            own = which == k
            seconds[own], known = zones.local_to_utc(seconds[own], tables.get(name))
            valid[own] &= known
    return seconds * 1_000_000 + micros, valid


def to_micros(
    values: list[str | None], zone: list[str | None], tables: zones.Tables, abbreviations: Mapping[str, float] = ABBREVIATIONS
) -> pa.Array:
    """The instants of written times, null where there is none; ``tables`` has the zones by name."""
    groups: dict[str, tuple[list[int], list[str]]] = defaultdict(lambda: ([], []))
    for i, value in enumerate(values):
        # The longest form has fewer than 64 characters; longer values are no times.
        if value is not None and len(value := tidy(value)) < 100:
            at, same = groups[mask_of(value)]
            at.append(i)
            same.append(value)
    out, null = np.zeros(len(values), dtype=np.int64), np.ones(len(values), dtype=bool)
    names = np.array(["" if z is None else z for z in zone], dtype=object).astype(str)
    for mask, (at, same) in groups.items():
        if parser(mask) is not None:
            where = np.array(at)
            micros, valid = convert(mask, same, names[where], tables, abbreviations)
            out[where], null[where] = micros, ~valid
    return pa.array(out, mask=null)


def zones_of(frames: list[DataFrame], tzpath: tuple[str, ...] | None = None) -> zones.Tables:
    """Tables of the zones named in the one column of each frame.

    Only names of the zone database are kept, which bounds what comes to the
    driver by its size of some 600 names.
    """
    known = sorted(zones.known_names(tzpath))
    named = frames[0].toDF("z")
    for frame in frames[1:]:
        named = named.unionByName(frame.toDF("z"))
    used = [r.z for r in named.where(F.col("z").isin(known)).distinct().limit(len(known)).collect()]
    return zones.make_tables(used, tzpath)


def normalise_timestamps(
    df: DataFrame,
    rooms: DataFrame,
    value: str = "create_time",
    room: str = "room_name",
    own_zone: str = "export_zone",
    room_zone: str = "zone_name",
    to: str = "utc_us",
    abbreviations: Mapping[str, float] = ABBREVIATIONS,
    tzpath: tuple[str, ...] | None = None,
) -> DataFrame:
    """``df`` with ``to``: microseconds since 1970 UTC that each ``value`` denotes, null if none.

    Further digits of a fraction are cut, missing seconds are 0. Digits alone are
    epoch seconds (10), milli- (13), micro- (16) or nanoseconds (19) or a local
    time written out (12, 14, 17). A time without zone is local in ``own_zone``
    or, if that is null, in its room's ``room_zone``; one that occurs twice means
    the earlier instant, one that the clock skips, or that has no known zone,
    gives null. AM and PM take hours from 1 to 12; 上午 and its like up to 12; 下午,
    晚上 and 中午 any. Dotted dates have the day first. Zone words that aren't in
    ``abbreviations`` make no time.

    Null, empty, blank and very long values give null; a room that isn't listed
    has no zone; repeated rows each count; repeated rooms count once (the
    smallest zone name); empty tables give an empty result; other columns pass
    through (names with ``__`` in front are reserved).

    Plan: the rooms are joined by name as a left join; they grow with the data,
    so no broadcast is asked for: Spark's size check decides, and a hot room is
    split by adaptive skew join, as the rooms' side is unique. The zones in use
    are made into tables on the driver, from the zone database at ``tzpath`` (the
    system's unless given), and sent to the executors with its version, so that
    all of them convert by one version, whatever is installed there.
    """
    zone_of = rooms.groupBy(F.col(room).alias("__room")).agg(F.min(room_zone).alias("__zone"))
    joined = df.join(zone_of, df[room] == zone_of["__room"], "left").withColumn("__zone", F.coalesce(df[own_zone], F.col("__zone"))).drop("__room")
    tables = zones_of([df.select(own_zone), rooms.select(room_zone)], tzpath)
    known = dict(abbreviations)
    place, zone_place = joined.columns.index(value), joined.columns.index("__zone")
    kept = [i for i in range(len(joined.columns)) if i != zone_place]
    schema = df.withColumn(to, F.lit(None).cast("long")).schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            written, zone = (batch.column(i).to_pylist() for i in (place, zone_place))
            columns = {schema.names[k]: batch.column(i) for k, i in enumerate(kept)}
            columns[to] = to_micros(written, zone, tables, known)
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], names=schema.names)

    return joined.mapInArrow(step, schema)
