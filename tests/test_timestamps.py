import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest

from colloqua.functions import zones
from colloqua.operators import timestamps
from colloqua.operators.timestamps import ABBREVIATIONS, normalise_timestamps

UTC = dt.timezone.utc
EPOCH = dt.datetime(1970, 1, 1, tzinfo=UTC)
ZONES = ["Asia/Shanghai", "Europe/London", "Australia/Sydney", "Asia/Kolkata", "Asia/Kathmandu", "UTC",
         "America/New_York", "Australia/Lord_Howe", "Europe/Berlin"]


def to_micros(values, zone):
    return timestamps.to_micros(values, zone, zones.make_tables(z for z in set(zone) if z)).to_pylist()


def micros(when):
    return (when - EPOCH) // dt.timedelta(microseconds=1)


def local(wall, zone):
    """Brute force: the earlier instant, None for a skipped time."""
    when = wall.replace(tzinfo=ZoneInfo(zone), fold=0).astimezone(UTC)
    back = when.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    return micros(when) if back == wall else None


@pytest.mark.parametrize("zone", ZONES)
def test_local_times_against_brute_force(zone):
    rng = random.Random(zone)
    walls = [dt.datetime(2015, 1, 1) + dt.timedelta(seconds=rng.randrange(10 * 365 * 86400)) for _ in range(400)]
    for at, _ in zip(*map(list, zones.transitions(zone))):
        if 1_400_000_000 < at < 1_750_000_000:
            near = (EPOCH + dt.timedelta(seconds=int(at))).replace(tzinfo=None)
            walls += [near + dt.timedelta(minutes=m) for m in range(-900, 900, 13)]
    text = [w.strftime("%Y-%m-%d %H:%M:%S") for w in walls]
    assert to_micros(text, [zone] * len(text)) == [local(w, zone) for w in walls]


def test_forms():
    at = dt.datetime(2021, 3, 4, 17, 6, 7, tzinfo=UTC)
    us = micros(at)
    berlin = us - 3600 * 10**6
    cases = {
        "2021-03-04 17:06:07": berlin, " 2021-03-04  17:06:07 ": berlin, "2021-03-04T17:06:07.123": berlin + 123000,
        "２０２１－０３－０４ １７：０６：０７": berlin, "2021​-03-04 17:06:07": berlin,
        "2021-03-04T17:06:07Z": us, "2021-03-04T17:06:07.123456789Z": us + 123456,
        "2021-03-04T18:06:07+01:00": us, "2021-03-04 12:06:07.5 -0500": us + 500000,
        "Thu, 04 Mar 2021 18:06:07 +0100": us, "Mar 4, 2021 5:06:07 PM": berlin, "Mar 4, 2021 12:06:07 AM": berlin - 17 * 3600 * 10**6,
        "2021年3月4日 下午5:06:07": berlin, "2021年3月4日 上午12:06:07": berlin - 17 * 3600 * 10**6,
        "04.03.2021 17:06:07": berlin, "2021/3/4 17:06": berlin - 7 * 10**6, "20210304T170607Z": us, "20210304170607": berlin,
        "1614877567": us, "1614877567.25": us + 250000, "1614877567123": us + 123000, "1614877567123456": us + 123456,
        "1614877567123456789": us + 123456, "2021-03-04 12:06:07 EST": us, "2021-03-04 18:06:07 CET": us,
        "": None, " ": None, "-": None, "N/A": None, "unknown": None, "刚刚": None, "昨天 12:30": None,
        "2021-02-30 10:00:00": None, "2020-13-01 08:00:00": None, "2022-04-05 25:10:00": None, "0000-00-00 00:00:00": None,
        "2019-06-31T07:15:00Z": None, "2021-03-28 02:30:00": None, "9" * 100000: None, "x" * 100000: None,
        "2021-10-31 02:30:00": micros(dt.datetime(2021, 10, 31, 0, 30, tzinfo=UTC)),
    }
    got = to_micros(list(cases), ["Europe/Berlin"] * len(cases))
    assert dict(zip(cases, got)) == cases
    assert to_micros([None, "2021-03-04 17:06:07", "2021-03-04 17:06:07"], ["UTC", None, "No/Where"]) == [None] * 3


def test_hours_go_by_their_own_half_day_word():
    at = lambda h, m=5: micros(dt.datetime(2024, 3, 10, h, m, tzinfo=UTC))
    cases = {
        "Mar 10, 2024 13:05:00 PM": None, "Mar 10, 2024 13:05:00 AM": None, "Mar 10, 2024 00:05:00 PM": None, "Mar 10, 2024 12:05:00 PM": at(12), "Mar 10, 2024 01:05:00 am": at(1),
        "Mar 10, 2024 12:05:00 AM": at(0), "2024年3月10日 下午13:05": at(13), "2024年3月10日 下午01:05": at(13), "2024年3月10日 晚上23:05": at(23), "2024年3月10日 上午13:05": None,
        "2024年3月10日 凌晨00:05": at(0), "2024年3月10日 中午12:05": at(12), "2024年3月10日 AM01:05": at(1), "2024年3月10日 PM13:05": None,
    }
    assert to_micros(list(cases), ["UTC"] * len(cases)) == list(cases.values())
    assert [to_micros([c], ["UTC"])[0] for c in cases] == list(cases.values())


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Asia/Shanghai", "Africa/Casablanca"])
def test_years_far_from_now(zone):
    walls = [dt.datetime(year, month, 1, 12) for year in (1, 1850, 1899, 1950, 2099, 2100, 2150, 2499, 2500, 2777, 3500, 9000) for month in (1, 7)]
    found = to_micros([f"{w.year:04d}-{w:%m-%d %H:%M:%S}" for w in walls], [zone] * len(walls))
    assert found == [local(w, zone) for w in walls]


def test_zone_words_are_a_parameter():
    at = micros(dt.datetime(2024, 3, 10, 4, tzinfo=UTC))
    texts = ["2024-03-10 12:00:00 CST", "2024-03-10 04:00:00 UTC", "2024-03-10 12:00 GMT+8", "2024-03-10 12:00 QQQ", "2024-03-10 12:00 QQQ+8"]
    none = zones.make_tables([])
    assert to_micros(texts, ["UTC"] * 5) == [at + 14 * 3600 * 10**6, at, at, None, None]
    assert timestamps.to_micros(texts, [None] * 5, none, {**ABBREVIATIONS, "cst": 8}).to_pylist() == [at, at, at, None, None]
    assert timestamps.to_micros(["٢٠٢٤-٠٣-١٠ ٠٤:٠٠:٠٠Z", "2024-03-10 04:00:00"], ["UTC", "UTC"], none).to_pylist() == [at, None]
    assert none.version and zones.make_tables(["Asia/Tokyo"], zones.zoneinfo.TZPATH).get("Asia/Tokyo")[1][-1] == 32400


def test_zone_of_row_before_zone_of_room(spark):
    raw = spark.createDataFrame(
        [(1, "a", "2021-03-04 17:06:07", "UTC", "x"), (2, "a", "2021-03-04 17:06:07", None, "x"),
         (3, None, "2021-03-04 17:06:07", None, "x"), (4, "b", None, None, "x"), (5, None, "1614877567", None, "x")],
        "raw_id long, room_name string, create_time string, export_zone string, zone_name string")
    rooms = spark.createDataFrame([("a", "Asia/Kolkata"), ("a", "Asia/Kolkata"), ("b", "UTC")], "room_name string, zone_name string")
    got = {r.raw_id: r.utc_us for r in normalise_timestamps(raw, rooms).collect()}
    us = 1614877567 * 10**6
    assert got == {1: us, 2: us - 19800 * 10**6, 3: None, 4: None, 5: us}
    assert normalise_timestamps(raw.limit(0), rooms).collect() == []
