"""Repeats, conversations and turns on small tables, with nulls, ties, repeats and empty tables."""

import datetime as dt
import os
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle import assert_same, connect  # noqa: E402

from colloqua.llm import conversations as C  # noqa: E402
from colloqua.llm.conversations import rebuild_conversations, rebuild_messages  # noqa: E402
from colloqua.llm.queries import ORACLES, QUERIES  # noqa: E402
from colloqua.llm.repeats import collapse_repeats  # noqa: E402
from colloqua.llm.turns import bare, clean_speech, resolve_labels, speaker_turns  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)
MSG = "row_id long, room_name string, is_sender int, talker string, msg string, create_time timestamp, text string, side int, us long"


def messages(spark, rows):
    """(room, second, side, msg, talker) with ids in order; extra columns clash with the operators' own names."""
    return spark.createDataFrame(
        [(i, room, side, talker, msg, None if t is None else T0 + dt.timedelta(seconds=t), "x", 7, 9) for i, (room, t, side, msg, talker) in enumerate(rows)], MSG)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    found = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert_same(found, connect(FOLDER), ORACLES[name])
    else:
        assert found.count() >= 0


def runs(df):
    return sorted((r.first_row_id, r.last_row_id, r.n_events, (r.last_us - r.first_us) // 10**6) for r in collapse_repeats(df).collect() if r.n_events > 1)


def pair(spark, a, b):
    return len(runs(messages(spark, [("r", 0, 0, a, "t"), ("r", 1, 0, b, "t")]))) == 1


@pytest.mark.parametrize("a, b, same", [
    ("Ok!", "ｏｋ", True), ("好 的", "好的。", True), ("收到", "收到到到", True), ("got it, thanks", "got it, thavnks", True), ("same here", "sam here", True),
    ("good one", "god one", True), ("abc", "abd", False), ("还剩10分钟就开始", "还剩11分钟就开始", False), ("costs 111 now", "costs 11 now", False),
    ("再试试看看好不好", "再试试瞧一瞧好不好", False), ("？？", "！！", False), ("x" * 50000, "x" * 50001, True), ("ab" * 20000, "ab" * 20000 + "c", True),
])
def test_near_same(spark, a, b, same):
    assert pair(spark, a, b) is same


def test_repeats(spark):
    df = messages(spark, [
        ("r", 0, 0, "hello", "t"), ("r", 0, 0, "HELLO", "t"), ("r", 4000, 0, "hello!", None), ("r", 4001, 1, "hello", "t"), ("r", 4002, None, "hello", "t"),
        ("r", 4003, None, "hello", "t"), ("r", 4004, 0, None, "t"), ("r", 4005, 0, "\u200b", "t"), ("r", None, 0, "hello", "t"),
        (None, 1, 2, "one", "t"), (None, 9000, 2, "one", "t"), ("q", 5, 0, "one", "t")])
    assert runs(df) == [(0, 2, 3, 4000), (9, 10, 2, 8999)]
    assert runs(df.limit(0)) == []


def test_repeats_against_plain_loop(spark):
    rng = random.Random(2)
    rows, t = [], 0
    for _ in range(400):
        t += rng.choice([0, 1, 50, 3600, 5000])
        rows.append(("r", t, rng.choice([0, 1, None]), rng.choice(["yes", "no"]), "t"))
    want, run = [], [0]
    for i in range(1, len(rows) + 1):
        if i < len(rows) and rows[i][2] is not None and rows[i][2:4] == rows[i - 1][2:4]:
            run.append(i)
            continue
        if len(run) > 1:
            want.append((run[0], run[-1], len(run), rows[run[-1]][1] - rows[run[0]][1]))
        run = [i]
    assert runs(messages(spark, rows)) == sorted(want)


def conversations(df):
    return sorted((str(r.room), r.first_id, r.last_id, r.n_msgs, r.n_turns) for r in rebuild_conversations(df).collect())


def test_conversations(spark):
    day = 86400
    df = messages(spark, [
        ("a", 0, 0, "q", "t"), ("a", 3600, 1, "r", "t"), ("a", 7201, 0, "alone", "t"),  # 3600 s goes on, 3601 s doesn't
        ("b", 0, 1, "r", "t"), ("b", 1, 0, "q", "t"),  # the reply comes first
        ("c", 0, 0, "q", "t"), ("c", 1, 1, "r", " "),  # blank talker
        ("d", 0, 0, "q", "t"), ("d", 1, 2, "x", "t"), ("d", 2, 1, "r", "t"),  # side 2
        ("e", 0, 0, "\u200b", "t"), ("e", 1, 0, "q", "t"), ("e", 1, 1, "r", "t"), ("e", 1, 1, "r", "t"), ("e", 2, 1, None, "t"),
        (None, 5, 0, "q", "t"), (None, 6, 1, "r", "t"), (None, None, 1, "r", "t"),
        ("f", day - 2, 0, "q", "t"), ("f", day + 2, 0, "q", "t"), ("f", day + 3, 1, "r", "t"), ("f", day + 4, 0, "q", "t")])
    assert conversations(df) == [("None", 15, 16, 2, 2), ("a", 0, 1, 2, 2), ("e", 11, 13, 3, 2), ("f", 18, 21, 4, 3)]
    assert conversations(df.limit(0)) == []


def test_conversations_against_plain_loop(spark):
    rng = random.Random(4)
    rows = []
    for room in ("a", "b", "c"):
        t = 0
        for _ in range(250):
            t += rng.choice([0, 5, 600, 3600, 3601, 3600, 3000, 9000])
            rows.append((room, t, rng.choice([0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 2, None]), rng.choice(["x", "y", "", None]), "t"))
    want = []
    for room in ("a", "b", "c"):
        own = [(i, *r[1:]) for i, r in enumerate(rows) if r[0] == room]
        parts = [[own[0]]]
        for p, r in zip(own, own[1:]):
            parts.append([r]) if r[1] - p[1] > 3600 else parts[-1].append(r)
        for part in parts:
            seen = [r for r in part if r[3]]
            users, replies = [i for i, r in enumerate(seen) if r[2] == 0], [i for i, r in enumerate(seen) if r[2] == 1]
            if all(r[2] in (0, 1) for r in part) and users and replies and users[0] < replies[-1]:
                want.append((room, seen[0][0], seen[-1][0], len(seen), 1 + sum(a[2] != b[2] for a, b in zip(seen, seen[1:]))))
    assert len(want) > 10
    assert conversations(messages(spark, rows)) == sorted(want)


def test_conversations_of_any_year(spark):
    far = 73 * 365 * 86400  # 2096-12
    df = messages(spark, [("a", 0, 0, "q", "t"), ("a", 1, 1, "r", "t"), ("a", far, 0, "q", "t"), ("a", far + 60 * 86400, 0, "q", "t"), ("a", far + 60 * 86400 + 1, 1, "r", "t"), ("b", -40 * 365 * 86400, 0, "q", "t"),
                          ("b", -40 * 365 * 86400, 1, "r", "t")])
    assert conversations(df) == [("a", 0, 1, 2, 2), ("a", 3, 4, 2, 2), ("b", 5, 6, 2, 2)]


def test_messages_in_order_with_roles(spark):
    block = 6 * 3600
    df = messages(spark, [
        ("a", 5, 1, "r", "t"), ("a", 0, 0, "q", "t"), ("a", 5, 1, " ", "t"), ("a", 9, 0, "x" * 100000, "t"), ("b", 0, 0, "alone", "t"),
        (None, block - 2, 0, "q", "t"), (None, block - 1, 0, None, "t"), (None, block, 1, "r", "t"), (None, 2 * block - 3, 0, "apart", "t"), (None, block + 3000, 0, "more", "t")])
    got = sorted((str(r.room), r.first_id, r.pos, r.id, r.role, r.text[:5]) for r in rebuild_messages(df).collect())
    assert got == [("None", 5, 1, 5, "user", "q"), ("None", 5, 2, 7, "assistant", "r"), ("None", 5, 3, 9, "user", "more"),
                   ("a", 1, 1, 1, "user", "q"), ("a", 1, 2, 0, "assistant", "r"), ("a", 1, 3, 3, "user", "xxxxx")]
    assert rebuild_messages(df.limit(0)).collect() == []


def test_live_stream(spark, tmp_path):
    """Micro-batches with late rows, a restart under another number of shuffle partitions, and rows too late to count."""
    rng = random.Random(11)
    rows, t = [], 0
    for i in range(300):
        t += rng.choice([5, 60, 900, 3600, 3601, 4000, 9000])
        rows.append((rng.choice("abc"), t, rng.randrange(2), f"m{i}", "t"))
    end = [("z", rows[-1][1] + 40 * 86400, 0, "end", "t")]
    late = [r for r in rows if rng.random() < 0.1]
    parts, left = [], [r for r in rows if r not in late]
    while left:
        parts.append(left[:40])
        left = left[40:]
        # A late row comes one part after its own; the watermark waits that long.
        parts[-1] += [r for r in late if len(parts) > 1 and r[1] <= parts[-2][-1][1] and r not in sum(parts, [])]
    parts[-1] += [r for r in late if r not in sum(parts, [])]
    assert sum(parts[k][0][1] < parts[k - 1][-1][1] or any(r[1] < parts[k - 1][39][1] for r in parts[k]) for k in range(1, len(parts))) > 2
    folder, state, out = (str(tmp_path / n) for n in ("rows", "state", "out"))
    buckets = C.stored_buckets(spark, state, 5)
    ids = {r: i for i, r in enumerate(rows + end)}

    def feed(part):
        df = messages(spark, rows + end).where(F.col("row_id").isin([ids[r] for r in part]))
        C.message_rows(df).coalesce(1).write.mode("append").parquet(folder)

    def drive(partitions):
        own = C.with_rocksdb(spark)
        own.conf.set("spark.sql.shuffle.partitions", partitions)
        stream = C.stream_conversations(own.readStream.schema(C.ROW).option("maxFilesPerTrigger", 1).parquet(folder), delay="10 days", buckets=C.stored_buckets(spark, state, 7))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()

    for k, part in enumerate(parts):
        feed(part)
        drive("3" if k % 2 else "4")
    feed(end)
    drive("2")
    feed([rows[0]])  # the watermark is past it: neither counted again nor the start of anything
    drive("2")
    assert buckets == 5 == C.stored_buckets(spark, state, 9)
    whole = conversations(messages(spark, rows))
    got = sorted((str(r.room), r.first_id, r.last_id, r.n_msgs, r.n_turns) for r in C.join_pieces(spark.read.schema(C.PIECE).parquet(out)).collect())
    assert got == whole and len(whole) > 10


def test_settings_of_the_session_stay(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    C.with_rocksdb(spark)
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("text, label, out", [
    ("[00:31.72] Um, um, morning!", None, "morning"), ("00:00:15.100 like, I like the quiet", None, "ilikethequiet"), ("用户：嗯…额，名额只有3个", "用户", "名额只有3个"),
    ("my （掌声） train ♪ is late, you know.", None, "mytrainislate"), ("那个，那个文件发我一下，那个。", None, "那个文件发我一下"), ("uhh - uh, SPEAKER", None, "speaker"),
    ("[00:00:24] SPEAKER_01：let's, hmm, meet", "SPEAKER_01", "letsmeet"), ("嗯嗯嗯。", None, ""), ("(music)", None, ""), ("", None, ""), ("note: this stays", None, "notethisstays"),
    ("did, ummmmmm, you", None, "didyou"), ("x" * 100000, None, "x" * 100000),
])
def test_clean_speech(text, label, out):
    lead, clean = clean_speech(text)
    assert (lead, bare(clean)) == (label, out)


def test_labels():
    got = resolve_labels(["USER", "usr", "speaker user", " assistant", "asst.", "Assitant", "AI", "助手", "用户", "spk1", "SPEAKER_00", "track 2", "Bob", "", "?"])
    assert got == {"USER": "user", "usr": "user", "speaker user": "user", "用户": "user", " assistant": "assistant", "asst.": "assistant", "Assitant": "assistant",
                   "AI": "assistant", "助手": "assistant", "spk1": "track 1", "SPEAKER_00": "track 0", "track 2": "track 2", "Bob": "Bob"}


def test_people_are_speakers_of_their_own():
    got = resolve_labels({"Alice": 3, "ALICE": 5, "Al": 1, "Bob": 2, "Bob Smith": 4, "Dr. Lee": 2, "dr lee": 1, "R. Jones": 1, "Robert Jones": 2, "Customer Support": 1, "patient": 3, "Patent": 1, "张医生": 2, "Ann": 1, "Anthony": 1})
    assert got == {"Alice": "ALICE", "ALICE": "ALICE", "Al": "Al", "Bob": "Bob Smith", "Bob Smith": "Bob Smith", "Dr. Lee": "Dr. Lee", "dr lee": "Dr. Lee", "R. Jones": "Robert Jones",
                   "Robert Jones": "Robert Jones", "Customer Support": "assistant", "patient": "patient", "Patent": "patient", "张医生": "张医生", "Ann": "Ann", "Anthony": "Anthony"}


def test_turns(spark):
    seg = "seg_id long, call_id long, seg_role string, seg_content string, ts_start double, ts_end double, speaker string, label string"
    rows = [
        (1, 1, "user", "Hello there", 10.0, 11.0), (2, 1, "SPEAKER_00", "Hi", 10.0, None), (3, 1, None, "用户: 嗯，好的", 12.0, 13.0), (4, 1, "usr", "Hello there!", 10.0, 11.0),
        (5, 1, "user", None, 13.0, 14.0), (6, 1, "user", "um.", 14.0, 15.0), (7, 1, "Bob", "who", 15.0, 16.0), (8, 1, " ", "no label", 16.0, 17.0), (13, 1, "bob", "is it", 15.5, 16.0),
        (9, 1, "user", "much later", 2000.0, 2001.0), (10, 2, "track 5", "x", 1.0, 2.0), (11, 3, "AI", "alone", 1.0, 2.0), (12, 1, "user", "no start", None, 2.0),
        (14, None, "Alice", "lost call", 1.0, 2.0), (15, None, "assistant", "answer", 1.0, 2.0)]
    df = spark.createDataFrame([(*r, "s", "l") for r in rows], seg)
    calls = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "call_id long, user_track int, assistant_track int")
    got = [tuple(r) for r in speaker_turns(df, calls).select("call_id", "turn_no", "speaker", "start_s", "bare_text").orderBy("call_id", "turn_no").collect()]
    assert got == [(None, 1, "assistant", 1.0, "answer"), (None, 2, "Alice", 1.0, "lostcall"), (1, 1, "user", 10.0, "hellothere"), (1, 2, "assistant", 10.0, "hi"), (1, 3, "user", 12.0, "好的"), (1, 4, "Bob", 15.0, "whoisit"),
                   (1, 5, "unknown", 16.0, "nolabel"), (1, 6, "user", 2000.0, "muchlater"), (2, 1, "track 5", 1.0, "x"), (3, 1, "assistant", 1.0, "alone")]
    assert speaker_turns(df.limit(0), calls).count() == 0


@pytest.mark.parametrize("sound", ["[{}]", "【{}】", "(noise {})", "（笑声{}）", "<{}>", "*{}*"])
def test_sound_annotations_of_any_length(sound):
    for n in (1, 60, 61, 5000):
        assert clean_speech(f"hello {sound.format('x' * n)} there")[1].split() == ["hello", "there"]
    assert "hello" in clean_speech("hello " + sound[0] * 50000)[1]


@pytest.mark.parametrize("text, out", [
    ("meet me at 10:30", "meet me at 10:30"), ("see [1] and (optional) args", "see [1] and (optional) args"), ("it is 2 * 3 * 4", "it is 2 * 3 * 4"), ("10:30 - hello", "hello"),
    ("[10:30] user: 10:31 hello at 10:32:05.5", "hello at"), ("we (laughing) stayed", "we stayed"), ("（轻微的咳嗽）好", "好"), ("the string (and the rest)", "the string (and the rest)"), ("Alice: hi", "Alice: hi")])
def test_content_stays(text, out):
    assert clean_speech(text)[1].split() == out.split()
