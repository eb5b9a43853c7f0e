"""Hand-traced cases and random comparisons for dialogue and text expressions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from colloqua.functions import dialogue as D
from colloqua.functions import text as T
from colloqua.operators import bursts as B
from colloqua.operators import sets as S
from colloqua.operators.scoring import accepted, judge_texts, length_judge, parse_reply, score_pairs, segment_conversations

ROWS = "room string, us long, seq long, side int, msg string"
S1 = 1_000_000


def dialogue_frame(spark, *dialogues):
    return spark.createDataFrame(list(enumerate(dialogues)), f"id int, messages {D.MESSAGES}")


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def bursts(spark, rows, gap=120, most=2048):
    df = spark.createDataFrame([(room, int(t * S1), i, side, m) for i, (room, t, side, m) in enumerate(rows)], ROWS)
    return [(r.us // S1, r.side, r.msg) for r in B.merge_bursts(df, gap, most).orderBy("room", "us", "seq").collect()]


def test_bursts(spark):
    day = [("r", 0, 0, "a1"), ("r", 60, 0, "a2"), ("r", 180, 0, "a3"), ("r", 210, 1, "b1"), ("r", 331, 1, "b2")]
    assert bursts(spark, day) == [(0, 0, "a1\na2\na3"), (210, 1, "b1"), (331, 1, "b2")]
    assert bursts(spark, [("r", i, 0, m) for i, m in enumerate(("ab", "cd", "ef"))], most=5) == [(0, 0, "ab\ncd")]
    short = [("r", 0, 0, "abc"), ("r", 1, 0, "de")]
    assert bursts(spark, short, most=5) == [(0, 0, "abc"), (1, 0, "de")]
    assert bursts(spark, short, most=6) == [(0, 0, "abc\nde")]


def test_replies_and_context_across_blocks(spark):
    rng = random.Random(5)
    rows = []
    for room in "ab":
        t = 0
        for _ in range(300):
            t += rng.choice([1, 30, 200, 300, 301, 2000, 5000])
            rows.append((room, t * S1, len(rows), rng.choice([0, 1, 1, 0, 0]), f"m{len(rows)}"))
    df = spark.createDataFrame(rows, ROWS)
    got = {r.seq: (r.reply_us, r.reply) for r in B.next_reply(df, 300).collect()}
    context = {r.seq: [c.msg for c in r.context] for r in B.previous_rows(df, 10).collect()}
    numbers = {r.seq: r.idx for r in B.row_numbers(df).collect()}
    for room in "ab":
        own = [r for r in rows if r[0] == room]
        for i, r in enumerate(own):
            follower = next((x for x in own[i + 1:] if x[3] == 1), None)
            near = follower is not None and follower[1] - r[1] <= 300 * S1
            assert got[r[2]] == ((follower[1], follower[4]) if near else (None, None))
            assert context[r[2]] == [x[4] for x in own[max(0, i - 10):i]]
            assert numbers[r[2]] == i + 1
    assert B.build_dialogues(df.limit(0)).count() == 0


def test_shared_reply_makes_the_second_dialogue_invalid(spark):
    rows = [("r", 0, 0, 0, "first question"), ("r", 200 * S1, 1, 0, "second question"), ("r", 250 * S1, 2, 1, "an answer")]
    got = B.build_dialogues(spark.createDataFrame(rows, ROWS)).collect()
    assert [[m.content for m in r.messages] for r in got] == [["first question", "an answer"]]


def test_budget_and_reduction(spark):
    three = [("user", "aaa"), ("assistant", "bb"), ("user", "c")]
    df = dialogue_frame(spark, three, [])
    assert [len(x) for x in values(df, D.budget_prefix(F.col("messages"), F.lit(5)))] == [2, 0]
    long = [("user", "aaaa"), ("assistant", "bbb"), ("user", "ccc"), ("user", "dd"), ("assistant", "ee")]
    assert [m.content for m in values(dialogue_frame(spark, long), D.greedy_reduce(F.col("messages"), F.lit(10)))[0]] == ["bbb", "ccc", "dd", "ee"]
    assert values(dialogue_frame(spark, long), D.greedy_reduce(F.col("messages"), F.lit(3))) == [None]


@pytest.mark.parametrize("last, valid", [("fine then", True), ("ok", False), ("哈哈哈", False), ("？？？", False), ("12 45", False), ("好", False)])
def test_validity(spark, last, valid):
    both = dialogue_frame(spark, [("user", "a question"), ("assistant", last)], [("user", last), ("assistant", "an answer")])
    assert values(both, D.is_valid_dialogue(F.col("messages"))) == [valid, valid]


def test_validity_of_roles(spark):
    q, a = ("user", "a question"), ("assistant", "an answer")
    df = dialogue_frame(spark, [q], [a, q], [q, q, a], [a, q, a], [("system", "x"), q, ("system", "y"), a], [], None)
    assert values(df, D.is_valid_dialogue(F.col("messages"))) == [False, False, False, True, False, False, False]


def test_role_runs(spark):
    df = dialogue_frame(spark, [("user", "a b"), ("user", "c"), ("assistant", "d")], [])
    assert [[tuple(m) for m in x] for x in values(df, D.merge_role_runs(F.col("messages")))] == [[("user", "a\nb\nc"), ("assistant", "d")], []]


def test_split(spark):
    rows = [("r", i * S1, i, s, "x") for i, s in enumerate([1, 1, 0, 1, 1, 0, 0, 1])] + [("q", i * S1, i, s, "x") for i, s in enumerate([0, 1, 0])]
    got = sorted((r.room, r.roles) for r in B.split_conversations(spark.createDataFrame(rows, ROWS)).collect())
    assert got == [("q", "ua"), ("r", "aa"), ("r", "uaa"), ("r", "uua")]


def test_scores(spark):
    assert parse_reply('[{"id": 1, "score": 4}, {"id": 2, "score": "x"}, {"id": 1, "score": 3}]') == {"1": 3, "2": 0}
    assert parse_reply('```json\n[{"id": 1, "score": 4}]\n```') == {}
    assert parse_reply('{"id": "a", "score": 5}\n{"id": "b", "score": 2},') == {"a": 5}
    reply = spark.createDataFrame([(0, '[{"id": "a", "score": "4"}, {"id": "b", "score": "x"}]'), (1, '{"id": "a", "score": 5}\nno'), (2, None)], "id int, r string")
    assert [None if v is None else [tuple(x) for x in v] for v in values(reply, D.parse_scores(F.col("r")))] == [[("a", 4), ("b", 0)], [("a", 5)], None]
    pairs = spark.createDataFrame([("p", [("user", "hello")], []), ("q", [("user", "hi")], ["x"])], f"id string, messages {D.MESSAGES}, images array<string>")
    assert {r.id: r.score for r in score_pairs(pairs, length_judge).collect()} == {"p": len("user: hello") % 5 + 1, "q": 6}

    def broken(_):
        raise OSError

    assert {r.id: r.score for r in score_pairs(pairs, broken, retries=0).collect()} == {"p": 0, "q": 6}
    assert {r.id: r.score for r in score_pairs(pairs, lambda _: "[]").collect()} == {"p": None, "q": 6}
    scored = spark.createDataFrame([(1, "4"), (2, "x"), (3, None)], "id int, score string")
    assert values(accepted(scored, 2), "id") == [1]


def test_judged_segments_and_texts(spark):
    df = dialogue_frame(spark, [("user", "a"), ("assistant", "b"), ("user", "c")])
    kept = segment_conversations(df, lambda p: '<think>x</think>```json\n{"removed_indices": [1]}\n```')
    assert [m.content for m in values(kept, "messages")[0]] == ["a", "c"]
    assert len(values(segment_conversations(df, lambda p: "no json"), "messages")[0]) == 3
    texts = spark.createDataFrame([(0, "plain"), (1, "".join(map(chr, range(200, 260))))], "id int, text string")
    got = values(judge_texts(texts, lambda t: '{"is_valid": true, "confidence": 0.8}'), "verdict")
    assert [(v.is_valid, v.confidence) for v in got] == [(True, 0.8), (False, 0.9)]

    def failing(_):
        raise OSError

    assert values(judge_texts(texts, failing), "verdict")[0].is_valid


def test_texts(spark):
    def one(f, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
        return values(df, f(F.col("t")))

    assert one(T.text_quality, "hello", "你好世界啊", "") == [2.0, 2.5, 0.0]
    assert one(T.is_encoded, "hello how are you today", "short") == [True, False]
    assert one(lambda c: T.is_encoded(c, alnum_rule=False), "hello how are you today") == [False]
    assert one(T.has_garbage, "I'm ok", "ok!!", "OK!", "fine") == [True, True, True, False]
    assert one(T.is_garbled_strict, "早上好\n朋友", "早上好朋友", "  ") == [True, False, True]
    assert one(lambda c: T.blocked(c, ("Pass",)), "my PASSword", "", None, "x") == [True, True, True, False]
    assert one(T.squeeze_blanks, "a　 \n b ", " ", "") == ["a b", "", ""]
    assert one(T.double_spaces_to_lines, "a  b   c d") == ["a\nb\nc d"]
    assert one(T.message_type, "", "[语音]", "[视频]", "[文件]", "[图片]", "a.mp4", "hi there") == ["system", "voice", "video", "file", "image", "media", "text"]
    entropy = lambda t: -sum(t.count(c) / len(t) * math.log2(t.count(c) / len(t)) for c in set(t))
    assert [round(x, 6) for x in one(T.char_entropy, "aab", "", "ab😀😀中", "x")] == [0.918296, 0.0, round(entropy("ab😀😀中"), 6), 0.0]
    pair = spark.createDataFrame([(0, "abc", "bcd"), (1, "", ""), (2, "a", "")], "id int, a string, b string")
    assert values(pair, T.char_jaccard(F.col("a"), F.col("b"))) == [0.5, 0.0, 0.0]


def test_sets(spark):
    assert [S.mix_size(*x) for x in ((200, 20, 500), (200, 0, 500), (0, 20, 500), (200, 20, 0), (200, 100, 50))] == [40, 1, 1, 0, 50]
    records = spark.createDataFrame([(0, '{"a":1,"b":2}'), (1, '{"b":2,"a":1}'), (2, '{"a":2}'), (3, None)], "id int, r string")
    assert values(S.keep_first(records, S.canonical_json(F.col("r")), [F.col("id")]), "id") == [0, 2, 3]
    numbers = spark.createDataFrame([(i, v) for i, v in enumerate([6.0, 7.5, 100.0, None])], "id int, v double")
    assert values(numbers, S.nearest(F.col("v"), [5.0, 10.0])) == [5.0, 5.0, 10.0, None]
    capped = S.cap_per_group(spark.createDataFrame([(i, "g", i == 3) for i in range(4)], "id int, g string, r boolean"), "g", ["id"], 2, F.col("r"))
    assert values(capped, "id") == [0, 1, 3]
    many = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"))
    assert {r.id: r.idx for r in S.numbered(many, ["id"]).collect()} == {i: i for i in range(1000)}
    assert {r.id: r.chunk for r in S.chunked(many, ["id"], 64).collect()} == {i: i // 64 for i in range(1000)}
    mixed = S.mix_by_percentage(records.select("id"), spark.range(100, 200).select(F.col("id").cast("int")), "id", 50)
    assert mixed.count() == 4 + 2


def test_canonical_json(spark):
    texts = ['{"a":{"x":1,"y":[2]},"b":2}', '{"b":2, "a":{"y":[2],"x":1}}', '{"k":1}', '{"k":"1"}', '{"k":1.0}', "[1]", "[2]", "[ 1 ]", "3", "{broken", "{broken}", "{broken", "", None, None,
             '{"k":null}', "{}", '{"k":1,"k":2}', '{"k":2}', '{"k":"\\u4e2d"}', '{"k":"中"}', "[" * 100000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, r string")
    assert values(S.keep_first(df, S.canonical_json(F.col("r")), [F.col("id")]), "id") == [0, 2, 3, 4, 5, 6, 8, 9, 10, 12, 13, 15, 16, 17, 19, 21]


def test_formats(spark):
    cases = spark.createDataFrame(
        [(0, [("user", "q"), ("assistant", "a")], None, None, None, None), (1, None, "i", "x", "o", None), (2, None, "i", "", "o", None),
         (3, None, None, "x", "o", None), (4, None, None, None, None, "t"), (5, None, None, None, None, None)],
        f"id int, m {D.MESSAGES}, i string, x string, o string, t string")
    got = values(cases, D.sft_text(F.col("m"), F.col("i"), F.col("x"), F.col("o"), F.col("t"), "</s>"))
    assert got == ["user: q\nassistant: a</s>", "Instruction: i\nInput: x\nAnswer: o</s>", "Instruction: i\nAnswer: o</s>", "Input: x\nAnswer: o</s>", "t</s>", None]
