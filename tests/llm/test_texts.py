"""Personal data, tokenizer, leaks and same-looking texts on small tables."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from colloqua.llm import leakage as L
from colloqua.llm import personal
from colloqua.llm.personal import find_personal_data, find_spans, mask, masked, normalised, transduce
from colloqua.llm.queries import QUERIES
from colloqua.llm.samelook import _target, form_rows, one_form, one_forms, same_look_classes, same_look_pairs, tables
from colloqua.llm.tokenize import VOCABULARY, decode, encode_corpus, encode_texts


def kinds(text):
    return sorted({k for k, _, _ in find_spans(text)})


@pytest.mark.parametrize("text, found", [
    ("write to mo.chen7@mail.example.org now", ["email"]), ("xy (at) inbox (dot) test", ["email"]), ("a.b ＠ example.com", ["email"]), ("xy#example.com（#换成@）", ["email"]),
    ("logo@2x.png 那张", []), ("@所有人 放假", []), ("加我１５６００００２００２", ["phone"]), ("打一七二零零零零八九六三找快递", ["phone"]), ("(+86)143-00007382", ["phone"]),
    ("0780-55503041", ["phone"]), ("text (474) 555-0120 now", ["phone"]), ("+44 7700 900613", ["phone"]), ("020 7946 0718", ["phone"]), ("count one two three four five six seven eight", []),
    ("call one eight four seven five five five zero one seven three", ["phone"]), ("订单号80554909591743918829", []), ("时间戳1549611865", []), ("群号166114311", []), ("会议号 123 456 789", []),
    ("证件号是 319987 20020224 8593", ["id_number"]), ("65999119650711782X", ["id_number"]), ("659991199613178200", []), ("926 49 4146", ["id_number"]), ("QQ 60 19 10 C", ["id_number"]),
    ("快递寄望川市石榴区鹤鸣巷624号，谢谢", ["address"]), ("听雨大道796弄25号319", ["address"]), ("9号楼的电梯坏了", []), ("坐9号线到终点站", []), ("meet me outside 901 quince hill rd.", ["address"]),
    ("Flat 12, 792 Thistledown Avenue, Eastvale", ["address"]), ("我叫司徒听澜，第一次来", ["name"]), ("孟怀瑾明天也来吗", ["name"]), ("阳光真好，出去走走", []), ("收件人：Orin Fernsby", ["name"]),
    ("this is Greer Ashdown-Pike speaking", ["name"]), ("ask for 林青棠 at the desk", ["name"]), ("谢谢 后天见", []), ("", []), (" ", []), ("x" * 100000, []),
    ("Name: 阮见山 / ID: 945-11-9181 / Mail: d@example.net", ["email", "id_number", "name"]),
])
def test_kinds(text, found):
    assert kinds(text) == found


CUED = [
    ("我的名字是王小明", ["name"]), ("麻烦转告张伟带伞", ["name"]), ("收件:李雷", ["name"]), ("收件写王小明", ["name"]), ("I live at 221b Baker Street", ["address"]), ("7a oak lane", ["address"]),
    ("12B High Street", ["address"]), ("9 'Old Oak' Lane", ["address"]), ("415(.)555(.)2671", ["phone"]), ("415 [dot] 555 [dot] 2671", ["phone"]), ("٩٢٦-٤٩-٤١٤٦", ["id_number"]), ("+7 22 33", ["phone"]),
    ("明天见", []), ("a dot b", []),
]


@pytest.mark.parametrize("text, found", CUED)
def test_kinds_whatever_the_cue(text, found):
    assert kinds(text) == found


def test_pre_tests_change_no_result(monkeypatch):
    rng = random.Random(5)
    parts = [*"我叫 名字是 转告 收件 寄件人 姓名 交给 王小明 张伟 明天 先生 号 弄 鹤鸣巷 点 艾特 一七二零零零零八九 12b 7 221 +7 22 33 555 415 ٤١٤٦ 2671 A ' - . , : ( ) [ ] dot DOT at AT @ # example.com Baker oak Street lane Ada Byron dear one two".split(),
             "name: ", "this is ", "ask for ", " will join", " speaking", ", flat 2, ", "one two three four five six seven", " ", " ", " ", "\t"]
    parts += ["Rosenweg ", "straße", "rue de ", " bis ", "Calle ", "n.º ", "ул. ", "д. ", "дом", "Иван Петров", "меня зовут ", "Ich bin ", "说", "李娜", "我是", "Regards, "]
    texts = [t for t, _ in CUED] + ["".join(rng.choice(parts) for _ in range(rng.randrange(2, 14))) for _ in range(20000)]
    with_tests = [find_spans(t) for t in texts]
    anything = re.compile("")
    for name in ("_NAME_CUE", "_STREET_CUE", "_HOUSE_CUE", "_DIGITS_CUE"):
        monkeypatch.setattr(personal, name, anything)
    monkeypatch.setattr(personal, "_STEPS", [(pattern, to, lambda t: True) for pattern, to, _ in personal._STEPS])
    assert with_tests == [find_spans(t) for t in texts]
    assert len({kind for spans in with_tests for kind, _, _ in spans}) >= 4


def test_masking_keeps_the_rest():
    assert mask("简历投到 ｍｏ＠example．com 吧 😀") == "简历投到 [EMAIL] 吧 😀"
    assert mask("加我\u200b１５６００００２００２，谢谢") == "加我\u200b[PHONE]，谢谢"
    assert mask("打一七二零零零零八九六三找我") == "打[PHONE]找我" and mask(None) is None and mask("") == ""
    for text in ("a (at) b　 c", "一二三四五六七八九", "ﬁ́x  y\tz"):
        traced = transduce(text)
        assert traced.text == normalised(text) and len(traced.text) == len(traced.starts) == len(traced.ends)


def test_personal_data_of_tables(spark):
    df = spark.createDataFrame([(1, "a@b.example and c@d.example", "x"), (1, "a@b.example and c@d.example", "x"), (2, None, "x"), (None, "15600002002", "x")], "id long, t string, kind string")
    got = sorted(map(str, find_personal_data(df, "id", "t").collect()))
    assert len(got) == 5 and find_personal_data(df.limit(0), "id", "t").count() == 0
    assert [r[0] for r in df.select(masked(F.col("t"))).collect()] == ["[EMAIL] and [EMAIL]"] * 2 + [None, "[PHONE]"]


def test_both_tables_are_masked(spark, tmp_path):
    spark.createDataFrame([(1, "a@b.example", "x"), (2, None, "x")], "row_id long, msg string, talker string").write.parquet(f"{tmp_path}/messages.parquet")
    spark.createDataFrame([(1, "to c@d.example", "x"), (1, "to c@d.example", "x"), (3, " ", "x")], "cm_id long, chat_content string, chat_role string").write.parquet(f"{tmp_path}/chatml_messages.parquet")
    got = sorted(map(tuple, QUERIES["p3_masked"](spark, str(tmp_path)).collect()), key=str)
    assert got == [("chatml_messages", 1, "to [EMAIL]")] * 2 + [("chatml_messages", 3, " "), ("messages", 1, "[EMAIL]"), ("messages", 2, None)]


TEXTS = ["", "hello world", " don't WE'LL I'VE  \n\n x", "<|endoftext|> 是普通文字", "a" * 5000, " " * 3000, "ab" * 2500, "𠮷野家 👨‍👩‍👧 שלום", "\x00\x07\r\n", "1234567890" * 300, "é e\u0301 ﬁ"]


def test_tokenizer_against_library():
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(VOCABULARY)
    reference.encode_special_tokens = True
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("aab bc12 '\n.é中") for _ in range(rng.randrange(200))) for _ in range(300)]
    got = encode_texts(texts)
    assert got == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert [decode(ids) for ids in got[: len(TEXTS)]] == TEXTS


def test_tokens_of_tables(spark):
    df = spark.createDataFrame([(1, "hello", 5), (1, "hello", 5), (2, "", 5), (3, None, 5), (None, "hello", 5)], "doc_id long, text string, ids int")
    got = encode_corpus(df)
    assert dict(got.dtypes) == {"doc_id": "bigint", "ids": "array<int>"}
    assert got.count() == 5
    assert {r.doc_id: list(r.ids) for r in got.collect()} == {1: encode_texts(["hello"])[0], 2: [], 3: [], None: encode_texts(["hello"])[0]}
    assert encode_corpus(df.limit(0)).count() == 0


def test_ids_do_not_depend_on_the_table(spark):
    from colloqua.llm.tokenize import word_table

    rng = random.Random(12)
    texts = ["".join(rng.choice(["the ", "cat", " 猫", "\n", "\u00a0", "\u2003", "\x1c", "\x85", "12 ", "½", "é", "e\u0301", "😀", "don't ", "<|endoftext|>", "  ", "ß", "x" * 80, "\u200b"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id int, text string").withColumn("ids", F.lit(1)).withColumn("word", F.lit("w"))
    want = {i: x for i, x in enumerate(encode_texts([*texts, None, ""]))}
    for most in (0, 5, 1 << 17):
        assert {r.doc_id: list(r.ids) for r in encode_corpus(df, most=most).collect()} == want
    table = {r.word: (r.n, list(r.ids)) for r in word_table(df, most=5).collect()}
    assert len(table) == 5 and all(x[1] == encode_texts([w])[0] for w, x in table.items()) and not any("x" * 80 in w for w in table)


def words(rng, n):
    return [rng.choice("amber brass cellar dented eager ferry gilded hinge idle juggler kiln ledger".split()) + str(rng.randrange(50)) for _ in range(n)]


def test_winnowing_guarantees_every_shared_run():
    rng = random.Random(6)
    for _ in range(300):
        shared = words(rng, rng.choice([10, 11, 12, 13, 20]))
        a, b = words(rng, rng.randrange(15)) + shared + words(rng, rng.randrange(15)), words(rng, rng.randrange(9)) + shared + words(rng, 9)
        if L.shares_run(a, b, 12):
            found = L.fingerprints([" ".join(a), "", " ".join(b)], L.WORDS)
            assert set(found.hash[found.text == 0]) & set(found.hash[found.text == 2])


def test_fingerprints_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["", "one two " * 30, "斑驳的罗盘" * 20, "x" * 40000, "short", "a\0b " * 40, "\ud800 lone " * 30]
    for view in (L.WORDS, L.LETTERS):
        found = L.fingerprints(texts, view)
        for i, text in enumerate(texts):
            alone = L.fingerprints([text], view)
            for name in ("hash", "place", "context"):
                assert getattr(found, name)[found.text == i].tolist() == getattr(alone, name).tolist()


def test_leaks(spark):
    rng = random.Random(7)
    en, zh = " ".join(words(rng, 30)), "".join(rng.choice("斑驳罗盘反复唤醒锋利织工座守护温顺水车倾斜冰窖终于描述果园蜂箱") for _ in range(60))
    items = spark.createDataFrame([(1, "en", en, None), (2, "zh", None, zh), (3, None, "short", ""), (4, "en", None, None), (1, "en", en, None)], "item_id long, lang string, input_text string, expected_text string")
    cut = en.split()
    docs = spark.createDataFrame([
        (1, "before " + " ".join(cut[3:15]) + " after"), (2, " ".join(cut[3:14]) + " after"), (3, "\\n".join(cut[3:15]).replace("a", "A") + "!"), (4, "；".join(zh[5:29])), (5, zh[5:28] + "x"),
        (6, None), (7, ""), (None, en), (8, zh + " " + en), (8, zh + " " + en), (9, "ｘ" * 50000), (10, "".join(c + "\u0301\u200b" for c in " ".join(cut[3:15])))], "doc_id long, text string")
    docs = docs.withColumn("lang", F.lit("en")).withColumn("item_id", F.lit(5))
    got = sorted(map(tuple, L.find_leaks(docs, items).collect()))
    assert got == [(1, 1), (3, 1), (4, 2), (8, 1), (8, 2), (10, 1)]
    assert L.find_leaks(docs.limit(0), items).count() == 0 and L.find_leaks(docs, items.limit(0)).count() == 0
    passages = sorted(tuple(r) for r in L.find_passages(docs, items).collect() if r.doc_id in (1, 4, 8))
    assert passages == [(1, 1, "input_text", 1, 13, 3), (4, 2, "expected_text", 0, 24, 5), (8, 1, "input_text", 60, 90, 0), (8, 2, "expected_text", 0, 60, 0)]


def test_passages_against_brute_force(spark):
    rng = random.Random(8)
    tests = [words(rng, rng.randrange(10, 60)) for _ in range(6)]
    docs = []
    for _ in range(90):
        doc = []
        for _ in range(rng.randrange(4)):
            t = rng.choice(tests)
            a = rng.randrange(len(t))
            doc += words(rng, rng.randrange(5)) + t[a : a + rng.randrange(5, 50)]
        docs.append(doc)
    want = set()
    for d, doc in enumerate(docs):
        for i, t in enumerate(tests):
            for a in range(len(doc)):
                for b in range(len(t)):
                    if doc[a] == t[b] and (a == 0 or b == 0 or doc[a - 1] != t[b - 1]):
                        n = 0
                        while a + n < len(doc) and b + n < len(t) and doc[a + n] == t[b + n]:
                            n += 1
                        if n >= 12:
                            want.add((d, i, "input_text", a, a + n, b))
    left = spark.createDataFrame([(d, " ".join(doc)) for d, doc in enumerate(docs)], "doc_id long, text string")
    right = spark.createDataFrame([(i, "en", " ".join(t), "") for i, t in enumerate(tests)], "item_id long, lang string, input_text string, expected_text string")
    assert len(want) > 20
    assert {tuple(r) for r in L.find_passages(left, right).collect()} == want
    assert {tuple(r) for r in L.find_leaks(left, right).collect()} == {w[:2] for w in want}


def test_no_text_of_the_corpus_is_moved(spark):
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("text of the corpus").alias("text"))
    items = spark.createDataFrame([(1, "en", "a", "b")], "item_id long, lang string, input_text string, expected_text string")
    for line in L.find_leaks(docs, items)._jdf.queryExecution().executedPlan().toString().split("\n"):
        assert "text" not in line or "Exchange" not in line


def test_filter_passes_all_it_holds(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        hashes = rng.integers(-(2**63), 2**63 - 1, n)
        kept = L._filter(spark.createDataFrame([(int(h),) for h in hashes], "h long"))
        assert L._passing(hashes.view(np.uint64), kept).all() and L._passing(rng.integers(0, 2**63 - 1, 10000).view(np.uint64), kept).mean() < 0.1


def form(text):
    return unicodedata.normalize("NFC", "".join(_target(c) if not 0xAC00 <= ord(c) <= 0xD7A3 else c for c in text))


LOOKS = ["file one", "ﬁle one", "ｆｉｌｅ　ｏｎｅ", "fi\u200ble\u00a0one", "fіlе оne", "File one", "fil\ne one", "café", "cafe\u0301", "cafe", "ẹ\u0301", "e\u0301\u0323", "é\u0323", "e\u0323\u0301", "한", "한", "ｶﾞ", "ガ",
         "x\r\ny", "x\ny", "o\u0308\u200d", "ö", "Ѕаmе", "Same", "\u0301start", "𠮷", "①", "1"]


def test_forms_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate([*LOOKS, None, "", " ", "\u200b"])), "doc_id int, text string").withColumn("x", F.lit(1))
    got = {r.doc_id: r.form for r in one_form(df).collect()}
    assert got == {i: None if t is None else form(t) for i, t in enumerate([*LOOKS, None, "", " ", "\u200b"])}
    want = {(i, j) for i in range(len(LOOKS)) for j in range(i + 1, len(LOOKS)) if LOOKS[i] != LOOKS[j] and form(LOOKS[i]) == form(LOOKS[j])}
    assert {tuple(r) for r in same_look_pairs(df).collect()} == want and len(want) > 15
    assert same_look_pairs(df.limit(0)).count() == 0


def test_copies_make_no_pairs(spark):
    df = spark.createDataFrame([(i, "same text") for i in range(50)] + [(99, "same\u00a0text"), (99, "same\u00a0text"), (None, "sаme text")], "doc_id long, text string")
    assert sorted(tuple(r) for r in same_look_pairs(df).collect()) == [(i, 99) for i in range(50)]


def test_forms_of_any_sequence():
    """Ordering by class and recomposition by table against the normaliser, over whatever stands next to each other."""
    rng = random.Random(9)
    marks = [chr(c) for c in range(0x300, 0x370)] + ["\u0591", "\u05b0", "\u0e38", "\u1dca", "\u20d0", "\u3099", "\U0001d165"]
    letters = list("aeiouAEOcnsyz gЕеИйеΑαΩ") + ["é", "ǭ", "ệ", "й", "ё", "ΐ", "ｅ", "ﬁ", "①", "　", "\u200b", "\n", "\r"]
    jamo = [chr(c) for c in (0x1100, 0x1112, 0x1161, 0x1175, 0x11A8, 0x11C2, 0xAC00, 0xAC01, 0xD788)]
    indic = ["\u0b47", "\u0b3e", "\u0b56", "\u0dd9", "\u0dcf", "\u0dca", "\u1025", "\u102e", "\u0915", "\u093c", "\U00011131", "\U00011127"]
    texts = ["".join(rng.choice(rng.choice((letters, marks, marks, jamo, indic))) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    texts += ["e" + "\u0323\u0301" * 3000, "\u0301" * 50, "\u1161" * 50, "x" * 200000 + "é", "", None, "\ud83d".encode("utf-8", "replace").decode()]
    for at in range(0, len(texts), 97):
        part = texts[at : at + 97]
        assert one_forms(part) == [None if t is None else form(t) for t in part]


def test_every_code_point_alone():
    import sys

    codes = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    assert one_forms(codes) == [form(c) for c in codes]
    assert len(form_rows()) < 30_000 and len(tables().pairs) < 1_500


def test_classes(spark):
    df = spark.createDataFrame(list(enumerate(["cafe\u0301", "café", "café", "cafe", None, " ", "\u00a0", "fine", "ｆine", "ｆｉne", "alone"], 1)), "doc_id int, text string").withColumn("key", F.lit(1)).withColumn("form_hash", F.lit(1))
    got = sorted(map(tuple, same_look_classes(df).collect()))
    assert got == [(1, 1, 2, 3), (2, 1, 2, 3), (3, 1, 2, 3), (8, 8, 3, 3), (9, 8, 3, 3), (10, 8, 3, 3)]
    assert same_look_classes(df.limit(0)).count() == 0
    assert one_form(df.withColumn("form", F.lit(3))).where("doc_id = 1").first().form == "café"
