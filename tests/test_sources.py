"""Sources and sinks over files made here."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from colloqua.config import load_settings, parse_jsonc
from colloqua.functions import dialogue as D
from colloqua.plans import pipeline
from colloqua.plans.reference_queries import _varint, protobuf_decode
from colloqua.sinks import files as sinks
from colloqua.sources import files as sources
from colloqua.sources.sqlite import columns_of, read_qq, read_wechat, tables_of
from colloqua.sources.telegram import read_telegram
from colloqua.sources.wire import best_text, harvest, read_varint, wire_texts


def field(number, body):
    size, n = b"", len(body)
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    return bytes([number << 3 | 2]) + size + bytes([n]) + body


def test_wire(spark):
    inner = field(1, "早上好，我在路上".encode())
    body = b"\x08\x96\x01" + field(2, inner) + b"\x15abcd" + b"\x19abcdefgh" + field(3, b"no")
    assert "早上好，我在路上" in harvest(body) and harvest(body)[-1] == "no"
    assert harvest(b"") == [] and harvest(None) == [] and harvest(b"\x0a\xff") == [] and harvest(b"\x07abc") == []
    assert read_varint(b"\xff" * 11, 0) is None and read_varint(b"\x96\x01", 0) == (150, 2)
    deep = "x".encode()
    for _ in range(100):
        deep = field(1, deep)
    assert len(harvest(deep)) == 100 and harvest(deep)[-1] == "x"
    df = spark.createDataFrame([(1, body), (2, None), (3, b"\xff\xff")], "id int, b binary")
    got = {r.id: r.t for r in df.select("id", best_text(wire_texts(F.col("b"))).alias("t")).collect()}
    assert got == {1: "早上好，我在路上", 2: "", 3: ""}


def test_qq_and_wechat(spark, tmp_path):
    store = sqlite3.connect(tmp_path / "a.db")
    store.execute('CREATE TABLE c2c_msg_table ("40050" INT, "40030" INT, "40033" INT, "40800" BLOB)')
    texts = ["早上好，我在路上", "好的，一会儿见", None, "[图片]"]
    for i, t in enumerate(texts):
        store.execute("INSERT INTO c2c_msg_table VALUES (?, 10001, ?, ?)", (1704067200 + i, 10001 + i % 2, None if t is None else field(1, t.encode())))
    store.commit()
    store.close()
    got = read_qq(spark, str(tmp_path / "*.db"), "10002").orderBy("id").collect()
    assert [(r.id, r.msg, r.is_sender, r.room_name, r.MsgSvrID) for r in got] == [
        (1, texts[0], 0, "QQ_10001", "1704067200_10001"), (2, texts[1], 1, "QQ_10001", "1704067201_10002")]
    (tmp_path / "wechat").mkdir()
    store = sqlite3.connect(tmp_path / "wechat" / "MSG0.db")
    store.execute("CREATE TABLE MSG (MsgSvrID TEXT, IsSender INT, CreateTime INT, StrTalker TEXT, StrContent TEXT, Type INT)")
    rows = [("1", 0, 5, "wxid_a", " hi ", 1), ("2", 1, 4, "wxid_a", "yo", 1), ("3", 0, 5, "g@chatroom", "x", 1), ("4", 0, 5, "wxid_a", "x", 3), ("5", 0, 9, "wxid_a.", "z", 1)]
    store.executemany("INSERT INTO MSG VALUES (?,?,?,?,?,?)", rows)
    store.commit()
    store.close()
    got = read_wechat(spark, str(tmp_path / "wechat")).orderBy("MsgSvrID").collect()
    assert [(r.id, r.msg, r.is_sender) for r in got] == [(2, "hi", 0), (1, "yo", 1), (1, "z", 0)]
    assert got[0].room_name == "WX_wxid_a" != got[2].room_name
    assert tables_of(str(tmp_path / "a.db")) == ["c2c_msg_table"]
    assert columns_of(str(tmp_path / "a.db"), "c2c_msg_table")[0] == ("40050", "INT")
    assert sources.detect_sources(str(tmp_path)) == ["qq", "wx"]
    assert sources.read_all(spark, str(tmp_path)).count() == 5
    assert {r.source: r.available for r in sources.source_catalogue(spark, str(tmp_path)).collect()} == {"qq": True, "tg": False, "wx": True}


def test_telegram(spark, tmp_path):
    (tmp_path / "chat").mkdir()
    messages = [
        {"id": 7, "type": "message", "date": "2024-01-01T08:00:00", "date_unixtime": "1704067200", "from": "Ann", "from_id": "user5", "text": ["a", {"type": "link", "text": "b"}]},
        {"id": 8, "type": "message", "date_unixtime": "1704067201", "from_id": "user58", "photo": "p.jpg", "text": "hi"},
        {"id": 9, "type": "service", "text": "joined"},
        {"type": "message", "date_unixtime": "1704067202", "from": "Me", "text": "好的", "forwarded_from": None},
        {"id": 11, "type": "message", "date_unixtime": "1704067203", "from": "Ann", "text": "!!!"},
        {"id": 12, "type": "message", "from": "Ann", "sticker": "s", "sticker_emoji": "😀", "text": ""},
    ]
    (tmp_path / "chat" / "result.json").write_text(json.dumps({"name": "N", "type": "personal_chat", "id": 42, "messages": messages}), encoding="utf-8")
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "result.json").write_text("{}", encoding="utf-8")
    got = read_telegram(spark, str(tmp_path), "Me").orderBy("id").collect()
    assert [(r.id, r.MsgSvrID, r.type_name, r.is_sender, r.talker, r.msg, r.is_forward) for r in got] == [
        (1, "7_42", "text", 0, "Ann", "ab", 0), (2, "8_42", "image", 0, "58", "[图片] hi", 0), (4, "3_42", "text", 1, "Me", "好的", 1),
        (6, "12_42", "image", 0, "Ann", "[表情包😀]", 0)]
    assert {r.room_name for r in got} == {"TG_N_42"}
    assert sources.detect_sources(str(tmp_path)) == ["tg"]


def test_records_and_pipeline(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    lines = ['{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', "", "broken",
             '{"conversations":[{"from":"user","value":"v"}]}', '{"instruction":"i","output":"o"}', '{"turns":[{"role":"user","text":"t"},{"role":"ai","text":"u"}]}']
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    assert [r.id for r in sources.read_dialogues(spark, str(path)).orderBy("line_no").collect()] == ["r.jsonl_1", "r.jsonl_4"]
    assert sources.read_records(spark, str(path)).count() == 4
    assert [r.text for r in sources.read_sft(spark, str(path), "", 2).collect()] == ["user: q\nassistant: a", "Instruction: i\nAnswer: o"]
    assert sources.read_training(spark, str(tmp_path / "none.jsonl")).count() == 0
    converted = pipeline.convert_records(sources.read_records(spark, str(path)), "P").orderBy("line_no").select(D.rendered(F.col("messages")))
    assert [r[0] for r in converted.collect()] == ["system: P\nuser: q\nassistant: a", "system: P\nuser: i\nassistant: o", "system: P\nuser: t\nassistant: u"]
    assert pipeline.stats(spark, str(path)).collect()[0].n_records == 4
    assert [r.line for r in pipeline.preview(spark, str(path), 1).collect()] == [lines[0]]
    good = tmp_path / "good.jsonl"
    good.write_text('{"a":1,"b":2}\n{"b":2,"a":1}\n', encoding="utf-8")
    assert pipeline.merge(spark, [str(good), str(good)], str(tmp_path / "out.jsonl")).count() == 1
    try:
        sources.read_strict(spark, str(path)).collect()
        raise AssertionError("a blank line has to fail")
    except Exception as failed:  # noqa: BLE001
        assert "broken record" in str(failed)
    array = tmp_path / "x.json"
    array.write_text('[{"a": 1}, {"b": [2]}]', encoding="utf-8")
    assert [r.record for r in sources.read_strict(spark, str(array)).orderBy("line_no").collect()] == ['{"a": 1}', '{"b": [2]}']


def test_lines_of_split_files(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i}\n" for i in range(1, 2001)), encoding="utf-8")
    (tmp_path / "short.txt").write_text("line 1\n\nline 3", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = sources.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 2003 and all(r.line == f"line {r.line_no}" for r in got if r.line)


def test_unified_csv(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "s", "text", 0, "t", 'a "q"\nb', "", "2024-01-01 08:00:00", "R_1", 0), (2, "s", "text", 1, "t", "an answer", "", "2024-01-01 08:01:00", "R_1", 0)],
        "id long, MsgSvrID string, type_name string, is_sender int, talker string, msg string, src string, CreateTime string, room_name string, is_forward int")
    sinks.write_rooms(rows.withColumn("CreateTime", F.to_timestamp("CreateTime")), str(tmp_path / "out"))
    back = sources.read_unified(spark, str(tmp_path / "out"))
    assert [(r.id, r.msg, str(r.CreateTime)) for r in back.orderBy("id").collect()] == [(1, 'a "q"\nb', "2024-01-01 08:00:00"), (2, "an answer", "2024-01-01 08:01:00")]
    made = pipeline.clean_raw(back).collect()
    assert [[m.content for m in r.messages] for r in made] == [['a "q" b', "an answer"]]
    pairs = pipeline.scoring_pairs(sources.read_scoring_rows(spark, str(tmp_path / "out")))
    assert [len(r.messages) for r in pairs.collect()] == [2]


def test_settings(tmp_path):
    assert parse_jsonc('{"a": "http://x", // note\n "b": [1]}') == {"a": "http://x", "b": [1]} and parse_jsonc(" // x\n") == {}
    path = tmp_path / "s.jsonc"
    path.write_text('{"make": {"accept_score": "3", "include_type": ["text", "image"]}, "other": 1}', encoding="utf-8")
    got = load_settings(str(path), batch_size=4)
    assert (got.accept_score, got.include_type, got.batch_size, got.retries) == (3, ("text", "image"), 4, 3)
    assert load_settings(str(tmp_path / "none")).accept_score == 2


def test_small_helpers(spark, tmp_path):
    import datetime as dt

    import pytest

    from colloqua.functions import checks, misc
    from colloqua.sources.model_client import ModelClient

    sizes = {0: "0 B", 512: "512 B", 1023: "1023 B", 1024: "1.0 KB", 1536: "1.5 KB", 1280: "1.2 KB", 1030042: "1005.9 KB", 3 * 1024**3: "3.0 GB", 1024**4: "1.0 TB", 5000 * 1024**5: "5000.0 PB", None: None}
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "id int, n long").orderBy("id")
    assert [r[0] for r in df.select(misc.size_text(F.col("n"))).collect()] == list(sizes.values())
    spans = {0.0: "0秒", -5.0: "0秒", 0.9: "0秒", 61.5: "1分1秒", 3600.0: "1小时", 3661.5: "1小时1分1秒", 125.3: "2分5秒", 90061.0: "25小时1分1秒", None: None}
    df = spark.createDataFrame([(i, n) for i, n in enumerate(spans)], "id int, n double").orderBy("id")
    assert [r[0] for r in df.select(misc.duration_text(F.col("n"))).collect()] == list(spans.values())
    df = spark.createDataFrame([("train_loss: 0.5 step: 12",), ("step:7",), ("x",), (None,)], "x string")
    assert [tuple(r[0]) for r in df.select(misc.training_log(F.col("x"))).collect()] == [(0.5, 12), (None, 7), (None, None), (None, None)]
    assert df.select(misc.ordered_distinct(F.array(F.lit("b"), F.lit("a"), F.lit("b")))).first()[0] == ["b", "a"]
    assert [r[0] for w in (0, 30) for r in misc.column_width(df, "x", w).collect()] == [24, 30] and misc.column_width(df.limit(0), "x").first()[0] == 0
    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "config.json").write_text("{}", encoding="utf-8")
    (tmp_path / "bad.json").write_text("{", encoding="utf-8")
    wrong = (
        lambda: checks.check_account("12"), lambda: checks.check_time_range("2024-02-01,2024-01-01"), lambda: checks.check_time_range("2024-02-01,2024-02-01"),
        lambda: checks.check_time_range("2024-02-01"), lambda: checks.check_data_path("x.bin"), lambda: checks.check_path(" "), lambda: checks.check_path("../x", False),
        lambda: checks.check_path(str(tmp_path / "no")), lambda: checks.check_path(str(tmp_path / "no" / "x"), False, True), lambda: checks.check_positive("0", "n"),
        lambda: checks.check_positive("x", "n"), lambda: checks.check_number("2", "n", 0, 1), lambda: checks.check_number(None, "n"), lambda: checks.check_choice("c", "n", ("a", "b")),
        lambda: checks.check_url("ftp://x"), lambda: checks.check_url("http://"), lambda: checks.check_model_path(str(tmp_path)), lambda: checks.check_model_path(str(tmp_path / "bad.json")),
        lambda: checks.check_json_file(str(tmp_path / "bad.json")), lambda: checks.check_json_file(str(tmp_path / "model")))
    for call in wrong:
        with pytest.raises(ValueError):
            call()
    assert checks.check_positive("3", "n") == 3 and checks.check_number("0.5", "n", 0, 1) == 0.5 and checks.check_choice("A", "n", ("a",), True) == "a"
    assert checks.check_url("https://x/y") and checks.check_account(12345) == "12345" and checks.check_time_range("2024-01-01, 2024-02-01")[1].month == 2
    assert checks.check_model_path(str(tmp_path / "model")) and checks.check_json_file(str(tmp_path / "model" / "config.json")) and checks.check_data_path(str(tmp_path / "bad.json"))
    path = tmp_path / "x.txt"
    assert sinks.keep_backup(spark, str(path)) is None
    path.write_text("a", encoding="utf-8")
    assert sinks.keep_backup(spark, str(path), dt.datetime(2024, 1, 1)) == f"{path}.20240101000000.bak" and not path.exists()
    sinks.copy_tree(spark, f"{path}.20240101000000.bak", str(tmp_path / "y.txt"))
    assert (tmp_path / "y.txt").read_text(encoding="utf-8") == "a"
    nobody = ModelClient("http://127.0.0.1:9", "m", timeout=0.2, retries=0)
    assert nobody.models() == [] and not nobody.healthy() and nobody.chat([]) is None
    with pytest.raises(ConnectionError):
        nobody.score([("a", "b")])


def test_messages_of_any_length_pass_the_wire(spark, tmp_path):
    sizes = [1, 127, 128, 300, 16383, 16384, 70000, 2097151, 2097152]
    rows = [(n, "x" * (n % 3) + "字" * (n // 3)) for n in sizes] + [(-1, None), (-2, "")]
    spark.createDataFrame(rows, "row_id long, msg string").write.parquet(f"{tmp_path}/messages.parquet")
    assert {r.row_id: r.msg for r in protobuf_decode(spark, str(tmp_path)).collect()} == {n: t for n, t in rows if t}


def test_varints(spark):
    numbers = [0, 1, 127, 128, 16383, 16384, 2097152, 268435455, 268435456, 2147483647]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", _varint(F.col("n")).alias("v"))
    for r in df.collect():
        assert read_varint(bytes(r.v), 0) == (r.n, len(r.v)) and len(r.v) == max(1, -(-r.n.bit_length() // 7))


def test_folders(spark):
    from colloqua.operators import folders

    files = spark.createDataFrame(
        [(f"file:/m/whole/{n}", 10) for n in ("config.json", "model.safetensors")] + [("file:/m/parts/config.json", 1), ("file:/m/parts/model-1.safetensors", None)]
        + [(f"file:/m/many/f{i:02}.txt", 1) for i in range(13)] + [("file:/m/many/x.md", 5), ("file:/m/deep/sub/config.json", 1), ("file:/m/top.json", 9), ("file:/mm/x/config.json", 9)],
        "path string, length long")
    placed = folders.with_folders(files, "/m")
    assert sorted(map(tuple, folders.roll_up(placed).collect())) == [("deep", 1, 1, False), ("many", 14, 18, False), ("parts", 2, 1, True), ("whole", 2, 20, True)]
    listed = folders.main_files(placed).where("folder = 'many'").collect()
    assert sorted(r["name"] for r in listed) == [f"f{i:02}.txt" for i in range(10)] and {r["more"] for r in listed} == {3}
    assert folders.roll_up(placed.limit(0)).count() == 0
    times = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9), ("d", None)], "path string, t long").select("path", F.timestamp_seconds("t").alias("modificationTime"))
    assert folders.latest(times).first()[0] == "c" and folders.latest(times.limit(0)).first()[0] is None


def test_training_files_of_any_path(spark, tmp_path):
    assert sources.read_training(spark, f"file://{tmp_path}/none*.json").count() == 0
    (tmp_path / "a.json").write_text('{"messages":[{"role":"user","content":"x"}]}', encoding="utf-8")
    assert sources.read_training(spark, f"file://{tmp_path}/*.json").count() == sources.read_training(spark, str(tmp_path / "a.json")).count() == 1


def test_texts_nested_forty_deep(spark):
    body = b"deep"
    for _ in range(40):
        body = b"\x0a" + bytes([len(body)]) + body if len(body) < 128 else b"\x0a" + bytes([len(body) & 127 | 128, len(body) >> 7]) + body
    assert "deep" in harvest(body)


def test_stores_of_any_keys(spark, tmp_path):
    from colloqua.sources import sqlite as Q

    with sqlite3.connect(tmp_path / "a.db") as store:
        store.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, x TEXT)")
        store.executemany("INSERT INTO t VALUES (?, ?)", [(k, f"v{i}") for i, k in enumerate([-5, 1, 2, 3, 9_000_000_000_000_000_000, 9_000_000_000_000_000_001, 1704067200000000000])])
    with sqlite3.connect(tmp_path / "b.db") as store:
        store.execute("CREATE TABLE t (id TEXT PRIMARY KEY, x TEXT) WITHOUT ROWID")
        store.executemany("INSERT INTO t VALUES (?, ?)", [("p", "w0"), ("q", "w1")])
    with sqlite3.connect(tmp_path / "c.db") as store:
        store.execute("CREATE TABLE t (id INT, x TEXT)")
    everything = Q.scan(spark, str(tmp_path / "*.db"), "t", ("id", "x", Q.FILE, Q.ROWID), "id string, x string, _file string, _rowid bigint")
    got = sorted((r.x, r._rowid) for r in everything.collect())
    assert [x for x, _ in got] == [*(f"v{i}" for i in range(7)), "w0", "w1"] and got[0][1] == -5 and got[-1][1] is None
    reader = Q.SqliteReader({"path": str(tmp_path / "*.db"), "table": "t", "columns": "x", "rows": "2"}, None)
    parts = reader.partitions()
    assert [(p.low, p.high) for p in parts if p.keyed] == [(-5, 1), (2, 3), (1704067200000000000, 9_000_000_000_000_000_000), (9_000_000_000_000_000_001, 9_000_000_000_000_000_001)]
    assert sorted(x for p in parts for (x,) in reader.read(p)) == [x for x, _ in got]
    counted = Q.query(spark, str(tmp_path / "[ab].db"), "SELECT count(*) AS n, max(x) AS top FROM t", ("n", "top"), "n bigint, top string")
    assert sorted(map(tuple, counted.collect())) == [(2, "w1"), (7, "v6")]
    (tmp_path / "d.db").write_bytes(b"no store at all" * 100)
    assert [f[0] for f in Q.broken_stores(str(tmp_path / "*.db"), "t")] == [str(tmp_path / "d.db")]
    assert Q.scan(spark, str(tmp_path / "*.db"), "t", ("x",), "x string", mode="permissive").count() == 9
    with pytest.raises(Exception, match="database"):
        Q.scan(spark, str(tmp_path / "*.db"), "t", ("x",), "x string").count()


def test_wechat_numbers_in_the_order_of_stores(spark, tmp_path):
    from colloqua.sources.sqlite import peers

    for n, rows in enumerate([[("1", 9), ("2", 5), ("3", 5)], [("4", 1), ("5", 7000), ("6", 3)]]):
        with sqlite3.connect(tmp_path / f"MSG{n}.db") as store:
            store.execute("CREATE TABLE MSG (MsgSvrID TEXT, IsSender INT, CreateTime INT, StrTalker TEXT, StrContent TEXT, Type INT)")
            store.executemany("INSERT INTO MSG VALUES (?, 0, ?, 'a', 'hi', 1)", rows)
    (tmp_path / "MSG2.db").write_bytes(b"broken" * 500)
    got = {r.MsgSvrID: r.id for r in read_wechat(spark, str(tmp_path)).collect()}
    assert got == {"2": 1, "3": 2, "1": 3, "4": 4, "6": 5, "5": 6}
    for n, who in enumerate([(1, 2, 2), (2, 3, None)]):
        with sqlite3.connect(tmp_path / f"q{n}.db") as store:
            store.execute('CREATE TABLE c2c_msg_table ("40030" INT)')
            store.executemany("INSERT INTO c2c_msg_table VALUES (?)", [(w,) for w in who])
    assert sorted(r.peer for r in peers(spark, str(tmp_path / "q*.db")).collect()) == [1, 2, 3]


def test_exports_as_streams(tmp_path, monkeypatch):
    import io

    from colloqua.sources import json_stream, telegram

    items = [{"id": i, "text": "x" * i, "n": 10**i, "e": [1, {"a": "]}\\\""}]} for i in range(30)]
    head = {"name": "n", "type": "t", "id": 5}
    good = [json.dumps({**head, "messages": items}), json.dumps({"messages": items, **head}, indent=2), json.dumps({"x": {"messages": 1}, **head, "messages": []})]
    bad = ["", "[]", "{", json.dumps(head), json.dumps({**head, "messages": {}}), good[0][:-1], good[0][:200], good[0] + "x", "nul"]
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(json_stream, "_CHUNK", size)
        assert all(telegram.header_of(io.StringIO(t)) == {**head, "messages": True} for t in good)
        assert [telegram.header_of(io.StringIO(t)) for t in bad] == [None] * len(bad)
        for k, text in enumerate(good):
            (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
            rows = list(telegram.TelegramReader({}).read(telegram._Export(str(tmp_path / f"{k}.json"))))
            assert [json.loads(r[3]) for r in rows] == (items if k < 2 else []) and all(r[:2] == ("n", "5") for r in rows)
            assert telegram.is_export(str(tmp_path / f"{k}.json"))
