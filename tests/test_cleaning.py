"""Judged cleaning end to end, and sources and sinks around it."""

import json
import sqlite3
import sys
import types

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from colloqua import __main__ as cli
from colloqua import session
from colloqua.config import Settings, coerce, load_settings
from colloqua.functions import dialogue as D
from colloqua.operators import scoring, sets
from colloqua.plans import pipeline
from colloqua.sinks import files as sinks
from colloqua.sources import files as sources


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # judges travel to the workers


def lines_of(folder, spark):
    return [r.value for r in spark.read.text(str(folder)).collect()]


def dialogue(k):
    return {"messages": [{"role": "user", "content": f"q{k}"}, {"role": "user", "content": "more"}, {"role": "assistant", "content": "a" * (k % 7)}]}


def by_number(pairs):
    """4 for every third dialogue, no verdict for the tenth."""
    return json.dumps([{"id": i, "score": 4 if int(text.split("\n")[0][7:]) % 3 == 0 else 1} for i, text in pairs if "q10\n" not in text])


def fails(_):
    raise ConnectionError


@pytest.fixture
def pairs_file(tmp_path):
    path = tmp_path / "pairs.jsonl"
    path.write_text("\n".join(json.dumps(dialogue(k)) for k in range(25)), encoding="utf-8")
    return path


def test_scoring_keeps_the_order_of_the_input(spark, tmp_path, pairs_file):
    out, scored = tmp_path / "out", tmp_path / "scored"
    out.mkdir()
    (out / "old").write_text("x", encoding="utf-8")
    settings = Settings(accept_score=2, delay=0.0)
    counts = pipeline.clean_llm(spark, str(pairs_file), str(out), by_number, settings, scored=str(scored)).first()
    assert tuple(counts) == (25, 9, 1)
    kept = [json.loads(t)["messages"] for t in lines_of(out, spark)]
    assert [m[0]["content"] for m in kept] == [f"q{k}\nmore" for k in range(0, 25, 3)]  # 0, 3, 6, ... and not 0, 12, 15, ...
    assert any(p.name.startswith("out.") and p.name.endswith(".bak") and (p / "old").exists() for p in tmp_path.iterdir())
    rows = spark.read.option("header", True).csv(str(scored)).collect()
    assert [r[1] for r in rows] == [f"q{k}" for k in range(25)] and rows[10][3] is None and rows[9][3] == "4"


def test_strategies_and_fall_back(spark, tmp_path, pairs_file):
    judge = lambda text: '{"removed_indices": [1]}' if "q3\n" not in text else "no verdict"
    assert pipeline.clean_llm(spark, str(pairs_file), str(tmp_path / "segments"), judge, strategy="segment").first()[0] == 24
    first = json.loads(lines_of(tmp_path / "segments", spark)[0])["messages"]
    assert [m["content"] for m in first] == ["q0", ""]
    with pytest.raises(ValueError):
        pipeline.clean_llm(spark, str(pairs_file), str(tmp_path / "x"), judge, strategy="other")
    csv = tmp_path / "room"
    csv.mkdir()
    head = "id,MsgSvrID,type_name,is_sender,talker,msg,src,CreateTime,room_name,is_forward\n"
    (csv / "room_chat.csv").write_text(head + '1,s1,text,0,a,早上好呀,,2024-01-01 08:00:00,room,0\n2,s2,text,1,b,你也早上好,,2024-01-01 08:01:00,room,0\n3,s3,text,0,a,broken', encoding="utf-8")
    assert pipeline.clean(spark, str(csv), str(tmp_path / "rules"), None) == "rules"
    assert len(lines_of(tmp_path / "rules", spark)) == 1
    assert pipeline.clean(spark, str(csv), str(tmp_path / "judged"), scoring.length_judge, Settings(accept_score=1, delay=0.0)) == "scoring"
    (tmp_path / "single").mkdir()
    (tmp_path / "single" / "x.csv").write_text(head + "1,s1,text,0,a,早上好呀,,2024-01-01 08:00:00,room,0\n", encoding="utf-8")
    assert pipeline.clean(spark, str(tmp_path / "single"), str(tmp_path / "fell"), scoring.length_judge) == "rules" and lines_of(tmp_path / "fell", spark) == []
    unified = sources.read_unified(spark, str(csv / "room_chat.csv"))
    assert [r.id for r in pipeline.rejected_rows(unified).collect()] == [3]


def test_scoring_as_it_comes(spark, tmp_path):
    schema = f"id string, messages {D.MESSAGES}, _file string, line_no bigint"
    for part in range(3):
        rows = [(f"p_{k}", [(m["role"], m["content"]) for m in dialogue(k)["messages"]], "p", k) for k in range(part * 12, part * 12 + 12)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "pairs"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "pairs"))
        sinks.score_as_they_come(stream, by_number, str(tmp_path / "out"), str(tmp_path / "state"), 2, delay=0.0).awaitTermination()
    for number in range(3):
        kept = [json.loads(t)["messages"][0]["content"] for t in lines_of(tmp_path / "out" / "accepted" / f"batch={number}", spark)]
        assert kept == [f"q{k}\nmore" for k in range(number * 12, number * 12 + 12, 3)]
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "scored")).count() == 36


def test_every_id_is_judged_once(spark):
    asked = spark.sparkContext.accumulator(0)

    def judge(pairs):
        asked.add(len(pairs))
        return scoring.length_judge(pairs)

    rows = [("a", "x"), ("a", "yy"), ("a", "x"), ("b", "x"), (None, "x")]
    df = spark.createDataFrame([(i, [("user", t)]) for i, t in rows], f"id string, messages {D.MESSAGES}")
    got = sorted(((r.id or "", r.score) for r in scoring.score_pairs(df, judge, delay=0.0).collect()), key=str)
    assert got == [("", None), ("a", 3), ("a", 3), ("a", 3), ("b", 3)] and asked.value == 2
    failed = scoring.score_pairs(df, fails, retries=1, delay=0.0)
    assert {(r.id, r.score) for r in failed.collect()} == {("a", 0), ("b", 0), (None, None)}
    texts = spark.createDataFrame([("hi", "before"), ("yo", None)], "text string, ctx string")
    seen = lambda t: json.dumps({"is_valid": True, "cleaned_text": t.upper()})
    assert [r.verdict.cleaned_text for r in scoring.batch_clean(texts, seen, context="ctx").collect()] == ["CONTEXT: BEFORE\nHI", "YO"]
    assert [r.verdict.cleaned_text for r in scoring.batch_clean(texts, fails, context="ctx").collect()] == ["hi", "yo"]


def test_documents_and_arrays(spark, tmp_path):
    df = spark.createDataFrame([(i, json.dumps({"k": i})) for i in range(50)], "i int, record string")
    sinks.write_records(df.orderBy(F.col("i").desc()), str(tmp_path / "a.json"))
    part = next((tmp_path / "a.json").glob("part-*"))
    assert json.loads(part.read_text(encoding="utf-8")) == [{"k": i} for i in range(49, -1, -1)]
    assert [json.loads(r.record)["k"] for r in sources.read_strict(spark, str(part)).orderBy("line_no").collect()] == list(range(49, -1, -1))
    sinks.write_records(df.limit(0), str(tmp_path / "b.json"))
    assert json.loads(next((tmp_path / "b.json").glob("part-*")).read_text(encoding="utf-8")) == []
    (tmp_path / "c.json").write_text('{"k": 1}', encoding="utf-8")
    with pytest.raises(Exception, match="no JSON array"):
        sources.read_strict(spark, str(tmp_path / "c.json")).count()
    (tmp_path / "seg.json").write_text(json.dumps([{"role": "user", "content": c, "timestamp": {"start": s, "end": s + 1}} for c, s in (("b", 2.0), ("a", 1.0), (" ", 0.0))]), encoding="utf-8")
    user, other = sources.read_segments(spark, str(tmp_path / "seg.json")), sources.read_segments(spark, str(tmp_path / "seg.json"), "x")
    assert {r.role for r in other.collect()} == {"x"} and user.count() == 2
    merged = sources.merge_tracks(user, other)
    assert [(r.role, r.content) for r in merged.collect()] == [("user", "a"), ("assistant", "a"), ("user", "b"), ("assistant", "b")]
    assert [r.pos for r in sources.merge_tracks(user, other, to="pos").orderBy("pos").collect()] == [1, 2, 3, 4]
    text = "\n".join(r.value for r in sinks.timed_document(merged).collect())
    assert [(x["role"], x["content"]) for x in json.loads(text)] == [("user", "a"), ("assistant", "a"), ("user", "b"), ("assistant", "b")]
    probe = spark.createDataFrame([('{"streams": [{"index": 0, "codec_type": "video"}, {"index": 1, "codec_type": "audio", "codec_name": "aac", "channels": 2}]}',)], "value string")
    assert [tuple(r) for r in sources.audio_streams(probe).collect()] == [(1, "aac", "2", "unknown")]
    assert {r.path.split("/")[-1]: r.length for r in sources.list_files(spark, str(tmp_path / "c.json")).collect()} == {"c.json": 8}
    assert sources.count_records(spark, str(part)) == 50 and sources.count_records(spark, str(tmp_path / "c.json")) == 0
    (tmp_path / "d.json").write_text('{"x": 1, "messages": [1, 2]}', encoding="utf-8")
    (tmp_path / "e.jsonl").write_text("1\n2\n3\n", encoding="utf-8")
    assert sources.count_records(spark, str(tmp_path / "d.json")) == 2 and sources.count_records(spark, str(tmp_path / "e.jsonl")) == 3


def test_inference_in_batches(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps({"input": f"x{i}", "expected": "x1"}) for i in range(12)), encoding="utf-8")
    answered = pipeline.batch_infer(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out.jsonl"), lambda t: t.upper(), "m")
    rows = [json.loads(t) for t in lines_of(tmp_path / "out.jsonl", spark)]
    assert [r["input"] for r in rows] == [f"x{i}" for i in range(12)] and rows[3]["output"] == "X3" and rows[0]["metadata"]["model_path"] == "m" and answered.count() == 12
    (tmp_path / "bad.jsonl").write_text('{"input": "x"}\n{"text": "y"}', encoding="utf-8")
    with pytest.raises(Exception, match="no input in record 2"):
        pipeline.batch_infer(spark, str(tmp_path / "bad.jsonl"), str(tmp_path / "no.jsonl"), str.upper)
    df = spark.createDataFrame([("ab", "ab"), ("ab", "bc"), ("", "x"), (None, "x")], "output string, expected string")
    assert pipeline.mean_similarity(df).first()[0] == pytest.approx((1 + 1 / 3) / 4) and pipeline.mean_similarity(df.limit(0)).first()[0] is None
    everything = sets.mix_all(spark.range(50).toDF("id"), spark.range(50, 90).toDF("id").withColumn("x", F.lit(1)), "id").collect()
    assert sorted(r.id for r in everything) == list(range(90)) != [r.id for r in everything]
    mixed = pipeline.mix(spark.range(100).withColumn("x", F.lit("a")), spark.range(1000, 1100).withColumn("x", F.lit("b")), 10)
    assert mixed.groupBy("x").count().orderBy("x").collect()[1]["count"] == 10
    assert pipeline.mix(spark.range(10), spark.range(10), 50).collect() == pipeline.mix(spark.range(10), spark.range(10), 50).collect()


def test_one_source_that_fails(spark, tmp_path):
    (tmp_path / "wechat").mkdir()
    with sqlite3.connect(tmp_path / "wechat" / "MSG0.db") as store:
        store.execute("CREATE TABLE MSG (MsgSvrID TEXT, IsSender INT, CreateTime INT, StrTalker TEXT, StrContent TEXT, Type INT)")
        store.execute("INSERT INTO MSG VALUES ('1', 0, 5, 'a', 'hi', 1)")
    with sqlite3.connect(tmp_path / "q.db") as store:
        store.execute("CREATE TABLE c2c_msg_table (other INT)")
        store.execute("INSERT INTO c2c_msg_table VALUES (1)")
    failed = []
    assert sources.read_all(spark, str(tmp_path), failed=failed).count() == 1 and failed == ["qq"]
    with pytest.raises(Exception):
        sources.read_all(spark, str(tmp_path))


def test_shared_folder(spark):
    staged = session.staged(spark.range(5), "x")
    assert staged.count() == 5
    paths = list(session._MADE[spark.sparkContext.applicationId])
    assert session.clean_shared(spark) == len(paths) and session.clean_shared(spark) == 0
    with pytest.raises(Exception):
        staged.count()
    context = types.SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://cluster:7077")
    with pytest.raises(RuntimeError):
        session.shared_folder(types.SimpleNamespace(conf={}, sparkContext=context))


def test_bounds_of_settings(tmp_path):
    assert coerce("0", 10, (1, None)) == 10 and coerce("x", 10) == 10 and coerce("7", 10, (1, 9)) == 7 and coerce("0.5", 1.0, (0, 1)) == 0.5
    (tmp_path / "s.json").write_text('{"a": {"batch_size": 0, "retries": "5"}}', encoding="utf-8")
    assert load_settings(str(tmp_path / "s.json")).batch_size == 10 and load_settings(str(tmp_path / "s.json")).retries == 5


def test_command_line(spark, tmp_path, pairs_file, capsys, monkeypatch):
    monkeypatch.setattr(cli, "local_session", lambda: spark)
    monkeypatch.setattr(cli, "clean_shared", lambda _: 0)
    assert cli.main(["count", str(pairs_file)]) == 0 and capsys.readouterr().out.strip() == "25"
    csv = tmp_path / "room.csv"
    csv.write_text("id,MsgSvrID,type_name,is_sender,talker,msg,src,CreateTime,room_name,is_forward\n1,s1,text,0,a,早上好呀,,2024-01-01 08:00:00,room,0\n2,s2,text,1,b,你也早上好,,2024-01-01 08:01:00,room,0\n", encoding="utf-8")
    settings = tmp_path / "s.json"
    settings.write_text('{"base_url": "http://127.0.0.1:9", "model": "m", "retries": 0, "delay": 0}', encoding="utf-8")
    assert cli.main(["--settings", str(settings), "clean", "llm", str(csv), str(tmp_path / "out"), "--accept", "1", "--strategy", "segment"]) == 0
    assert capsys.readouterr().out.strip() == "segment" and lines_of(tmp_path / "out", spark) == []  # nobody answers, so no verdict
    assert cli.main(["clean", "raw", str(csv), str(tmp_path / "raw")]) == 0 and len(lines_of(tmp_path / "raw", spark)) == 1
