"""The curation pipeline end to end: extract, clean, convert, mix, merge, preview, stats."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloqua.config import Settings
from colloqua.functions import dialogue as D
from colloqua.functions import text as T
from colloqua.operators import bursts as B
from colloqua.operators import scoring, sets
from colloqua.session import staged
from colloqua.sinks import files as sinks
from colloqua.sources import files as sources


def extract(spark: SparkSession, folder: str, out: str, settings: Settings = Settings(), prefer: str | None = None) -> DataFrame | None:
    """Native exports to unified CSV, a folder for each room; the messages, or None without a source."""
    rows = sources.read_all(spark, folder, prefer, settings.owner_id, settings.telegram_chat_id, settings.alnum_rule)
    if rows is not None:
        sinks.write_rooms(rows, out)
    return rows


def select_messages(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """P1-P5 over unified rows: ``room, us, seq, side, msg``."""
    kept = df.where(F.col("type_name").isin(*settings.include_type) & (F.coalesce("is_forward", F.lit(0)) != 1))
    kept = kept.withColumn("msg", T.squeeze_blanks(F.col("msg"))).where(~T.blocked(F.col("msg"), settings.blocked_words))
    return B.ordered_rows(kept, "room_name", "is_sender", "msg", "CreateTime", "_seq")


def rejected_rows(df: DataFrame) -> DataFrame:
    """Unified rows that don't parse, or whose time doesn't, for quarantine."""
    return df.where(F.col("CreateTime").isNull() | F.col("_corrupt_record").isNotNull())


def clean_raw(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Unified rows to dialogues by rules: ``room, us, seq, messages``."""
    if settings.require_owner_id and not settings.owner_id:
        df = df.limit(0)
    bursts = B.merge_bursts(select_messages(df, settings), settings.single_combine_time_window * 60, settings.combine_msg_max_length)
    return B.build_dialogues(
        bursts, settings.qa_match_time_window * 60, settings.messages_max_length, settings.context_rows, settings.system_prompt
    )


def scoring_pairs(df: DataFrame) -> DataFrame:
    """A4: unified rows of files to ``id, messages, _file, line_no`` conversations of two rows or more, in file order.

    A conversation begins at a user row whose predecessor is an assistant row.
    Files are cut into blocks of their rows' numbers, so that one may hold any
    share of the rows; ``id`` counts a file's conversations from 0.
    """
    rows = df.select(F.col("_file").alias("room"), (F.col("_seq") * 1_000_000).alias("us"), F.col("id").alias("seq"), F.col("is_sender").alias("side"), "msg")
    convs = staged(B.conversations(rows), "pairs")
    name = F.element_at(F.split("room", "/"), -1)
    role = lambda s: F.when(s["side"] == 1, "assistant").otherwise("user")
    return B.row_numbers(convs).where("n >= 2").select(
        F.concat_ws("_", name, (F.col("idx") - 1).cast("string")).alias("id"),
        F.transform("said", lambda s: D.message(role(s), s["msg"])).alias("messages"), F.col("room").alias("_file"), F.col("idx").alias("line_no"),
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``id, messages, images, _file, line_no`` of dialogues in JSON lines, or of a tree or file of unified CSV."""
    if path.endswith(".jsonl"):
        return sources.read_dialogues(spark, path)
    return scoring_pairs(sources.read_scoring_rows(spark, path))


def clean_llm(
    spark: SparkSession, path: str, out: str, judge: Callable, settings: Settings = Settings(), strategy: str = "scoring", scored: str | None = None
) -> DataFrame:
    """Dialogues judged and written to ``out``; what was there is moved aside.

    By ``scoring``, pairs of at least the accepted score, all with their scores to
    ``scored`` where it is given; the counters are returned. By ``segment``,
    dialogues without the messages the judge removes, those without a verdict
    left out; the number written is returned. An input without dialogues is an
    error.
    """
    if strategy not in ("scoring", "segment"):
        raise ValueError(f"no strategy: {strategy}")
    pairs = read_pairs(spark, path)
    if pairs.isEmpty():
        raise ValueError(f"no dialogues in {path}")
    sinks.keep_backup(spark, out)
    if strategy == "segment":
        kept = staged(scoring.segment_conversations(pairs, judge, keep_failed=False).where(F.size("messages") > 0), "segments")
        sinks.write_chatml(kept.orderBy("_file", "line_no"), out, settings.system_prompt)
        return kept.agg(F.count("*").alias("accepted"))
    judged = staged(scoring.score_pairs(pairs, judge, settings.batch_size, settings.retries, settings.delay), "scored")
    sinks.write_accepted(judged, out, settings.accept_score, settings.system_prompt)
    if scored is not None:
        sinks.keep_backup(spark, scored)
        sinks.write_scored(judged, scored, ("_file", "line_no"))
    return scoring.counters(judged, settings.accept_score)


def clean(spark: SparkSession, path: str, out: str, judge: Callable | None, settings: Settings = Settings(), strategy: str = "scoring", scored: str | None = None) -> str:
    """Cleaning by a judge, or by rules where there is none or judging fails; which of the two it was."""
    if judge is not None:
        try:
            clean_llm(spark, path, out, judge, settings, strategy, scored)
            return strategy
        except Exception as error:  # noqa: BLE001 - any failure falls back to the rules
            print(f"judged cleaning failed, cleaning by rules: {error}", file=sys.stderr)
    found = clean_raw(sources.read_unified(spark, path), settings)
    sinks.write_chatml(found.orderBy("room", "us", "seq"), out, settings.system_prompt)
    return "rules"


def batch_infer(spark: SparkSession, path: str, out: str, model: Callable[[str], str], model_path: str = "") -> DataFrame:
    """``input, output`` of each record, written with the model's path and the time; a record without input fails the run."""
    rows = sources.read_strict(spark, path)
    given = F.get_json_object("record", "$.input")
    checked = F.when(given.isNotNull(), given).otherwise(F.raise_error(F.concat(F.lit("no input in record "), F.col("line_no").cast("string"))))

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model(t) for t in texts], dtype=object)

    answered = staged(rows.select("_file", "line_no", checked.alias("input")).withColumn("output", answer("input")), "answers")
    meta = F.struct(F.unix_micros(F.current_timestamp()).cast("double").__truediv__(1e6).alias("timestamp"), F.lit(model_path).alias("model_path"))
    sinks.write_records(answered.orderBy("_file", "line_no").select(F.to_json(F.struct("input", "output", meta.alias("metadata"))).alias("record")), out)
    return answered.select("input", "output")


def mean_similarity(df: DataFrame, output: str = "output", expected: str = "expected") -> DataFrame:
    """``similarity``: the mean share of characters that outputs and expected texts have in common; null without rows."""
    either = (F.coalesce(F.col(output), F.lit("")) == "") | (F.coalesce(F.col(expected), F.lit("")) == "")
    return df.agg(F.avg(F.when(either, 0.0).otherwise(T.char_jaccard(F.col(output), F.col(expected)))).alias("similarity"))


def convert_records(df: DataFrame, prompt: str = "") -> DataFrame:
    """Foreign question-answer records of any format to ``messages``; others are dropped."""
    messages = F.coalesce(
        D.turns_to_messages(F.col("turns"), prompt),
        F.when(F.col("messages").isNotNull(), D.replace_system(F.col("messages"), prompt)),
        D.instruction_to_messages(F.col("instruction"), F.col("input"), F.col("output"), prompt),
    )
    return df.withColumn("messages", messages).where("messages IS NOT NULL")


def mix(original: DataFrame, foreign: DataFrame, percentage: float, key: str = "id", seed: int = 42) -> DataFrame:
    """U-4 and O11: an exact share of foreign dialogues among the original ones, in hash order."""
    return sets.shuffled(sets.mix_by_percentage(original, foreign, key, percentage, seed), key, seed)


def merge(spark: SparkSession, paths: list[str], out: str, deduplicate: bool = True) -> DataFrame:
    """U-5, A9, K7: records of files in order, copies (keys in any order) once."""
    frames = [sources.read_strict(spark, p) for p in paths]
    identity = sets.canonical_json(F.col("record")) if deduplicate else None
    whole = sets.merge_records(frames, identity, ["line_no"])
    sinks.write_records(whole, out)
    return whole


def preview(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first records, long texts cut."""
    lines = sources.read_lines(spark, path).where("line <> ''")
    return sets.first_rows(lines, [F.col("_file"), F.col("line_no")], n).select(T.preview(F.col("line")).alias("line"))


def stats(spark: SparkSession, path: str) -> DataFrame:
    """A10: records, the average of top-level contents as the reference counts it, and that of all contents."""
    rows = sources.read_records(spark, path)
    length = F.coalesce(D.total_length(F.col("messages")), F.length("text"), F.lit(0))
    return rows.agg(
        F.count("*").alias("n_records"),
        F.expr("CASE WHEN count(*) > 0 THEN coalesce(sum(length(text)), 0) div count(*) END").alias("avg_length"),
        F.avg(length).alias("avg_content_length"),
    )
