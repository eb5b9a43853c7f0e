"""Scoring and cleaning through an injected judge, batch by batch.

A judge is any picklable callable; cheap tests come before it as expressions, so
that only rows that need it reach Python. Retries and fail-open rules are kept
inside the batch.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloqua.functions import dialogue as D
from colloqua.functions import text as T

#: prompts of a batch, as (id, rendered dialogue) -> the judge's reply
Judge = Callable[[list[tuple[str, str]]], str]
IMAGE_SCORE = 6


def with_retries(call: Callable[[], str], retries: int, delay: float) -> str | None:
    """The call's result, after at most ``retries`` more tries with doubling pauses; None if all fail."""
    for attempt in range(retries + 1):
        try:
            return call()
        except Exception:  # noqa: BLE001 - a judge may fail in any way
            if attempt < retries:
                time.sleep(delay * 2**attempt)
    return None


def parse_reply(reply: str) -> dict[str, int]:
    """Scores by id, as :func:`colloqua.functions.dialogue.parse_scores` reads them; the last verdict of an id wins."""
    text = reply.strip()
    try:
        found = json.loads(text) if text.startswith("[") else None
    except ValueError:
        found = []
    if found is None:
        found = []
        for line in map(str.strip, text.split("\n")):
            if line.startswith("{") and line.endswith("}"):
                try:
                    found.append(json.loads(line))
                except ValueError:
                    continue
    scores = {}
    for verdict in found:
        if isinstance(verdict, dict) and "id" in verdict:
            try:
                scores[str(verdict["id"])] = int(verdict.get("score", 0))
            except (TypeError, ValueError):
                scores[str(verdict["id"])] = 0
    return scores


def score_pairs(df: DataFrame, judge: Judge, batch_size: int = 10, retries: int = 3, delay: float = 1.0) -> DataFrame:
    """``df`` (id, messages, images) with ``score``.

    Pairs with images have 6 and don't reach the judge. A failed batch has 0, an
    id without a verdict null. Of equal ids the first dialogue by its text is
    judged, and all have its score; a null id is none and has null.
    """
    has_images = F.coalesce(F.size("images") > 0, F.lit(False)) if "images" in df.columns else F.lit(False)
    pictured = df.where(has_images).withColumn("score", F.lit(IMAGE_SCORE))
    plain = df.where(~has_images)
    # One row for each id before the judge, who is slow and paid; the texts are compared on the map side.
    asked = plain.where("id IS NOT NULL").groupBy("id").agg(F.min(D.rendered(F.col("messages"))).alias("__prompt"))

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                pairs = list(zip(part["id"].astype(str), part["__prompt"]))
                reply = with_retries(lambda pairs=pairs: judge(pairs), retries, delay)
                scores = parse_reply(reply) if reply is not None else dict.fromkeys((i for i, _ in pairs), 0)
                yield pd.DataFrame({"__id": part["id"], "score": pd.array([scores.get(str(i)) for i in part["id"]], dtype="Int32")})

    kind = asked.select(F.col("id").alias("__id"), F.lit(None).cast("int").alias("score")).schema
    scored = asked.mapInPandas(step, kind)
    joined = plain.join(scored, plain["id"] == scored["__id"], "left").drop("__id")
    return joined.unionByName(pictured)


def histogram(df: DataFrame, score: str = "score") -> DataFrame:
    """``score, n`` of the scores there are, in order."""
    return df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n")).orderBy(score)


def counters(df: DataFrame, least: int) -> DataFrame:
    """``total, accepted, missing``: all pairs, those of a score of at least ``least``, those without."""
    score = F.col("score").try_cast("int")
    return df.agg(F.count("*").alias("total"), F.count_if(score >= least).alias("accepted"), F.count_if(score.isNull()).alias("missing"))


def accepted(df: DataFrame, least: int) -> DataFrame:
    """U4: rows whose score is a number of at least ``least``."""
    return df.where(F.coalesce(F.col("score").try_cast("int"), F.lit(0)) >= least)


def judge_texts(df: DataFrame, judge: Callable[[str], str], text: str = "text", entropy_limit: float = 5.0) -> DataFrame:
    """``df`` with ``verdict`` (is_valid, cleaned_text, reason, confidence).

    Texts of more entropy than the limit are invalid (.9) before the judge; a
    reply that isn't JSON makes them invalid (.3); a judge that fails, valid.
    """
    kind = "struct<is_valid:boolean,cleaned_text:string,reason:string,confidence:double>"

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            replies = []
            for t in texts:
                if t is None:
                    replies.append(None)
                    continue
                try:
                    replies.append(judge(t))
                except Exception:  # noqa: BLE001 - fail-open
                    replies.append('{"is_valid": true, "reason": "judge failed"}')
            yield pd.Series(replies)

    wild = T.char_entropy(F.col(text)) > entropy_limit
    reply = F.from_json(D.without_thought(ask(F.when(~wild, F.col(text)))), kind)

    def verdict(valid, cleaned, reason, confidence):
        return F.struct(valid.alias("is_valid"), cleaned.alias("cleaned_text"), reason.alias("reason"), confidence.alias("confidence"))

    asked = df.withColumn("__reply", reply)
    r = F.col("__reply")
    return asked.withColumn(
        "verdict",
        F.when(wild, verdict(F.lit(False), F.lit(""), F.lit("entropy"), F.lit(0.9)))
        .when(r["is_valid"].isNull() & r["cleaned_text"].isNull(), verdict(F.lit(False), F.lit(""), F.lit("no verdict"), F.lit(0.3)))
        .otherwise(verdict(F.coalesce(r["is_valid"], F.lit(False)), F.coalesce(r["cleaned_text"], F.col(text)), F.coalesce(r["reason"], F.lit("")), F.coalesce(r["confidence"], F.lit(0.5)))),
    ).drop("__reply")


def batch_clean(df: DataFrame, judge: Callable[[str], str], text: str = "text", context: str | None = None) -> DataFrame:
    """:func:`judge_texts` over texts, each after its context where there is one."""
    if context is None:
        return judge_texts(df, judge, text)
    asked = F.when(F.coalesce(F.col(context), F.lit("")) != "", F.concat(F.lit("Context: "), context, F.lit("\n"), text)).otherwise(F.col(text))
    judged = judge_texts(df.withColumn("__asked", asked), judge, "__asked").drop("__asked")
    same = judged["verdict"]["cleaned_text"] == asked
    return judged.withColumn("verdict", F.when(same, judged["verdict"].withField("cleaned_text", F.col(text))).otherwise(judged["verdict"]))


def segment_conversations(df: DataFrame, judge: Callable[[str], str], keep_failed: bool = True) -> DataFrame:
    """``df`` with the messages the judge removes by index taken out.

    If the judge fails, or its reply isn't understood, a conversation is kept
    whole, or left out with ``keep_failed`` false.
    """

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            yield pd.Series([with_retries(lambda p=p: judge(p), 0, 0.0) for p in prompts], dtype=object)

    reply = F.from_json(D.without_thought(ask(D.numbered(F.col("messages")))), "struct<removed_indices:array<int>,reason:string>")
    judged = df.withColumn("__removed", reply["removed_indices"])
    if not keep_failed:
        judged = judged.where("__removed IS NOT NULL")
    return judged.withColumn("messages", D.without_indices(F.col("messages"), F.col("__removed"))).drop("__removed")


def length_judge(pairs: list[tuple[str, str]]) -> str:
    """A judge for tests and dry runs: 1 to 5 by the dialogue's length."""
    return json.dumps([{"id": i, "score": len(text) % 5 + 1} for i, text in pairs])
