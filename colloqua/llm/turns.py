"""Speech transcripts into clean speaker turns."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloqua.operators.islands import blocked_islands
from colloqua.session import staged

#: Seconds of a call's time block.
BLOCK_SECONDS = 600

#: What the two sides of a transcript are called.
USER_NAMES = ("user", "用户", "human", "customer", "caller", "client", "客户", "访客")
ASSISTANT_NAMES = ("assistant", "助手", "助理", "ai", "bot", "agent", "客服", "support", "operator", "customersupport", "customerservice")
#: The speaker of segments that have no label at all.
UNKNOWN = "unknown"
#: Phrases that say nothing when punctuation sets them off.
STOCK_PHRASES = {
    "you know", "i mean", "like", "you see", "sort of", "kind of", "basically", "literally",
    "就是说", "你知道吧", "那个", "怎么说呢", "怎么讲呢", "你知道", "就是", "然后呢", "这个",
}

#: Beginnings of words that tell a sound, a voice or a silence, in the languages of the transcripts.
SOUND_WORDS = (
    "music", "song", "singing", "sings", "humming", "laugh", "chuckl", "giggl", "applau", "clap", "cheer", "nois", "sound of", "sound effect", "static", "beep",
    "ringing", "rings", "phone ring", "knock", "click", "sigh", "cough", "sneez", "sniff", "crying", "sobb", "gasp", "breath", "whisper", "shout", "groan", "yawn",
    "inaudib", "unintell", "indistinct", "crosstalk", "overlapping", "silen", "paus", "door open", "door clos", "door slam", "typing", "mumbl", "clears throat",
    "musik", "lacht", "lachen", "applaus", "räusper", "husten", "hustet", "seufz", "stille", "rauschen", "unverständlich", "musique", "rires", "toux", "soupir", "bruit",
    "música", "risas", "aplauso", "suspir", "ruido", "музык", "смех", "смеёт", "аплодисмент", "кашель", "вздох", "шум", "пауза", "тишина", "неразборчиво",
)
SOUND_WORDS_ZH = (
    "音乐", "歌声", "唱歌", "哼", "笑声", "大笑", "轻笑", "笑）", "笑)", "掌声", "鼓掌", "欢呼", "噪", "杂音", "铃声", "哭", "叹气", "叹息", "咳", "喷嚏", "喘", "呼吸声", "低语", "喊", "哈欠",
    "听不清", "不清楚", "停顿", "沉默", "静音", "背景音", "敲门", "脚步声",
)

_TIME = r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
#: A time in brackets, or a time code that no speaker says: with seconds and more, or with a fraction.
_CLOCK = re.compile(rf"[\[(（【<]\s*{_TIME}\s*[\])）】>]|(?<![\d:.])\d{{1,3}}:\d{{2}}(?::\d{{2}}(?:[.,]\d{{1,3}})?|[.,]\d{{1,3}})(?![\d:])")
_LEAD_CLOCK = re.compile(rf"\s*{_TIME}(?![\d:])[\s\-–—|]*")
_SOUND = re.compile(r"\[[^\[\]]*\]|【[^【】]*】|<[^<>]*>|\*[^*\n]+\*|[♩♪♫♬]+")
_ROUND = re.compile(r"\([^()]*\)|（[^（）]*）")
_SOUND_WORD = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(SOUND_WORDS)})|{'|'.join(map(re.escape, SOUND_WORDS_ZH))}", re.I)
_LABEL = re.compile(r"\s*([A-Za-z一-鿿][\w .]{0,30}?)\s*[:：]\s*")
_TRACK = re.compile(r"(?:speaker|spkr?|track|channel|声道|音轨)0*(\d+)")
_SPLIT = re.compile(r"(\s+[-–—]+\s+|(?:(?<!\d)[,.:]|[,.:](?!\d)|[，。…！!？?、；;：—~～\n])+)")
_HESITATION_WORD = re.compile(r"(?<![A-Za-z'’])(?:u+h*m+|u+h+|e+r+m*|h+m+|m{2,})(?![A-Za-z'’])", re.I)
_HESITATION = re.compile(r"[嗯呃额唔呣\s]+")
_HESITATION_LEAD = re.compile(r"^\s*[嗯呃唔呣]+")
_EDGES = re.compile(r"[_\s.\-]+")


def bare_label(label: str) -> str:
    return _EDGES.sub("", label.casefold())


def track_of(label: str) -> int | None:
    m = _TRACK.fullmatch(bare_label(label))
    return int(m[1]) if m else None


_ROLES = frozenset((*USER_NAMES, *ASSISTANT_NAMES))


def _abbreviates(short: str, long: str) -> bool:
    """Same initial, and the letters of ``short`` come in order in ``long``."""
    if len(short) < 3 or len(short) > len(long) or short[0] != long[0]:
        return False
    rest = iter(long)
    return all(c in rest for c in short)


def _words(label: str) -> list[str]:
    return [w for w in _EDGES.split(label.casefold()) if w]


def similar(a: str, b: str) -> bool:
    """Variants of one label: alike by their initials and by their letters.

    Equal but for punctuation; word for word with the same initials, one being
    short for the other; a name without its other words; the abbreviation of a
    role (usr, asst.); or a slip of letters.
    """
    x, y = bare_label(a), bare_label(b)
    if x == y:
        return True
    if not x or not y or x[0] != y[0]:
        return False
    if y in _ROLES and _abbreviates(x, y) or x in _ROLES and _abbreviates(y, x):
        return True
    u, v = _words(a), _words(b)
    if len(u) == len(v) > 1 and all(p.startswith(q) or q.startswith(p) for p, q in zip(u, v)):
        return True
    if len(u) != len(v) and 1 in (len(u), len(v)) and u[0] == v[0] and len(u[0]) >= 3:
        return True
    return min(len(x), len(y)) >= 4 and difflib.SequenceMatcher(None, x, y).ratio() >= 0.75


def resolve_labels(labels: Mapping[str, int] | list[str]) -> dict[str, str]:
    """Label -> ``user``, ``assistant``, ``track N`` or the speaker's commonest label within one transcript.

    ``labels`` tells how often each occurs. Label variants and the known names are
    nodes; similar ones of one initial are united by union-find, names of one side
    from the start, and never both sides. A cluster goes by the side of the names
    in it, else by its commonest label, of equally common ones the least. A label
    without a letter or digit is none.
    """
    counts = labels if isinstance(labels, Mapping) else dict.fromkeys(labels, 1)
    found: dict[str, str] = {}
    plain: dict[str, str] = {}
    for label in counts:
        own = " ".join(_words(label))
        track = track_of(label)
        if track is not None:
            found[label] = f"track {track}"
        elif any(c.isalnum() for c in own):
            own = own[len("speaker "):] if own.startswith("speaker ") else own
            plain[label] = bare_label(own) if bare_label(own) in _ROLES else own
    nodes = list(dict.fromkeys([*USER_NAMES, *ASSISTANT_NAMES, *plain.values()]))
    parent = {n: n for n in nodes}

    def root(n: str) -> str:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for names in (USER_NAMES, ASSISTANT_NAMES):
        for name in names[1:]:
            parent[root(name)] = root(names[0])
    sides = {"user", "assistant"}
    by_initial: dict[str, list[str]] = {}
    for n in nodes:
        for other in by_initial.setdefault(n[0], []):
            a, b = root(n), root(other)
            if a != b and {a, b} != sides and similar(n, other):
                # A side stays the root of its cluster.
                parent[b if a in sides else a] = a if a in sides else b
        by_initial[n[0]].append(n)
    common: dict[str, tuple[int, str]] = {}
    for label, own in plain.items():
        common[root(own)] = min(common.get(root(own), (0, label)), (-counts[label], label))
    for label, own in plain.items():
        found[label] = root(own) if root(own) in sides else common[root(own)][1].strip()
    return found


_KNOWN: dict[str, bool] = {}


def _is_label(text: str) -> bool:
    known = _KNOWN.get(text)
    if known is None:
        if len(_KNOWN) > 10_000:
            _KNOWN.clear()
        known = _KNOWN[text] = track_of(text) is not None or resolve_labels([text]).get(text) in ("user", "assistant")
    return known


def without_sounds(text: str) -> str:
    """Text without sound annotations of any length: in square, pointed or Chinese brackets or between stars anything
    with a letter, in round brackets what tells a sound."""
    text = _SOUND.sub(lambda m: " " if any(c.isalpha() for c in m[0]) or not m[0][-1].isascii() and m[0][0] in "♩♪♫♬" else m[0], text)
    return _ROUND.sub(lambda m: " " if _SOUND_WORD.search(m[0]) else m[0], text)


def clean_speech(text: str) -> tuple[str | None, str]:
    """(label the text begins with, clean text) of a segment.

    Times go in brackets, as time codes, and in front; a time of day that is
    spoken of stays. A leading label is known by its names, as any short stretch
    before a colon looks like one.
    """
    label = None
    lead = without_sounds(_CLOCK.sub(" ", text))
    while True:
        if m := _LEAD_CLOCK.match(lead):
            lead = lead[m.end():]
        if not ((m := _LABEL.match(lead)) and _is_label(m[1].strip())):
            break
        label = label or m[1].strip()
        lead = lead[m.end():]
    kept, parts = [], _SPLIT.split(lead)
    for i in range(0, len(parts), 2):
        piece = _HESITATION_LEAD.sub(" ", _HESITATION_WORD.sub(" ", parts[i]))
        words = " ".join(piece.split())
        if words.casefold() in STOCK_PHRASES and len(parts) > 1 or _HESITATION.fullmatch(words):
            words = ""
        if any(c.isalnum() for c in words):
            kept.append(words + (parts[i + 1].strip() if i + 1 < len(parts) else ""))
    return label, " ".join(kept)


def bare(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum())


def clean_segments(df: DataFrame, call: str, seg: str, role: str, text: str, start: str, end: str) -> DataFrame:
    """``call, seg, label, start_s, end_s, content, bare_text`` of segments with a word and a start."""
    rows = df.where(F.col(text).isNotNull() & F.col(start).isNotNull() & ~F.isnan(F.col(start))).select(
        F.col(call).cast("long").alias("call"), F.col(seg).cast("long").alias("seg"),
        F.col(start).cast("double").alias("start_s"), F.col(end).cast("double").alias("end_s"),
        F.col(role).cast("string").alias("role"), F.col(text).alias("text"),
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, contents, bares = [], [], []
            for r, t in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                lead, content = clean_speech(t)
                labels.append(r.strip() if r and any(c.isalnum() for c in r) else lead or "")
                contents.append(content)
                bares.append(bare(content))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(labels, pa.string()), pa.array(contents, pa.string()), pa.array(bares, pa.string())],
                names=["call", "seg", "start_s", "end_s", "label", "content", "bare_text"],
            )

    clean = rows.mapInArrow(
        step, "call long, seg long, start_s double, end_s double, label string, content string, bare_text string"
    )
    return clean.where("bare_text <> ''")


def speaker_turns(
    segments: DataFrame,
    calls: DataFrame,
    call: str = "call_id",
    seg: str = "seg_id",
    role: str = "seg_role",
    text: str = "seg_content",
    start: str = "ts_start",
    end: str = "ts_end",
) -> DataFrame:
    """``call_id, turn_no, speaker, start_s, end_s, content, bare_text`` of each call's turns.

    A segment's speaker comes from its label or, without one, from the label its
    text begins with; labels are resolved among those of its call, track labels by
    ``calls``: to user or assistant, or, where they name neither, to the commonest
    label of their cluster, or to ``unknown`` without any label. Clock times,
    labels, sound annotations, hesitation sounds and stock phrases set off by
    punctuation are taken out. Equal segments (speaker, start, text) count once;
    segments left with no word are dropped, as are those without start or text. By
    start, user first, then assistant, then others by name, then ``seg``, a turn is
    a longest run of one speaker, numbered from 1 in its call; ``end_s`` is the
    latest known end. A null call is a call; ties are settled by ``seg``; empty
    tables give an empty result; other columns are ignored.

    Plan: cleaning is one pass, written once. Labels with their counts go to a
    small table for each call, which is resolved and joined back. Runs are formed
    over (call, ten minutes), see :mod:`colloqua.operators.islands`, and numbered
    by a running sum of the blocks' counts, so one call may hold any share of the
    rows.
    """
    clean = staged(clean_segments(segments, call, seg, role, text, start, end), "segments")
    counts = clean.where("label <> ''").groupBy("call", "label").agg(F.count("*").alias("n"))
    sets = counts.groupBy("call").agg(F.collect_list(F.struct("label", "n")).alias("labels"))

    @F.pandas_udf("array<struct<label:string,side:string>>")
    def resolve(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for labels in batches:
            of = [resolve_labels({r["label"]: r["n"] for r in sorted(x, key=lambda r: r["label"])}) for x in labels]
            yield pd.Series([[{"label": k, "side": v} for k, v in found.items()] for found in of])

    known = sets.select("call", F.explode(resolve("labels")).alias("r")).select("call", "r.label", "r.side")
    tracks = calls.groupBy(F.col(call).cast("long").alias("call")).agg(
        F.min("user_track").alias("ut"), F.min("assistant_track").alias("at")
    )
    known = known.join(tracks, "call", "left")
    speaker = (
        F.when(F.col("side") == F.concat(F.lit("track "), F.col("ut").cast("string")), "user")
        .when(F.col("side") == F.concat(F.lit("track "), F.col("at").cast("string")), "assistant")
        .otherwise(F.col("side"))
    )
    known = known.select(F.col("call").alias("__call"), F.col("label").alias("__label"), speaker.alias("speaker"))
    spoken = (
        clean.join(known, clean["call"].eqNullSafe(known["__call"]) & (clean["label"] == known["__label"]), "left")
        .withColumn("speaker", F.coalesce("speaker", F.lit(UNKNOWN)))
        .withColumn("side", F.when(F.col("speaker") == "user", 0).when(F.col("speaker") == "assistant", 1).otherwise(2))
        .groupBy("call", "side", "speaker", "start_s", "bare_text")
        .agg(F.min_by(F.struct("seg", "content"), "seg").alias("one"), F.max("end_s").alias("end_s"))
        .select("call", "side", "speaker", "start_s", "end_s", "bare_text", "one.seg", "one.content")
    )
    block = F.floor(F.col("start_s") / F.lit(float(BLOCK_SECONDS)))
    order = ["start_s", "side", "speaker", "seg"]
    said = F.struct(*order, "content", "bare_text")
    turns = blocked_islands(
        spoken, ["call"], order, block, [],
        lambda p, c: p["speaker"] == c["speaker"],
        {"said": (F.collect_list(said), lambda c: F.flatten(F.collect_list(c))), "end_s": (F.max("end_s"), F.max)},
    ).withColumn("blk", F.floor(F.col("first.start_s") / F.lit(float(BLOCK_SECONDS))))
    local = Window.partitionBy("call", "blk").orderBy(*[f"first.{c}" for c in order])
    running = Window.partitionBy("call").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    counts = turns.groupBy("call", "blk").agg(F.count("*").alias("n"))
    before = counts.select(F.col("call").alias("__call"), F.col("blk").alias("__blk"), F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    ranked = turns.withColumn("rank", F.row_number().over(local))
    numbered = ranked.join(before, ranked["call"].eqNullSafe(before["__call"]) & (ranked["blk"] == before["__blk"]))
    ordered = F.array_sort("said")
    return numbered.select(
        F.col("call").alias(call),
        (F.col("before") + F.col("rank")).cast("int").alias("turn_no"),
        F.col("first.speaker").alias("speaker"),
        F.col("first.start_s").alias("start_s"),
        "end_s",
        F.array_join(F.transform(ordered, lambda s: s["content"]), " ").alias("content"),
        F.array_join(F.transform(ordered, lambda s: s["bare_text"]), "").alias("bare_text"),
    )
