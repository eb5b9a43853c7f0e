"""Queries for each operator of the curation pipeline, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloqua.config import Settings
from colloqua.functions import dialogue as D
from colloqua.functions import misc
from colloqua.functions import text as T
from colloqua.operators import bursts as B
from colloqua.operators import folders, scoring
from colloqua.operators import sets as S
from colloqua.plans import pipeline
from colloqua.session import table

BLOCKED = ("密码", "password", "OOM")
PROMPT = "You are a helpful assistant."
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- SQL building blocks, written apart from the Column expressions -------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def n_of(x: str, pattern: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, {q(pattern)}, '', 'g')))"


def has(x: str, marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(m)})" for m in marks) + ")"


def like(x: str, patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {q(p)})" for p in patterns) + ")"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{T.BLANK}+|{T.BLANK}+$')}, '', 'g')"


def share(a: str, b: str) -> str:
    return f"({a}) * 1.0 / nullif({b}, 0)"


def unprintable_sql(x: str) -> str:
    return f"({n_of(x, T.UNPRINTABLE)} - {n_of(x, ' ')})"


def special_sql(x: str) -> str:
    return f"(length({x}) - {n_of(x, T.ALNUM)} - {n_of(x, T.BLANK)})"


def link_sql(x: str) -> str:
    return (
        f"({has(x, T.LINK_MARKS)} OR (contains({x}, '?') AND contains({x}, '&') AND contains({x}, '=') AND length({x}) > 50 "
        f"AND NOT {has(f'lower({x})', ('http://', 'https://', 'www.'))}))"
    )


def encoded_sql(x: str, t: str) -> str:
    return (
        f"(length({x}) >= 8 AND length({t}) > 0 AND coalesce((length({t}) > 20 AND regexp_matches({t}, '^[123]0P.*[\\p{{L}}\\p{{N}}]')) "
        f"OR regexp_matches({t}, '^[A-Za-z0-9+/=_-]{{21,}}$') OR regexp_matches({t}, '^\\p{{Nd}}{{16,}}$') OR regexp_matches({t}, '^[0-9a-fA-F]{{17,}}$') "
        f"OR (length({t}) > 12 AND {share(n_of(t, T.ALNUM), f'length({t})')} > 0.8 AND NOT {has(f'lower({t})', T.READABLE_IDS)}), false))"
    )


def media_sql(x: str, t: str) -> str:
    return (
        f"({x} = '' OR {has(x, T.MEDIA_MARKS)} OR {link_sql(x)} OR {encoded_sql(x, t)} OR {has(x, T.PATH_MARKS)} "
        f"OR coalesce(length({x}) > 10 AND {share(unprintable_sql(x), f'length({x})')} > 0.3, false))"
    )


def garbled_sql(x: str) -> str:
    return f"coalesce({share(n_of(x, T.ODD), f'length({x})')} > 0.2 OR {share(unprintable_sql(x), f'length({x})')} > 0.3, false)"


def meaningful_sql(t: str) -> str:
    m = n_of(t, T.MEANINGFUL)
    return (
        f"(coalesce({share(m, f'length({t})')}, 0) >= 0.5 AND NOT {garbled_sql(t)} AND ({has(f'lower({t})', T.COMMON_WORDS)} OR "
        f"coalesce({m} >= 3 AND NOT regexp_matches(replace({t}, ' ', ''), '^\\p{{Nd}}+$') AND {share(special_sql(t), f'length({t})')} < 0.5, false)))"
    )


def strict_garbled_sql(t: str) -> str:
    odd = f"({n_of(t, T.LATIN1)} - {n_of(t, T.LATIN1_PLAIN)})"
    return (
        f"({t} = '' OR {has(t, T.GARBAGE_TEXTS)} OR {like(t, T.GARBAGE_FORMS)} OR regexp_matches({t}, {q(T.BANNED_BLOCKS)}) "
        f"OR {unprintable_sql(t)} > 0 OR coalesce(length({t}) > 2 AND {share(odd, f'length({t})')} > 0.4, false) "
        f"OR coalesce(length({t}) <= 10 AND {share(n_of(t, T.MEANINGFUL), f'length({t})')} < 0.8, false))"
    )


def strict_valid_sql(t: str) -> str:
    m = n_of(t, T.MEANINGFUL)
    return (
        f"(NOT {strict_garbled_sql(t)} AND {m} > 0 AND ({has(f'lower({t})', T.COMMON_WORDS_2)} OR "
        f"coalesce({m} >= 3 AND {share(special_sql(t), f'length({t})')} < 0.3, false)))"
    )


TEXTS = f"SELECT doc_id, text AS x, {stripped('text')} AS t FROM documents WHERE text IS NOT NULL"
SQUEEZED = f"trim(regexp_replace(msg, {q(T.BLANK + '+')}, ' ', 'g'))"
CLEAN = f"""rows AS (SELECT room_name AS room, epoch_us(create_time) AS us, row_id AS seq, is_sender AS side, {SQUEEZED} AS msg FROM messages
    WHERE type_name = 'text' AND coalesce(is_forward, 0) <> 1 AND create_time IS NOT NULL AND msg IS NOT NULL AND {SQUEEZED} <> ''
    AND NOT {has(f'lower({SQUEEZED})', tuple(w.lower() for w in BLOCKED))})"""
BURSTS = CLEAN + """,
  b1 AS (SELECT *, CASE WHEN side IS NOT DISTINCT FROM lag(side) OVER w AND us - lag(us) OVER w <= 120000000
      AND length(lag(msg) OVER w) + 1 + length(msg) <= 2048 AND lag(seq) OVER w IS NOT NULL THEN 0 ELSE 1 END AS brk
      FROM rows WINDOW w AS (PARTITION BY room ORDER BY us, seq)),
  b2 AS (SELECT *, sum(brk) OVER (PARTITION BY room ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS g FROM b1),
  bursts AS (SELECT room, min(us) AS us, arg_min(seq, (us, seq)) AS seq, arg_min(side, (us, seq)) AS side,
      substring(string_agg(msg, chr(10) ORDER BY us, seq), 1, 2048) AS msg, count(*) AS n_rows, max(us) AS end_us FROM b2 GROUP BY room, g)"""
# arg_min skips null values; a burst's side is the same in all its rows.
REPLIES = BURSTS + """,
  replies AS (SELECT *, first_value(CASE WHEN side = 1 THEN {'us': us, 'msg': msg} END IGNORE NULLS) OVER (PARTITION BY room ORDER BY us, seq
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM bursts)"""
DIALOGUES = """chat AS (SELECT dialogue_id, turn_no, cm_id, chat_role AS role, chat_content AS content FROM chatml_messages
    WHERE chat_role IS NOT NULL AND chat_content IS NOT NULL),
  talk AS (SELECT dialogue_id, list({'role': role, 'content': content} ORDER BY turn_no, cm_id) AS ms FROM chat GROUP BY dialogue_id)"""
LINES = "array_to_string([m.role || ': ' || m.content for m in {}], chr(10))"


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "messages").withColumnsRenamed({"create_time": "CreateTime", "row_id": "_seq"})
    return pipeline.select_messages(messages, Settings(blocked_words=BLOCKED))


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = table(spark, sf_dir, "chatml_messages").where("chat_role IS NOT NULL AND chat_content IS NOT NULL")
    one = F.struct("turn_no", "cm_id", F.col("chat_role").alias("role"), F.col("chat_content").alias("content"))
    listed = chat.groupBy("dialogue_id").agg(F.array_sort(F.collect_list(one)).alias("m"))
    return listed.select("dialogue_id", F.transform("m", lambda m: D.message(m["role"], m["content"])).alias("messages"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text").where("text IS NOT NULL")


# --- messages: filters, bursts, replies, context, dialogues ---------------------


@query(f"WITH {CLEAN} SELECT seq AS row_id, msg FROM rows")
def msg_clean_filter(spark, sf_dir):
    return clean_rows(spark, sf_dir).select(F.col("seq").alias("row_id"), "msg")


@query(f"WITH {BURSTS} SELECT room, us, seq, side, msg, n_rows, end_us FROM bursts")
def sessionize_merge(spark, sf_dir):
    return B.merge_bursts(clean_rows(spark, sf_dir))


@query(f"WITH {BURSTS} SELECT room, count(*) AS n_bursts, CAST(sum(n_rows) AS BIGINT) AS n_msgs, max(n_rows) AS longest FROM bursts GROUP BY room")
def session_stats(spark, sf_dir):
    return B.merge_bursts(clean_rows(spark, sf_dir)).groupBy("room").agg(
        F.count("*").alias("n_bursts"), F.sum("n_rows").alias("n_msgs"), F.max("n_rows").alias("longest"))


@query(f"WITH {REPLIES} SELECT room, us, seq, r.us AS reply_us, r.msg AS reply FROM replies WHERE coalesce(side, 0) <> 1 AND r.us - us <= 300000000")
def asof_reply(spark, sf_dir):
    found = B.next_reply(B.merge_bursts(clean_rows(spark, sf_dir)))
    return found.where("coalesce(side, 0) <> 1 AND reply_us IS NOT NULL").select("room", "us", "seq", "reply_us", "reply")


CONTEXT = BURSTS + """,
  numbered AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY us, seq) AS k FROM bursts),
  ctx AS (SELECT a.room, a.us, a.seq, b.k, b.side, b.msg, sum(length(b.msg)) OVER (PARTITION BY a.room, a.k ORDER BY b.k ROWS UNBOUNDED PRECEDING) AS so_far
      FROM numbered a JOIN numbered b ON a.room = b.room AND b.k BETWEEN a.k - 10 AND a.k - 1)"""


@query(f"WITH {CONTEXT} SELECT room, us, seq, string_agg(CASE WHEN side = 1 THEN 'assistant' ELSE 'user' END || ': ' || msg, chr(10) ORDER BY k) AS context "
       "FROM ctx WHERE so_far <= 60 GROUP BY room, us, seq")
def context_window(spark, sf_dir):
    rows = B.previous_rows(B.merge_bursts(clean_rows(spark, sf_dir)).select("room", "us", F.col("seq").cast("long").alias("seq"), F.col("side").cast("int").alias("side"), "msg"))
    role = lambda m: F.when(m["side"] == 1, "assistant").otherwise("user")
    context = D.budget_prefix(F.transform("context", lambda m: D.message(role(m), m["msg"])), F.lit(60))
    return B.evaluated_once(rows, "context", D.rendered(context), ["room", "us", "seq"]).where("context <> ''")


BUILD = REPLIES.replace("replies AS (", "numbered AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY us, seq) AS k FROM bursts),\n  replies AS (", 1) + f""",
  ctx AS (SELECT a.room, a.k AS pos, b.k, CASE WHEN b.side = 1 THEN 'assistant' ELSE 'user' END AS role, b.msg,
      sum(length(b.msg)) OVER (PARTITION BY a.room, a.k ORDER BY b.k ROWS UNBOUNDED PRECEDING) AS so_far
      FROM numbered a JOIN numbered b ON a.room = b.room AND b.k BETWEEN a.k - 10 AND a.k - 1),
  context AS (SELECT room, pos, list({{'role': role, 'content': msg}} ORDER BY k) AS c FROM ctx WHERE so_far <= 1024 GROUP BY room, pos),
  asked AS (SELECT n.room, n.us, n.seq, n.k, n.msg, r.r.msg AS reply FROM numbered n JOIN replies r ON n.room = r.room AND n.us = r.us AND n.seq = r.seq
      WHERE n.side <> 1 AND r.r.us - n.us <= 300000000),
  packed AS (SELECT a.room, a.us, a.seq, list_concat(coalesce(c.c, []), [{{'role': 'user', 'content': msg}}, {{'role': 'assistant', 'content': reply}}]) AS ms,
      {stripped('msg')} AS u, {stripped('reply')} AS v FROM asked a LEFT JOIN context c ON a.room = c.room AND a.k = c.pos)"""


@query(f"WITH {BUILD} SELECT room, us, seq, {LINES.format('ms')} AS dialogue FROM packed WHERE length(u) >= 2 AND length(v) >= 2 "
       f"AND NOT {like('u', T.MEANINGLESS)} AND NOT {like('v', T.MEANINGLESS)} "
       "AND len([i for i in range(2, len(ms) + 1) if ms[i].role = ms[i - 1].role]) = 0")
def chatml_build(spark, sf_dir):
    """The flagship: bursts, first reply in time, bounded context, validity."""
    built = B.build_dialogues(B.merge_bursts(clean_rows(spark, sf_dir)))
    return built.select("room", "us", "seq", D.rendered(F.col("messages")).alias("dialogue"))


VALID = (f"ms[-2].role = 'user' AND ms[-1].role = 'assistant' AND length({stripped('ms[-2].content')}) >= 2 AND length({stripped('ms[-1].content')}) >= 2 "
         f"AND NOT {like(stripped('ms[-2].content'), T.MEANINGLESS)} AND NOT {like(stripped('ms[-1].content'), T.MEANINGLESS)} "
         "AND len([i for i in range(2, len(ms) + 1) if ms[i].role = ms[i - 1].role]) = 0")


@query(f"""WITH {BUILD.replace('so_far <= 1024', 'so_far <= 20')},
    whole AS (SELECT room, us, seq, ms, list_sum([length(m.content) for m in ms]) AS n, length(ms[-1].content) + length(ms[-2].content) AS fixed, ms[:len(ms) - 2] AS mid FROM packed WHERE {VALID}),
    fit AS (SELECT room, us, seq, CASE WHEN n <= 40 THEN ms ELSE list_concat(mid[len(mid) - len([i for i in range(1, len(mid) + 1) if list_sum([length(m.content) for m in mid[i:]]) + fixed <= 40]) + 1:], ms[-2:]) END AS ms
      FROM whole WHERE n <= 40 OR fixed <= 40)
    SELECT room, us, seq, {LINES.format('ms')} AS dialogue FROM fit WHERE {VALID}""")
def chatml_build_reduced(spark, sf_dir):
    """The flagship under a limit so low that most contexts are cut and dialogues reduced or dropped."""
    built = B.build_dialogues(B.merge_bursts(clean_rows(spark, sf_dir)), limit=40)
    return built.select("room", "us", "seq", D.rendered(F.col("messages")).alias("dialogue"))


@query(f"""WITH {CLEAN}, f AS (SELECT *, CASE WHEN coalesce(side, 0) <> 1 AND lag(side) OVER w = 1 OR lag(seq) OVER w IS NULL THEN 1 ELSE 0 END AS brk
       FROM rows WINDOW w AS (PARTITION BY room ORDER BY us, seq)),
    g AS (SELECT *, sum(brk) OVER (PARTITION BY room ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS c FROM f)
    SELECT room, min(us) AS start_us, arg_min(seq, (us, seq)) AS start_seq, max(us) AS end_us, count(*) AS n,
      string_agg(CASE WHEN side = 1 THEN 'a' ELSE 'u' END, '' ORDER BY us, seq) AS roles FROM g GROUP BY room, c HAVING count(*) >= 2""")
def conv_split(spark, sf_dir):
    return B.split_conversations(clean_rows(spark, sf_dir))


@query("SELECT room_name AS room, row_id AS seq, row_number() OVER (PARTITION BY room_name ORDER BY create_time, row_id) AS idx FROM messages WHERE create_time IS NOT NULL")
def peer_row_number(spark, sf_dir):
    """Rows numbered in their room before any filter."""
    messages = table(spark, sf_dir, "messages").select("room_name", "create_time", "row_id", "is_sender", "msg")
    rows = B.ordered_rows(messages, "room_name", "is_sender", "msg", "create_time", "row_id")
    return B.row_numbers(rows).select("room", "seq", "idx")


# --- dialogues -------------------------------------------------------------------


@query(f"""WITH {DIALOGUES}, v AS (SELECT dialogue_id, ms, {stripped('ms[-2].content')} AS u, {stripped('ms[-1].content')} AS a,
      [m for m in ms if m.role IN ('user', 'assistant')] AS ua FROM talk)
    SELECT dialogue_id, coalesce(len(ms) >= 2 AND ms[-2].role = 'user' AND ms[-1].role = 'assistant' AND length(u) >= 2 AND length(a) >= 2
      AND NOT {like('u', T.MEANINGLESS)} AND NOT {like('a', T.MEANINGLESS)}
      AND len([i for i in range(2, len(ua) + 1) if ua[i].role = ua[i - 1].role]) = 0, false) AS valid FROM v""")
def dialogue_validity(spark, sf_dir):
    return dialogues(spark, sf_dir).select("dialogue_id", D.is_valid_dialogue(F.col("messages")).alias("valid"))


@query(f"""WITH {DIALOGUES}, p AS (SELECT dialogue_id, ms, coalesce(ms[1].role = 'system', false) AS led FROM talk),
    s AS (SELECT dialogue_id, CASE WHEN led THEN ms[1:1] ELSE [] END AS sys, CASE WHEN len(ms) >= 2 THEN ms[-2:] ELSE [] END AS tail,
      CASE WHEN len(ms) > 2 THEN ms[CASE WHEN led THEN 2 ELSE 1 END:len(ms) - 2] ELSE [] END AS mid FROM p),
    f AS (SELECT *, coalesce(list_sum([length(m.content) for m in sys]), 0) + coalesce(list_sum([length(m.content) for m in tail]), 0) AS fixed FROM s),
    k AS (SELECT *, len([i for i in range(1, len(mid) + 1) if list_sum([length(m.content) for m in mid[i:]]) + fixed <= 60]) AS kept FROM f WHERE fixed <= 60)
    SELECT dialogue_id, {LINES.format('list_concat(sys, mid[len(mid) - kept + 1:], tail)')} AS dialogue FROM k""")
def greedy_reduce(spark, sf_dir):
    cut = dialogues(spark, sf_dir).withColumn("r", D.greedy_reduce(F.col("messages"), F.lit(60))).where("r IS NOT NULL")
    return cut.select("dialogue_id", D.rendered(F.col("r")).alias("dialogue"))


@query(f"""WITH {DIALOGUES.split('talk AS')[0].rstrip().rstrip(',')},
    t AS (SELECT *, {stripped("regexp_replace(content, ' +', chr(10), 'g')")} AS line, row_number() OVER (PARTITION BY dialogue_id ORDER BY turn_no, cm_id) AS k FROM chat),
    f AS (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY dialogue_id ORDER BY k) = role THEN 0 ELSE 1 END AS brk FROM t),
    g AS (SELECT *, sum(brk) OVER (PARTITION BY dialogue_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM f),
    r AS (SELECT dialogue_id, run, any_value(role) AS role, string_agg(line, chr(10) ORDER BY k) AS content FROM g GROUP BY dialogue_id, run)
    SELECT dialogue_id, string_agg(role || ': ' || content, chr(10) ORDER BY run) AS dialogue FROM r GROUP BY dialogue_id""")
def role_run_merge(spark, sf_dir):
    return dialogues(spark, sf_dir).select("dialogue_id", D.rendered(D.merge_role_runs(F.col("messages"))).alias("dialogue"))


@query(f"WITH {DIALOGUES} SELECT dialogue_id, {LINES.format('[ms[i] for i in range(1, len(ms) + 1) if (i - 1) NOT IN (1, 3, 4)]')} AS dialogue FROM talk")
def removed_index_anti(spark, sf_dir):
    kept = D.without_indices(F.col("messages"), F.array(F.lit(1), F.lit(3), F.lit(4)))
    return dialogues(spark, sf_dir).select("dialogue_id", D.rendered(kept).alias("dialogue"))


@query(f"WITH {DIALOGUES} SELECT dialogue_id, {LINES.format('ms[-20:]')} AS dialogue FROM talk")
def history_cap(spark, sf_dir):
    return dialogues(spark, sf_dir).select("dialogue_id", D.rendered(D.last_turns(F.col("messages"))).alias("dialogue"))


@query(f"WITH {DIALOGUES} SELECT dialogue_id, array_to_string(['[' || (i - 1) || '] ' || CASE WHEN ms[i].role = 'user' THEN '用户' ELSE 'AI' END || ': ' || ms[i].content || chr(10) for i in range(1, len(ms) + 1)], '') AS prompt FROM talk")
def judge_prompt(spark, sf_dir):
    return dialogues(spark, sf_dir).select("dialogue_id", D.numbered(F.col("messages")).alias("prompt"))


@query(f"WITH {DIALOGUES}, p AS (SELECT dialogue_id, coalesce([m.content for m in ms if m.role = 'user'][1], '') AS q, coalesce([m.content for m in ms if m.role = 'assistant'][1], '') AS a FROM talk) SELECT * FROM p")
def qa_projection(spark, sf_dir):
    m = F.col("messages")
    return dialogues(spark, sf_dir).select("dialogue_id", D.first_content(m, "user").alias("q"), D.first_content(m, "assistant").alias("a"))


@query(f"""WITH {DIALOGUES}, p AS (SELECT dialogue_id, list_distinct(string_split([m.content for m in ms if m.role = 'user'][1], '')) AS a,
      list_distinct(string_split([m.content for m in ms if m.role = 'assistant'][1], '')) AS b FROM talk),
    c AS (SELECT dialogue_id, [x for x in coalesce(a, []) if x <> ''] AS a, [x for x in coalesce(b, []) if x <> ''] AS b FROM p)
    SELECT dialogue_id, round(CASE WHEN len(a) + len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) * 1.0 / (len(a) + len(b) - len(list_intersect(a, b))) END, 6) AS similarity FROM c""")
def char_jaccard(spark, sf_dir):
    m = F.col("messages")
    score = T.char_jaccard(D.first_content(m, "user"), D.first_content(m, "assistant"))
    return dialogues(spark, sf_dir).select("dialogue_id", F.round(score, 6).alias("similarity"))


@query(f"WITH {DIALOGUES} SELECT dialogue_id, {q('system: ' + PROMPT)} || chr(10) || {LINES.format('ms')} AS dialogue FROM talk")
def system_prompt(spark, sf_dir):
    return dialogues(spark, sf_dir).select("dialogue_id", D.rendered(D.with_system(F.col("messages"), PROMPT)).alias("dialogue"))


@query(f"WITH {DIALOGUES} SELECT dialogue_id, {q('system: ' + PROMPT)} || coalesce(chr(10) || nullif({LINES.format(chr(91) + 'm for m in ms if m.role <> ' + q('system') + chr(93))}, ''), '') AS dialogue FROM talk")
def convert_messages(spark, sf_dir):
    out = D.replace_system(F.col("messages"), PROMPT)
    return dialogues(spark, sf_dir).select("dialogue_id", D.rendered(out).alias("dialogue"))


def _turns(spark, sf_dir):
    role = lambda m: F.when(m["role"] == "assistant", "ai").otherwise(m["role"])
    listed = F.transform(F.filter("messages", lambda m: m["role"] != "system"), lambda m: F.struct(role(m).alias("role"), m["content"].alias("text")))
    return dialogues(spark, sf_dir).withColumn("turns", listed)


@query(f"WITH {DIALOGUES}, p AS (SELECT dialogue_id, [m for m in ms if m.role <> 'system'] AS o FROM talk) SELECT dialogue_id, {LINES.format('o')} AS dialogue FROM p WHERE len(o) > 0")
def convert_turns(spark, sf_dir):
    out = _turns(spark, sf_dir).withColumn("o", D.turns_to_messages(F.col("turns"))).where("o IS NOT NULL")
    return out.select("dialogue_id", D.rendered(F.col("o")).alias("dialogue"))


@query(f"""WITH {DIALOGUES}, p AS (SELECT dialogue_id, [m.content for m in ms if m.role = 'user'][1] AS u, [m.content for m in ms if m.role = 'assistant'][1] AS a FROM talk)
    SELECT dialogue_id, 'user: ' || u || chr(10) || 'assistant: ' || a AS dialogue FROM p WHERE u IS NOT NULL AND a IS NOT NULL""")
def convert_first_exchange(spark, sf_dir):
    out = _turns(spark, sf_dir).withColumn("o", D.first_exchange(F.col("turns"))).where("o IS NOT NULL")
    return out.select("dialogue_id", D.rendered(F.col("o")).alias("dialogue"))


@query("SELECT item_id, 'user: ' || input_text || CASE WHEN task <> '' THEN chr(10) || chr(10) || task ELSE '' END || chr(10) || 'assistant: ' || expected_text AS dialogue FROM eval_items WHERE input_text IS NOT NULL AND expected_text IS NOT NULL")
def convert_instruction(spark, sf_dir):
    out = D.instruction_to_messages(F.col("input_text"), F.col("task"), F.col("expected_text"))
    return table(spark, sf_dir, "eval_items").withColumn("o", out).where("o IS NOT NULL").select("item_id", D.rendered(F.col("o")).alias("dialogue"))


@query("""SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'Instruction: ' || input_text || chr(10) || 'Input: ' || task || chr(10) || 'Answer: ' || expected_text
    WHEN item_id % 3 = 1 THEN 'Instruction: ' || input_text || chr(10) || 'Answer: ' || expected_text ELSE 'Input: ' || task || chr(10) || 'Answer: ' || expected_text END || '</s>' AS text FROM eval_items""")
def sft_text(spark, sf_dir):
    kind = F.col("item_id") % 3
    text = D.sft_text(F.lit(None).cast(D.MESSAGES), F.when(kind != 2, F.col("input_text")), F.when(kind != 1, F.col("task")), F.col("expected_text"), F.lit(None).cast("string"), "</s>")
    return table(spark, sf_dir, "eval_items").select("item_id", text.alias("text"))


# --- scores and verdicts ------------------------------------------------------------

SCORED = "scored AS (SELECT cm_id, CASE WHEN cm_id % 11 = 0 THEN NULL WHEN cm_id % 13 = 0 THEN 6 ELSE (length(chat_content) + turn_no) % 5 + 1 END AS score FROM chatml_messages)"


def _scored(spark, sf_dir):
    score = F.when(F.col("cm_id") % 11 == 0, None).when(F.col("cm_id") % 13 == 0, 6).otherwise((F.length("chat_content") + F.col("turn_no")) % 5 + 1)
    return table(spark, sf_dir, "chatml_messages").select("cm_id", score.cast("int").alias("score"))


@query(f"WITH {SCORED} SELECT cm_id, score FROM scored WHERE score >= 4")
def score_threshold(spark, sf_dir):
    return scoring.accepted(_scored(spark, sf_dir), 4)


@query(f"WITH {SCORED} SELECT score, count(*) AS n FROM scored WHERE score IS NOT NULL GROUP BY score")
def score_histogram(spark, sf_dir):
    return scoring.histogram(_scored(spark, sf_dir))


@query(f"WITH {SCORED} SELECT count(*) AS total, count(*) FILTER (WHERE score >= 3) AS accepted, count(*) FILTER (WHERE score IS NULL) AS missing FROM scored")
def score_counters(spark, sf_dir):
    return scoring.counters(_scored(spark, sf_dir), 3)


@query("SELECT cm_id, CASE WHEN cm_id % 7 = 0 THEN 6 ELSE length('user: ' || coalesce(chat_content, '')) % 5 + 1 END AS score FROM chatml_messages")
def image_bypass_score(spark, sf_dir):
    """Pairs with images have their score without the judge."""
    pairs = table(spark, sf_dir, "chatml_messages").select(
        F.col("cm_id").alias("id"), F.array(D.message(F.lit("user"), F.coalesce("chat_content", F.lit("")))).alias("messages"),
        F.when(F.col("cm_id") % 7 == 0, F.array(F.lit("a.png"))).alias("images"))
    return scoring.score_pairs(pairs, scoring.length_judge).select(F.col("id").alias("cm_id"), "score")


@query("SELECT event_id, CAST(event_id AS VARCHAR) AS id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS score FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def verdict_parse(spark, sf_dir):
    reply = F.concat(F.lit('[{"id": "'), F.col("event_id").cast("string"), F.lit('", "score": "'), F.get_json_object("props", "$.k"), F.lit('"}]'))
    found = table(spark, sf_dir, "events").select("event_id", F.explode(D.parse_scores(D.without_thought(F.concat(F.lit("<think>x</think>"), reply)))).alias("v"))
    return found.select("event_id", "v.id", "v.score")


# --- text predicates over documents ---------------------------------------------------


def _predicate(name: str, column, sql: str, alias: str) -> None:
    def run(spark, sf_dir):
        return texts(spark, sf_dir).select("doc_id", column(F.col("text")).alias(alias))

    run.__name__ = name
    query(f"WITH d AS ({TEXTS}) SELECT doc_id, {sql} AS {alias} FROM d")(run)


_predicate("sensitive_filter", T.is_sensitive, like("x", T.SENSITIVE), "hit")
_predicate("garbled_chars", T.is_garbled, garbled_sql("x"), "hit")
_predicate("encoded_data", T.is_encoded, encoded_sql("x", "t"), "hit")
_predicate("file_path", T.has_file_path, has("x", T.PATH_MARKS), "hit")
_predicate("download_link", T.is_download_link, link_sql("x"), "hit")
_predicate("media_filter", T.is_media, media_sql("x", "t"), "hit")
_predicate("meaningful_text", T.is_meaningful, meaningful_sql("t"), "hit")
VALID_TEXT = f"(lower(t) NOT IN ('', 'undefined', 'null', 'none') AND NOT {media_sql('x', 't')} AND NOT {like('x', T.SENSITIVE)} AND {meaningful_sql('t')})"
_predicate("valid_text", T.is_valid, VALID_TEXT, "hit")
_predicate("enhanced_garbled", T.is_garbled_strict, strict_garbled_sql("t"), "hit")
_predicate("enhanced_valid", T.is_valid_strict, strict_valid_sql("t"), "hit")
_predicate("export_valid", T.is_chat_export_valid,
           f"(t <> '' AND lower(t) NOT IN ('null', 'undefined') AND coalesce({share(n_of('t', T.MEANINGFUL), 'length(t)')} >= 0.3, false))", "hit")
_predicate("meaningless_text", T.is_meaningless, like("x", T.MEANINGLESS), "hit")
_predicate("message_type_case", T.message_type,
           f"CASE WHEN x = '' THEN 'system' WHEN {link_sql('x')} THEN 'file' WHEN {has('x', T.VOICE_MARKS)} THEN 'voice' WHEN {has('x', T.VIDEO_MARKS)} THEN 'video' "
           f"WHEN {has('x', T.FILE_MARKS)} THEN 'file' WHEN {has('x', T.IMAGE_MARKS)} THEN 'image' WHEN {media_sql('x', 't')} THEN 'media' ELSE 'text' END", "kind")
_predicate("meaningful_count", lambda c: T.count_of(c, T.MEANINGFUL).cast("long"), f"CAST({n_of('x', T.MEANINGFUL)} AS BIGINT)", "n")
_predicate("special_count", lambda c: T.special(c).cast("long"), f"CAST({special_sql('x')} AS BIGINT)", "n")
_predicate("nonprintable", lambda c: T.unprintable(c).cast("long"), f"CAST({unprintable_sql('x')} AS BIGINT)", "n")
_predicate("double_space_lines", T.double_spaces_to_lines, "regexp_replace(x, ' {2,}', chr(10), 'g')", "out")
CLEANED = stripped("regexp_replace(regexp_replace(" + stripped("regexp_replace(x, '[\\x{202a}-\\x{202e}\\x{2066}-\\x{2069}\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')")
                    + ", '^[^0-9A-Za-z\\x{80}-\\x{10ffff}]+', ''), '[^0-9A-Za-z\\x{80}-\\x{10ffff}.!?,;:]+$', '')")
_predicate("clean_text", T.clean_text, CLEANED, "out")
QUALITY = (f"CASE WHEN x = '' THEN 0.0 ELSE {share(n_of('x', T.CJK), 'length(x)')} * 2.0 + {share(n_of('x', '[A-Za-z]'), 'length(x)')} * 1.5 "
           f"+ least({share(n_of('x', '[' + chr(92) + 'p{Nd}²³¹]'), 'length(x)')} * 0.5, 0.3) + least({share(n_of('x', T.PUNCTUATION), 'length(x)')} * 0.3, 0.2) "
           "+ CASE WHEN length(x) BETWEEN 5 AND 200 THEN 0.5 WHEN length(x) > 200 THEN 0.2 ELSE 0.0 END END")
_predicate("text_quality", lambda c: F.round(T.text_quality(c), 6), f"round({QUALITY}, 6)", "score")
_predicate("preview_text", T.preview, "CASE WHEN length(x) > 100 THEN substring(x, 1, 100) || '...' ELSE x END", "out")


@query("""WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents), n AS (SELECT doc_id, c, count(*) AS k FROM c WHERE c <> '' GROUP BY doc_id, c),
    s AS (SELECT doc_id, k * 1.0 / sum(k) OVER (PARTITION BY doc_id) AS p FROM n), e AS (SELECT doc_id, abs(round(-sum(p * log2(p)), 6)) AS entropy FROM s GROUP BY doc_id)
    SELECT doc_id, CASE WHEN text = '' THEN 0.0 WHEN text IS NOT NULL THEN entropy END AS entropy FROM documents LEFT JOIN e USING (doc_id)""")
def char_entropy(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.abs(F.round(T.char_entropy(F.col("text")), 6)).alias("entropy"))


@query(f"""WITH one AS (SELECT dialogue_id, turn_no, cm_id, chat_content AS x, {stripped('chat_content')} AS t FROM chatml_messages WHERE chat_content IS NOT NULL),
    valid AS (SELECT dialogue_id, turn_no, cm_id, {CLEANED} AS x FROM one WHERE {VALID_TEXT}), scored AS (SELECT *, {QUALITY} AS q FROM valid WHERE x <> ''),
    best AS (SELECT dialogue_id, arg_max(x, (q, length(x), -turn_no, -cm_id)) AS best FROM scored GROUP BY dialogue_id)
    SELECT dialogue_id, coalesce(best, '') AS best FROM (SELECT DISTINCT dialogue_id FROM one) LEFT JOIN best USING (dialogue_id)""")
def best_candidate(spark, sf_dir):
    """of a dialogue's texts the best by quality, then length, then place."""
    from colloqua.sources.wire import best_text

    said = table(spark, sf_dir, "chatml_messages").where("chat_content IS NOT NULL")
    listed = said.groupBy("dialogue_id").agg(F.array_sort(F.collect_list(F.struct("turn_no", "cm_id", "chat_content"))).alias("m"))
    texts_of = listed.select("dialogue_id", F.transform("m", lambda m: m["chat_content"]).alias("texts"))
    return texts_of.select("dialogue_id", best_text(F.col("texts")).alias("best"))


# --- records: dedup, union, mix, caps, statistics ---------------------------------------


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def dedup_keep_first(spark, sf_dir):
    return S.keep_first(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), [F.col("doc_id")]).select("doc_id")


@query("SELECT min(event_id) AS event_id FROM events GROUP BY json_extract_string(props, '$.k')")
def dedup_canonical_json(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return S.keep_first(events, S.canonical_json(F.col("props")), [F.col("event_id")]).select("event_id")


@query("SELECT doc_id AS id, lang, CAST(NULL AS VARCHAR) AS task FROM documents UNION ALL SELECT item_id, lang, task FROM eval_items")
def union_merge(spark, sf_dir):
    return S.merge_records([table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang"), table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("id"), "lang", "task")])


@query("""WITH n AS (SELECT greatest(1, CAST(floor(count(*) * 20 / 100) AS BIGINT)) AS k FROM documents), e AS (SELECT item_id AS id, input_text AS text,
      row_number() OVER (ORDER BY md5(CAST(item_id AS VARCHAR) || '|42'), item_id) AS r FROM eval_items)
    SELECT doc_id AS id, text FROM documents UNION ALL SELECT id, text FROM e, n WHERE r <= k""")
def mix_exact_percent(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return S.mix_by_percentage(docs, table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("id"), F.col("input_text").alias("text")), "id", 20)


@query("SELECT * EXCLUDE k FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS k FROM lineitem) WHERE k <= 3")
def per_group_cap(spark, sf_dir):
    return S.cap_per_group(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_orderkey", ["l_linenumber", "l_partkey", "l_quantity"], 3)


@query("SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 10 AS chunk FROM orders")
def fixed_chunks(spark, sf_dir):
    return S.chunked(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_orderkey"], 10, "o_custkey")


@query("SELECT p_partkey, [5, 10, 20, 40][list_position(list_transform([5, 10, 20, 40], lambda c: abs(c - p_size)), list_min(list_transform([5, 10, 20, 40], lambda c: abs(c - p_size))))] AS near FROM part")
def nearest_match(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.nearest(F.col("p_size"), [5, 10, 20, 40]).alias("near"))


@query("SELECT count(*) AS n_records, CAST(coalesce(sum(length(text)), 0) // count(*) AS BIGINT) AS avg_length FROM documents")
def record_stats(spark, sf_dir):
    return S.record_stats(table(spark, sf_dir, "documents"), "text")


@query("SELECT doc_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS shown FROM documents ORDER BY doc_id LIMIT 5")
def preview_top_n(spark, sf_dir):
    return S.first_rows(table(spark, sf_dir, "documents"), [F.col("doc_id")], 5).select("doc_id", T.preview(F.col("text")).alias("shown"))


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 50")
def tail_n(spark, sf_dir):
    return S.first_rows(table(spark, sf_dir, "events").select("event_id", "event_type"), [F.col("event_id").desc()], 50)


FILE_NAME = "CASE doc_id % 5 WHEN 0 THEN 'config.json' WHEN 1 THEN 'model-' || doc_id || '.safetensors' WHEN 2 THEN 'sub/pytorch_model.bin' WHEN 3 THEN 'notes.md' ELSE 'vocab-' || doc_id || '.txt' END"
FILES = f"files AS (SELECT replace(coalesce(source, 'none'), '/', '_') || '-' || (doc_id // 4) % 50 AS folder, {FILE_NAME} AS name, n_chars AS size FROM documents)"


def _files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    folder = F.expr("concat(replace(coalesce(source, 'none'), '/', '_'), '-', (doc_id div 4) % 50)")
    paths = docs.select(F.concat(F.lit("file:///models/"), folder, F.lit("/"), F.expr(FILE_NAME)).alias("path"), F.col("n_chars").alias("length"))
    return folders.with_folders(paths, "/models")


@query(f"""WITH {FILES} SELECT folder, count(*) AS n_files, CAST(coalesce(sum(size), 0) AS BIGINT) AS size, bool_or(name IN ('config.json', 'configuration.json'))
    AND bool_or(name IN ('pytorch_model.bin', 'model.safetensors', 'pytorch_model.safetensors') OR name LIKE 'model-%.safetensors') AS complete FROM files GROUP BY folder""")
def size_rollup(spark, sf_dir):
    return folders.roll_up(_files(spark, sf_dir))


@query(f"""WITH {FILES}, n AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY name) AS k, count(*) OVER (PARTITION BY folder) AS total FROM files WHERE NOT name LIKE '%.md')
    SELECT folder, name, greatest(total - 10, 0) AS more FROM n WHERE k <= 10""")
def main_files(spark, sf_dir):
    return folders.main_files(_files(spark, sf_dir)).select("folder", "name", "more")


@query("SELECT call_id, seg_id, role, row_number() OVER (PARTITION BY call_id ORDER BY ts_start NULLS FIRST, CASE WHEN role = 'user' THEN 0 ELSE 1 END, ts_end NULLS FIRST, seg_id) AS pos FROM "
       "(SELECT *, CASE WHEN seg_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role FROM call_segments)")
def segments_union_sort(spark, sf_dir):
    """U-2, O5: two tracks of each call, one order; user first at equal starts."""
    from colloqua.sources.files import merge_tracks

    rows = table(spark, sf_dir, "call_segments").select("call_id", "seg_id", F.struct(F.col("ts_start").alias("start"), F.col("ts_end").alias("end")).alias("timestamp"))
    return merge_tracks(rows.where("seg_id % 2 = 0"), rows.where("seg_id % 2 <> 0"), ["call_id"], ["seg_id"], "pos").select("call_id", "seg_id", "role", "pos")


@query("SELECT event_id, CAST(event_id * 0.25 AS DOUBLE) AS loss, CAST(json_extract_string(props, '$.k') AS INTEGER) AS step FROM events")
def regex_extract_log(spark, sf_dir):
    """fn22: losses and steps of log lines."""
    line = F.concat(F.lit("epoch 1, train_loss: "), (F.col("event_id") * 0.25).cast("string"), F.coalesce(F.concat(F.lit(" step: "), F.get_json_object("props", "$.k")), F.lit("")))
    return table(spark, sf_dir, "events").select("event_id", misc.training_log(line).alias("r")).select("event_id", "r.*")


@query("SELECT row_id, 'WX_' || regexp_replace(talker, '[^\\p{L}\\p{N}_-]', '', 'g') || CASE WHEN regexp_matches(talker, '[^\\p{L}\\p{N}_-]') THEN '~' || substring(md5(talker), 1, 6) ELSE '' END AS room FROM messages")
def room_sanitise(spark, sf_dir):
    """Rooms named after talkers; those whose names would collide stay apart."""
    from colloqua.sources.sqlite import room_of

    return table(spark, sf_dir, "messages").select("row_id", room_of(F.col("talker")).alias("room"))


# --- sources, sinks, scoring and streams -------------------------------------------------


@query("SELECT row_id AS id, coalesce(msg, '') AS msg, is_sender, coalesce(talker, '') AS talker, coalesce(room_name, '') AS room_name, "
       "strftime(date_trunc('second', create_time), '%Y-%m-%d %H:%M:%S') AS at FROM messages")
def csv_roundtrip(spark, sf_dir):
    """Unified CSV written by room and read again. The format doesn't tell a null text from an empty one."""
    from colloqua.session import shared_path
    from colloqua.sinks.files import write_rooms
    from colloqua.sources.files import read_unified

    rows = table(spark, sf_dir, "messages")
    path = shared_path(spark, "rooms")
    write_rooms(rows.withColumnsRenamed({"msg_svr_id": "MsgSvrID", "create_time": "CreateTime"}).withColumn("id", F.col("row_id")), path)
    back = read_unified(spark, path)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return back.select("id", text("msg"), "is_sender", text("talker"), text("room_name"), F.date_format("CreateTime", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(f"WITH {DIALOGUES} SELECT {LINES.format('ms')} AS dialogue FROM talk")
def jsonl_roundtrip(spark, sf_dir):
    """Dialogues written as JSON lines and read again."""
    from colloqua.session import shared_path
    from colloqua.sinks.files import write_chatml
    from colloqua.sources.files import read_dialogues

    path = shared_path(spark, "dialogues")
    write_chatml(dialogues(spark, sf_dir), path)
    return read_dialogues(spark, path).select(D.rendered(F.col("messages")).alias("dialogue"))


def _varint(n):
    """A long of up to 35 bits as a varint: seven bits a byte from the lowest, the high bit on all bytes but the last."""
    groups = [F.shiftright(n, at).bitwiseAND(127) + F.when(F.shiftright(n, at + 7) > 0, 128).otherwise(0) for at in range(0, 35, 7)]
    return F.unhex(F.concat(*[F.when(F.lit(at == 0) | (F.shiftright(n, at) > 0), F.lpad(F.hex(g), 2, "0")).otherwise("") for at, g in zip(range(0, 35, 7), groups)]))


@query("SELECT row_id, msg FROM messages WHERE msg <> ''")
def protobuf_decode(spark, sf_dir):
    """texts put into length-delimited fields, found again as the first of each body."""
    from colloqua.sources.wire import wire_texts

    raw = F.col("msg").cast("binary")
    body = F.concat(F.unhex(F.lit("0801")), F.unhex(F.lit("0A")), _varint(F.octet_length("msg").cast("long")), raw)
    rows = table(spark, sf_dir, "messages").where("msg <> ''")
    return rows.select("row_id", F.try_element_at(wire_texts(body), F.lit(1)).alias("msg"))


@query("SELECT row_id, talker, is_sender, msg FROM messages WHERE is_forward = 0 AND msg IS NOT NULL")
def sqlite_scan(spark, sf_dir):
    """Stores written by tasks, scanned again with a filter that SQLite evaluates."""
    from colloqua.session import shared_path
    from colloqua.sinks.stores import write_sqlite
    from colloqua.sources.sqlite import scan

    path = shared_path(spark, "stores")
    rows = table(spark, sf_dir, "messages").select("row_id", "talker", "is_sender", "msg", "is_forward")
    write_sqlite(rows, path, "MSG", key="row_id")
    path = path.removeprefix("file://")
    return scan(spark, f"{path}/*.db", "MSG", ("row_id", "talker", "is_sender", "msg"), "row_id bigint, talker string, is_sender int, msg string", "is_forward = 0 AND msg IS NOT NULL")


@query(f"""SELECT CAST(row_id AS VARCHAR) AS "MsgSvrID", coalesce(is_sender, 7) AS is_sender, talker, {stripped('msg')} AS msg, epoch_us(create_time) // 1000000 AS at FROM messages
    WHERE type_name = 'text' AND {stripped('msg')} <> '' AND coalesce(talker, '') <> '' AND NOT ends_with(talker, '@chatroom')""")
def wechat_scan(spark, sf_dir):
    """Message stores of one messenger, unified."""
    from colloqua.session import shared_path
    from colloqua.sinks.stores import write_sqlite
    from colloqua.sources.sqlite import read_wechat

    path = shared_path(spark, "stores")
    rows = table(spark, sf_dir, "messages").select(
        F.col("row_id").cast("string").alias("MsgSvrID"), F.coalesce("is_sender", F.lit(7)).alias("IsSender"), F.unix_seconds("create_time").alias("CreateTime"),
        F.col("talker").alias("StrTalker"), F.col("msg").alias("StrContent"), F.when(F.col("type_name") == "text", 1).otherwise(3).alias("Type"))
    write_sqlite(rows, path, "MSG")
    found = read_wechat(spark, path.removeprefix("file://"))
    return found.select("MsgSvrID", "is_sender", "talker", "msg", F.unix_seconds("CreateTime").alias("at"))


@query(f"""WITH t AS (SELECT row_id, create_time, talker, is_forward, row_id % 3 AS k, {stripped('msg')} AS x FROM messages WHERE create_time IS NOT NULL),
    f AS (SELECT *, CASE WHEN x <> '' AND lower(x) NOT IN ('null', 'undefined') AND {share(n_of('x', T.MEANINGFUL), 'length(x)')} >= 0.3 THEN regexp_replace(x, ' {{2,}}', chr(10), 'g') ELSE '' END AS clean FROM t),
    m AS (SELECT *, CASE WHEN k = 1 THEN '[图片]' || CASE WHEN coalesce(clean, '') <> '' THEN ' ' || clean ELSE '' END ELSE clean END AS msg FROM f)
    SELECT row_id || '_7' AS "MsgSvrID", CASE WHEN k = 1 THEN 'image' ELSE 'text' END AS type_name, coalesce(nullif(talker, ''), 'unknown') AS talker, msg,
      epoch_us(create_time) // 1000000 AS at, 'TG_chat_7' AS room_name, CASE WHEN is_forward = 1 THEN 1 ELSE 0 END AS is_forward FROM m WHERE msg <> ''""")
def telegram_variant(spark, sf_dir):
    """Exports written by tasks, read as variants: texts plain, in parts, and with a photo."""
    from colloqua.session import shared_path
    from colloqua.sinks.stores import write_telegram
    from colloqua.sources.telegram import read_telegram

    kind, text = F.col("row_id") % 3, F.coalesce("msg", F.lit(""))
    rows = table(spark, sf_dir, "messages").where("create_time IS NOT NULL")
    plain = F.struct(
        F.col("row_id").alias("id"), F.lit("message").alias("type"), F.unix_seconds("create_time").cast("string").alias("date_unixtime"), F.col("talker").alias("from"),
        F.when(F.col("is_forward") == 1, "x").alias("forwarded_from"), F.when(kind == 1, "photo.jpg").alias("photo"), text.alias("text"))
    half = F.floor(F.length(text) / 2).cast("int")
    parts = F.array(F.to_json(F.struct(F.lit("bold").alias("type"), F.substring(text, F.lit(1), half).alias("text"))), F.to_json(F.struct(F.lit("plain").alias("type"), F.substring(text, half + 1, F.length(text)).alias("text"))))
    listed = F.regexp_replace(F.to_json(plain.dropFields("text")), r"\}$", "")
    message = F.when(kind == 2, F.concat(listed, F.lit(', "text": ['), F.array_join(parts, ", "), F.lit("]}"))).otherwise(F.to_json(plain))
    path = shared_path(spark, "exports")
    write_telegram(rows.select(message.alias("message")), path, 7)
    found = read_telegram(spark, path.removeprefix("file://"))
    return found.select("MsgSvrID", "type_name", "talker", "msg", F.unix_seconds("CreateTime").alias("at"), "room_name", "is_forward")


@query(f"WITH {DIALOGUES} SELECT dialogue_id AS id, length({LINES.format('ms')}) % 5 + 1 AS score FROM talk")
def llm_scoring(spark, sf_dir):
    """U3 with the deterministic judge."""
    from colloqua.operators.scoring import length_judge, score_pairs

    pairs = dialogues(spark, sf_dir).withColumnRenamed("dialogue_id", "id")
    return score_pairs(pairs, length_judge).select("id", "score")


def _stream_rows(messages):
    return messages.where("create_time IS NOT NULL").select(
        F.col("room_name").alias("room"), F.col("is_sender").alias("side"), F.col("create_time").alias("at"),
        F.unix_micros("create_time").alias("us"), F.col("row_id").alias("seq"), F.coalesce("msg", F.lit("")).alias("msg"))


@query("""WITH r AS (SELECT room_name AS room, is_sender AS side, epoch_us(create_time) AS us, row_id AS seq, coalesce(msg, '') AS msg FROM messages WHERE create_time IS NOT NULL),
    f AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 120000000 THEN 0 ELSE 1 END AS brk FROM r WINDOW w AS (PARTITION BY room, side ORDER BY us, seq)),
    g AS (SELECT *, sum(brk) OVER (PARTITION BY room, side ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS g FROM f)
    SELECT room, side, min(us) AS start_us, max(us) + 120000000 AS end_us, count(*) AS n_rows, string_agg(msg, chr(10) ORDER BY us, seq) AS msg FROM g GROUP BY room, side, g""")
def stream_sessionize(spark, sf_dir):
    from colloqua.session import shared_path
    from colloqua.streaming.messages import closed_stream, run_to_end, stream_bursts

    base = shared_path(spark, "stream")
    rows = closed_stream(_stream_rows(table(spark, sf_dir, "messages")), base)
    found = run_to_end(stream_bursts(rows), base)
    return found.select("room", "side", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n_rows", "msg")


@query("WITH r AS (SELECT room_name AS room, epoch_us(create_time) AS us, row_id AS seq, is_sender AS side FROM messages WHERE create_time IS NOT NULL) "
       "SELECT a.room, a.us, a.seq, min(b.us) AS reply_us FROM r a JOIN r b ON a.room = b.room AND a.side <> 1 AND b.side = 1 AND b.us > a.us AND b.us <= a.us + 300000000 GROUP BY ALL")
def stream_asof(spark, sf_dir):
    from colloqua.session import shared_path
    from colloqua.streaming.messages import closed_stream, run_to_end, stream_replies

    base = shared_path(spark, "stream")
    later = 2000 * 366 * 86_400_000_000  # the watermark starts at 1970, and rows before it would be late
    rows = _stream_rows(table(spark, sf_dir, "messages")).drop("msg")
    rows = closed_stream(rows.withColumns({"at": F.timestamp_micros(F.col("us") + later), "us": F.col("us") + later}), base)
    found = run_to_end(stream_replies(rows, with_text=False), base)
    return found.groupBy("room", F.col("us") - later, "seq").agg(F.min("reply_us") - later).toDF("room", "us", "seq", "reply_us")


# --- small expressions ---------------------------------------------------------------------


@query("""WITH b AS (SELECT o_orderkey, CAST(o_orderkey % 4999 AS BIGINT) * (1::BIGINT << CAST(10 * (o_orderkey % 6) AS INTEGER)) + o_orderkey % 7 AS n FROM orders)
    SELECT o_orderkey, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f KB', n / 1024) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576)
      WHEN n < 1099511627776 THEN printf('%.1f GB', n / 1073741824) WHEN n < 1125899906842624 THEN printf('%.1f TB', n / 1099511627776)
      ELSE printf('%.1f PB', n / 1125899906842624) END AS shown FROM b""")
def size_display(spark, sf_dir):
    """fn23: sizes from nothing to petabytes."""
    n = F.expr("o_orderkey % 4999 * shiftleft(1L, CAST(10 * (o_orderkey % 6) AS INT)) + o_orderkey % 7")
    return table(spark, sf_dir, "orders").select("o_orderkey", misc.size_text(n).alias("shown"))


@query("""WITH s AS (SELECT event_id, event_id * 17.5 - 100 AS n FROM events), w AS (SELECT event_id, greatest(CAST(trunc(n) AS BIGINT), 0) AS n FROM s),
    t AS (SELECT event_id, CASE WHEN n >= 3600 THEN n // 3600 || '小时' ELSE '' END || CASE WHEN n // 60 % 60 > 0 THEN n // 60 % 60 || '分' ELSE '' END || CASE WHEN n % 60 > 0 THEN n % 60 || '秒' ELSE '' END AS t FROM w)
    SELECT event_id, CASE WHEN t = '' THEN '0秒' ELSE t END AS shown FROM t""")
def duration_display(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", misc.duration_text(F.col("event_id") * 17.5 - 100).alias("shown"))


@query("SELECT c_mktsegment, max_by(c_name, CAST(regexp_extract(c_name, '(\\d+)$', 1) AS BIGINT)) AS latest FROM customer GROUP BY c_mktsegment")
def latest_by_suffix(spark, sf_dir):
    """The name with the largest number at its end."""
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.max_by("c_name", misc.number_at_end(F.col("c_name"))).alias("latest"))


MODULES = "modules AS (SELECT l_orderkey, l_linenumber, l_partkey, 'model.layers.' || l_orderkey % 50 || CASE WHEN l_linenumber % 4 = 0 THEN '.router' ELSE '.expert' END AS name FROM lineitem)"


@query(f"WITH {MODULES}, k AS (SELECT *, row_number() OVER (PARTITION BY regexp_extract(name, '(layers\\.\\d+|h\\.\\d+)', 1) ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM modules WHERE NOT contains(name, 'router')) "
       "SELECT l_orderkey, l_linenumber, l_partkey, name FROM k WHERE k <= 6 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, name FROM modules WHERE contains(name, 'router')")
def module_targets(spark, sf_dir):
    """W8, fn26: a cap for each layer, which routers bypass."""
    name = F.concat(F.lit("model.layers."), (F.col("l_orderkey") % 50).cast("string"), F.when(F.col("l_linenumber") % 4 == 0, ".router").otherwise(".expert"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", name.alias("name")).withColumn("layer", misc.layer_key(F.col("name")))
    return S.cap_per_group(rows, "layer", ["l_orderkey", "l_linenumber", "l_partkey"], 6, F.contains("name", F.lit("router"))).drop("layer")


@query("SELECT p_partkey, 'part' || p_size AS name, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS version FROM part")
def requirement_split(spark, sf_dir):
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("part"), size, F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("=="), size)).otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", misc.name_version(text).alias("r")).select("p_partkey", "r.*")
