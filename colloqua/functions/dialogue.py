"""Dialogues as arrays of ``struct<role, content>``: budgets, validity, runs, formats.

All are higher-order expressions on one row; nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloqua.functions.text import any_of, is_meaningless, spaces_to_lines, strip

MESSAGES = "array<struct<role:string,content:string>>"


def message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def total_length(messages: Column) -> Column:
    """Characters of all contents."""
    return F.aggregate(messages, F.lit(0), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))


def budget_prefix(messages: Column, budget: Column) -> Column:
    """The oldest messages whose running length stays within ``budget``."""
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("open"), F.lit(0).alias("kept"))

    def step(a: Column, m: Column) -> Column:
        n = a["n"] + F.length(m["content"])
        fits = a["open"] & (n <= budget)
        return F.struct(n.alias("n"), fits.alias("open"), (a["kept"] + F.when(fits, 1).otherwise(0)).alias("kept"))

    return F.slice(messages, F.lit(1), F.aggregate(messages, start, step, lambda a: a["kept"]))


def greedy_reduce(messages: Column, limit: Column) -> Column:
    """fn14: a system message in front and the last two, plus the newest others while they fit; null if those don't fit.

    Others are added newest first and stop at the first that doesn't fit. System
    messages elsewhere count as others. Of less than two messages none is a last
    one; of two, a system message in front is both.
    """
    n = F.size(messages)
    leads = F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "system", F.lit(False)).cast("int")
    system = F.slice(messages, F.lit(1), leads)
    tail = F.slice(messages, F.greatest(n - 1, F.lit(1)), F.when(n >= 2, 2).otherwise(0))
    middle = F.slice(messages, leads + 1, F.greatest(n - 2 - leads, F.lit(0)))
    fixed = total_length(system) + total_length(tail)
    kept = F.size(budget_prefix(F.reverse(middle), limit - fixed))
    context = F.slice(middle, F.greatest(F.size(middle) - kept + 1, F.lit(1)), kept)
    return F.when(fixed <= limit, F.concat(system, context, tail))


def alternates(messages: Column) -> Column:
    """No two neighbouring user and assistant roles are equal, system messages aside."""
    roles = F.transform(F.filter(messages, lambda m: m["role"].isin("user", "assistant")), lambda m: m["role"])
    start = F.struct(F.lit("").alias("last"), F.lit(True).alias("ok"))
    return F.aggregate(
        roles, start, lambda a, r: F.struct(r.alias("last"), (a["ok"] & (a["last"] != r)).alias("ok")), lambda a: a["ok"]
    )


def is_valid_dialogue(messages: Column) -> Column:
    """fn15: ends with user, assistant; both say something; roles alternate."""
    last, before = F.try_element_at(messages, F.lit(-1)), F.try_element_at(messages, F.lit(-2))
    said = [strip(before["content"]), strip(last["content"])]
    ok = (before["role"] == "user") & (last["role"] == "assistant") & alternates(messages)
    for text in said:
        ok &= F.length(text) >= 2
    ok &= ~any_of([is_meaningless(text) for text in said])
    return F.coalesce((F.size(messages) >= 2) & ok, F.lit(False))


def merge_role_runs(messages: Column) -> Column:
    """A5: neighbours of one role become one message, its texts line by line."""
    empty = F.array().cast(MESSAGES)

    def step(done: Column, m: Column) -> Column:
        text = spaces_to_lines(m["content"])
        last = F.try_element_at(done, F.lit(-1))
        joined = message(m["role"], F.concat(last["content"], F.lit("\n"), text))
        same = F.coalesce(last["role"] == m["role"], F.lit(False))
        grown = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
        return F.when(same, grown).otherwise(F.concat(done, F.array(message(m["role"], text))))

    return F.aggregate(messages, empty, step)


def with_system(messages: Column, prompt: str) -> Column:
    """A leading system message, unless the prompt is blank or ``*``."""
    if not prompt.strip() or prompt == "*":
        return messages
    return F.concat(F.array(message(F.lit("system"), F.lit(prompt))), messages)


def first_content(messages: Column, role: str) -> Column:
    """What ``role`` says first, or the empty text."""
    return F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(1))["content"], F.lit(""))


def without_indices(messages: Column, removed: Column) -> Column:
    """Messages whose place, from 0, isn't in ``removed``; null removes nothing (fail-open)."""
    gone = F.coalesce(removed, F.array().cast("array<int>"))
    return F.filter(messages, lambda m, i: ~F.array_contains(gone, i))


def rendered(messages: Column) -> Column:
    """``role: content`` lines."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def numbered(messages: Column) -> Column:
    """fn20: ``[i] 用户: text`` lines for a judge."""
    name = lambda m: F.when(m["role"] == "user", F.lit("用户")).otherwise(F.lit("AI"))
    line = lambda m, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), name(m), F.lit(": "), m["content"], F.lit("\n"))
    return F.array_join(F.transform(messages, line), "")


def last_turns(messages: Column, n: int = 20) -> Column:
    """The last ``n`` messages."""
    return F.slice(messages, F.greatest(F.size(messages) - n + 1, F.lit(1)), F.lit(n))


def sft_text(messages: Column, instruction: Column, given: Column, output: Column, text: Column, eos: str = "") -> Column:
    """fn16: one training text of whichever format a record has; null if it has none."""
    full = F.concat(F.lit("Instruction: "), instruction, F.lit("\nInput: "), given, F.lit("\nAnswer: "), output)
    short = F.concat(F.lit("Instruction: "), instruction, F.lit("\nAnswer: "), output)
    pair = F.concat(F.lit("Input: "), given, F.lit("\nAnswer: "), output)
    body = (
        F.when(messages.isNotNull(), rendered(messages))
        .when(instruction.isNotNull() & output.isNotNull() & (F.coalesce(given, F.lit("")) != ""), full)
        .when(instruction.isNotNull() & output.isNotNull(), short)
        .when(given.isNotNull() & output.isNotNull(), pair)
        .otherwise(text)
    )
    done = F.concat(body, F.lit(eos))
    return F.when(done != "", done)


def turns_to_messages(turns: Column, prompt: str = "") -> Column:
    """fn17: ``turns[{role, text}]`` with role ``ai`` for the assistant; null without turns."""
    role = lambda t: F.when(t["role"] == "ai", "assistant").otherwise(t["role"])
    return F.when(F.size(turns) > 0, with_system(F.transform(turns, lambda t: message(role(t), t["text"])), prompt))


def first_exchange(turns: Column, prompt: str = "") -> Column:
    """fn17: the first user and the first ai turn; null unless there are both."""
    first = lambda who: F.try_element_at(F.filter(turns, lambda t: t["role"] == who), F.lit(1))["text"]
    both = F.array(message(F.lit("user"), first("user")), message(F.lit("assistant"), first("ai")))
    ok = (F.size(turns) >= 2) & first("user").isNotNull() & first("ai").isNotNull()
    return F.when(ok, with_system(both, prompt))


def instruction_to_messages(instruction: Column, given: Column, output: Column, prompt: str = "") -> Column:
    """fn17: an instruction, with its input after a blank line, and the output."""
    ask = F.when(F.coalesce(given, F.lit("")) != "", F.concat(instruction, F.lit("\n\n"), given)).otherwise(instruction)
    pair = F.array(message(F.lit("user"), ask), message(F.lit("assistant"), output))
    return F.when(instruction.isNotNull() & output.isNotNull(), with_system(pair, prompt))


def replace_system(messages: Column, prompt: str) -> Column:
    """fn17: the messages without their system messages, under a new one."""
    return with_system(F.filter(messages, lambda m: m["role"] != "system"), prompt)


def conversations_to_messages(conversations: Column) -> Column:
    """fn21: ``[{from, value}]`` records."""
    return F.transform(conversations, lambda c: message(c["from"], c["value"]))


def without_thought(c: Column) -> Column:
    """fn18: a judge's reply without its first thought and without code fences."""
    bare = F.regexp_replace(c, r"(?s)^(.*?)<think>.*?</think>", "$1")
    return strip(F.regexp_replace(strip(bare), r"^```(?:json)?|```$", ""))


def parse_scores(reply: Column) -> Column:
    """fn19: ``array<struct<id, score>>`` of a reply that is a JSON array, or one object a line.

    A line counts only if it is one whole object; fenced or comma-ended lines don't.
    A score that is no number counts 0.
    """
    kind = "array<struct<id:string,score:string>>"
    whole = F.from_json(strip(reply), kind)
    lines = F.filter(F.transform(F.split(reply, "\n"), strip), lambda x: x.rlike(r"^\{.*\}$"))
    each = F.transform(lines, lambda x: F.from_json(x, "struct<id:string,score:string>"))
    found = F.when(strip(reply).startswith("["), whole).otherwise(each)
    number = lambda v: F.coalesce(F.try_to_number(v["score"], F.lit("999999")).cast("int"), F.lit(0))
    kept = F.filter(found, lambda v: v["id"].isNotNull())
    return F.transform(kept, lambda v: F.struct(v["id"].alias("id"), number(v).alias("score")))
