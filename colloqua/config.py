"""Typed settings, read from JSON with line comments."""

from __future__ import annotations

import dataclasses
import json
import re
from pathlib import Path

_STRING_OR_COMMENT = re.compile(r'"(?:\\.|[^"\\])*"|//[^\n]*')


@dataclasses.dataclass(frozen=True)
class Settings:
    """Every key has a default, so that none is silently missing."""

    include_type: tuple[str, ...] = ("text",)
    blocked_words: tuple[str, ...] = ("密码", "账号", "手机号")
    single_combine_time_window: float = 2.0
    qa_match_time_window: float = 5.0
    combine_msg_max_length: int = 2048
    messages_max_length: int = 2048
    context_rows: int = 10
    system_prompt: str = "*"
    owner_id: str = ""
    require_owner_id: bool = False
    telegram_chat_id: str = ""
    accept_score: int = 2
    batch_size: int = 10
    retries: int = 3
    delay: float = 1.0
    base_url: str = ""
    model: str = ""
    api_key: str = ""
    entropy_limit: float = 5.0
    alnum_rule: bool = True


def parse_jsonc(text: str) -> dict:
    """JSON whose ``//`` comments outside strings are left out; an empty text is an empty object."""
    bare = _STRING_OR_COMMENT.sub(lambda m: m[0] if m[0].startswith('"') else "", text)
    return json.loads(bare) if bare.strip() else {}


#: The least and most of numbers that have bounds; a value outside them gives way to the default.
BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "single_combine_time_window": (0, None), "qa_match_time_window": (0, None), "combine_msg_max_length": (1, None), "messages_max_length": (1, None),
    "context_rows": (0, 1000), "accept_score": (0, 6), "batch_size": (1, None), "retries": (0, None), "entropy_limit": (0, None),
}


def coerce(value: object, like: object, bounds: tuple[float | None, float | None] = (None, None)) -> object:
    """fn25: ``value`` in the type of the default ``like``, which stands where that or the bounds don't allow it."""
    if isinstance(like, bool):
        return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes", "on")
    if isinstance(like, tuple):
        return tuple(map(str, value)) if isinstance(value, (list, tuple)) else tuple(str(value).split(","))
    try:
        found = type(like)(value)
    except (TypeError, ValueError):
        return like
    least, most = bounds
    return like if least is not None and found < least or most is not None and found > most else found


def load_settings(path: str | None = None, **given: object) -> Settings:
    """Given values over those of the file over the defaults; a missing file counts as empty.

    The file may nest its keys in sections; unknown keys are left alone.
    """
    found: dict[str, object] = {}

    def walk(node: dict) -> None:
        for key, value in node.items():
            if isinstance(value, dict):
                walk(value)
            else:
                found[key] = value

    if path and Path(path).exists():
        walk(parse_jsonc(Path(path).read_text(encoding="utf-8")))
    found |= {k: v for k, v in given.items() if v is not None}
    fields = {f.name: f.default for f in dataclasses.fields(Settings)}
    return Settings(**{k: coerce(v, fields[k], BOUNDS.get(k, (None, None))) for k, v in found.items() if k in fields})
