"""Argument checks: each gives the value in its type, or raises ValueError with what is wrong."""

from __future__ import annotations

import datetime as dt
import json
import re
from pathlib import Path
from urllib.parse import urlsplit

#: Names by which a model folder is recognised, and kinds of data files.
MODEL_FILES = ("config.json", "pytorch_model.bin", "model.safetensors")
DATA_KINDS = (".json", ".jsonl", ".csv", ".txt")


def check_path(path: str, must_exist: bool = True, parent: bool = False) -> Path:
    """A path that isn't empty and doesn't climb; it, or with ``parent`` its folder, has to be there."""
    if not str(path).strip():
        raise ValueError("empty path")
    found = Path(path)
    if ".." in found.parts:
        raise ValueError(f"path climbs: {path}")
    if must_exist and not found.exists():
        raise ValueError(f"nothing at {path}")
    if parent and not found.parent.exists():
        raise ValueError(f"no folder {found.parent}")
    return found


def check_positive(value: int | str, name: str) -> int:
    try:
        number = int(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} is no whole number: {value}") from None
    if number <= 0:
        raise ValueError(f"{name} isn't positive: {value}")
    return number


def check_number(value: float | str, name: str, least: float | None = None, most: float | None = None) -> float:
    try:
        number = float(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} is no number: {value}") from None
    if (least is not None and number < least) or (most is not None and number > most) or number != number:
        raise ValueError(f"{name} is outside [{least}, {most}]: {value}")
    return number


def check_choice(value: str, name: str, choices: tuple[str, ...], any_case: bool = False) -> str:
    """The choice ``value`` names, as it is listed."""
    for choice in choices:
        if value == choice or any_case and value.lower() == choice.lower():
            return choice
    raise ValueError(f"{name} is none of {choices}: {value}")


def check_url(url: str) -> str:
    parts = urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.netloc:
        raise ValueError(f"no web address: {url}")
    return url


def check_model_path(path: str) -> Path:
    """A folder with one of the files of a model."""
    found = check_path(path)
    if not found.is_dir():
        raise ValueError(f"no folder: {path}")
    if not any((found / name).exists() for name in MODEL_FILES):
        raise ValueError(f"no model in {path}")
    return found


def check_data_path(path: str) -> Path:
    """A data file of a known kind."""
    found = check_path(path)
    if not found.is_file():
        raise ValueError(f"no file: {path}")
    if found.suffix.lower() not in DATA_KINDS:
        raise ValueError(f"no data file: {path}")
    return found


def check_account(number: str | int) -> str:
    """An account number of 5 to 11 digits."""
    text = str(number)
    if not re.fullmatch(r"[0-9]{5,11}", text):
        raise ValueError(f"no account number: {number}")
    return text


def check_time_range(given: str, form: str = "%Y-%m-%d") -> tuple[dt.datetime, dt.datetime]:
    """Both ends of a range ``start,end``, the first before the second."""
    parts = given.split(",")
    if len(parts) != 2:
        raise ValueError(f"no range: {given}")
    a, b = (dt.datetime.strptime(p.strip(), form) for p in parts)
    if a >= b:
        raise ValueError(f"{parts[0]} isn't before {parts[1]}")
    return a, b


def check_json_file(path: str) -> Path:
    found = check_path(path)
    if found.suffix.lower() != ".json":
        raise ValueError(f"no JSON file: {path}")
    json.loads(found.read_text(encoding="utf-8"))
    return found
