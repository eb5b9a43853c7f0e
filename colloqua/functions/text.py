"""Message-level text predicates and clean-up as Column expressions.

Everything stays in the JVM and inside whole-stage code generation. Patterns are
written with explicit classes, so that they mean the same in Java's and RE2's
dialect; null gives null unless a docstring says otherwise.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: they must equal the reference's for equal results. ---------
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
MEANINGFUL = r"[\p{L}\p{Nd}²³¹]"
ALNUM = r"[\p{L}\p{N}]"
UNPRINTABLE = r"[\p{C}\p{Z}]"
CJK = r"[\x{4e00}-\x{9fff}]"
ODD = r"[\x{80}-\x{9f}\x{b0}-\x{ff}\x00-\x08\x0b\x0c\x0e-\x1f\x{10000}-\x{10ffff}\x{e000}-\x{f8ff}]"
BANNED_BLOCKS = r"[\x{370}-\x{4ff}\x{600}-\x{6ff}\x{e000}-\x{f8ff}]"
LATIN1 = r"[\x00-\x{ff}]"
LATIN1_PLAIN = r"[0-9A-Za-z\s\x0b\x1c-\x1f\x{85}\x{a0}ªµºÀ-ÖØ-öø-ÿ²³¹¼½¾]"
PUNCTUATION = r"[.,!?;:。，！？；：]"
SENSITIVE = (
    r"Users\\[\p{L}\p{N}_]+", r"C:\\Users", r"Tencent Files", r"NTOS.*::",
    r"(^|[^\p{L}\p{N}_])1[3-9]\d{9}($|[^\p{L}\p{N}_])",
    r"(^|[^\p{L}\p{N}_])\d{17}[\dX]($|[^\p{L}\p{N}_])",
    r"(^|[^\p{L}\p{N}_])(\d{1,3}\.){3}\d{1,3}($|[^\p{L}\p{N}_])",
)
GARBAGE_TEXTS = ("tAB>b)Z)L", "c/Pخ𝅘𝅥Xo", "ړ~!ufX1L", "Rd;kj\ncd", "HR=    ί0\\5O", "E|gQf")
GARBAGE_FORMS = (
    r"^[A-Z]{1,3}[><!|=~]{1,3}", r"[)><!;=]{2,}",
    r"[A-Za-z]{1,3}[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\p{Z}\x{4e00}-\x{9fff}]{2,}",
    r"^[A-Z][a-z]?[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\p{Z}]+", r"\\[0-9]",
)
COMMON_WORDS = tuple(
    "你 我 他 她 是 不 有 的 了 在 都 可以 也 怎么 什么 为什么 对 好 行 的确 真假 这 那 太 点 猜 心动 堆料 猿 "
    "the a an and or but in on at to for of with how what why when where who yes no ok good bad "
    "neo iphone android windows mac".split()
)
COMMON_WORDS_2 = tuple(
    "你 我 他 她 是 不 有 的 了 在 都 可以 也 怎么 什么 为什么 对 好 行 的确 真假 这 那 太 点 那个 试试 能不能 哦不对 没事 "
    "开源 命令行 动画 哆 这么大 因为 写 the a an and or but in on at to for of with how what why when where who yes no ok good bad "
    "idk sketch qt5 qt pyqt neo flux".split()
)
PATH_MARKS = ("C:\\", "D:\\", "E:\\", "F:\\", "/home/", "/usr/", "/var/", "/tmp/", "Documents", "Desktop", "Downloads",
              "Tencent Files", "QQ", "NTOS", "Full::")
LINK_MARKS = ("download?appid=", "fileid=", "&spec=", "qq.com/file/", "qzone.qq.com/", "weiyun.com/", "appid=1406", "EhR", "EhQ")
MEDIA_MARKS = ("[图片]", "[表情]", "[Pic]", "[图]", "[Image]", "[语音]", "[Voice]", "[音频]", "[Audio]", "[视频]", "[Video]",
               "[文件]", "[File]", "[动画表情]", "[Sticker]", "[贴纸]", "data:image/", ".jpg", ".png", ".gif", ".jpeg", ".webp",
               ".mp3", ".wav", ".mp4", ".avi")
VOICE_MARKS = ("[语音]", "[Voice]", "[音频]", "[Audio]")
VIDEO_MARKS = ("[视频]", "[Video]")
FILE_MARKS = ("[文件]", "[File]")
IMAGE_MARKS = ("[图片]", "[表情]", "[Pic]", "[图]", "[Image]", "[动画表情]", "[Sticker]", "[贴纸]")
READABLE_IDS = ("neo", "phone", "user", "file", "path")
MEANINGLESS = (
    r"^[a-zA-Z]{1,3}$", r"^[\p{Nd}\s\x0b\x1c-\x1f\x{85}\p{Z}]+$", r"^[^一-龥a-zA-Z\p{Nd}]{3,}$", r"^([哈嘿呵]{3,}|[23]{3,}|w{3,})$",
)
# -------------------------------------------------------------------------------


def any_of(tests: list[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


@functools.cache
def alternation(marks: tuple[str, ...]) -> str:
    """A pattern that finds any of the marks: by first character, so that most places of a text fail at once."""
    heads: dict[str, list[str]] = {}
    for mark in marks:
        heads.setdefault(mark[0], []).append(mark[1:])
    quoted = lambda c: "\\" + c if c.isascii() and not c.isalnum() else c
    branches = [quoted(c) if "" in rest else quoted(c) + "(?:" + "|".join(rf"\Q{r}\E" for r in rest) + ")" for c, rest in heads.items()]
    return f"(?=[{''.join(map(quoted, heads))}])(?:{'|'.join(branches)})"


def contains_any(c: Column, marks: tuple[str, ...]) -> Column:
    """One pass with an alternation, so that ``c`` is evaluated once, not once for each mark."""
    return c.rlike(alternation(marks))


def matches_any(c: Column, patterns: tuple[str, ...]) -> Column:
    return any_of([c.rlike(p) for p in patterns])


def count_of(c: Column, pattern: str) -> Column:
    """Characters in a class ``[...]``: what is left when runs of others are taken out, or the count of another pattern."""
    if pattern.startswith("[") and pattern.endswith("]") and not pattern.startswith("[^"):
        return F.length(F.regexp_replace(c, f"[^{pattern[1:-1]}]+", ""))
    return F.regexp_count(c, F.lit(pattern))


def share_of(c: Column, pattern: str) -> Column:
    """Share of a text's characters that match; null for an empty text."""
    return count_of(c, pattern) / F.nullif(F.length(c), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def squeeze_blanks(c: Column) -> Column:
    """Blanks, line breaks included, become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def double_spaces_to_lines(c: Column) -> Column:
    """Two or more spaces become a line break."""
    return F.regexp_replace(c, " {2,}", "\n")


def spaces_to_lines(c: Column) -> Column:
    """fn6: runs of spaces become line breaks; stripped."""
    return strip(F.regexp_replace(c, " +", "\n"))


def blocked(c: Column, words: tuple[str, ...]) -> Column:
    """Empty, or one of the words in any case."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return any_of([low == "", *[F.contains(low, F.lower(F.lit(w))) for w in words if w]])


def unprintable(c: Column) -> Column:
    return count_of(c, UNPRINTABLE) - count_of(c, " ")


def special(c: Column) -> Column:
    """Characters neither letter, digit nor blank."""
    return F.length(c) - count_of(c, ALNUM) - count_of(c, BLANK)


def is_sensitive(c: Column) -> Column:
    """F6."""
    return matches_any(c, SENSITIVE)


def is_garbled(c: Column) -> Column:
    """over a fifth odd or nearly a third unprintable characters; an empty text isn't."""
    return F.coalesce((share_of(c, ODD) > 0.2) | (unprintable(c) / F.nullif(F.length(c), F.lit(0)) > 0.3), F.lit(False))


def is_meaningful(c: Column) -> Column:
    """F8."""
    t = strip(c)
    share = F.coalesce(share_of(t, MEANINGFUL), F.lit(0.0))
    digits_only = F.regexp_replace(t, " ", "").rlike(r"^\p{Nd}+$")
    strict = (count_of(t, MEANINGFUL) >= 3) & ~digits_only & (special(t) / F.nullif(F.length(t), F.lit(0)) < 0.5)
    return (share > 0) & (share >= 0.5) & ~is_garbled(t) & (contains_any(F.lower(t), COMMON_WORDS) | F.coalesce(strict, F.lit(False)))


def is_encoded(c: Column, alnum_rule: bool = True) -> Column:
    """F9; ``alnum_rule`` keeps the reference's rule that long texts of letters are codes."""
    t = strip(c)
    n = F.length(t)
    tests = [
        (n > 20) & t.rlike(r"^[123]0P.*[\p{L}\p{N}]"),
        t.rlike(r"^[A-Za-z0-9+/=_-]{21,}$"),
        t.rlike(r"^\p{Nd}{16,}$"),
        t.rlike(r"^[0-9a-fA-F]{17,}$"),
    ]
    if alnum_rule:
        tests.append((n > 12) & (count_of(t, ALNUM) / n > 0.8) & ~contains_any(F.lower(t), READABLE_IDS))
    return (F.length(c) >= 8) & (n > 0) & F.coalesce(any_of(tests), F.lit(False))


def has_file_path(c: Column) -> Column:
    """F10."""
    return contains_any(c, PATH_MARKS)


def is_download_link(c: Column) -> Column:
    """F11."""
    low = F.lower(c)
    url = F.contains(c, F.lit("?")) & F.contains(c, F.lit("&")) & F.contains(c, F.lit("=")) & (F.length(c) > 50)
    return contains_any(c, LINK_MARKS) | (url & ~contains_any(low, ("http://", "https://", "www.")))


def is_media(c: Column, alnum_rule: bool = True) -> Column:
    """F13; an empty text is media."""
    dense = (F.length(c) > 10) & (unprintable(c) / F.nullif(F.length(c), F.lit(0)) > 0.3)
    return (c == "") | contains_any(c, MEDIA_MARKS) | is_download_link(c) | is_encoded(c, alnum_rule) | has_file_path(c) | F.coalesce(
        dense, F.lit(False)
    )


def is_valid(c: Column, alnum_rule: bool = True) -> Column:
    """not a null word, not media, nothing sensitive, meaningful."""
    word = F.lower(strip(c)).isin("", "undefined", "null", "none")
    return ~word & ~is_media(c, alnum_rule) & ~is_sensitive(c) & is_meaningful(c)


def message_type(c: Column) -> Column:
    """F14."""
    return (
        F.when(c == "", "system")
        .when(is_download_link(c), "file")
        .when(contains_any(c, VOICE_MARKS), "voice")
        .when(contains_any(c, VIDEO_MARKS), "video")
        .when(contains_any(c, FILE_MARKS), "file")
        .when(contains_any(c, IMAGE_MARKS), "image")
        .when(is_media(c), "media")
        .when(c.isNotNull(), "text")
    )


def clean_text(c: Column) -> Column:
    """no direction and control characters; odd ends trimmed."""
    t = strip(F.regexp_replace(c, r"[\x{202a}-\x{202e}\x{2066}-\x{2069}\x00-\x08\x0b\x0c\x0e-\x1f]", ""))
    t = F.regexp_replace(t, r"^[^0-9A-Za-z\x{80}-\x{10ffff}]+", "")
    return strip(F.regexp_replace(t, r"[^0-9A-Za-z\x{80}-\x{10ffff}.!?,;:]+$", ""))


def text_quality(c: Column) -> Column:
    """F16: 0 for an empty text."""
    n = F.nullif(F.length(c), F.lit(0))
    score = (
        count_of(c, CJK) / n * 2.0
        + count_of(c, "[A-Za-z]") / n * 1.5
        + F.least(count_of(c, r"[\p{Nd}²³¹]") / n * 0.5, F.lit(0.3))
        + F.least(count_of(c, PUNCTUATION) / n * 0.3, F.lit(0.2))
        + F.when(F.length(c).between(5, 200), 0.5).when(F.length(c) > 200, 0.2).otherwise(0.0)
    )
    return F.when(F.length(c) == 0, 0.0).otherwise(score)


def has_garbage(c: Column) -> Column:
    """F19."""
    return contains_any(c, GARBAGE_TEXTS) | matches_any(c, GARBAGE_FORMS)


def too_special(c: Column) -> Column:
    """F20."""
    odd = count_of(c, LATIN1) - count_of(c, LATIN1_PLAIN)
    return (F.length(c) > 2) & (odd / F.nullif(F.length(c), F.lit(0)) > 0.4)


def is_garbled_strict(c: Column) -> Column:
    """F21; a blank text is garbled, as is one with a line break."""
    t = strip(c)
    few = (F.length(t) <= 10) & (share_of(t, MEANINGFUL) < 0.8)
    return (t == "") | has_garbage(t) | t.rlike(BANNED_BLOCKS) | (unprintable(t) > 0) | too_special(t) | F.coalesce(few, F.lit(False))


def is_valid_strict(c: Column) -> Column:
    """F22."""
    t = strip(c)
    meaningful = count_of(t, MEANINGFUL)
    strict = (meaningful >= 3) & (special(t) / F.nullif(F.length(t), F.lit(0)) < 0.3)
    return ~is_garbled_strict(c) & (meaningful > 0) & (contains_any(F.lower(t), COMMON_WORDS_2) | F.coalesce(strict, F.lit(False)))


def is_chat_export_valid(c: Column) -> Column:
    """Not blank, not a null word, at least three tenths meaningful."""
    t = strip(c)
    return (t != "") & ~F.lower(t).isin("null", "undefined") & F.coalesce(share_of(t, MEANINGFUL) >= 0.3, F.lit(False))


def is_meaningless(c: Column) -> Column:
    """fn4: a few letters, digits only, signs only, or laughter only."""
    return matches_any(c, MEANINGLESS)


def char_entropy(c: Column) -> Column:
    """Shannon entropy in bits over code points; 0 for an empty text."""
    chars = F.array_sort(F.split(c, ""))
    n = F.length(c).cast("double")
    # Runs of the sorted characters: one pass instead of one count for each distinct character.
    start = F.struct(F.lit("").alias("c"), F.lit(0).alias("k"), F.lit(0.0).cast("double").alias("s"))
    xlogx = lambda k: F.when(k > 0, k * F.log2(k)).otherwise(0.0)
    total = F.aggregate(
        chars,
        start,
        lambda a, x: F.when(a["c"] == x, F.struct(a["c"].alias("c"), (a["k"] + 1).alias("k"), a["s"].alias("s"))).otherwise(
            F.struct(x.alias("c"), F.lit(1).alias("k"), (a["s"] + xlogx(a["k"])).alias("s"))
        ),
        lambda a: a["s"] + xlogx(a["k"]),
    )
    return F.when(F.length(c) == 0, 0.0).otherwise(F.log2(n) - total / n)


def char_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the character sets; 0 if both are empty."""
    chars = lambda c: F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))
    union = F.size(F.array_union(chars(a), chars(b)))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(chars(a), chars(b))) / F.nullif(union, F.lit(0)))


def preview(c: Column, most: int = 100) -> Column:
    """P26."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)
