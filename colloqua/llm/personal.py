"""Personal information inside free text: found behind disguises, replaced by typed placeholders.

A text goes through transducers, each of which keeps for every character of its
output the stretch of source characters it came from: width forms, look-alike
letters and invisible characters; blanks; spelled digits; spelled at and dot.
Identifiers are detected in the normalised text, and their spans mapped back.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloqua.llm.lookalikes import LOOK_ALIKES

KINDS = ("email", "phone", "id_number", "address", "name")
#: Texts whose result a Python worker remembers; beyond it the memory starts anew.
MEMO_TEXTS = 50_000

#: Common Chinese surnames of two characters and of one.
SURNAMES_2 = "欧阳 司马 上官 诸葛 夏侯 东方 皇甫 尉迟 公孙 慕容 司徒 令狐 宇文 长孙 闻人 南宫 西门 东郭 百里 端木 轩辕".split()
SURNAMES_1 = (
    "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾萧田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白"
    "邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤温阮康施文牛樊葛邢安齐伍庞颜倪庄聂章鲁岳翟殷詹申欧耿关兰焦俞左柳甘祝包宁"
)
#: Characters that are common in Chinese given names; where little else tells a name, all of it has to be of these.
GIVEN = (
    "伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂英华玉萍红玲芬燕彩春菊兰凤洁梅琳素云莲雪荣爱妹香月媛瑞凡佳嘉琼勤珍莉岚欣怡婷雅慧颖倩薇梦琪瑶诗涵梓轩浩宇晨辰阳旭俊豪博文泽睿子墨思"
    "远哲翔鹏飞龙斌波辉健峰宁建国志海亮东林森鑫凯帆诚悦然心妍可依语彤若曦恒毅立新胜民永良才发武力光昌庆义兴仁清友保富顺信德世广生福全祥松柏晓紫靖萌璐婧妮娇蕾倪昊宏振少大小春秋冬夏元启家伯仲叔季文"
)
#: Words that begin like a surname with a given name: with whatever follows, and alone.
NOT_NAMES = ("程序", "白天", "江边", "温度", "许多", "陆续", "谢谢", "高兴", "马上", "任何", "方便", "于是", "安全", "文件", "金额", "关于", "何时", "包裹", "向前", "万一", "石头", "钱包", "龙头", "左边", "严重", "毛毯")
NOT_NAMES_ALONE = frozenset((
    "程序 程度 白天 白色 白酒 白菜 白费 江边 江湖 温度 温柔 温暖 温泉 许多 许可 陆续 陆地 谢谢 高兴 高考 高速 高级 高度 马上 马路 马桶 任何 任务 任意 任性 方便 方法 方案 方向 方式 方面 于是 安全 安排 安装 安静 安心 安慰 "
    "文件 文章 文字 文档 文化 文本 金额 金钱 金属 金融 关于 关系 关闭 关心 关注 关键 关机 何时 何必 何况 何处 包裹 包子 包括 包含 包装 向前 向上 向下 向来 向导 万一 万能 石头 石油 钱包 钱财 龙头 龙虾 左边 左右 左手 "
    "严重 严格 严禁 毛毯 毛病 毛巾 毛衣 周末 周一 周二 周三 周四 周五 周六 周日 周年 周围 王者 王子 李子 黄金 黄色 黄瓜 曾经 董事 叶子 苏州 范围 范例 夏天 夏季 付款 付费 付钱 付出 熊猫 段落 雷雨 雷达 史上 "
    "陶瓷 黎明 贺卡 顾客 顾问 顾虑 武器 武术 戴上 戴着 莫非 莫名 孔雀 汤圆 康复 施工 牛奶 牛肉 齐全 庞大 颜色 章节 岳父 岳母 申请 申报 欧元 欧洲 兰花 焦虑 焦点 柳树 甘心 祝福 祝贺 祝你 祝大 宁愿 宁可 胡说 胡子 "
    "孙子 孙女 罗列 田野 张开 张嘴 余额 余下 林子 韩国 韩语 郑重 成功 杜绝 钟头 钟表 唐突 萧条 丁点 贾宝"
).split())
#: Capitalised words that no full name holds.
NOT_NAME_WORDS = frozenset(
    "customer service support team all users user sir madam everyone everybody friend friends colleague colleagues very important urgent the this that our your my his her their new old please "
    "great good best happy dear hello hi thanks thank regards sincerely monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december "
    "street road avenue lane drive square north south east west university college school hospital bank company limited inc ltd gmbh department office manager director group committee board city county state republic united "
    "kingdom states america china germany france spain russia europe asia london paris berlin madrid moscow beijing shanghai microsoft google windows android linux python java machine learning deep language model open source "
    "sehr geehrte geehrter damen herren liebe lieber alle kunden madame monsieur mesdames messieurs cher chère clients estimado estimada señores todos clientes уважаемые друзья коллеги not only just from here there what when".split()
)
#: Endings of file names that look like mail domains.
NOT_DOMAINS = {"png", "jpg", "jpeg", "gif", "webp", "svg", "bmp", "ico", "pdf", "zip", "js", "css", "json", "py"}
_SPELLED = {c: str(i) for i, c in enumerate("零一二三四五六七八九")} | {"〇": "0", "幺": "1", "两": "2"}
_ENGLISH = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}


@functools.lru_cache(maxsize=65536)
def _folded(c: str) -> str:
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c == "\n":
        return c
    if unicodedata.category(c) in ("Cf", "Cc", "Mn", "Me") and c != "\t":
        return ""
    plain = unicodedata.normalize("NFKC", c)
    return " " if plain.isspace() else plain


_AT = re.compile(r" ?[(\[{<] ?(?:at|AT|At|@) ?[)\]}>] ?|(?<=[A-Za-z0-9]) (?:at|AT) (?=[A-Za-z0-9-]+ ?(?:\.|[(\[]?dot))| ?艾特 ?")
_HASH = re.compile(r"(?<=[A-Za-z0-9])#(?=[A-Za-z0-9-]+\.[A-Za-z])")
_DOT = re.compile(r" ?[(\[{<] ?(?:dot|DOT|Dot|\.|点) ?[)\]}>] ?|(?<=[A-Za-z0-9]) (?:dot|DOT) (?=[A-Za-z])")
_BLANKS = re.compile(r"[ \t]{2,}|(?<=[一-鿿])[ \t]+(?=[一-鿿])|\t")
_HAN_DIGITS = re.compile(r"[零〇一幺二两三四五六七八九](?:[ -]?[零〇一幺二两三四五六七八九]){6,}")
_WORD_DIGITS = re.compile(r"\b(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)(?:[ -]+(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)){6,}\b", re.I)


def _spell(m: re.Match) -> str:
    return "".join(_SPELLED.get(c, c) for c in m[0])


def _spell_words(m: re.Match) -> str:
    return "".join(_ENGLISH[w] for w in re.findall(r"[a-z]+", m[0].lower()))


def _blank(m: re.Match) -> str:
    a, b = m.string[m.start() - 1 : m.start()], m.string[m.end() : m.end() + 1]
    return "" if "一" <= a <= "鿿" and "一" <= b <= "鿿" else " "


#: (pattern, replacement, cheap test without which the pattern can't match)
_STEPS = [
    (_BLANKS, _blank, lambda t: " " in t or "\t" in t),
    (_HAN_DIGITS, _spell, lambda t: not t.isascii()),
    (_WORD_DIGITS, _spell_words, lambda t: t.count(" ") + t.count("-") >= 6),
    (_AT, lambda m: "@", lambda t: "at" in t or "AT" in t or "At" in t or "@" in t or "艾特" in t),
    (_HASH, lambda m: "@", lambda t: "#" in t),
    (_DOT, lambda m: ".", lambda t: "dot" in t or "DOT" in t or "Dot" in t or "点" in t or ("." in t and ("(" in t or "[" in t or "{" in t or "<" in t))),
]


@dataclass
class Traced:
    """A text with the source span of each of its characters."""

    text: str
    starts: list[int]
    ends: list[int]

    def replaced(self, pattern: re.Pattern, to) -> Traced:
        out, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = to(m)
            a, b = m.span()
            out += [self.text[at:a], new]
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            if len(new) == b - a:
                starts += self.starts[a:b]
                ends += self.ends[a:b]
            else:
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            at = b
        if not at:
            return self
        out.append(self.text[at:])
        return Traced("".join(out), starts + self.starts[at:], ends + self.ends[at:])


def transduce(source: str) -> Traced:
    """The normalised text with its trace."""
    chars, starts, ends = [], [], []
    for i, c in enumerate(source):
        for x in c if c.isascii() and c != "\t" else _folded(c):
            chars.append(x)
            starts.append(i)
            ends.append(i + 1)
    traced = Traced("".join(chars), starts, ends)
    for pattern, to, needs in _STEPS:
        if needs(traced.text):
            traced = traced.replaced(pattern, to)
    return traced


def normalised(source: str) -> str:
    """The text of :func:`transduce`, without the trace."""
    text = source if source.isascii() else "".join([c if c.isascii() else _folded(c) for c in source])
    for pattern, to, needs in _STEPS:
        if needs(text):
            text = pattern.sub(to, text)
    return text


_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]* ?@ ?((?:[A-Za-z0-9-]+\.)+([A-Za-z]{2,}))(?![A-Za-z0-9-])")
_CN_ID = re.compile(r"(?<![0-9A-Za-z])([1-9]\d{5})([ -]?)((?:19|20)\d{6})\2(\d{3}[\dXx])(?![0-9A-Za-z])")
_SOCIAL = re.compile(r"(?<![0-9A-Za-z+.-])\d{3}([ -])\d{2}\1\d{4}(?![0-9A-Za-z])(?![ -]\d)")
_INSURANCE = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}( ?)\d{2}\1\d{2}\1\d{2}\1[A-D](?![0-9A-Za-z])", re.I)
_PHONE = re.compile(
    r"(?<![0-9A-Za-z.+-])(?:"
    r"(?:\(?(?:\+|00)86\)?[ -]?)?1[3-9]\d[ -]?\d{4}[ -]?\d{4}"  # mainland mobile
    r"|(?:\(?(?:\+|00)86\)?[ -]?)?\(?0[1-9]\d{1,2}\)?[ -]\d{7,8}"  # mainland landline
    r"|(?:\+?1[ .-]?)?\([2-9]\d{2}\) ?[2-9]\d{2}[ .-]?\d{4}"  # North America
    r"|(?:\+?1[ .-])?[2-9]\d{2}[ .-][2-9]\d{2}[ .-]\d{4}"
    r"|\+?1[2-9]\d{2}[2-9]\d{6}"
    r"|(?:\+44|0044)[ -]?(?:\(0\)[ -]?)?[1-9]\d{1,4}(?:[ -]?\d{3,4}){1,2}"  # United Kingdom
    r"|0(?:20[ -]?\d{4}[ -]?\d{4}|7\d{3}[ -]?\d{6}|7\d{3}[ -]?\d{3}[ -]?\d{3}|1\d{3}[ -]\d{5,6})"
    r"|\+(?!1|44|86)[1-9]\d{0,2}(?:[ .-]?\d{2,4}){2,5}"  # elsewhere
    r")(?![0-9A-Za-z])(?![ .-]\d)"
)
#: As many digits as the shortest of the patterns above has, of any script, as ``\d`` takes them.
_DIGITS_CUE = re.compile(r"(?:\d\D*){4}\d")
_STREET_ZH = re.compile(
    r"[一-鿿]{2,12}(?:大道|路|街|巷|胡同|弄|里|道)(?:\d{1,5}|[一二三四五六七八九十百零]{1,5})(?:号|弄)"
    r"(?:[\d一二三四五六七八九十-]{0,5}(?:号院?|院|栋|幢|座|单元|室|楼|层)){0,4}\d{0,5}"
)
_STREET_EN = re.compile(
    r"(?<![0-9A-Za-z])(?:(?:Flat|Apt|Unit|Suite) \w{1,5}, )?\d{1,5}[A-Z]? (?:[A-Za-z']+ ){1,3}"
    r"(?:Street|St|Lane|Ln|Avenue|Ave|Road|Rd|Boulevard|Blvd|Drive|Dr|Way|Court|Ct|Square|Terrace|Crescent|Close|Row|Place|Hill)\b\.?"
    r"(?:, (?:Flat|Apt|Unit|Suite) \w{1,5})?(?:, [A-Z][a-z]+(?: [A-Z][a-z]+)?(?=[ ,\n]|$))?",
    re.I,
)
#: A number with a letter before it, or a word after it.
_HOUSE_CUE = re.compile(r"[^\W\d_]\.?,? ?(?:[^\W\d_]{1,4}\.? ?)?\d|\d(?: ?(?:bis|ter))?,? [^\W\d_]", re.I)
_STREET_CUE = re.compile(r"\d[A-Z]? [A-Z']", re.I)
_UP = "[A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĖĘĚĞĪİŁŃŇŌŐŘŚŞŠŤŪŮŰŹŻŽА-ЯЁІЇЄ]"
_LOW = "[A-Za-zÀ-ÖØ-öø-ÿĀ-žА-яЁёІіЇїЄє]"


def _as_folded(text: str) -> str:
    """A pattern's letters as :func:`transduce` leaves them, with look-alikes as Latin ones; ranges of letters stay."""
    return "".join(part if part.startswith("[") else "".join(LOOK_ALIKES.get(c, c) for c in part) for part in re.split(r"(\[[^\]]*\])", text))


_STREETS = [
    # German: the kind of street ends its name, or stands behind it.
    re.compile(rf"(?<![\w-])(?:{_UP}{_LOW}+[ -]){{0,3}}(?:{_UP}{_LOW}+(?:straße|strasse|str\.|weg|platz|allee|gasse|ring|ufer|damm)|(?<=[ -])(?:Straße|Strasse|Str\.|Weg|Platz|Allee|Gasse|Ring|Ufer|Damm)) ?"
               rf"\d{{1,4}} ?[a-z]?(?![\w])(?:, (?:\d{{5}} )?{_UP}{_LOW}+)?"),
    # French: number, kind, name, which begins with an article or a capital.
    re.compile(rf"(?<![\w.-])\d{{1,4}}(?: ?(?:bis|ter))?,? (?i:rue|avenue|av\.|boulevard|bd|place|chemin|allée|impasse|quai|cours|route|square) (?:(?:de la|de l['’]|du|des|de|d['’]|la|le) ?{_LOW}|{_UP})(?:{_LOW}|['’-])*"
               rf"(?: (?:(?:de|du|des|la|le) )?{_UP}(?:{_LOW}|['’-])+){{0,3}}(?:, (?:\d{{5}} )?{_UP}{_LOW}+)?"),
    # Spanish: kind, name, number.
    re.compile(rf"(?<![\w])(?:calle|c/|avenida|avda\.?|av\.|plaza|paseo|camino|ronda|carrera) ?(?:(?:de la|de los|de las|del|de|la|el) )?(?:{_LOW}|['’-])+(?: (?:(?:de|del|la|y) ){{0,2}}(?:{_LOW}|['’-])+){{0,3}},? ?(?:n[ºo°.]+ ?|núm\.? ?)?\d{{1,4}}(?![\w])"
               rf"(?:, (?:\d{{5}} )?{_UP}{_LOW}+)?", re.I),
    # Russian: kind, name, house; or a name and the kind behind it.
    re.compile(_as_folded(rf"(?<![\w])(?:(?:ул\.?|улица|улице|проспект|проспекте|просп\.|пр-т|пр\.|переулок|пер\.|площадь|пл\.|шоссе|бульвар|набережная|наб\.) ?{_UP}(?:{_LOW}|-)+(?: {_UP}(?:{_LOW}|-)+){{0,2}}"
               rf"|{_UP}(?:{_LOW}|-)+(?:ий|ый|ая|ой) (?:проспект|переулок|улица|площадь|бульвар|шоссе)),? ?(?:дом|д\.)? ?\d{{1,4}}(?:/\d{{1,3}})?(?![\d])(?:,? ?(?:кв\.|квартира|корп\.|к\.) ?\d{{1,4}}){{0,2}}"), re.I),
]
_ZN = rf"(?:(?:{'|'.join(SURNAMES_2)})[一-鿿]{{1,2}}|(?!{'|'.join(NOT_NAMES)})[{SURNAMES_1}][一-鿿]{{1,2}})"
#: A name all of whose given name is common in names.
_ZG = rf"(?:(?:{'|'.join(SURNAMES_2)})[{GIVEN}]{{1,2}}|(?!{'|'.join(NOT_NAMES)})[{SURNAMES_1}][{GIVEN}]{{1,2}})"
_EN = rf"{_UP}(?:{_LOW}|['’])+(?:(?:[ -]|(?: (?:de|del|de la|van|von|van der|von der|da|di|dos|bin|al|el|ben) ))(?!(?:{'|'.join(('de', 'von', 'van'))})\b){_UP}(?:{_LOW}|['’])+){{1,3}}"
_N = rf"(?P<n>{_ZN}|{_EN})"
_END = r"(?= at the| speaking| here| from | / |[ ,.;:，。、；!！?？)）\n]|$)"
_OPEN = r"(?:^|(?<=[\s，。！？、；：,.!?;:“”\"'（(]))"
_NAMES = [
    re.compile(rf"(?:我叫|我的名字是|名字叫|名叫|联系人(?:是|写|填)?[::]? ?|收件人?(?:是|写|填)?[::]? ?|寄件人[::]? ?|姓名[::]? ?|交给|转交|转告){_N}"),
    re.compile(rf"(?<![A-Za-z])(?:(?i:my name is|name is|name's|this is|ask for|name ?:|attn:?|attention:?|recipient ?:|contact ?:|dear|call me) )(?P<n>{_ZN}|{_EN}){_END}"),
    re.compile(r"(?<![A-Za-z])(?i:name ?:) ?" + _N),
    re.compile(rf"(?<![一-鿿])(?P<n>{_ZN})(?=明天|今天|后天|今晚|也来|先生|女士|小姐)"),
    re.compile(rf"(?<![A-Za-z])(?P<n>{_EN})(?=明天|今天|后天|今晚|也来|先生|女士|小姐)"),
    re.compile(rf"(?<![A-Za-z一-鿿])(?P<n>{_ZN}|{_EN})(?= (?i:will join|is speaking|speaking\b))"),
    re.compile(rf"(?<![A-Za-z一-鿿])(?P<n>{_ZN}|{_EN})(?=, (?i:(?:flat|apt|unit|suite) \w+, |\d{{1,5}} [a-z]))"),
    # Introductions, signatures and titles, by language.
    re.compile(rf"(?:我是|他是|她是|这是|这位是|叫做|认识|找|联系|问问|问一下|通知|告诉|@|来自|对方是|法人|患者|客户|同事|室友|老师|同学|朋友|给|和|跟|与)(?P<n>{_ZG})(?=[ ,.;，。、；！!？?\n：:（(]|的|吗|吧|说|就|来|去|在|$)"),
    re.compile(rf"{_OPEN}(?P<n>{_ZG})(?=说|讲|问|告诉|表示|觉得|认为|来了|来不|不来|到了|没到|走了|去了|在家|在吗|在哪|请假|生病|结婚|住在|住|的电话|的手机|的地址|的微信|的邮箱|的生日|的身份|的简历|和|跟|与|给我|约我|发来|同学|老师|医生|律师|经理|教授|师傅|已经|昨天|刚才|刚刚|上周|下周|明早|明晚)"),
    re.compile(rf"(?<![A-Za-z])(?i:(?:best|kind|warm|many)?,? ?(?:regards|wishes)|sincerely|yours(?: truly| faithfully)?|cheers|many thanks|thanks|signed|sent by|written by|from|to|by|with|cc)[,:]?\s(?P<n>{_EN})(?=\s*(?:$|\n|[,.;!?]))"),
    re.compile(rf"(?<![A-Za-z])(?i:i am|i'm|i’m|we met|met|meet|met with|spoke to|spoke with|talked to|talk to|contact|call|email|ask|tell|told|thank|patient|client|tenant|mr|mrs|ms|miss|dr|prof)\.? (?P<n>{_EN})(?=[ ,.;:!?)\n]|'s|’s|$)"),
    re.compile(rf"(?<!\w)(?P<n>{_EN})(?=(?:'s|’s) (?i:phone|number|email|address|birthday|house|flat|passport|account)| (?i:said|says|told|asked|called|wrote|writes|emailed|replied|phoned|lives|lived|works|worked|can't|cannot|won't|will|joined|left|signed|moved|arrived|is (?:coming|late|here|sick|my|our|the)|has|was))"),
    re.compile(rf"(?<!\w)(?i:ich hei(?:ß|ss)e|ich bin|mein name ist|hei(?:ß|ss)t|herrn?|frau|grü(?:ß|ss)en?,?|gru(?:ß|ss),?|ihre?|deine?|je m['’]appelle|je suis|mon nom est|s['’]appelle|monsieur|madame|m\.|mme|cordialement,?|me llamo|mi nombre es|se llama|soy|señora?|sra?\.|saludos,?|atentamente,?)\s(?P<n>{_EN})(?=[ ,.;:!?)\n]|$)"),
    re.compile(rf"(?<!\w)(?i:{_as_folded('меня зовут|моё имя|мое имя|его зовут|её зовут|ее зовут|зовут|господин|госпожа|с уважением,?|я —|пациент|клиент')})\s(?P<n>{_EN})(?=[ ,.;:!?)\n]|$)"),
]
#: What all of the patterns above hold.
_NAME_CUE = re.compile(rf"[{SURNAMES_1}][一-鿿]|{'|'.join(SURNAMES_2)}|{_UP}(?:{_LOW}|['’])+[ -]")
_AROUND_EN = re.compile(r"^(?:[Tt]his [Ii]s|[Aa]sk [Ff]or|[Mm]y [Nn]ame [Ii]s|THIS IS|ASK FOR|MY NAME IS) ")


def _real_date(digits: str) -> bool:
    try:
        dt.date(int(digits[:4]), int(digits[4:6]), int(digits[6:8]))
    except ValueError:
        return False
    return True


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in a normalised text, without overlaps between identifiers."""
    found: list[tuple[str, int, int]] = []

    def add(kind: str, a: int, b: int) -> None:
        if all(b <= x or a >= y for _, x, y in found):
            found.append((kind, a, b))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            if m[2].lower() not in NOT_DOMAINS:
                add("email", *m.span())
    if _DIGITS_CUE.search(text):
        for m in _CN_ID.finditer(text):
            if _real_date(m[3]):
                add("id_number", *m.span())
        for pattern, kind in ((_SOCIAL, "id_number"), (_INSURANCE, "id_number"), (_PHONE, "phone")):
            for m in pattern.finditer(text):
                add(kind, *m.span())
    if "号" in text or "弄" in text:
        for m in _STREET_ZH.finditer(text):
            add("address", *m.span())
    if _STREET_CUE.search(text):
        for m in _STREET_EN.finditer(text):
            add("address", *m.span())
    if _HOUSE_CUE.search(text):
        for pattern in _STREETS:
            for m in pattern.finditer(text):
                add("address", *m.span())
    if _NAME_CUE.search(text):
        for pattern in _NAMES:
            for m in pattern.finditer(text):
                a, b = m.span("n")
                if lead := _AROUND_EN.match(text[a:b]):
                    a += lead.end()
                    if " " not in text[a:b]:
                        continue
                if text[a:b] in NOT_NAMES_ALONE or not NOT_NAME_WORDS.isdisjoint(re.split(r"[ -]", text[a:b].lower())):
                    continue
                add("name", a, b)
    return sorted(found, key=lambda f: f[1])


def find_spans(source: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of personal data in the source text's own characters."""
    if not detect(normalised(source)):
        return []
    traced = transduce(source)
    return [(kind, traced.starts[a], traced.ends[b - 1]) for kind, a, b in detect(traced.text)]


_MEMO: dict[str, list[tuple[str, int, int]]] = {}


def remembered_spans(source: str | None) -> list[tuple[str, int, int]]:
    if not source:
        return []
    spans = _MEMO.get(source)
    if spans is None:
        if len(_MEMO) >= MEMO_TEXTS:
            _MEMO.clear()
        spans = find_spans(source)
        if len(source) < 2000:
            _MEMO[source] = spans
    return spans


def mask(source: str | None) -> str | None:
    """The text with a placeholder like ``[EMAIL]`` for each span; the rest as it is."""
    if source is None:
        return None
    out, at = [], 0
    for kind, a, b in remembered_spans(source):
        out += [source[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + source[at:]


def find_personal_data(df: DataFrame, key: str, text: str) -> DataFrame:
    """``row_key, kind, start, end`` of each personal datum; offsets count source code points.

    Null, empty and blank texts give nothing; very long texts are searched whole;
    repeated rows are reported each. Empty tables give an empty result; other
    columns are ignored.

    Plan: one pass in Arrow batches without a shuffle; only found spans come out
    of Python. Equal texts met by a worker are searched once.
    """
    kind = df.schema[key].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rest = [], []
            for i, source in enumerate(batch.column(1).to_pylist()):
                for span in remembered_spans(source):
                    at.append(i)
                    rest.append(span)
            kinds, starts, ends = zip(*rest) if rest else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, type=pa.int64())), pa.array(kinds, type=pa.string()),
                 pa.array(starts, type=pa.int32()), pa.array(ends, type=pa.int32())],
                names=["row_key", "kind", "start", "end"],
            )

    found = df.where(F.col(text).isNotNull()).select(key, text)
    return found.mapInArrow(step, f"row_key {kind}, kind string, start int, end int")


def masked(text: Column) -> Column:
    """The text with typed placeholders for its personal data; null stays null."""

    @F.pandas_udf("string")
    def mask_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([mask(t) for t in texts.tolist()], dtype=object)

    return mask_batches(text)
