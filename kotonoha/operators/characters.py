"""Fictional characters and their actors, from the lists of casts in articles.

A cast section is read in one of several layouts: headings with notes below, definition lists, tables, one-liners. Each
layout is scored by how many entries it would give, the best one is parsed (of equals the first), and each entry's lines
are cut into words that fill a record: name, reading, up to three actors.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column

from ..functions import wikitext as w
from ..functions.charclass import HIRAGANA, KATAKANA, SPACE, TRIM, has, only
from .readings import find_reading

# ---- Fixed values: words of cast lists.
ACTOR_MARKS = frozenset((
    "声", "声優", "CV", "-", "キャスティングボイス", "CV キャスティングボイス", "日本語吹替", "吹替", "日本語吹替版", "吹替版", "日本語吹き替え", "日本語吹替え",
    "日本語版吹替=", "吹き替え", "日本語版", "日本語", "原語・日本語版", "日本語版声優", "声・", "英語", "英", "英語版", "日本語・英語共に", "日本版", "日", "香港版", "香",
    "台湾版", "台", "インターナショナル版", "演", "俳優", "声・操演", "操演",
))
NO_ACTORS = frozenset(("主人公", "本人役", "二役", "三役", "四役", "モーションアクター"))
FORMER = frozenset(("元", "当時"))
STOP_WORDS = frozenset(("作詞", "原作", "原画", "脚本", "音楽", "照明", "製作", "エグゼクティブプロデューサー", "プロデューサー", "ディレクター", "スタイリスト"))
STOP_PARTS = ("。", "これも", "これらは", "オープニング", "エンディング", "することにより", "関連項目", "キャラクターデザイン", "製作プロダクション", "プロモーションビデオ")
CAST_HEADINGS = ("登場人物", "主要登場人物", "主要人物", "登場キャラクター", "主な登場人物", "主な人物", "主なキャラクター", "主要キャラクター")
CAST_TITLES = ("の登場人物", "のキャラクター", "の登場キャラクター", "オリジナルキャラクター")
CAST_CATEGORIES = (
    "アニメの登場人物の一覧", "漫画の登場人物の一覧", "テレビドラマの登場人物の一覧", "登場キャラクターの一覧", "ライトノベルの登場人物の一覧", "文学の登場人物の一覧",
    "ゲームの登場人物の一覧", "映画の登場人物の一覧",
)
PERSON_NEEDS = (("架空の人物", "架空のキャラクター"), ("登場する[[", "登場する架空の", "登場人物。", "登場人物・"))
PERSON_FORBIDS = (
    "存命人物]]", "Infobox 漫画家", "SF漫画家", "市町村", "同人誌即売会", "学校記事", "短編小説", "女性を指す俗語", "男性を指す俗語", "人名の曖昧さ回避",
    "スコットランドヤード", "{{Infobox Film", "映画作品", "西遊記の成立史", "歴史上の人物", "架空の学校", "架空の病院", "架空の建物", "架空の企業", "架空の建築物", "架空の道具",
)
SECTIONS_LEFT_OUT = (
    "凡例", "ゲスト", "脚注", "参考資料", "関連項目", "参考資料", "オープニング", "エンディング", "主題歌", "テーマ曲", "関連項目", "キャラクターデザイン", "解説", "あらすじ",
    "スタッフ", "音楽", "スピンオフ短編", "短編", "スピンオフ", "脚注・出典", "脚注", "出典", "ストーリー", "概要", "主なスタッフ", "開発スタッフ",
)
PAGES_LEFT_OUT = ("BB戦士三国伝", "少林サッカー")
#: Pages whose layout is known: a pattern of the title and the layout's name; the first that fits counts.
KNOWN_LAYOUTS = (("^ギャラクシーエンジェルの登場人物$", "later3"), ("^風来のシレンのキャラクター一覧$", "definition"))
LATER_ACTORS = ("声]]：", "声：", "声優]]：", "声優：", "演：", "声]]:", "声:", "声優]]:", "声優:", "演:")
# Tokens that are no names: as a whole, by their beginning, by a part.
NO_NAMES = frozenset((
    "lang", "en", "本名", "なし", "無し", "夫", "妻", "父", "母", "現", "DS", "PSP", "ー", "歌", "PC", "では", "匠", "新", "反", "奪", "黄", "我", "千", "朝", "汚", "白", "蝶", "女", "男",
    "連続", "単発", "アニメ", "テレビ", "以降不定期", "不明", "概要", "概歴", "劇中", "解決編", "幼少期", "幼年期", "少年期", "少女期", "少年時", "少女時", "青年期", "青年時",
    "若年期", "壮年期", "変装時", "少年", "少女", "幼馴染", "幼少", "老年", "TVアニメ", "テレビアニメ", "ラジオドラマ", "CDドラマ", "ドラマCD", "OVA", "ファンディスク",
    "まんがDVD", "ゲーム", "実写", "Webアニメ", "※", "出版社", "回想", "？", "?", "仮の姿", "真の姿", "同左", "VOMIC", "Age", "成長後", "♂", "♀", "TVSP", "小学", "中学", "高校", "大学",
    "の娘で", "過去", "OAD", "サンデーCM劇場", "次回予告", "誕生日", "血液型", "O型", "A型", "B型", "AB型", "子供の", "ジョジョの奇妙な冒険", "堪能で", "若い頃", "・", "じじい", "変身前",
    "通常時", "電撃文庫", "クリーム", "ショコラ", "特番", "スーパー", "総集編", "2人", "CD", "カメオ出演", "友情出演", "ゲスト", "ゲスト出演", "クレジットタイトル", "明記なし",
    "イメージアルバム", "身長", "体重", "スリーサイズ", "初代", "後述", "無印", "放送開始", "がいるほか", "モノローグ", "幼年時", "幼い", "ヒーローズファンタジア", "本編", "が出現",
    "騒動となった", "初期の", "両者とも", "子供", "子役", "大人", "現代", "アーカイブ", "スペシャルアニメ", "プロサッカー選手", "パチスロ", "アダルト", "ナレーションも", "スペシャル",
    "兄役", "コロちゃん役", "世界大会編", "息子", "土曜ワイド劇場", "クレジットなし", "ラジオ", "女 不明", "男 不明", "シーズン", "効果音", "DC PS", "PS DC", "子犬", "PCゲーム", "原作漫画",
    "原作第", "原作と", "原作系", "知り合い", "ノベル", "コミック", "原作版設定", "美女", "多数の声優が担当", "ドラマCDのみボイスあり", "全国編", "アニメ第一作", "アニメ第ニ作",
    "アニメ第三作", "アニメ第四作", "ディレクターズカット", "外伝", "全作品", "FC", "SFC", "GB", "GB1", "GB2", "GBA", "N64", "Wii", "妖精", "貴族", "職人", "パチンコ", "先生", "主人公",
    "前作主人公", "王子", "謎の男", "黄色", "イメージカラー", "所属クラス", "Aクラス", "趣味", "正式名", "総督", "調査官", "地方検事", "刑事", "地方検事補", "警部補", "名称不明", "通称",
    "上司", "部下", "元彼女", "blackops", "暴力", "IRQ", "KOR", "AUS", "USA", "GBR", "NGB", "TMS",
    "パイロット版", "映画版", "赤子時代", "幼少時代", "子供時代", "少年時代", "少女時代", "小学時代", "中校時代", "高校時代", "大学時代", "学生時代", "小学生時代", "中学生時代", "高学生時代",
    "大学生時代", "幼少期のみ", "登場時のみ", "テレビ版", "アニメ版", "牡羊座", "牡牛座", "双子座", "蟹座", "獅子座", "乙女座", "天秤座", "蠍座", "射手座", "山羊座", "水瓶座", "魚座",
    "コンシューマ版", "オリジナル版", "TV版", "DVD版", "SS版", "ミュージカル版", "BOX版", "イベント版", "声優版", "リマスター版", "原作のみ", "原作版", "PC版", "OVAのみ", "ラブラブおもちゃ箱のみ",
    "とらハ2OVAのみ", "ドラマCDのみ", "テレビアニメのみ", "※ドラマCDと2のみ", "ドラマCD版", "PSPゲーム版のみ", "SHINY版のみ", "アニメ版のみ", "エピローグのみ", "実写映画版", "パチンコ版", "BeeTV版",
))
NO_NAME_STARTS = (
    "原作では", "原作と", "現・", "過去の", "Ver.", "と同棲", "大尉の", "が好き", "が怒り", "声優さん", "予見されて", "漫画版のみ", "DVD EDITION", "に置き換えられた", "原作第五期",
    "原作第四期", "原作第三期", "原作第ニ期", "登場するが", "テレビアニメ第", "無印", "一部ルートのみ", "NEW VISIONの", "戦闘中のみ", "外伝以外",
)
NO_NAME_PARTS = (
    "【", "】", "「", "」", "〈", "〉", "〔", "〕", "『", "』", "シリーズ", "シーズン", "エピソード", "台詞なし", "ボイスなし", "登場せず", "未公表", "だった", "名前のみ",
    "おまけシナリオ", "登場人物", "登場作品", "劇場版", "新II", "植物図鑑", "動物図鑑", "マンガ版", "兼任", "役として", "ワールド映画", "デスクトップアクセサリ", "スマッシュブラザーズ",
    "代役", "キャストは未公開", "スーパーロボット", "上映版", "厳密には", "表記なし", "分割提案", "機械化人", "いくなど", "テレビ版", "CM版", "称されていない", "知り合いで",
    "と恋人騒動があった", "長髪が特徴的な", "アダルト",
)
# ---- End of fixed values.

_SEPARATOR = re.compile("[()（），,；;、\\-：:/／⇒→\\[{]")
#: Numbered episodes, volumes, years and the like: a number at the start, perhaps behind a counter or a medium.
_NUMBERED = re.compile("第?(?:TV)?(?:SP)?(?:DS)?(?:PS)?(?:MGS)?(?:S\\.)?[0-9.０-９．]")
_MARKS = re.compile(r"\[|\]|'''?|\{\{|\}\}|==")


@dataclass
class Character:
    reading: str = ""
    name: str = ""
    actors: tuple[str, ...] = ()

    def as_row(self) -> dict[str, str]:
        padded = (*self.actors, "", "", "")
        return {"reading": self.reading, "name": self.name, "actor1": padded[0], "actor2": padded[1], "actor3": padded[2]}


def stops(word: str) -> bool:
    return word in STOP_WORDS or any(p in word for p in STOP_PARTS)


def no_word(word: str, noise: frozenset[str] = frozenset()) -> bool:
    """Whether a token is left out: noise by rule or by the given list, or a stop word."""
    return bool(word) and (
        "#" in word or stops(word) or (len(word) == 1 and not has(word, "kanji")) or word in NO_NAMES or word in noise
        or word.startswith(NO_NAME_STARTS) or any(p in word for p in NO_NAME_PARTS) or _NUMBERED.match(word) is not None
    )


def tokens(line: str, first: bool) -> list[str]:
    """Words of a line; a link keeps a ``[`` in front on an entry's first line. A stop word ends the line."""
    out: list[str] = []
    start = pos = 0
    while pos < len(line):
        m = _SEPARATOR.search(line, pos)
        if not m:
            break
        at, mark = m.start(), m[0]
        pos = at + 1
        if mark == "-" and not (0 < at < len(line) - 1 and line[at - 1] in SPACE and line[at + 1] in SPACE):
            continue
        word = _MARKS.sub("", line[start:at]).strip(TRIM)
        if stops(word):
            return out
        if word and not no_word(word):
            out += [word] + ["-"] * (first and mark == "-")
        if line.startswith(("[[", "{{"), at):
            close = line.find("]]" if mark == "[" else "}}", at + 2)
            if close < 0:
                return out
            inside = line[at + 2 : close]
            if mark == "[":
                inside = inside.split(":", 2)[-1].split("(", 1)[0].split("|", 1)[0]
                if not no_word(inside):
                    plain = inside in ACTOR_MARKS or inside in NO_ACTORS or not first or line.startswith("。", close + 2)
                    out.append(("" if plain else "[") + inside.strip(TRIM))
            else:
                pieces = inside.split("|")
                longest = max(pieces[1:], key=len) if len(pieces) > 1 else inside
                if not no_word(longest):
                    out += tokens(longest, False)
            # The character behind the closing mark is skipped as well.
            pos = close + 3
        start = pos
    word = _MARKS.sub("", line[start:]).strip(TRIM)
    return out + [word] * bool(word and not no_word(word))


def _fold(letter: str) -> str:
    return chr(ord(letter) - 0x60) if "ァ" <= letter <= "ヶ" else letter


def agrees(name: str, reading: str) -> bool:
    """Whether name and reading begin alike, or else end alike, as far as the name's letter there is kana. Middle dots and blanks do not count."""
    name, reading = w.plain_reading(name), w.plain_reading(reading)
    if not name or not reading:
        return bool(reading)
    kana = re.compile(f"[{HIRAGANA}{KATAKANA}]")
    for at in (0, -1):
        if kana.match(name[at]):
            return not kana.match(reading[at]) or _fold(name[at]) == _fold(reading[at])
    return True


def _sounds(word: str) -> bool:
    """In kana, or kana with Latin letters."""
    return only(word, "kana_name") or (re.fullmatch(f"[A-Za-z0-9{HIRAGANA}{KATAKANA}{SPACE}_.・＝=]+", word) is not None and re.search(f"[{HIRAGANA}{KATAKANA}]", word) is not None)


def _best_reading(words: list[str], at: int, name: str) -> bool:
    """Whether no later candidate before an actor mark is more than two characters longer."""
    for word in words[at + 1 :]:
        if word in ACTOR_MARKS:
            return True
        if word == "読み":
            return False
        if len(word) > len(words[at]) + 2 and word[0] != "[" and agrees(name, word) and only(word, "kana_name"):
            return False
    return True


def _fill(c: Character, words: list[str], first: bool) -> None:
    at = 0
    while at < len(words):
        word, plain = words[at], words[at].removeprefix("[")
        at += 1
        if word in ACTOR_MARKS:
            rest = iter(words[at:])
            for actor in rest:
                if actor in ACTOR_MARKS or actor in NO_ACTORS:
                    actor = next(rest, "")
                if actor in FORMER:
                    next(rest, "")
                    actor = next(rest, "")
                actor = actor.removeprefix("[")
                if actor and actor not in c.actors and len(c.actors) < 3:
                    c.actors += (actor,)
            return
        if word == "読み":
            at += at < len(words) and words[at] == "-"
            if at < len(words):
                if agrees(c.name, words[at]) and _sounds(words[at]):
                    c.reading = words[at].translate(dict.fromkeys(map(ord, " 　")))
                at += 1
            continue
        if first and not c.reading and len(word) >= 2 and word[0] != "[" and agrees(c.name, word) and _sounds(word):
            if _best_reading(words, at - 1, c.name):
                c.reading = word.translate(dict.fromkeys(map(ord, " 　")))
            continue
        if not c.name and len(word) >= 2 and (only(plain, "kanji_space") or only(plain, "kana_kanji") or only(plain, "alnum") or (not c.reading and _sounds(plain))):
            c.name = plain.translate(dict.fromkeys(map(ord, " 　")))
        elif not c.actors and word[0] == "[":
            c.actors = (plain,)


def record(top: str, notes: tuple[str, ...] = (), heading: bool = False) -> Character | None:
    """The character of an entry: its first line and up to three lines below. None without a name."""
    c = Character()
    for number, line in enumerate((top.replace("]] - [[", "]]、演:[["), *notes[:3])):
        _fill(c, tokens(line, number == 0 or (heading and number == 1)), number == 0 or (heading and number == 1))
        if c.reading:
            c.name, c.reading = c.name or c.reading, w.plain_reading(c.reading)
        elif c.name and only(c.name, "kana_name"):
            c.reading = w.plain_reading(c.name)
    if not c.name:
        return None
    if c.reading and not agrees(c.name, c.reading):
        c.reading = ""
    return c


# ---------------------------------------------------------------- layouts: entries as (first line, lines below)

Entry = tuple[str, tuple[str, ...]]


def _notes(lines: list[str], at: int, marks: str) -> tuple[str, ...]:
    out = []
    for line in lines[at : at + 3]:
        if not line.startswith(tuple(marks)):
            break
        out.append(line[1:])
    return tuple(out)


def headings(lines: list[str], level: int) -> Iterator[Entry]:
    """Headings of a level with ``:`` or ``*`` lines below; not those whose first note is a lone link."""
    mark = "=" * level
    for at, line in enumerate(lines):
        notes = _notes(lines, at + 1, ":*")
        if line.startswith(mark) and line[level : level + 1] != "=" and notes and not re.fullmatch(f"[{SPACE}]?\\[\\[.*\\]\\][{SPACE}]?", notes[0]):
            yield line[level:].strip(" 　\n="), notes


def later_actors(lines: list[str], level: int) -> Iterator[Entry]:
    """Headings of a level with a reading below them, then prose in which some later line names the actor.

    A heading waits for its actor's line; the next heading of any level ends the wait, and the one that waited is dropped.
    Lines are whole lines, blank ones do not count.
    """
    heading = re.compile(f"={{{level}}}(?!=)")
    waiting: Entry | None = None
    for at, line in enumerate(lines):
        if line.startswith("="):
            below = lines[at + 1] if at + 1 < len(lines) else ""
            reading = below[1:] if below[:1] and below[0] in SPACE else below
            fits = heading.match(line) and below and not below.startswith((":", "*", ";", "=")) and reading and not re.fullmatch(f"\\[\\[.*\\]\\][{SPACE}]?", reading)
            waiting = (line[level:].strip(" 　\n="), (reading,)) if fits else None
        elif waiting and lines[at - 1][:1] != "=" and any(mark in line for mark in LATER_ACTORS):
            yield waiting[0], (*waiting[1], line)
            waiting = None


def definitions(lines: list[str]) -> Iterator[Entry]:
    """``;name`` with ``:`` lines or a template below."""
    for at, line in enumerate(lines):
        below = lines[at + 1] if at + 1 < len(lines) else ""
        if line.startswith(";") and below.startswith((":", "{{")):
            notes = _notes(lines, at + 2, ":")
            yield line[1:], (below[1:].removeprefix("*"), *notes)


def followed(lines: list[str], mark: str) -> Iterator[Entry]:
    """``;name`` with a plain line below (no mark), or with lines below that start with the mark."""
    for at, line in enumerate(lines):
        below = lines[at + 1] if at + 1 < len(lines) else ""
        if not line.startswith(";") or (mark and line.startswith(mark)):
            continue
        if mark and below.startswith(mark):
            notes = [x.removeprefix(mark) for x in lines[at + 1 : at + 4]]
            yield line[1:], tuple(notes[: next((i for i, x in enumerate(lines[at + 1 : at + 4]) if not x.startswith(mark)), 3)])
        elif not mark and below and below[0] not in ";:*=|{#":
            yield line[1:], (below,)


def bullets(lines: list[str]) -> Iterator[Entry]:
    """``*`` one-liners under a heading, without sentences."""
    if lines and lines[0].startswith("=="):
        for line in lines:
            if line.startswith("*") and not line.startswith("**") and "。" not in line:
                yield line[1:], ()


def terms(lines: list[str]) -> Iterator[Entry]:
    """``;`` one-liners, cut at the first colon or stop."""
    for line in lines:
        name = re.split("[:：。]", line[1:], maxsplit=1)[0]
        if line.startswith(";") and name.strip(TRIM):
            yield name, ()


def rows(lines: list[str]) -> Iterator[Entry]:
    """Rows of a wikitable: cells of a line become words. A lone cell with attributes is a divider."""
    if any("wikitable" in line for line in lines):
        start = next(i for i, line in enumerate(lines) if "wikitable" in line)
        for line in lines[start + 1 :]:
            if line.startswith("|") and not line.startswith(("|-", "|}")) and not re.fullmatch(r"\|[^|=]*=[^|]*\|[^|\[]*", line):
                yield line[1:].replace("||", " "), ()


def _titled(entries: Iterator[Entry]) -> Iterator[Entry]:
    return ((top, notes) for top, notes in entries if "キャラクター" not in top and "人物" not in top)


LAYOUTS: tuple[tuple[str, Callable[[list[str]], Iterator[Entry]], bool], ...] = (
    *[(f"heading{n}", lambda lines, n=n: headings(lines, n), True) for n in (2, 3, 4, 5)],
    ("definition", definitions, False), ("table", rows, False), ("bullet", bullets, False),
    ("followed", lambda lines: followed(lines, ""), False), ("continued", lambda lines: followed(lines, ";:"), False), ("term", terms, False),
)
#: Layouts that only pages known to have them are given; headings that name the cast are no characters there.
ASKED_FOR = tuple((f"later{n}", lambda lines, n=n: _titled(later_actors(lines, n)), True) for n in (2, 3, 4, 5))


def parse_cast(title: str, text: str, *, raw_tags: bool = False, known: tuple[tuple[str, str], ...] = KNOWN_LAYOUTS) -> list[Character]:
    """Characters of a cast section, by the layout that fits most entries, or the one that is known for the title."""
    text = w.clean(text, raw_tags=raw_tags).replace("&lt;", " ").replace("&gt;", " ") + "\n"
    text = reduce(w.cut_section, SECTIONS_LEFT_OUT, text)
    if len(text) <= 20 or title in PAGES_LEFT_OUT:
        return []
    lines = text.split("\n")
    best = next((name for pattern, name in known if re.search(pattern, title)), None)
    if best is None:
        # A heading that only names the cast counts for nothing.
        scores = {name: sum(1 for _ in (_titled(layout(lines)) if heading else layout(lines))) for name, layout, heading in LAYOUTS}
        best = max(scores, key=lambda n: scores[n])
    layout, heading = next((f, h) for n, f, h in (*LAYOUTS, *ASKED_FOR) if n == best)
    found = (record(top, notes, heading) for top, notes in layout(lines))
    return [c for c in found if c]


def is_fictional_person(inner: str) -> bool:
    return all(any(x in inner for x in group) for group in PERSON_NEEDS) and not any(x in inner for x in PERSON_FORBIDS)


def find_characters(title: str, inner: str, *, raw_tags: bool = False, known: tuple[tuple[str, str], ...] = KNOWN_LAYOUTS) -> list[Character]:
    """Characters by the cast section, else by what title or categories say of the page, else of a page on one person."""
    m = re.search("\n== ?(?:" + "|".join(CAST_HEADINGS) + ") ?==", inner)
    if m:
        end = inner.find("\n== ", m.end())
        return parse_cast(title, inner[m.start() : end if end >= 0 else None], raw_tags=raw_tags, known=known)
    if any(x in title for x in CAST_TITLES) or any(f"[[Category:{x}]]" in inner for x in CAST_CATEGORIES):
        return parse_cast(title, inner, raw_tags=raw_tags, known=known)
    if is_fictional_person(inner):
        return [Character(w.plain_reading(find_reading(title, inner, raw_tags=raw_tags)), title)]
    return []


def may_list_characters(title: Column, inner: Column) -> Column:
    """A native test that holds for every page on which ``find_characters`` looks further."""
    return (
        inner.rlike("\n== ?(?:" + "|".join(CAST_HEADINGS) + ") ?==") | title.rlike("|".join(CAST_TITLES))
        | inner.rlike(r"\[\[Category:(?:" + "|".join(CAST_CATEGORIES) + r")\]\]") | inner.rlike("|".join(PERSON_NEEDS[0]))
    )
