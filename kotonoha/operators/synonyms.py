"""Synonyms of a title, as its article states them, and the targets of redirect and disambiguation pages."""

from __future__ import annotations

import re

from ..functions import wikitext as w
from ..functions.charclass import ALPHA, KANJI, KATAKANA, SPACE, TRIM, only
from . import titles as t

# ---- Fixed values: phrases of the language that mark, end or forbid a synonym. Order matters among marks.
FORWARD_MARKS = ("略称", "愛称", "通称", "呼称", "略語", "隠語", "英略称")
FORWARD_SKIPS = ("複数形の", "男女同形の", "複数形である", "男女同形である")
FORWARD_STOPS = ("のひとつであり", "するため", "]]などによって")
FORWARD_JOINTS = ("および", "または", "、また", "や", "、", "'", "「", "『", "[[", "（", "(")
BACKWARD_MARKS = (
    "略称", "愛称", "通称", "呼称", "略語", "隠語", "と略さ", "呼ばれる。", "呼ばれ、", "呼ばれて", "呼ばれることもある", "呼ばれることがある",
    "ともいう", "略記", "としても知られている。", "を意味する", "英略称", "と名前を変えて",
)
BACKWARD_JOINTS = ("および", "または", "や", "という", "、", "'", "」", "』", "]]", "）", ")")
PARTICLES = ("の", "を", "で", "は")
FORWARD_CLAUSES = ("とする", "は、", "頭文字を", "頭文字。", "一般的に", "とも呼び")
BACKWARD_CLAUSES = ("とする", "は、", "頭文字を", "一般的に", "にした", "とは、", "を取得しており、", "作用があり", "するため")
HEDGES_OF_TITLE = ("の", "を", "と、", "と[[", "ではない", "と違")
HEDGES = (
    "を利用した", "らと", "呼ばれ、", "呼ばれており", "呼んでおり", "たとえば", "例えば", "のうち、", "のなかで", "を指すが", "全般を指す", "広義", "一般的には",
    "正確には", "]]に対する", "の値を意味", "これらの場合", "機構の名称", "]]の犠牲者", "]]に関する", "]]の関係者", "]]の被害者", "などのこと", "などの事", "などでは",
    "では、", "こともある", "こちらは", "ばあい", "]]内", "]]における", "]]での", "]]の[[", "]]などでは", "]]では", "]]にも", "]]が", "</math>", "&lt;/math&gt;",
    "住民は", "市民は", "住民呼称は", "読者側の", "した[[", "からなる", "を指すのが通例", "始まりである", "関数部分", "愛称区間", "こう呼ぶケースがある",
    "性差を含まない呼称", "このことからしばしば", "]]の用語で", "]]用語で", "語化した形であり", "圏]]で", "圏]]の", "国]]の", "国]]で", "語]]で", "語略称", "海外では",
    "語で[[", "なくなり", "以前", "いた。", "を使った", "のように", "過去", "なった", "略称であり、", "愛称であり、", "通称であり、", "呼称であり、", "略語であり、",
    "隠語であり、", "略であり、", "これに対し", "反対に", "対義語", "逆に", "自伝", "]]に表示される", "との区別のため", "と区別のため",
)
LINE_HEDGES = ("これに対し", "反対に", "対義語", "逆に", "自伝", "]]に表示される")
LINE_REJECTS = (
    "登場人物", "架空の", "シングル", "アルバム", "収録曲", "機能。", "における", "登場する", "内の", "小説。", "記事。", "曲。", "話の", "各地にある", "の曲", "の名前",
)
REFERS_BEFORE = ("のこと", "の事", "の愛称", "の略称", "の名称", "を参照のこと", "を参照", "の意", "を示す", "の呼称", "の別名", "の名前", "と呼称")
REFERS_AFTER = ("のこと", "の事", "の愛称", "の略称", "の名称", "を参照", "の意", "を示す", "の呼称", "の別名", "の名前", "と呼称")
TIED_LINKS = ("]][[", "]]'''[[", "]]『[[", "]]『'''[[", "]]「[[", "]]「'''[[", "]]（[[", "]]（'''[[", "]]([[", "]]('''[[", "]]の", "]]にある", "]]等", "]]など")
REDIRECTS_LEFT_OUT = ("てんてけマーチ", "モンモン山が泣いてるよ", "ヤジとボク", "山太郎かえる", "いないいないばあ", "松早ファミリーマート")
BOX_KEYS = ("略称", "愛称", "通称")
# In a university's infobox: what is rewritten, in order.
UNIVERSITY_FIRST = (
    ("。他に", "、"), ("特にないが", ""), ("特に無いが", ""), ("などと呼ばれている", ""), ("定着したものはないが", ""), ("も使用されることがある", ""), ("主に", ""),
    ("など", ""), ("学生の間では", ""), ("である", ""), ("この他に", ""), ("「", ""), ("」", "、"), ("｣", "、"), ("や", "、"), ("'''", "、"), ("または", "、"), ("[[旧六]]", "。"),
)
UNIVERSITY_ENDS = ("等と", "だが", "が", "※", "とも呼ば")
UNIVERSITY_LOCAL = ("県内", "地元", "地方では")
BOX_REWRITES = (("および", "、"), ("もしくは", "、"), ("特になし", ""), ("特に無い", ""))
# ---- End of fixed values.

_SEPARATOR = re.compile(f"([、　，,；;。|｜])|[{SPACE}][/／](?=[{SPACE}])")
_BAR = re.compile("[|｜。]")
_DATE = re.compile(t.DATE.replace("\\z", "\\Z"))
_SENTENCE = re.compile(r"[^。.]*[。.]")
_HEDGES = re.compile("|".join(map(re.escape, HEDGES)))
_LINE_HEDGES = re.compile("|".join(map(re.escape, LINE_HEDGES)))
_LINE_REJECTS = re.compile("|".join(map(re.escape, LINE_REJECTS)))
_REFERS_BEFORE = re.compile("]](?:" + "|".join(map(re.escape, REFERS_BEFORE)) + f")(?=$|[。.\n{SPACE}])")
_REFERS_AFTER = re.compile("(?:" + "|".join(map(re.escape, REFERS_AFTER)) + r")。\[\[")
_TIED = re.compile("|".join(map(re.escape, TIED_LINKS)))
_REDIRECT = re.compile(r">#(?:転送|REDIRECT|redirect|Redirect).*?\[\[", re.S)
_OPENING_RUN = re.compile(f"(?:とし)?は?、?([{KATAKANA}]+|[{KANJI}]+|[{ALPHA}]+)")


def noise(word: str) -> bool:
    """The Python form of ``titles.is_noise``."""
    return (
        word in t.NOISE_EXACT or word.startswith(t.NOISE_PREFIX) or any(s in word for s in t.NOISE_INSIDE) or word.endswith(t.NOISE_SUFFIX)
        or ("0" <= word[0] <= "9" and word.endswith(("年", "日"))) or _DATE.match(word) is not None
        or (word.startswith("旧暦") and word.endswith("日")) or ("年" in word and any(e in word for e in t.NOISE_ERAS))
        or ("号" in word and any(r in word for r in t.NOISE_ROADS)) or (word.endswith("日") and word.startswith(t.LUNAR_MONTHS))
    )


def clean_name(text: str) -> str:
    text = w.without_links(text).replace("'''", "")
    for a, b in (("(", ")"), ("（", "）"), ("{{", "}}")):
        text = w.snip(text, a, b)
    return text.strip(TRIM)


def admissible(title: str, word: str) -> bool:
    """Whether a word may be a synonym: no noise, no mere translation, no part of a page, not the title again."""
    return not (
        not word or word == title or noise(word) or word.endswith("一覧") or (not only(title, "alpha") and only(word, "alpha_small"))
        or (only(word, "alpha") and len(word) <= 1) or "#" in word or "カテゴリ" in word or w.strip_disambiguation(title) == w.strip_disambiguation(word)
    )


class Names:
    """Synonyms of one title in the order in which they turn up."""

    def __init__(self, title: str):
        self.title, self.found = title, []

    def add(self, word: str) -> None:
        if admissible(self.title, word) and word not in self.found:
            self.found.append(word)

    def add_link(self, text: str) -> bool:
        """The first link's label."""
        link = w.bracket(text, "[[", "]]")
        if link:
            inside = clean_name(text[link[1] : link[2]])
            self.add(inside.partition("|")[2] if "|" in inside else inside)
        return bool(link)

    def add_list(self, text: str) -> bool:
        """Names of a list of quoted, linked or bare words; brackets within brackets are lists again."""
        pos, got = 0, False
        while pos < len(text):
            got = True
            span = w.any_bracket(text, pos, anywhere=False)
            if span:
                inside = clean_name(text[span[1] : span[2]])
                if text[span[0]] == "'" and text[span[0] + 3] not in w.OPENERS:
                    self.add(inside)
                else:
                    self.add_list(inside)
                m = (_BAR if text.startswith("[[", span[0]) else _SEPARATOR).search(text, span[3])
                if not m or (m.re is _BAR and m[0] == "。"):
                    return True
            else:
                m = _SEPARATOR.search(text, pos)
                if not m:
                    self.add(clean_name(text[pos:]))
                    return True
                self.add(text[pos : m.start()])
            pos = m.end() + (not m[1] if m.re is _SEPARATOR else 0)
        return got


def sentences(text: str) -> list[str]:
    """Sentences with their stops and a space at both ends; what follows the last stop without."""
    out, end = [], 0
    for m in _SENTENCE.finditer(text):
        out.append(f" {m[0].strip(TRIM)} ")
        end = m.end()
    rest = text[end:].strip(TRIM)
    return out + [rest] * bool(rest)


def bare_name(text: str, pos: int, end: int) -> tuple[int, int] | None:
    """An unquoted abbreviation right here: three or more katakana, kanji or letters."""
    if end < pos + 3:
        return None
    skip = w.first_of(text, ("語の", "型の"), pos, end)
    m = re.compile(f"()([{KATAKANA}]+|[{KANJI}]+|[{ALPHA}]+)").match(text, skip[1] + 1, end) if skip else _OPENING_RUN.match(text, pos, end)
    run = m.span(m.lastindex) if m else (0, 0)
    return run if run[1] - run[0] > 2 else None


def bare_name_back(text: str, pos: int, end: int) -> tuple[int, int] | None:
    """The same leftwards from ``pos``; katakana or kanji only, and not from the very start."""
    last = pos - (text[pos : pos + 1] == "、")
    if last < end:
        return None
    m = re.search(f"([{KATAKANA}]+|[{KANJI}]+)$", text[end + 1 : last + 1])
    start = end + 1 + m.start() if m else last + 1
    return (start, last + 1) if m and last - start + 1 > 2 else None


def _colon_form(names: Names, text: str, pos: int) -> bool:
    m = re.compile(f"[{SPACE}]?[:：][{SPACE}]?").match(text, pos)
    run = bare_name(text, m.end(), len(text)) if m else None
    return bool(run) and names.add_list(text[run[0] : run[1]])


def forward(names: Names, text: str) -> None:
    """Names behind the first mark such as 略称, one after another as long as only joints stand between."""
    mark, end = w.first_of(text, FORWARD_MARKS), len(text)
    if not mark or _colon_form(names, text, mark[1]):
        return
    skip = w.first_of(text, FORWARD_SKIPS, mark[1])
    pos = skip[1] if skip else mark[1]
    openers = tuple(p + q for q in ("[[", "「", "（", "'''") for p in PARTICLES)
    while pos < end:
        stop = w.first_of(text, FORWARD_STOPS, pos)
        found = w.any_bracket(text, pos)
        span = (found[0], found[3]) if found else bare_name(text, pos, end)
        if not span or (stop and stop[0] < span[1]) or not names.add_list(text[span[0] : span[1]]):
            return
        pos = span[1]
        joint = w.first_of(text, FORWARD_JOINTS, pos)
        if not joint:
            return
        # Another subject or clause between the name and the joint ends the list.
        guards = ((PARTICLES, 2), (openers, 1), (FORWARD_CLAUSES, 1))
        if any((hit := w.first_of(text, words, pos)) and joint[1] - hit[0] >= gap for words, gap in guards):
            return
        pos = joint[1] + 1


def backward(names: Names, text: str) -> None:
    """Names before the last mark such as と呼ばれる, from right to left."""
    mark = w.last_of(text, BACKWARD_MARKS, len(text), 0)
    if not mark:
        return
    pos = mark[0] - 1
    if pos < 1 or text[pos] == "、" or text[mark[1] : mark[1] + 1] in (":", "："):
        return
    closers = tuple(q + p for q, more in (("]]", ("ら",)), ("'''", ()), ("」", ()), ("）", ())) for p in (*PARTICLES, *more))
    while pos >= 0:
        joint = w.last_of(text, BACKWARD_JOINTS, pos, 0)
        if not joint:
            return
        bad = w.last_of(text, (*PARTICLES, "："), pos, 0)
        clause = w.last_of(text, BACKWARD_CLAUSES, pos, 0)
        linked = w.last_of(text, closers, pos, 0)
        if (bad and bad[0] - joint[0] >= 3) or (linked and joint[0] < linked[0]) or (clause and joint[0] < clause[0]):
            return
        limit = clause[0] if clause else 0
        pos = joint[0]
        found = w.any_bracket_back(text, pos)
        span = (found[0], found[3]) if found else bare_name_back(text, pos, 0)
        if not span:
            return
        if pos - span[1] >= 11:
            pos = span[1] - 5
        elif span[0] < limit:
            pos = limit
            if limit >= joint[0]:
                return
        else:
            names.add_list(text[span[0] : span[1]])
            pos = span[0] - 1


def hedged(title: str, sentence: str) -> bool:
    """Whether a sentence speaks of examples, uses or the past rather than of the title's names."""
    return any(title + tail in sentence for tail in HEDGES_OF_TITLE) or _HEDGES.search(sentence) is not None


def _abbreviation(names: Names, sentence: str) -> bool:
    """A bracket in katakana right behind the bold title."""
    hit = w.first_of(sentence, (f"'''{names.title}'''", f"{names.title}（"))
    span = w.any_bracket(sentence, hit[1], anywhere=False) if hit else None
    inside = sentence[span[1] : span[2]] if span else ""
    if not span or not re.fullmatch(f"[{KATAKANA}{SPACE}_、']*", inside):
        return False
    return names.add_list(inside)


def _box_value(title: str, value: str) -> str:
    if "大学" in title:
        for a, b in UNIVERSITY_FIRST:
            value = value.replace(a, b)
        for a, b in (("（", "）"), ("[[", "]]"), ("{{", "}}")):
            value = w.snip(value, a, b)
        for a in UNIVERSITY_ENDS:
            value = value.replace(a, "。")
        first = next(iter(sentences(value)), "")
        value = "" if any(x in first for x in UNIVERSITY_LOCAL) else first.replace("。", "").strip(TRIM)
    for a, b in BOX_REWRITES:
        value = value.replace(a, b)
    return "" if value == "-" else value


def synonyms(title: str, inner: str, *, raw_tags: bool = False) -> list[str]:
    """Synonyms from the infobox, then from the lead's sentences."""
    names, head = Names(title), w.head_of(inner, raw_tags=raw_tags)
    for key in (*BOX_KEYS, "諡号" if "{{基礎情報 中国君主" in head else "呼称"):
        value = _box_value(title, w.infobox(head, key, raw_tags=raw_tags))
        if value:
            names.add_list(value)
    spoken = sentences(w.lead_of(inner, raw_tags=raw_tags))
    for sentence in (w.snip(s, "（", "）") for s in spoken):
        if not hedged(title, sentence):
            forward(names, sentence)
            backward(names, sentence)
    any(_abbreviation(names, w.snip(s, "{{", "}}")) for s in spoken)
    return names.found


# ---------------------------------------------------------------- redirects and disambiguation


def redirect_target(title: str, inner: str, *, whole_rest: bool = True) -> list[str]:
    """Target of a redirect, or nothing for those into sections. ``whole_rest`` looks for ``#`` in all that follows."""
    m = _REDIRECT.search(inner)
    if not m:
        return []
    rest = inner[m.end() - 2 :]
    scope = rest if whole_rest else rest.partition("]]")[0]
    if "#" in scope or title in REDIRECTS_LEFT_OUT or not admissible(title, scope):
        return []
    names = Names(title)
    names.add_link(rest)
    return names.found


def _dash_at(text: str) -> int:
    """The first of four dashes and colons that has a space before it, each looked at where it occurs first."""
    at = [p for mark in "-－:：" if (p := text.find(mark)) > 0 and text[p - 1] in SPACE]
    return min(at, default=-1)


def _single_link_before(text: str) -> bool:
    """Whether text ends in a link with no other link before it on the bullet."""
    text = text.rstrip(SPACE)
    return text.endswith("]]") and len(text) > 2 and "]" not in text[: len(text) - 2].rpartition("*")[2]


def _keyword_part(title: str, line: str) -> tuple[str, bool]:
    """The side of a bullet that names the target, and whether several links in a row may be taken from it."""
    dash = _dash_at(line)
    if dash > 0:
        inside = line.find(title)
        inside = line.find(w.strip_disambiguation(title)) if inside < 0 else inside
        behind = inside > dash if inside >= 0 else not _single_link_before(line[:dash])
        return (line[dash:], False) if behind else (line[:dash], not _TIED.search(line[:dash]))
    arrows = [line.find(a) + len(a) for a in ("⇒", "→", "->") if a in line]
    if not arrows:
        return line, False
    part = line[min(arrows) :]
    if _TIED.search(part) and _single_link_before(line[: min(arrows) - 1]):
        part = line[: max(0, min(arrows) - 2)]
    return part, not _TIED.search(part)


def _only_link(part: str, next_line: str) -> str:
    """The link of a bullet that holds nothing else but perhaps a bracket, unless the next line is a deeper bullet."""
    m = re.match(f"[{SPACE}*]*(?=\\[)", part)
    span = w.any_bracket(part, m.end(), anywhere=False) if m else None
    if not span:
        return ""
    # What follows the link is looked at from the second character on.
    rest = span[3] + 1
    if rest < len(part):
        more = w.any_bracket(part, rest, anywhere=False) if part[rest] in w.OPENERS and part[rest] != "[" else None
        if not more or more[3] + 1 < len(part):
            return ""
    stars = re.match(f"[{SPACE}\n*]*", next_line)[0].count("*")
    return "" if stars > 1 + m[0].count("*") else part[m.end() : span[3]]


def disambiguation_targets(title: str, inner: str, *, raw_tags: bool = False) -> list[str]:
    """Targets that the bullets of a disambiguation page name, in order; nothing for other pages."""
    names = Names(title)
    if not re.search(r"\{\{(?:aimai|Aimai|AIMAI)\}\}", inner):
        return []
    text = w.clean(inner, raw_tags=raw_tags).replace("'''", "")
    related = text.find("\n== 関連項目")
    if related >= 0:
        after = text.find("\n== ", related + 8)
        text = text[: related + 1] + (text[after:] if after >= 0 else "")
    lines = text.split("\n")
    for number, line in enumerate(lines[1:], 1):
        if not line.startswith("*") or _LINE_HEDGES.search(line):
            continue
        part, several = _keyword_part(title, line[1:])
        if _LINE_REJECTS.search(w.snip(w.snip(part, "(", ")"), "[", "]")):
            continue
        after, before = _REFERS_AFTER.search(part), _REFERS_BEFORE.search(part)
        if after and (span := w.bracket(part, "[[", "]]", after.end() - 2)):
            names.add_link(part[span[0] : span[3]])
        elif before and (span := w.any_bracket_back(part, before.start(), anywhere=False)):
            names.add_link(part[span[0] : span[3]])
        elif link := _only_link(part, "\n".join(lines[number + 1 :])):
            names.add_link(link)
        elif "]]なども参照" in part:
            head = part[: part.find("]]なども参照") + 2]
            for link in reversed(re.search(r"(?:\[\[[^\[\]]*\]\]、)*\[\[[^\[\]]*\]\]$", head)[0].split("、") if head.endswith("]]") and "[[" in head else []):
                names.add_link(link)
        elif several:
            run = re.search(r"\[\[.*", part, re.S)
            chain = re.match(r"(?:\[\[(?:(?!\]\]).)*\]\]、)+\[\[(?:(?!\]\]).)*\]\]", run[0], re.S) if run else None
            for link in chain[0].split("]]、") if chain else []:
                names.add_link(link if link.endswith("]]") else link + "]]")
    return names.found
