"""Small inputs of our own: each operator by its usual name with what it must give, and a small export through the six tables.

A case is (operator, function, arguments, result). Functions over Python strings are called as they are, native ones on the
columns of a row for each case. Results are compared as JSON text.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotonoha import plans
from kotonoha.functions import charclass, kana, keyboard
from kotonoha.functions import strings as st
from kotonoha.functions import wikitext as w
from kotonoha.operators import categories, characters, english, phonemes, readings, synonyms, titles

Case = tuple[str, Callable, tuple, object]


def _names(method: str) -> Callable:
    """A method of ``synonyms.Names`` as a function of title and text that gives the names found."""

    def run(title: str, text: str) -> list[str]:
        names = synonyms.Names(title)
        getattr(synonyms, method, None)(names, text) if hasattr(synonyms, method) else getattr(names, method)(text)
        return names.found

    return run


def _entries(layout: Callable, *more) -> Callable:
    return lambda text: [[top, list(notes)] for top, notes in layout(text.split("\n"), *more)]


def _record(top: str, notes: list[str], heading: bool = False) -> dict | None:
    found = characters.record(top, tuple(notes), heading)
    return found.as_row() if found else None


def _characters(title: str, inner: str) -> list[list[str]]:
    return [list(c.as_row().values()) for c in characters.find_characters(title, inner)]


KERNELS: list[Case] = [
    ("parseKako", w.bracket, ("a(b(c)d)e", "(", ")"), [1, 2, 7, 8]),
    ("parseKako", w.bracket, ("a(b", "(", ")"), None),
    ("parseKako", w.bracket, ("((x)", "(", ")"), None),
    ("parseKakoR", w.bracket_back, ("a[[b[[c]]d]]", "[[", "]]", 11), [1, 3, 10, 12]),
    ("parseKakoR", w.bracket_back, ("ab]]", "[[", "]]", 3), None),
    ("parseKakoEx", w.any_bracket, ("x「y」[[z]]",), [1, 2, 3, 4]),
    ("parseKakoEx", w.any_bracket, ("'''a''b",), [0, 2, 4, 6]),
    ("parseKakoREx", w.any_bracket_back, ("（a）「b」c", 6), [3, 4, 5, 6]),
    ("isKakoStart", lambda c: c in w.OPENERS, ("「",), True),
    ("isKakoStart", lambda c: c in w.OPENERS, ("」",), False),
    ("firstfindPos", w.first_of, ("abcab", ("b", "ab")), [0, 2, 1]),
    ("firstfindPos", w.first_of, ("abc", ("z", "")), None),
    ("firstrrfindPos", w.last_of, ("abcab", ("a", "b"), 4, 0), [4, 5, 1]),
    ("firstrrfindPos", w.last_of, ("xyz", ("a",), 2, 0), None),
    ("strsnip", w.snip, ("ab[[c[[d]]e]]zx[[aa]]12", "[[", "]]"), "abzx12"),
    ("strsnip", w.snip, ("a[[b[[c]]d", "[[", "]]"), "ad"),
    ("strsnip", w.snip, ("", "[[", "]]"), ""),
    ("strsnipOne", lambda s: w.snip(s, "[[", "]]", once=True), ("ab[[c[[d]]e]]zx[[aa]]12",), "abzx[[aa]]12"),
    ("killHTMLTag", w.drop_elements, ("x&lt;ref&gt;y&lt;/ref&gt;z", "ref"), "xz"),
    ("killHTMLTag", w.drop_elements, ("x&lt;ref name=a /&gt;z", "ref"), "xz"),
    ("killHTMLTag", w.drop_elements, ("x&lt;ref&gt;y", "ref"), "x&lt;ref&gt;y"),
    ("killHTMLTag (tags only)", w.drop_tag_marks, ("a&lt;br /&gt;b&lt;small&gt;c&lt;/small&gt;", "br"), "ab&lt;small&gt;c&lt;/small&gt;"),
    ("cleaningInnerText", w.clean, (" &quot;a&quot;&amp;b  c&lt;!-- x --&gt;&lt;b&gt;d&lt;/b&gt; ",), "a&b cd"),
    ("cleaningInnerText", w.clean, ("",), ""),
    ("snipWikiKeywordSyntax", w.without_links, ("a[[b|c]]d",), "ab|cd"),
    ("snipAimaiKako", w.strip_disambiguation, ("猫 (動物)",), "猫"),
    ("snipAimaiKako", w.strip_disambiguation, ("'''犬'''（いぬ）",), "犬"),
    ("snipNado", w.without_et_cetera, ("猫、犬など",), "猫、犬"),
    ("makeInnerHead", w.head_of, ("a\n{{b}}\n== c ==\nd",), "a\n{{b}}"),
    ("makeInnerText", w.lead_of, (">{{箱\n|a=1\n}}\n'''猫'''は。\n== 節 ==\n文",), ">\n'''猫'''は。\n=="),
    ("killWikiKako", w.drop_blocks, (">{{a{{b}}c}}\n[[ファイル]]x\n{|表|}\ny",), ">\nx\n\ny"),
    ("getInfoboxStr", w.infobox, ("{{学校\n|名前=山\n|大学の略称 = 山大 \n|x=1\n}}", "略称"), "山大"),
    ("getInfoboxStr", w.infobox, ("{{箱\n|ふりがな = やま（が）\n}}", "ふりがな"), "やま"),
    ("getInfoboxStr", w.infobox, ("{{箱\n|a=1", "a"), ""),
    ("getInfoboxStr", w.infobox, ("文", "略称"), ""),
    ("getWikiBlock", w.section, ("前\n== 甲 ==\nあ\n=== 小 ===\nい\n== 乙 ==\nう\n", "甲"), "\n== 甲 ==\nあ\n=== 小 ===\nい"),
    ("getWikiBlock", w.section, ("前\n== 乙 ==\nう\n", "乙"), ""),
    ("cutWikiBlock", w.cut_section, ("前\n== 甲 ==\nあ\n== 乙 ==\nう\n", "甲"), "前\n== 乙 ==\nう\n"),
    ("cutWikiBlock", w.cut_section, ("前\n== 甲 ==\nあ\n", "丙"), "前\n== 甲 ==\nあ\n"),
    ("convertPlainYomi", w.plain_reading, ("や ま-だ_・=＝",), "やまだ"),
    ("isKanji", charclass.has, ("漢", "kanji"), True),
    ("isKanji", charclass.has, ("か", "kanji"), False),
    ("isKana", charclass.has, ("か", "hiragana"), True),
    ("isKata", charclass.has, ("・", "katakana"), True),
    ("isAlphanum", charclass.has, ("7", "alnum"), True),
    ("isAlpha", charclass.has, ("7", "alpha"), False),
    ("isSpace", charclass.has, ("　", "space"), True),
    ("isSpace", charclass.has, ("\n", "space"), False),
    ("isKanjiOnly", charclass.only, ("漢字Ω", "kanji"), True),
    ("isKanjiOnly", charclass.only, ("漢a", "kanji"), False),
    ("isKatakanaOnly", charclass.only, ("カタ・カナー", "katakana"), True),
    ("isAplhaOnly", charclass.only, ("Ab c_.", "alpha"), True),
    ("isAplhaSmallOnly", charclass.only, ("Ab", "alpha_small"), False),
    ("isAlphanumOnly", charclass.only, ("Ab1", "alnum"), True),
    ("isHiraKataOnly", charclass.only, ("かなカナ", "kana"), True),
    ("IsTofuOnly", charclass.unreadable, ("ж",), True),
    ("IsTofuOnly", charclass.unreadable, ("жa",), False),
    ("mb_convert_kana h", kana.convert, ("アガヴｱ　1１Aａ", "h"), "アガヴｱ　1１Aａ"),
    ("mb_convert_kana H", kana.convert, ("ｱｶﾞ", "H"), "あが"),
    ("mb_convert_kana c", kana.convert, ("アガヴ", "c"), "あがう゛"),
    ("mb_convert_kana C", kana.convert, ("あが", "C"), "アガ"),
    ("mb_convert_kana k", kana.convert, ("アガ", "k"), "ｱｶﾞ"),
    ("mb_convert_kana K", kana.convert, ("ｱｶﾞﾗ", "K"), "アガラ"),
    ("mb_convert_kana n", kana.convert, ("1１", "n"), "11"),
    ("mb_convert_kana N", kana.convert, ("1１", "N"), "１１"),
    ("mb_convert_kana r", kana.convert, ("Ａａ（", "r"), "Aa("),
    ("mb_convert_kana R", kana.convert, ("Aa", "R"), "Ａａ"),
    ("mb_convert_kana a", kana.convert, ("Ａ１", "a"), "A1"),
    ("mb_convert_kana A", kana.convert, ("A1", "A"), "Ａ１"),
    ("mb_convert_kana s", kana.convert, ("a　b", "s"), "a b"),
    ("mb_convert_kana S", kana.convert, ("a b", "S"), "a　b"),
    ("mb_convert_typo", keyboard.convert, ("nihongo", "r"), "にほんご"),
    ("mb_convert_typo", keyboard.convert, ("がっこう", "R"), "gakkou"),
    ("mb_convert_typo", keyboard.convert, ("t@", "K"), "が"),
    ("mb_convert_typo", keyboard.convert, ("がぱ", "k"), "t@f["),
]

READINGS: list[Case] = [
    ("script switch", readings.script_switch, ("山たろう",), [1, 0]),
    ("script switch", readings.script_switch, ("やま太郎",), [0, 2]),
    ("script switch", readings.script_switch, ("山本",), [-1, 0]),
    ("cleaners by word", readings.cut_at, ("あ、い、う", "、"), "あ"),
    ("getKatahiraKatamari", readings.longest_piece, ("a・bb・cc", "・"), "bb"),
    ("NihongoCount", readings.japanese_length, ("漢かカa1-",), 3),
    ("NihongoCount", readings.japanese_length, ("",), 0),
    ("spoken part", readings.spoken_part, (" ふぇるみめん Fermi",), "ふぇるみめん"),
    ("clean reading", readings.clean_reading, ("山川", "やま かわ、別"), "やまかわ"),
    ("clean reading", readings.clean_reading, ("普", "ふ/ぷぷ"), "ぷぷ"),
    ("bracket after", readings.bracket_after, ("'''x'''[[a]]（よみ）", "'''x'''"), "よみ"),
    ("bracket after", readings.bracket_after, ("x", "y"), ""),
    ("early span", readings.early_span, ("あ'''b'''c", "'''", "'''"), "b"),
    ("early span", readings.early_span, ("あ" * 120 + "'''b'''", "'''", "'''"), ""),
    ("infobox reading", readings.boxed_reading, ("{{箱\n|ふりがな=やま、べつ\n}}",), "やま"),
    ("elision", readings.elision_at, ("-たろう",), 0),
    ("elision", readings.elision_at, ("て-す",), -1),
    ("completion", readings.complete, ("山本たろう", "やまもと-", 4, 2, 0), "やまもとたろう"),
    ("plausible", readings.plausible, ("ハト派", "ハトは"), True),
    ("plausible", readings.plausible, ("ハト派", "派"), False),
    ("makeSpaceAddData", readings.spaced, ("青木",), ["青 木", "青　木"]),
    ("reading", readings.reading, ("ねこ・いぬ", ">"), "ねこいぬ"),
    ("reading", readings.reading, ("山川", ">'''山川'''（やまかわ {{lang|en|x}}、別）は"), "やまかわ"),
    ("reading", readings.reading, ("キット郡", ">'''キット郡''' (''ーぐん''、'''K''') は"), "キットぐん"),
    ("reading", readings.reading, ("山本たろう", ">'''山本たろう'''（やまもと-）は"), "やまもとたろう"),
    ("reading", readings.reading, ("青木花子", ">'''青木 花子'''（あおき はなこ、1990年）は"), "あおきはなこ"),
    ("reading by infobox", readings.reading, ("山大学", ">{{大学\n|ふりがな = やまだいがく、別\n}}\n'''山'''"), "やまだいがく"),
    ("findAliasName", readings.reading, ("川線", ">'''別線'''（べつせん）"), "べつせん"),
    ("reading by ruby", readings.reading, ("地外", ">'''地外'''（{{音声ルビ|ちがい}}、x）は"), "ちがい"),
    ("reading", readings.reading, ("東メトロ線", ">'''南線'''（みなみせん）は"), ""),
    ("reading", readings.reading, ("漢字", ">何も無い"), ""),
    ("reading", readings.reading, ("", ""), ""),
]

SYNONYMS: list[Case] = [
    ("cleanWord", synonyms.clean_name, (" [['''甲''']]（乙）{{x}}",), "甲"),
    ("checkRuigi", synonyms.admissible, ("題", "NHK"), True),
    ("checkRuigi", synonyms.admissible, ("題", "1月"), False),
    ("checkRuigi", synonyms.admissible, ("題", "abc"), False),
    ("checkRuigi", synonyms.admissible, ("題", "題 (町)"), False),
    ("checkRuigi", synonyms.admissible, ("題", ""), False),
    ("tryInsert", _names("add"), ("題", "甲"), ["甲"]),
    ("tryInsert", _names("add"), ("題", "題"), []),
    ("list parser", _names("add_list"), ("題名", "「甲乙」、『丙丁』、[[頁|札]]、裸"), ["甲乙", "丙丁", "頁", "札"]),
    ("link parser", _names("add_link"), ("題", "x[[頁|札]]"), ["札"]),
    ("SplitSentence", synonyms.sentences, ("一。 二.三",), [" 一。 ", " 二. ", "三"]),
    ("SplitSentence", synonyms.sentences, ("",), []),
    ("forward abbreviation", lambda s: list(synonyms.bare_name(s, 0, len(s)) or ()), ("はカナカナ。",), [1, 5]),
    ("forward abbreviation", lambda s: list(synonyms.bare_name(s, 0, len(s)) or ()), ("はカ。",), []),
    ("backward abbreviation", lambda s: list(synonyms.bare_name_back(s, len(s) - 1, 0) or ()), ("これはカナカナ",), [3, 7]),
    ("forward scan", _names("forward"), ("川会社", "略称は「川社」や、「カワ」。"), ["川社", "カワ"]),
    ("forward scan", _names("forward"), ("川会社", "何も無い。"), []),
    ("backward scan", _names("backward"), ("空港", " 「ソラ」と略される。 "), ["ソラ"]),
    ("colon form", _names("forward"), ("山鉄道", "略称：ヤマテツ"), ["ヤマテツ"]),
    ("hedges", synonyms.hedged, ("題", "例えば略称は「文」。"), True),
    ("hedges", synonyms.hedged, ("題", "略称は「文」。"), False),
    ("synonyms by infobox", synonyms.synonyms, ("山鉄道", ">{{鉄道\n|略称 = 山鉄、ヤマテツ\n}}\n"), ["山鉄", "ヤマテツ"]),
    ("synonyms", synonyms.synonyms, ("川会社", ">'''川会社'''（かわ）は、企業。略称は「川社」や、「カワ」。"), ["川社", "カワ"]),
    ("synonyms", synonyms.synonyms, ("海の家族", ">'''海の家族'''は番組。通称『海家』。"), ["海家"]),
    ("synonyms", synonyms.synonyms, ("例文", ">例えば略称は「文」。"), []),
    ("synonyms", synonyms.synonyms, ("コンビニ店", ">'''コンビニ店'''（コンビニ）は店。"), ["コンビニ"]),
    ("university clean-up", synonyms.synonyms, ("山大学", ">{{大学\n|略称 = 山大、主に「ヤマ大」\n}}\n"), ["山大", "ヤマ大"]),
    ("AnalizeRedirect", synonyms.redirect_target, ("旧名", "<text>#REDIRECT [[新名]]"), ["新名"]),
    ("AnalizeRedirect", synonyms.redirect_target, ("旧名", "<text>#転送 [[頁|札]]"), ["札"]),
    ("AnalizeRedirect", synonyms.redirect_target, ("旧名", "<text>#REDIRECT [[新名#節]]"), []),
    ("AnalizeRedirect", synonyms.redirect_target, ("旧名", "<text>文"), []),
    *[
        ("parseAimai", synonyms.disambiguation_targets, ("題", f"<text>題\n{lines}\n{{{{aimai}}}}\n"), found)
        for lines, found in (
            ("* [[甲山]] - 山の名。", ["甲山"]), ("* 川の意味については[[乙川]]を参照。", ["乙川"]), ("* [[丙社]]", ["丙社"]), ("* 略語のこと。[[丁会]]", ["丁会"]),
            ("* [[庚市]]、[[辛市]] - 二つの市。", []), ("* アルバム [[壬]]を参照。", []), ("何も無い", []),
        )
    ],
    ("parseAimai", synonyms.disambiguation_targets, ("題", "<text>* [[甲山]]"), []),
]

ENGLISH: list[Case] = [
    ("clean word", english.clean_word, ("The Foo Corporation, x",), "Foo"),
    ("first letters", english.fits_initial, ("ラジオ", "radio"), True),
    ("first letters", english.fits_initial, ("ラジオ", "x-ray"), False),
    ("first letters", english.fits_initial, ("ラジオ", "ra"), False),
    ("mis-hits", english.misses, ("バス", "バス", "バス（bus）", "bus"), False),
    ("mis-hits", english.misses, ("バス", "バス", "バス（車 bus）", "bus"), True),
    ("marked word", english.marked_word, ("a[[:en:Bus|バス]]", "[[:en:", "]]"), "Bus"),
    ("marked word", english.marked_word, ("a", "[[:en:", "]]"), ""),
    ("leading word", english.leading_word, ("= Bus ",), "Bus"),
    ("by markers", english.by_markers, ("バス", "", "x{{lang-en-short|bus}}"), "bus"),
    ("near", english.near, ("バス", "バス", "バス（bus）は"), "bus"),
    ("near plain or bold", english.near_plain_or_bold, ("レッド", "レッド", "'''レッド'''('''Red Hat''')は"), "Red Hat"),
    ("english", english.english_word, ("インサイダー", "'''インサイダー'''（insider）"), "insider"),
    ("english", english.english_word, ("ゲーム", "'''ゲーム'''（{{Lang-en-short|[[w:Game|Game]]}}）とは"), "Game"),
    ("english", english.english_word, ("ソース", "'''ソース'''（Source code、'''別''')"), "Source code"),
    ("english", english.english_word, ("ビール", "『'''ビール'''』（会社）"), ""),
    ("english pair", english.english_pair, ("バス", "'''バス'''（bus）"), ["バス", "bus"]),
    ("english pair", english.english_pair, ("漢字", "x"), None),
]

_CAST = "<text>文\n== 登場人物 ==\n; 山田 太郎（やまだ たろう）\n: 声 - [[川本 一]]\n: 主役。\n; 花子（はなこ）\n: 演 - [[林 二]]、[[森 三]]\n== 音楽 ==\n"

CHARACTERS: list[Case] = [
    ("stop words", characters.stops, ("脚本",), True),
    ("stop words", characters.stops, ("太郎",), False),
    *[("checkGomiString", characters.no_word, (word,), noise) for word, noise in (
        ("第3話", True), ("TV1", True), ("2010年", True), ("MGS3", True), ("S.2", True), ("３", True), ("アニメ版", True), ("ラブラブおもちゃ箱のみ", True), ("※ドラマCDと2のみ", True), ("少年時代", True),
        ("蟹座", True), ("原作第三期", True), ("テレビアニメ第二", True), ("劇場版の", True), ("日本語版", False), ("山田太郎", False), ("花子", False), ("a", True), ("犬", False), ("", False), ("#x", True), ("暴力", True),
    )],
    ("tokens", characters.tokens, ("山田（やまだ）、[[林 二|x]]", True), ["山田", "やまだ", "[林 二"]),
    ("tokens", characters.tokens, ("声 - [[林]]", False), ["声", "林"]),
    ("tokens", characters.tokens, ("", True), []),
    ("reading check", characters.agrees, ("たろう", "タロウ"), True),
    ("reading check", characters.agrees, ("たろう", "はなこ"), False),
    ("reading check", characters.agrees, ("太郎", ""), False),
    ("record", _record, ("山田 太郎（やまだ たろう）", ["声 - [[川本 一]]"]), {"reading": "やまだたろう", "name": "山田太郎", "actor1": "川本 一", "actor2": "", "actor3": ""}),
    ("record", _record, ("、", []), None),
    ("layout heading", _entries(characters.headings, 3), ("=== 山田 ===\n: 声 - [[林]]\n=== 川 ===\n文",), [["山田", [" 声 - [[林]]"]]]),
    ("layout definition", _entries(characters.definitions), ("; 山田\n: 声\n: 主役\n; 川\n文",), [[" 山田", [" 声", " 主役"]]]),
    ("layout followed", _entries(characters.followed, ""), ("; 山田\n声 - 林\n; 川\n: x",), [[" 山田", ["声 - 林"]]]),
    ("layout continued", _entries(characters.followed, ";:"), ("; 山田\n;:声 - 林\n",), [[" 山田", ["声 - 林"]]]),
    ("layout bullet", _entries(characters.bullets), ("== 登場人物 ==\n* 山田\n** 注\n* 文。",), [[" 山田", []]]),
    ("layout term", _entries(characters.terms), ("; 山田：声\n文",), [[" 山田", []]]),
    ("layout table", _entries(characters.rows), ('{| class="wikitable"\n|-\n|山田||やまだ\n|}',), [["山田 やまだ", []]]),
    ("fictional person", characters.is_fictional_person, ("は、[[漫画]]に登場する[[架空の人物]]。",), True),
    ("fictional person", characters.is_fictional_person, ("は、存命人物]]に登場する[[架空の人物]]。",), False),
    ("characters", _characters, ("劇", _CAST), [["やまだたろう", "山田太郎", "川本 一", "", ""], ["はなこ", "花子", "林 二", "森 三", ""]]),
    ("characters by category", _characters, ("劇の人", "文\n; 山田 太郎（やまだ たろう）\n: 声 - [[川本 一]]\n[[Category:アニメの登場人物の一覧]]"), [["やまだたろう", "山田太郎", "川本 一", "", ""]]),
    ("characters of a person", _characters, ("海子", "<text>'''海子'''（うみこ）は、[[漫画]]に登場する[[架空の人物]]。"), [["うみこ", "海子", "", "", ""]]),
    ("characters", _characters, ("劇", "<text>何も"), []),
]

PHONEMES: list[Case] = [
    ("EnglishOnsoToJapanese", phonemes.to_kana, (text,), kana_)
    for text, kana_ in (("K AE1 T", "きゃと"), ("B IY0", "びー"), ("G AA1 D", "ごっど"), ("HH AE1 F", "はーふ"), ("N UW1 Z", "にゅーず"), ("S IH1 N D", "しんど"), ("F AO1 R", "ふぁあ"), ("", ""), ("M AH0", "ま"), ("L OY1 D", "ろいど"), ("CH OY1 S", "ちょいす"), ("S IY1", "しー"), ("W AY1", "わい"), ("K ER1", "かー"), ("D OW1", "どー"), ("M OW1", "もー"))
] + [("rules given", lambda: phonemes.to_kana("S T ER", ((1, "S T ER", "すたー"),)), (), "すたー")]



def _time() -> Column:
    return F.to_timestamp(F.lit("2024-02-29 23:05:07"))


STRINGS: list[Case] = [
    ("strtoupper", st.ascii_upper, ("aÉz1",), "AÉZ1"),
    ("strtolower", st.ascii_lower, ("AÉZ1",), "aÉz1"),
    ("header case", st.header_case, ("content-TYPE",), "Content-Type"),
    ("isnumber", st.is_number, ("-1.5",), True), ("isnumber", st.is_number, ("",), False), ("isnumber", st.is_number, ("1a",), False),
    ("ishex", st.is_hex, ("fF0",), True), ("ishex", st.is_hex, ("g",), False),
    ("isalpha", st.is_letters, ("ab",), True), ("isalnum", st.is_alphanumeric, ("a1",), True), ("isalnum", st.is_alphanumeric, ("a_",), False),
    ("isAsciiString", st.is_ascii, ("é",), False),
    ("isMailAddress", st.is_mail_address, ("a@b.c",), True), ("isMailAddress", st.is_mail_address, ("a.b",), False),
    ("isFileName", st.is_safe_name, ("a.txt",), True), ("isFileName", st.is_safe_name, ("a/b",), False),
    ("no line break", st.has_no_line_break, ("a\n",), False), ("no line break, equals", st.has_no_line_break_or_equals, ("a=b",), False),
    ("atoi", st.leading_int, (" -12ab",), -12), ("atoi", st.leading_int, ("x",), 0), ("atoui", st.leading_unsigned, ("12ab",), 12), ("atoui", st.leading_unsigned, ("-1",), 0),
    ("strpos", lambda s: st.find(s, "b"), ("abab",), 1), ("strpos", lambda s: st.find(s, "z"), ("ab",), -1),
    ("strrpos", lambda s: st.find_last(s, "ab"), ("abcab",), 3), ("strrpos", lambda s: st.find_last(s, "ab"), ("x",), -1),
    ("stripos", lambda s: st.find_any_case(s, "bC"), ("aBc",), 1), ("strpbrk", lambda s: st.find_any(s, "xyc"), ("abcx",), 2),
    ("strcount", lambda s: st.count_of(s, "aa"), ("aaaa",), 2),
    ("common prefix", lambda a, b: st.common_prefix_length(a, b), ("abx", "aby"), 2), ("common prefix", lambda a, b: st.common_prefix_length(a, b), ("", "a"), 0),
    ("wildcard", lambda s: st.glob(s, "a*.t?t"), ("abc.txt",), True), ("wildcard", lambda s: st.glob(s, "b*"), ("abc",), False),
    ("trim", st.trim, (" \ta\n",), "a"), ("split", lambda s: st.split(s, ","), ("a,,b",), ["a", "", "b"]), ("split", lambda s: st.split(s, "."), ("",), [""]),
    ("split_two", lambda s: st.split_two(s, "="), ("a=b=c",), {"left": "a", "right": "b=c"}), ("split_two", lambda s: st.split_two(s, "="), ("a",), {"left": "", "right": ""}),
    ("parse pairs", lambda s: st.parse_pairs(s, "&", "="), ("a=1&b&a=2",), {"a": "1", "b": ""}),
    ("join pairs", lambda s: st.join_pairs(st.parse_pairs(s, "&", "="), ";", ":"), ("a=1&b=2",), "a:1;b:2"),
    ("strab", lambda s: st.between(s, "<", ">"), ("a<b>c<d>",), "b"), ("strab", lambda s: st.between(s, "<", ">"), ("a<b",), ""),
    ("between_replace", lambda s: st.replace_between(s, "<", ">", "$1"), ("a<b>c<d>",), "a<$1>c<$1>"),
    ("template_if", lambda s: st.template_if(s, "x", F.lit(True)), ("a{x}b{/x}c",), "abc"), ("template_if", lambda s: st.template_if(s, "x", F.lit(False)), ("a{x}b{/x}c",), "ac"),
    ("remove", lambda s: st.remove(s, "a", "b"), ("abcab",), "c"), ("replace", lambda s: st.replace_all(s, [("a", "b"), ("b", "c")]), ("ab",), "cc"),
    ("makebigram", st.bigrams, ("abc",), ["ab", "bc"]), ("makebigram", st.bigrams, ("a",), ["a"]), ("makebigram", st.bigrams, ("",), []),
    ("strimwidth", lambda s: st.shorten(s, 5), ("abcdefgh",), "ab..."), ("strimwidth", lambda s: st.shorten(s, 5), ("abcde",), "abcde"),
]

MORE_STRINGS: list[Case] = [
    ("htmlspecialchars", st.html_escape, ("<a&'\">",), "&lt;a&&#039;&quot;&gt;"), ("nl2br", st.line_breaks_to_html, ("a\r\nb\nc",), "a<br>b\nc"),
    ("json text", st.json_text, ('a"/\n',), '"a\\"\\/\\n"'), ("json pair", st.json_pair, ("k", "v"), '"k": "v"'),
    ("remove line breaks", st.without_line_breaks, ("a\r\nb",), "ab"), ("escape quotes", st.double_quotes, ('a"b',), 'a\\"b'),
    ("unquote", st.unquote, ("'a'",), "a"), ("unquote", st.unquote, ("'a\"",), "'a\""), ("shell quote", st.shell_quote, ("a'b",), "'a'\\''b'"),
    ("urlencode", st.url_encode, ("a b/é~",), "a%20b%2f%c3%a9~"), ("urldecode", st.url_decode, ("a%20b%zz+c%",), "a b%zz c%"), ("urldecode", st.url_decode, ("",), ""),
    ("mime header", st.mime_header, ("é",), "=?utf-8?B?w6k=?="),
    ("extension", st.extension, ("/a/b.tar.GZ",), ".GZ"), ("extension", st.extension, ("/a.b/c",), ""), ("plain extension", st.extension_plain, ("/a/b.tar.GZ",), "gz"),
    ("dirname", st.directory, ("/a/b.c",), "/a"), ("dirname", st.directory, ("b",), ""), ("basename", st.file_name, ("/a\\b.c",), "b.c"), ("file stem", st.file_stem, ("/a/b.tar.gz",), "b.tar"),
    ("is full path", st.is_full_path, ("C:\\a",), True), ("is full path", st.is_full_path, ("a/b",), False), ("separators", st.with_separator, ("a\\b/c",), "a/b/c"),
    ("combine path", st.combine_path, ("a/", "b"), "a/b"), ("combine path", st.combine_path, ("a", "/b"), "/b"),
    ("hosturl", st.host_url, ("http://a.b:80/c?d",), "http://a.b:80"), ("hosturl", st.host_url, ("a.b/c",), ""), ("baseurl", st.base_url, ("http://a.b/c/d?e",), "http://a.b/c/"),
    ("changeprotocol", lambda s: st.with_protocol(s, "https"), ("http://a",), "https://a"), ("AppendURLParam", lambda s: st.with_parameter(s, "k", "v"), ("http://a?b",), "http://a?b&k=v"),
    ("mail name", st.mail_name, ("a@b.c",), "a"), ("mail domain", st.mail_domain, ("a@b.c",), "b.c"), ("mail domain", st.mail_domain, ("a",), ""),
    ("key_value", lambda s: st.key_value(s, "b"), ("a=1&b=22",), 22), ("key_value", lambda s: st.key_value(s, "b"), ("ab=1",), None),
    ("md5", st.md5, ("a",), "0cc175b9c0f1b6a831c399e269772661"), ("sha1", st.sha1, ("a",), "86f7e437faa5a7fce15d1ddcb9eaeaea377667b8"),
    ("base64encode", st.base64_encode, ("é",), "w6k="), ("base64decode", st.base64_decode, ("w6k=",), "é"),
    ("hex", lambda s: F.decode(st.hex_bytes(s), "UTF-8"), ("c3a9",), "é"), ("bytes", lambda s: F.hex(st.to_bytes(s)), ("é",), "C3A9"), ("encoding", lambda s: st.re_decode(F.unhex(s), "ISO-8859-1"), ("E9",), "é"),
    ("arguments", st.arguments, ("a 'b c' \"d \\\" e\" f",), ["a", "b c", 'd " e', "f"]), ("arguments", st.arguments, ("",), []),
    ("filter characters", lambda s: st.keep_characters(s, lambda c: c.rlike("[0-9]")), ("a1b2",), "12"), ("map characters", lambda s: st.map_characters(s, F.upper), ("ab",), "AB"),
    ("unique", lambda s: st.unique(F.split(s, ",")), ("b,a,b",), ["b", "a"]), ("merge", lambda a, b: st.merge_lists(F.split(a, ","), F.split(b, ",")), ("a,b", "a"), ["a", "b", "a"]),
    ("merge maps", lambda a, b: st.merge_maps(st.parse_pairs(a, "&", "="), st.parse_pairs(b, "&", "=")), ("a=1", "a=2&b=3"), {"a": "1", "b": "3"}),
    ("maps differ", lambda a, b: st.maps_differ(st.parse_pairs(a, "&", "="), st.parse_pairs(b, "&", "=")), ("a=1&b=2", "b=2&a=1"), False),
    ("is one of", lambda s: st.is_one_of(s, ["a", "b"]), ("b",), True), ("random text", lambda: F.char_length(st.random_text(7)), (), 7), ("identifier", lambda: F.char_length(st.identifier()), (), 36),
    ("getScaler", lambda: st.digit_count(F.lit(12345)), (), 5), ("sizehosei", lambda: st.clamp(F.lit(7), 10, 20), (), 10), ("ByteToHumanReadable", lambda: st.human_size(F.lit(5000).cast("long")), (), "4KB"),
]

TIMES: list[Case] = [
    ("parse time", lambda s: F.unix_timestamp(st.parse_time(s)) - F.unix_timestamp(F.lit("2012-08-03 00:00:00")), ("2012/8/3 2:2:8",), 7328), ("parse time", lambda s: st.parse_time(s).isNull(), ("x",), True),
    ("format time", lambda: st.format_time(_time()), (), "2024/2/29 23:5:7"), ("UnixTimeToHttpTime", lambda: st.http_date(_time()), (), "Thu, 29 Feb 2024 23:05:07 GMT"),
    ("HttpTimeToUnixTime", st.parse_http_date, ("Sun, 06 Nov 1994 08:49:37 GMT",), 784111777), ("HttpTimeToUnixTime", st.parse_http_date, ("Sunday, 06-Nov-94 08:49:37 GMT",), 784111777),
    ("HttpTimeToUnixTime", st.parse_http_date, ("never",), None),
    ("DayofweekToJapanese", lambda: st.weekday_japanese(_time()), (), "木"), ("DayofweekToEnglish", lambda: st.weekday_english(_time()), (), "Thu"), ("MonthToJapanese", lambda: st.month_japanese(_time()), (), "2月"),
    ("MonthToEnglish", lambda: st.month_english(_time()), (), "Feb"), ("IsTimeOver", lambda: st.is_after(_time(), 23, 6), (), False), ("IsTimeOver", lambda: st.is_after(_time(), 23, 5), (), True),
    ("IsTimeIn", lambda: st.is_within(_time(), (22, 0), (2, 0)), (), True), ("IsTimeIn", lambda: st.is_within(_time(), (2, 0), (22, 0)), (), False),
    ("to UTC", lambda: st.format_time(st.to_utc(_time(), "Asia/Tokyo")), (), "2024/2/29 14:5:7"), ("from UTC", lambda: st.format_time(st.from_utc(_time(), "Asia/Tokyo")), (), "2024/3/1 8:5:7"),
    *[("isHoliday", lambda d=d: st.is_japanese_holiday(F.to_date(F.lit(d))), (), holiday) for d, holiday in (
        ("2024-01-01", True), ("2024-01-02", False), ("2024-01-08", True), ("2024-02-11", True), ("2024-02-12", True), ("2024-02-23", True), ("2024-03-20", True), ("2024-05-06", True), ("2024-05-07", False),
        ("2024-09-22", True), ("2024-09-23", True), ("2015-09-22", True), ("2018-12-23", True), ("2019-12-23", False), ("2009-09-22", True),
    )],
]

TITLES: list[Case] = [
    *[("checkGomiPage", titles.is_noise, (title,), noise) for title, noise in (
        ("", True), ("Category:動物", True), ("Wikipedia:x", True), ("1月", True), ("11月1", True), ("2011年11月11日x", True), ("1日", True), ("国道1号", True), ("県道2号", True), ("号の県道", True), ("昭和5年", True), ("年号の昭和", True),
        ("一月三日", True), ("旧暦1日", True), ("あ行", True), ("日本の山", True), ("E1系電車", True), ("x/history", True), ("愛称", True), ("国鉄ダイヤ改正", False), ("正月", False), ("猫", False), ("一月", False), ("12", True), ("平成", False),
    )],
    ("checkIchiran", titles.is_list_page, ("山の一覧",), True), ("checkIchiran", titles.is_list_page, ("一覧の山",), False),
    ("isAsciiOnlyTitle", titles.is_ascii, ("Foo 1~",), True), ("isAsciiOnlyTitle", titles.is_ascii, ("Foé",), False), ("isAsciiOnlyTitle", titles.is_ascii, ("",), True),
    ("isAimai", titles.is_disambiguation, ("x{{Aimai}}",), True), ("isAimai", titles.is_disambiguation, ("x{{AimaI}}",), False),
    ("isRedirect", titles.is_redirect, ("<text>#REDIRECT [[a]]",), True), ("isRedirect", titles.is_redirect, ("<text>#転送\n[[a]]",), True), ("isRedirect", titles.is_redirect, ("<text> #REDIRECT [[a]]",), False),
    ("isDouseidoumei", titles.is_same_name, ("[[同姓同名]]",), True), ("category page", titles.is_category_page, ("Category:a",), True),
    ("ParseTitleOneLine", titles.parsed_title, ("  <title>A &amp; B</title>",), "A &amp; B"), ("ParseTitleOneLine", titles.parsed_title, ("<ns>0</ns>",), ""),
    ("category", categories.category_of, ("[[Category:動物|x]]",), "動物"), ("category", categories.category_of, ("[[Category:動物 *]]",), "動物 *"), ("category", categories.category_of, ("[[x]]",), ""),
    ("categories", categories.categories_of, ("<text>a\n[[Category:動物]]\n[[Category:ねこ|*]]\nx[[Category:y]]",), ["動物", "ねこ"]), ("categories", categories.categories_of, ("",), []),
    ("may list characters", characters.may_list_characters, ("劇", "a\n== 登場人物 ==\n"), True), ("may list characters", characters.may_list_characters, ("劇", "a"), False),
]

PYTHON_GROUPS = {"golden_kernels": KERNELS, "golden_readings": READINGS, "golden_synonyms": SYNONYMS, "golden_english": ENGLISH, "golden_characters": CHARACTERS, "golden_phonemes": PHONEMES}
NATIVE_GROUPS = {"golden_titles": TITLES, "golden_strings": STRINGS, "golden_more_strings": MORE_STRINGS, "golden_times": TIMES}


def as_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def native_results(spark: SparkSession, cases: list[Case]) -> list[str]:
    """Results of native cases, some at a time so that plans stay small. Arguments are columns, as on tables."""
    out = []
    for at in range(0, len(cases), 12):
        part = cases[at : at + 12]
        widest = max(len(arguments) for _, _, arguments, _ in part)
        for number, (_, function, arguments, _) in enumerate(part):
            part[number] = (function, [*arguments, *[None] * (widest - len(arguments))], len(arguments))
        row = [x for _, padded, _ in part for x in padded]
        table = spark.createDataFrame([tuple(row)], ", ".join(f"x{k} string" for k in range(len(row))))
        values = []
        for number, (function, padded, used) in enumerate(part):
            got = function(*[F.col(f"x{number * widest + k}") for k in range(used)])
            values.append(F.coalesce(F.to_json(F.struct(got.alias("v")), {"ignoreNullFields": "false"}), F.lit('{"v":null}')).alias(f"r{number}"))
        out += list(table.select(*values).first())
    return out


# ---------------------------------------------------------------- pages through the six tables

#: (title, body) of a small export.
PAGES = (
    ("ねこ", "'''ねこ'''は動物。\n[[Category:動物]]\n[[Category:ねこ|*]]"),
    ("山川町 (県)", "'''山川町'''（やまかわちょう、{{lang-en-short|x}}）は町。略称は「山町」。\n[[Category:町]]"),
    ("バス", "'''バス'''（{{lang-en-short|bus}}）は乗り物。"),
    ("Foo", "'''Foo'''（フー）は製品。"),
    ("山の一覧", "'''一覧'''\n[[Category:山]]"),
    ("1月", "月。"),
    ("旧町", "#REDIRECT [[山川町]]"),
    ("乗合", "#転送 [[バス]]"),
    ("あいまい", "題\n* [[バス]]を参照。\n{{aimai}}"),
    ("同名", "[[同姓同名]]\n[[Category:人名]]"),
    ("劇", "文\n== 登場人物 ==\n; 山田 太郎（やまだ たろう）\n: 声 - [[川本 一]]\n; 花子（はなこ）\n: 演 - [[林 二]]\n== 外 ==\n"),
    ("見出し劇", "文\n== 登場人物 ==\n=== 海田一郎（うみだいちろう） ===\n: 声 - [[森 三]]\n=== 空野二郎（そらのじろう） ===\n* 演 - [[林 二]]\n== 外 ==\n"),
    ("表の劇", "文\n== 登場人物 ==\n{| class=wikitable\n|-\n|石川三郎（いしかわさぶろう）||7月19日||[[林 二]]\n|-\n|木村花江（きむらはなえ）||4月12日||[[森 三]]\n|}\n== 外 ==\n"),
    ("海子", "'''海子'''（うみこ）は、[[漫画]]に登場する[[架空の人物]]。"),
    ("山鉄道", "{{鉄道\n|略称 = 山鉄、ヤマテツ\n}}\n'''山鉄道'''（やまてつどう）は会社。"),
    ("空", ""),
)
PHONEME_ENTRIES = (("CAT", "K AE1 T"), ("BEE", "B IY0"), ("GOD", "G AA1 D"), ("CAR", "K ER1"), ("CHOICE", "CH OY1 S"))


def _pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t, f"<text>{body}") for i, (t, body) in enumerate(PAGES)], "ordinal long, title string, inner string")


TABLES: dict[str, tuple[Callable[[SparkSession], DataFrame], str, list[tuple]]] = {
    "golden_table_categories": (lambda s: plans.categories(_pages(s)), "title, categories", [("ねこ", ["動物", "ねこ"]), ("山川町", ["町"])]),
    "golden_table_readings": (
        lambda s: plans.readings(_pages(s)), "reading, title",
        [("ネコ", "ねこ"), ("ヤマカワチョウ", "山川町"), ("バス", "バス"), ("アイマイ", "あいまい"), ("ウミコ", "海子"), ("ヤマテツドウ", "山鉄道")],
    ),
    "golden_table_english": (lambda s: plans.english_words(_pages(s)), "reading, english", [("バス", "bus"), ("フー", "Foo")]),
    "golden_table_synonyms": (lambda s: plans.synonyms(_pages(s)), "title, synonyms", [("バス", ["乗合", "あいまい"]), ("Foo", ["フー"]), ("山川町", ["山町"]), ("山鉄道", ["山鉄", "ヤマテツ"])]),
    "golden_table_characters": (
        lambda s: plans.characters(_pages(s)), "reading, name, title, actor1, actor2, actor3",
        [("ヤマダタロウ", "山田太郎", "劇", "川本 一", "", ""), ("ハナコ", "花子", "劇", "林 二", "", ""), ("ウミダイチロウ", "海田一郎", "見出し劇", "森 三", "", ""), ("ソラノジロウ", "空野二郎", "見出し劇", "林 二", "", ""),
         ("イシカワサブロウ", "石川三郎", "表の劇", "林 二", "", ""), ("キムラハナエ", "木村花江", "表の劇", "森 三", "", ""), ("ウミコ", "海子", "海子", "", "", "")],
    ),
    "golden_table_phonemes": (
        lambda s: plans.phonetic_dictionary(s.createDataFrame(list(PHONEME_ENTRIES), "word string, phonemes string")), "kana, word, phonemes",
        [("キャト", "CAT", "K AE1 T"), ("ビー", "BEE", "B IY0"), ("ゴッド", "GOD", "G AA1 D"), ("カー", "CAR", "K ER1"), ("チョイス", "CHOICE", "CH OY1 S")],
    ),
}

