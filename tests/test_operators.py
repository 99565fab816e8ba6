"""Text operators on small pages of our own, and their native forms against the Python ones."""

import re

import pytest

from kotonoha.functions import charclass, kana, wikitext as w
from kotonoha.operators import characters, english, phonemes, readings, synonyms


# ---- kernels
@pytest.mark.parametrize("text, out", [("aa[[bb]]cc", "aacc"), ("ab[[c[[d]]e]]zx[[aa]]12", "abzx12"), ("ab12", "ab12"), ("a[[b", "ab"), ("a[[b[[c]]d", "ad"), ("", "")])
def test_snip(text, out):
    assert w.snip(text, "[[", "]]") == out


def test_snip_once():
    assert w.snip("ab[[c[[d]]e]]zx[[aa]]12", "[[", "]]", once=True) == "abzx[[aa]]12"


@pytest.mark.parametrize("text, out", [
    (">a&lt;refef&gt;vb", ">a&lt;refef&gt;vb"), ('>a&lt;ref group="n"&gt;vb', '>a&lt;ref group="n"&gt;vb'), ('>a&lt;ref group="n"&gt;v&lt;/ref&gt;b', ">ab"),
    ("（よみ）&lt;ref name=x /&gt;。本文", "（よみ）。本文"), ("a&lt;ref&gt;b&lt;ref&gt;c&lt;/ref&gt;d&lt;/ref&gt;e", "ae"),
])
def test_drop_elements(text, out):
    assert w.drop_elements(text, "ref") == out


def test_raw_tags_are_a_switch():
    assert w.clean("a<br>b<ref>c</ref>d") == "a<br>b<ref>c</ref>d" and w.clean("a<br>b<ref>c</ref>d", raw_tags=True) == "abd"


def test_clean_order():
    assert w.clean(" &quot;a&quot;&amp;b  c&lt;!-- x --&gt;&lt;b&gt;d&lt;/b&gt; ") == "a&b cd"
    assert w.strip_disambiguation("猫 (動物)") == "猫" and w.strip_disambiguation("'''犬'''（いぬ）") == "犬"


@pytest.mark.parametrize("head, key, value", [
    ("{{学校\n|名前=山\n|大学の略称 = 山大 \n|x=1\n}}", "略称", "山大"), ("{{箱\n|ふりがな = やま（が）\n}}", "ふりがな", "やま"), ("{{箱\n|a=1", "a", ""), ("{{箱\n|愛称=みーくんなど\n}}", "愛称", "みーくん"), ("文", "略称", ""),
])
def test_infobox(head, key, value):
    assert w.infobox(head, key) == value


def test_sections():
    page = "前\n== 甲 ==\nあ\n=== 小 ===\nい\n== 乙 ==\nう\n"
    assert w.section(page, "甲") == "\n== 甲 ==\nあ\n=== 小 ===\nい" and w.section(page, "乙") == "" and w.section(page, "丙") == ""
    assert w.cut_section(page, "甲") == "前\n== 乙 ==\nう\n" and w.cut_section(page, "乙") == "前\n== 甲 ==\nあ\n=== 小 ===\nい" and w.cut_section(page, "丙") == page


def test_brackets():
    assert w.bracket("a(b(c)d)e", "(", ")") == (1, 2, 7, 8) and w.bracket("a(b", "(", ")") is None and w.bracket("a(b)", "(", ")", anywhere=False) is None
    assert w.bracket_back("a[[b[[c]]d]]", "[[", "]]", 11) == (1, 3, 10, 12)
    assert w.any_bracket("x「y」") == (1, 2, 3, 4)
    assert w.first_of("abcab", ("b", "ab")) == (0, 2, 1) and w.first_of("abc", ("z",)) is None


@pytest.mark.parametrize("options, out", [
    ("h", "ｱｲｳｴｵアガヴｱ　1１ Aａ"), ("H", "あいうえおアガヴあ　1１ Aａ"), ("c", "あいうえおあがう゛ｱ　1１ Aａ"), ("C", "アイウエオアガヴｱ　1１ Aａ"), ("k", "あいうえおｱｶﾞｳﾞｱ　1１ Aａ"), ("K", "あいうえおアガヴア　1１ Aａ"),
    ("n", "あいうえおアガヴｱ　11 Aａ"), ("N", "あいうえおアガヴｱ　１１ Aａ"), ("r", "あいうえおアガヴｱ　1１ Aa"), ("a", "あいうえおアガヴｱ　11 Aa"), ("s", "あいうえおアガヴｱ 1１ Aａ"), ("S", "あいうえおアガヴｱ　1１　Aａ"),
])
def test_kana(options, out):
    assert kana.convert("あいうえおアガヴｱ　1１ Aａ", options) == out


def test_character_classes():
    assert charclass.only("", "kanji") and charclass.only("漢字Ω", "kanji") and not charclass.only("漢a", "kanji")
    assert charclass.only("カタ・カナー", "katakana") and not charclass.only("かな", "katakana") and charclass.only("かナ ー", "kana")
    assert charclass.unreadable("?") and charclass.unreadable("ж") and not charclass.unreadable("") and not charclass.unreadable("a")


# ---- readings
@pytest.mark.parametrize("title, inner, out", [
    ("ねこ・いぬ", ">", "ねこいぬ"),
    ("山川", ">'''山川'''（やまかわ {{lang|en|x}}、別）は", "やまかわ"),
    ("普", ">\n'''普'''（ふ/ぷぷ）", "ぷぷ"),
    ("乳", ">日本語の'''乳'''（ち・ちち）には", "ちち"),
    ("ハト派", ">{{出典の明記|date=x}}\n'''ハト派'''（ハトは。英語：'''dove'''）とは", "ハトは"),
    ("キット郡", ">'''キット郡''' (''ーぐん''、'''K''') は", "キットぐん"),
    ("山本たろう", ">'''山本たろう'''（やまもと-）は", "やまもとたろう"),
    ("青木花子", ">'''青木 花子'''（あおき はなこ、1990年）は", "あおきはなこ"),
    ("山大学", ">{{大学\n|ふりがな = やまだいがく、別\n}}\n'''山'''", "やまだいがく"),
    ("地外", ">'''地外'''（{{音声ルビ|ちがい}}、x）は", "ちがい"),
    ("川線", ">'''別線'''（べつせん）", "べつせん"),
    ("東メトロ線", ">'''南線'''（みなみせん）は", ""),
    ("漢字", ">何も無い", ""),
])
def test_readings(title, inner, out):
    assert readings.reading(title, inner) == out


def test_reading_parts():
    assert readings.script_switch("山本太郎") == (-1, 0) and readings.script_switch("やま太郎") == (0, 2) and readings.script_switch("山たろう") == (1, 0) and readings.script_switch("やま") == (0, -1)
    assert readings.elision_at("-たろう") == 0 and readings.elision_at("やま-") == 2 and readings.elision_at("て-す") == -1 and readings.elision_at("-") == -1
    assert readings.spoken_part(" ふぇるみめん Fermi") == "ふぇるみめん" and readings.spoken_part("- たろう") == "- たろう" and readings.longest_piece("a・bb・cc", "・") == "bb"
    assert readings.bracket_after("'''x'''[[a]]（よみ）", "'''x'''") == "よみ" and readings.early_span("あ" * 120 + "'''b'''", "'''", "'''") == ""


# ---- English
@pytest.mark.parametrize("title, inner, out", [
    ("インサイダー", "'''インサイダー'''（insider）", "insider"),
    ("フロッピー", "'''フロッピー'''（{{lang-en-short|FLOPPY}}）、柔らかい。", "FLOPPY"),
    ("ゲーム", "'''ゲーム'''（{{Lang-en-short|[[w:Game|Game]]}}）とは", "Game"),
    ("レッド", "'''レッド'''('''Red Hat''')は、会社", "Red Hat"),
    ("ソース", "'''ソース'''（Source code、'''別''')", "Source code"),
    ("ビール", "『'''ビール'''』（会社）", ""), ("バー", "'''バー'''は乗り物。\nBleed, one", ""), ("バー", "'''バー''' '''Bar'''", "Bar"),
    ("トア", "'''トア'''（{{lang-en-short|To### the, x}}）は\nTo the end", ""), ("トア", "'''トア'''（To$$$ the）は\nTo the end", ""),
    ("トマト", "'''トマト'''は植物。\n== 分類 ==\nカナカナカナカナカナ（英語：tomato）", "tomato"),
])
def test_english(title, inner, out):
    assert english.english_word(title, inner) == out


def test_english_parts():
    assert english.fits_initial("ラジオ", "radio") and not english.fits_initial("ラジオ", "x-ray") and not english.fits_initial("ラジオ", "ra") and english.fits_initial("ヂ", "jet")
    assert english.clean_word("The Foo Corporation, x") == "Foo" and english.marked_word("a[[:en:Bus|バス]]", "[[:en:", "]]") == "Bus" and english.leading_word("= Bus ") == "Bus"
    assert english.english_pair("バス", "'''バス'''（bus）") == ("バス", "bus") and english.english_pair("漢字", "x") is None


def test_readings_of_bold_titles_with_parentheses():
    lead = "<text>'''Été +1 (403) e'''（えて、{{lang-en-short|x}}）は地名。"
    assert readings.reading("Été +1 e", lead, "Été +1 (403) e") == "えて" and readings.reading("Été +1 e", lead) == ""


def test_names_that_begin_with_a_dot_keep_their_reading():
    assert characters.agrees("・フタ", "フタ") and not characters.agrees("・フタ", "タフ")
    assert [c.as_row()["reading"] for c in characters.find_characters("x", "\n== 登場人物 ==\n; ・フ・タ\n: 声 - [[ある声優の名]]\n== 外部 ==\n")] == ["フタ"]


def test_titles_cut_within_a_parenthesis_keep_it():
    assert [w.strip_disambiguation(x) for x in ("ten on +1 (62", "a (b) c (", "a (b (c)) d", "（あ） い（う")] == ["ten on +1 (62", "a c (", "a d", "い（う"]


# ---- synonyms
@pytest.mark.parametrize("title, inner, out", [
    ("山鉄道", ">{{鉄道\n|略称 = 山鉄、ヤマテツ\n}}\n", ["山鉄", "ヤマテツ"]),
    ("川会社", ">'''川会社'''（かわ）は、企業。略称は「川社」や、「カワ」。", ["川社", "カワ"]),
    ("海の家族", ">'''海の家族'''は番組。通称『海家』。", ["海家"]),
    ("空港", ">「ソラ」と略される。", ["ソラ"]),
    ("例文", ">例えば略称は「文」。", []),
    ("コンビニ店", ">'''コンビニ店'''（コンビニ）は店。", ["コンビニ"]),
])
def test_synonyms(title, inner, out):
    assert synonyms.synonyms(title, inner) == out


def test_redirects():
    assert synonyms.redirect_target("旧名", "<text>#REDIRECT [[新名]]") == ["新名"] and synonyms.redirect_target("旧名", "<text>#転送 [[頁|札]]") == ["札"]
    assert synonyms.redirect_target("旧名", "<text>#REDIRECT [[新名#節]]") == [] and synonyms.redirect_target("旧名", "<text>#REDIRECT [[旧名 (町)]]") == []
    assert synonyms.redirect_target("旧名", "<text>#REDIRECT [[新名]] # x", whole_rest=False) == ["新名"]


@pytest.mark.parametrize("bullets, out", [
    ("* [[甲山]] - 山の名。", ["甲山"]), ("* 川の意味については[[乙川]]を参照。", ["乙川"]), ("* [[丙社]]", ["丙社"]), ("* 略語のこと。[[丁会]]", ["丁会"]), ("* [[戊]]、[[己]]なども参照", ["戊", "己"]),
    ("* 題の[[庚市]]、[[辛市]] - 二つの市。", ["庚市", "辛市"]), ("* [[庚市]]、[[辛市]] - 二つの市。", []), ("* アルバム [[壬]]を参照。", []),
])
def test_disambiguation(bullets, out):
    found = synonyms.disambiguation_targets("題", f"<text>題\n{bullets}\n{{{{aimai}}}}\n")
    assert set(found) == set(out)


def test_word_lists_and_sentences():
    names = synonyms.Names("題名")
    names.add_list("「甲乙」、『丙丁』、[[頁|札]]、裸")
    assert names.found == ["甲乙", "丙丁", "頁", "札"]
    assert synonyms.sentences("一。 二.三") == [" 一。 ", " 二. ", "三"] and not synonyms.admissible("題", "1月") and not synonyms.admissible("題", "abc") and synonyms.admissible("題", "NHK")


# ---- characters
CAST = "<text>文\n== 登場人物 ==\n; 山田 太郎（やまだ たろう）\n: 声 - [[川本 一]]\n: 主役。\n; 花子（はなこ）\n: 演 - [[林 二]]、[[森 三]]\n== 音楽 ==\n"


def test_characters():
    rows = [c.as_row() for c in characters.find_characters("劇", CAST)]
    assert rows == [
        {"reading": "やまだたろう", "name": "山田太郎", "actor1": "川本 一", "actor2": "", "actor3": ""},
        {"reading": "はなこ", "name": "花子", "actor1": "林 二", "actor2": "森 三", "actor3": ""},
    ]
    assert characters.find_characters("劇", "<text>何も") == []
    person = characters.find_characters("海子", "<text>'''海子'''（うみこ）は、[[漫画]]に登場する[[架空の人物]]。")
    assert [c.as_row()["reading"] for c in person] == ["うみこ"]


def test_layouts():
    heading = "=== 山田太郎（やまだたろう） ===\n: 声 - [[林 二]]\n=== 川花子（かわはなこ） ===\n* 演 - [[森 三]]\n"
    assert [c.name for c in characters.parse_cast("劇", "\n== 登場人物 ==\n" + heading)] == ["山田太郎", "川花子"]
    bullets = "== 登場人物 ==\n* 山田太郎（やまだたろう）：[[林 二]]\n* 川花子（かわはなこ）：[[森 三]]\n* 海次郎（うみじろう）\n"
    assert [(c.name, c.reading, c.actors) for c in characters.parse_cast("劇", bullets)][:2] == [("山田太郎", "やまだたろう", ("林 二",)), ("川花子", "かわはなこ", ("森 三",))]
    table = "== 登場人物 ==\n{| class=wikitable\n|-\n|山田太郎||やまだたろう||[[林 二]]\n|-\n|川花子||かわはなこ||[[森 三]]\n|}\n"
    assert len(characters.parse_cast("劇", table)) == 2


def test_character_tokens():
    assert characters.tokens("山田（やまだ）、[[林 二|x]]", True) == ["山田", "やまだ", "[林 二"] and characters.tokens("声 - [[林]]", False) == ["声", "林"]
    assert characters.agrees("たろう", "タロウ") and not characters.agrees("たろう", "はなこ") and characters.agrees("太郎", "はなこ") and not characters.agrees("太郎", "")


# ---- phonemes
def test_phonemes():
    assert phonemes.to_kana("K AE1 T") == "きゃと" and phonemes.to_kana("B IY0") == "びー" and phonemes.to_kana("") == "" and phonemes.to_kana("M AH0") == "ま"
    assert phonemes.to_kana("S T ER", ((1, "S T ER", "すたー"),)) == "すたー" and len(phonemes.syllables()) == len(phonemes.GRID) * len(phonemes.VOWELS)


def test_patterns_compile():
    assert re.compile(synonyms.t.DATE.replace("\\z", "\\Z"))


def test_keyboard():
    from kotonoha.functions import keyboard

    assert keyboard.convert("nihongo", "r") == "にほんご" and keyboard.convert("gakkou", "r") == "がっこう" and keyboard.convert("kyouto", "r") == "きょうと" and keyboard.convert("nyaa", "r") == "にゃあ"
    assert keyboard.convert("にほんご", "R") == "nihongo" and keyboard.convert("がっこう", "R") == "gakkou" and keyboard.convert("かー", "R") == "kaa"
    assert keyboard.convert("t@", "K") == "が" and keyboard.convert("がぱ", "k") == "t@f["


def test_later_actor_lines():
    text = ("文\n== 登場人物 ==\n=== 海野・桜 ===\n（うみの・さくら）\n\n「海野」は海の名より。\n\n[[声優|声]]：[[新田 良]]\n\n=== 山川 葉 ===\n（やまかわ よう）\n説明。\n声：[[林 二]]\n声：[[森 三]]\n"
            "=== 無役 ===\n（むやく）\n説明だけ。\n=== 列 ===\n* 声：[[川 四]]\n==== 深い ====\n（ふかい）\n\n声：[[川 四]]\n=== [[鎖]] ===\n[[鎖]]\n\n声：[[川 四]]\n=== 主な人物 ===\n（おもな）\n\n声：[[川 四]]\n== 外 ==\n")  # fmt: skip
    known = (("^劇$", "later3"),)
    got = [tuple(c.as_row().values())[:3] for c in characters.find_characters("劇", text, known=known)]
    assert got == [("うみのさくら", "海野・桜", "新田 良"), ("やまかわよう", "山川葉", "林 二")]
    assert [c.name for c in characters.find_characters("劇", text, known=(("劇", "later4"),))] == ["深い"]
    assert characters.find_characters("ギャラクシーエンジェルの登場人物", text)[0].actors == ("新田 良",)


@pytest.mark.parametrize("word, noise", [("銀座", False), ("歌舞伎座", False), ("宝座", False), ("魚座", True), ("昭和時代", False), ("少年時代", True), ("限定版", False), ("TV版", True), ("予告のみ", False), ("OVAのみ", True), ("3丁目の夕日", True), ("第2話", True), ("TVSP1", True)])
def test_noise_words_are_exact(word, noise):
    assert characters.no_word(word) == noise


def test_rule_trie_is_an_alternation_in_order():
    import random

    rng = random.Random(8)
    for _ in range(300):
        rules = {"".join(rng.choices("ab ", k=rng.randint(1, 4))): f"<{i}>" for i in range(rng.randint(1, 12))}
        text = "".join(rng.choices("abc ", k=rng.randint(0, 40)))
        pattern = re.compile("|".join(map(re.escape, rules)))
        assert phonemes.RuleTrie(rules).rewrite(text) == pattern.sub(lambda m: rules[m[0]], text)
    assert phonemes.to_kana("S T ER0", ((1, "S T ER", "すたー"), (1, "S T", "すと"))) == "すたー"
    assert phonemes.to_kana("S T ER0", ((1, "S T", "すと"), (1, "S T ER", "すたー"))) == "すと" + phonemes.to_kana("ER0")


def test_native_forms_of_scans(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(12)
    texts = ["".join(rng.choices(["[[", "]]", "a", "b ", "漢", "."], weights=[1, 1, 3, 3, 1, 1], k=rng.randint(0, 25))) for _ in range(300)] + ["", None, "[[", "]]", "[[a]]" * 3000, "x" * 50_000 + "[[y]]z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    rows = df.select("t", w.snip_column(t, "[[", "]]").alias("snip"), w.first_of_column(t, "漢", "]]", "b").alias("first"), readings.longest_piece_column(t, ".").alias("piece")).collect()
    for r in rows:
        if r["t"] is None:
            assert (r["snip"], r["first"], r["piece"]) == (None, None, None)
            continue
        hit = w.first_of(r["t"], ("漢", "]]", "b"))
        assert (r["snip"], r["first"], r["piece"]) == (w.snip(r["t"], "[[", "]]"), hit and hit[0] + 1, readings.longest_piece(r["t"], ".")), r["t"][:80]
