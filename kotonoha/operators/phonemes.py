"""English phonemes to kana.

Stress digits go first. Then rules rewrite the phoneme string stage by stage; within a stage the first listed rule that
fits a place wins. Built in are the word-initial rules, the single-phoneme rules and a two-phoneme stage that is computed
from the kana grid: a consonant and a vowel give one syllable, unless the pair is listed as irregular. Longer rules are a
parameter: a table of (stage, pattern, kana) rows, as read by ``sources.pages.read_rules``; its rows come before all others.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Rules at the start of a word, and rules of single phonemes. A pattern is a list of phonemes.
INITIAL = (("M AH", "ま"), ("K IH", "き"), ("AA N", "おん"))
SINGLE = (
    ("ZH", "ず"), ("AH", "あ"), ("AW", "ぁ"), ("AA", "あー"), ("AE", "あー"), ("EH", "え"), ("ER", "えあ"), ("EY", "えい"), ("NG", "んぐ"),
    ("IH", "え"), ("IY", "い"), ("CH", "ち"), ("JH", "じ"), ("AY", "あい"), ("OW", "おー"), ("SH", "しゅ"), ("AO", "おー"), ("UW", "うー"), ("TH", "す"),
    ("B", "ぶ"), ("D", "ど"), ("F", "ふ"), ("G", "ぐ"), ("K", "く"), ("L", "る"), ("M", "む"), ("N", "ん"), ("P", "ぷ"), ("R", "あ"),
    ("S", "す"), ("T", "と"), ("V", "ぶ"), ("W", "う"), ("Y", "い"), ("Z", "ず"),
)
# Pairs (and a few triples) whose kana are not those of the grid, or that are no syllable of it.
IRREGULAR = (
    ("G AA", "ごっ"), ("HH EH", "へっ"), ("NG K", "んく"), ("ER TH", "あーす"), ("HH AO", "ふぉ"), ("CH IH", "ちっ"), ("IY T", "いーと"), ("F ER", "ふぁ"), ("JH UW", "じゅ"), ("IH M", "えん"),
    ("IH NG", "ん"), ("F AO", "ふぁ"), ("L IH", "りっ"), ("AW T", "あうと"), ("EH G", "えっぐ"), ("CH IY", "っち"), ("V AH", "ぶ"), ("S EH", "せっ"), ("AO R", "あー"), ("HH IH", "ひー"),
    ("F EY", "ふぇ"), ("T AH", "とぅ"), ("T UW", "とぅ"), ("W AH", "うぉ"), ("W OW", "うぉ"), ("HH AE F", "はーふ"), ("HH AE K", "はっく"), ("CH AO", "ちょ"), ("D AA", "ど"), ("D AO", "ど"),
    ("D UW", "どぅ"), ("L EY", "れ"), ("S AO", "そ"), ("L AH", "れ"), ("F AH", "ふぃ"), ("HH AH", "へ"), ("P AW", "ぷぁ"), ("P ER", "ぺー"), ("HH OW", "ほ"), ("AH P", "あっぷ"),
    ("IH K", "えく"), ("AH L", "うる"), ("T OY", "とーい"), ("T AE", "たっ"), ("AW ER", "わー"), ("K AE", "きゃ"), ("L UW", "りゅー"), ("AO F", "おふ"), ("OY L", "おいる"), ("K IH", "きっ"),
    ("D AW", "どっ"), ("N UW", "にゅー"), ("T AY", "てぃ"), ("D IY", "でぃ"), ("B IH", "びっ"), ("B AH", "ばっ"), ("AE L", "あー"), ("T IY", "てぃ"), ("V IY", "びぃ"), ("AE M", "あん"),
    ("AH N", "あん"), ("AA N", "あん"), ("B UH", "ぶっ"), ("R UH", "ろっ"), ("Y UH", "ろぉ"), ("P UH", "ぷっ"), ("CH UH", "ちっ"), ("N UH", "ぬっ"), ("M UH", "むっ"), ("HH UH", "はっ"),
    ("S UH", "しっ"), ("K UH", "くっ"), ("F UH", "ふっ"), ("SH UH", "しっ"), ("Z UH", "ずっ"), ("L UH", "ろっ"), ("G UH", "ぐっ"), ("SH AA", "しゃー"), ("T AA", "と"), ("V AA", "ぶぁ"),
    ("HH AA", "はぁ"), ("K AA", "こー"), ("S AA", "すっ"), ("L AA", "ろっ"), ("M AA", "まー"), ("ER OW", "えあろ"), ("D AE", "だっ"), ("AH D", "あど"), ("M IH", "みい"), ("AE D", "あーど"),
    ("AE N", "あん"), ("R ER", "やー"), ("Z IH", "じー"), ("SH AH", "しょ"), ("S AH", "すっ"), ("R AH", "ろー"), ("R AA", "ろ"), ("EY P", "あぷっ"), ("AE P", "あぷっ"), ("P OW", "ぽーす"),
    ("F AA", "ふぉっ"), ("N D", "んど"), ("L Z", "るず"), ("AA R", "あー"), ("ER IH", "あり"), ("M Z", "むず"), ("ER EY", "あれい"), ("AE S", "あす"), ("AA S", "あす"), ("K S", "くす"),
    ("SH OW", "しょう"), ("K R AE", "くら"), ("K R AO", "くろ"), ("G R AE", "ぐら"), ("EH R", "えあー"), ("P AO R", "ぽー"), ("SH IH", "しっ"), ("W IH", "うい"), ("DH IY", "でぃ"), ("F AO R", "ふぉー"),
    ("IH L", "える"), ("EH L", "える"), ("ER AA", "らー"), ("D AH", "だー"), ("K T", "くと"), ("F IH", "ふぃー"), ("T W", "とぅ"), ("M IY", "みぃ"), ("NG ER", "んがー"), ("IH CH", "ぴっち"),
    ("P AH", "ぷ"), ("OW L", "おーる"), ("AO N", "おん"), ("IH N", "いん"), ("N EH", "ねっ"), ("CH EY", "ちぇ"), ("V EY", "べ"), ("AY S", "あいす"), ("B AA", "ぼっ"), ("B OY", "ぼーい"),
    ("AE F", "あふ"),
)
#: Consonants with their kana before a, i, u, e, o.
GRID = {
    "B": "ば び ぶ べ ぼ", "CH": "ちゃ ち ちゅ ちぇ ちょ", "D": "だ でぃ どぅ で ど", "DH": "ざ じ ず ぜ ぞ", "F": "ふぁ ふぃ ふ ふぇ ふぉ", "G": "が ぎ ぐ げ ご",
    "HH": "は ひ ふ へ ほ", "JH": "じゃ じ じゅ じぇ じょ", "K": "か き く け こ", "L": "ら り る れ ろ", "M": "ま み む め も", "N": "な に ぬ ね の",
    "P": "ぱ ぴ ぷ ぺ ぽ", "R": "ら り る れ ろ", "S": "さ し す せ そ", "SH": "しゃ し しゅ しぇ しょ", "T": "た てぃ とぅ て と", "TH": "さ し す せ そ",
    "V": "ば び ぶ べ ぼ", "W": "わ うぃ うっ うぇ うぉ", "Y": "や い ゆ いえ よ", "Z": "ざ じ ず ぜ ぞ", "ZH": "じゃ じ じゅ じぇ じょ",
}
#: Vowels: which column of the grid they take, and what follows the syllable.
VOWELS = {
    "AA": (0, ""), "AE": (0, ""), "AH": (0, ""), "ER": (0, "ー"), "AY": (0, "い"), "AW": (0, "う"), "IH": (1, ""), "IY": (1, "ー"), "UH": (2, ""), "UW": (2, "ー"),
    "EH": (3, ""), "EY": (3, "ー"), "AO": (4, "ー"), "OW": (4, "ー"), "OY": (4, "い"),
}


def syllables() -> list[tuple[str, str]]:
    """The two-phoneme rules of the grid."""
    return [(f"{c} {v}", row.split()[col] + tail) for c, row in GRID.items() for v, (col, tail) in VOWELS.items()]


class RuleTrie:
    """Rules as a trie of characters. At a place the first listed of the rules that fit wins, however long it is.

    A place is walked once down the trie, so its cost is the longest rule's length and not the number of rules.
    """

    def __init__(self, rules: dict[str, str]):
        self.root: dict = {}
        for rank, (pattern, kana) in enumerate(rules.items()):
            node = self.root
            for letter in pattern:
                node = node.setdefault(letter, {})
            node.setdefault("", (rank, len(pattern), kana))

    def rewrite(self, text: str) -> str:
        """The text with all fitting places replaced, from left to right."""
        out, done, at = [], 0, 0
        while at < len(text):
            node, best, i = self.root.get(text[at]), None, at + 1
            while node is not None:
                if "" in node and (best is None or node[""] < best):
                    best = node[""]
                node, i = node.get(text[i]) if i < len(text) else None, i + 1
            if best is None:
                at += 1
                continue
            out += [text[done:at], best[2]]
            done = at = at + best[1]
        return "".join(out) + text[done:]


@lru_cache(maxsize=16)
def _stages(extra: tuple[tuple[int, str, str], ...]) -> list[RuleTrie]:
    built = {0: [("  " + p, k) for p, k in INITIAL], 1: [], 2: [*IRREGULAR, *syllables()], 3: list(SINGLE)}
    out = []
    for stage in sorted(set(built) | {s for s, *_ in extra}):
        rows: dict[str, str] = {}
        # A row of digits can never fit, since stress is dropped before.
        for pattern, kana in [(p, k) for s, p, k in extra if s == stage] + built.get(stage, []):
            rows.setdefault(" " + pattern, " " + kana)
        if rows:
            out.append(RuleTrie(rows))
    return out


def to_kana(phonemes: str, extra: tuple[tuple[int, str, str], ...] = ()) -> str:
    """Hiragana of a phoneme string such as ``HH AH0 L OW1``."""
    text = "   " + re.sub("[012]", "", phonemes) + " "
    for stage in _stages(extra):
        text = stage.rewrite(text)
    return text.replace(" ", "")
