"""The text operators under SQL names: ``register(spark)``, then ``SELECT reading(title, inner) FROM pages``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..functions import html, kana, keyboard, wikitext
from ..operators import characters, english, phonemes, readings, synonyms
from .modes import text_udf

_CHARACTER = "reading string, name string, actor1 string, actor2 string, actor3 string"
#: Name -> (function of strings, result type).
FUNCTIONS = {
    "clean_wikitext": (wikitext.clean, "string"),
    "strip_disambiguation": (wikitext.strip_disambiguation, "string"),
    "snip": (wikitext.snip, "string"),
    "infobox": (wikitext.infobox, "string"),
    "section": (wikitext.section, "string"),
    "cut_section": (wikitext.cut_section, "string"),
    "lead_of": (wikitext.lead_of, "string"),
    "head_of": (wikitext.head_of, "string"),
    "kana_convert": (kana.convert, "string"),
    "keyboard_convert": (keyboard.convert, "string"),
    "reading": (readings.reading, "string"),
    "english_word": (english.english_word, "string"),
    "synonyms_of": (synonyms.synonyms, "array<string>"),
    "redirect_target": (synonyms.redirect_target, "array<string>"),
    "disambiguation_targets": (synonyms.disambiguation_targets, "array<string>"),
    "characters_of": (lambda title, inner: [c.as_row() for c in characters.find_characters(title, inner)], f"array<struct<{_CHARACTER.replace(' string', ':string')}>>"),
    "inner_html": (html.inner_html, "string"),
    "inner_text": (html.inner_text, "string"),
    "html_attribute": (html.attribute, "string"),
    "phonemes_to_kana": (phonemes.to_kana, "string"),
}


class CharacterRows:
    """A table function: one row for each character of a page."""

    def eval(self, title: str, inner: str):
        for c in characters.find_characters(title or "", inner or ""):
            yield tuple(c.as_row().values())


def register(spark: SparkSession) -> list[str]:
    """Registers all functions, and ``character_rows`` as a table function; returns their names."""
    for name, (function, kind) in FUNCTIONS.items():
        def nulls_pass(*row, function=function):
            return None if any(x is None for x in row) else function(*row)

        spark.udf.register(name, text_udf(nulls_pass, kind))
    spark.udtf.register("character_rows", udtf(CharacterRows, returnType=_CHARACTER))
    return [*FUNCTIONS, "character_rows"]
