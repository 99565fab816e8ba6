"""Category tags of pages, in native columns: no bracket nests here, so lines and patterns suffice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.charclass import ALNUM

#: A line that is one link, up to its first closing mark.
_LINK_LINE = r"^\[\[(?:(?!\]\]).)*\]\]\z"


def category_of(line: Column) -> Column:
    """Name behind ``Category:``; a space cuts a sort key unless a letter or digit comes after the next character; then a bar."""
    inside = F.regexp_extract(line, r"\[\[Category:(.*?)\]\]", 1)
    # The character behind the one after the first space decides.
    cut = F.regexp_replace(inside, rf"^([^ ]*) .[^{ALNUM}].*$", "$1")
    return F.substring_index(cut, "|", 1)


def categories_of(inner: Column) -> Column:
    """Categories in order of their lines, from behind the first ``>``."""
    body = F.when(F.contains(inner, F.lit(">")), F.regexp_extract(inner, r"(?s)^[^>]*>(.*)\z", 1)).otherwise(inner)
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(_LINK_LINE))
    return F.filter(F.transform(lines, category_of), lambda x: x != "")
