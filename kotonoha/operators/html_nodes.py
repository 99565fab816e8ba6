"""Pages as a table of nodes, and CSS selectors over it.

``node_table`` parses every page once into rows of numbers, tags and attributes, without the page itself. A selector is then
worked on step by step, all pages at once: an element lies inside an earlier match when the matches before it reach as far as
its own number (a running maximum over the page), children are grouped with their parent, and siblings look along their
parent's children. So no pairs of ancestors and descendants are made, and a page of many nodes costs a sort for each step.
``select`` cuts markup and text of what matched out of the pages.

Selectors: ``tag``, ``*``, ``#id``, ``.class``, ``[name]``, ``[name=value]`` with ``= ~= ^= $= *=``, ``:first-child``,
``:last-child``, ``:only-child``, ``:nth-child(number, odd or even)``, ``:not(...)`` of one simple selector, joined by blanks, ``>``, ``+`` and
``~``, and lists of these with commas.

Defined cases: a null page has no nodes; equal rows give equal results each; a null key is a key like others, and pages that
share a key are told apart by their content; other columns of the pages are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as h

_PAGES = 256  # pages of a batch of nodes
_NODE = "node int, parent int, depth int, last int, place int, places int, tag string, attributes map<string,string>, open int, start int, stop int, close int, text_from int, text_to int"
_SIMPLE = re.compile(r"\s*(?:(\*|[A-Za-z][A-Za-z0-9-]*)|\#([^\s#.\[:>+~,()]+)|\.([^\s#.\[:>+~,()]+)|\[\s*([^\s=~^$*\]]+)\s*(?:([~^$*]?=)\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\]]+))\s*)?\]|:([a-z-]+)(?:\(([^()]*(?:\[[^\]]*\])?)\))?)")
_BETWEEN = re.compile(r"\s*([>+~,])\s*|\s+")


@dataclass(frozen=True)
class Test:
    """One simple selector: ``kind`` tag, attribute or child; ``negated`` inside ``:not``."""

    kind: str
    name: str
    how: str = ""
    value: str = ""
    negated: bool = False

    def column(self) -> Column:
        if self.kind == "tag":
            found = F.col("tag") == self.name if self.name != "*" else F.lit(True)
        elif self.kind == "child":
            place, places = F.col("place"), F.col("places")
            found = {"first": place == 1, "last": place == places, "only": places == 1, "odd": place % 2 == 1, "even": place % 2 == 0}.get(self.name)
            if found is None:
                found = place == int(self.name)
        else:
            held = F.element_at("attributes", self.name)
            value = F.lit(self.value)
            found = {
                "": held.isNotNull(), "=": held == value, "~=": F.array_contains(F.split(F.coalesce(held, F.lit("")), r"\s+"), self.value) & F.lit(self.value != "" and not re.search(r"\s", self.value)),
                "^=": F.startswith(held, value) & F.lit(self.value != ""), "$=": F.endswith(held, value) & F.lit(self.value != ""), "*=": F.contains(held, value) & F.lit(self.value != ""),
            }[self.how]
        found = F.coalesce(found, F.lit(False))
        return ~found if self.negated else found


#: Steps of one selector: how it stands to the one before (blank for the first) and what it asks for.
Steps = list[tuple[str, list[Test]]]


def _test(m: re.Match) -> Test:
    tag, ident, cls, name, how, *values, pseudo, argument = m.groups()
    if tag:
        return Test("tag", tag.lower())
    if ident:
        return Test("attribute", "id", "=", ident)
    if cls:
        return Test("attribute", "class", "~=", cls)
    if name:
        return Test("attribute", name.lower(), how or "", next((v for v in values if v is not None), ""))
    if pseudo in ("first-child", "last-child", "only-child") and argument is None:
        return Test("child", pseudo.split("-")[0])
    if pseudo == "nth-child" and re.fullmatch(r"\s*(odd|even|[0-9]+)\s*", argument or ""):
        return Test("child", argument.strip())
    if pseudo == "not" and argument:
        inner = _SIMPLE.fullmatch(argument.strip())
        if inner and inner[9] != "not":
            found = _test(inner)
            return Test(found.kind, found.name, found.how, found.value, True)
    raise ValueError(f"unknown selector: {m[0].strip()}")


def parse_selector(selector: str) -> list[Steps]:
    """The alternatives of a selector, each as steps from left to right."""
    alternatives: list[Steps] = [[]]
    text, at, relation = selector.strip(), 0, ""
    while True:
        tests = []
        while (m := _SIMPLE.match(text, at)) and not (tests and (m[0][0].isspace() or m[1])):
            tests.append(_test(m))
            at = m.end()
        if not tests:
            raise ValueError(f"a selector is missing at {at} in {selector!r}")
        alternatives[-1].append((relation, tests))
        if at == len(text):
            return alternatives
        m = _BETWEEN.match(text, at)
        if not m:
            raise ValueError(f"not understood at {at} in {selector!r}")
        at, relation = m.end(), m[1] or " "
        if relation == ",":
            alternatives.append([])
            relation = ""


# ---------------------------------------------------------------- the table


def node_table(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Rows (key, digest, node, parent, depth, last, place, places, tag, attributes, open, ... text_to) of all elements."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _PAGES):
                part = batch.slice(at, _PAGES)
                found = [h.parse(page)[0] if page is not None else [] for page in part.column(2).to_pylist()]
                owner = pa.array([i for i, nodes in enumerate(found) for _ in nodes], pa.int64())
                columns = list(zip(*[n for nodes in found for n in nodes], strict=True)) or [()] * len(h.Node._fields)
                arrays = [
                    pa.array([list(x.items()) for x in c], pa.map_(pa.string(), pa.string())) if name == "attributes" else pa.array(c, pa.string() if name == "tag" else pa.int32())
                    for name, c in zip(h.Node._fields, columns, strict=True)
                ]
                yield pa.record_batch([part.column(0).take(owner), part.column(1).take(owner), *arrays], ["key", "digest", *h.Node._fields])

    given = pages.select(F.col(key).alias("key"), F.xxhash64(html).alias("digest"), F.col(html).alias("html"))
    return given.mapInArrow(run, f"key {kind}, digest long, {_NODE}").withColumnRenamed("key", key)


def matching(nodes: DataFrame, key: str, selector: str) -> DataFrame:
    """The nodes that the selector matches. Every step is a window over the table, so pages are parsed once, however long it is."""
    page = [key, "digest"]
    before = Window.partitionBy(*page).orderBy("node").rangeBetween(Window.unboundedPreceding, -1)
    siblings = Window.partitionBy(*page, "parent").orderBy("place")
    family = Window.partitionBy(*page, "_group")
    alternatives = parse_selector(selector)
    # What each step asks of an element itself is decided first; from then on only numbers are needed.
    asked = {f"_t{i}_{j}": reduce(lambda a, b: a & b, [t.column() for t in tests]) for i, steps in enumerate(alternatives) for j, (_, tests) in enumerate(steps)}
    # Dealt by page once: every window below is within a page, so nothing moves again.
    rows = nodes.withColumns(asked | {"_any": F.lit(False)}).repartition(*page)
    for i, steps in enumerate(alternatives):
        rows = rows.withColumn("_hit", F.col(f"_t{i}_0"))
        for j, (relation, _) in enumerate(steps[1:], 1):
            if relation == ">":
                # Each node stands once among its parent's children and once as the parent of its own.
                roles = F.array(F.struct(F.lit(False).alias("above"), F.col("parent").alias("group")), F.struct(F.lit(True).alias("above"), F.col("node").alias("group")))
                rows = rows.withColumn("_role", F.explode(roles)).withColumns({"_above": F.col("_role.above"), "_group": F.col("_role.group")}).drop("_role")
                rows = rows.withColumn("_met", F.max(F.when(F.col("_above"), F.col("_hit"))).over(family)).where(~F.col("_above")).drop("_above", "_group")
            else:
                met = {
                    " ": F.max(F.when(F.col("_hit"), F.col("last"))).over(before) >= F.col("node"),
                    "+": F.max(F.col("_hit")).over(siblings.rangeBetween(-1, -1)),
                    "~": F.max(F.col("_hit")).over(siblings.rangeBetween(Window.unboundedPreceding, -1)),
                }[relation]
                rows = rows.withColumn("_met", met)
            rows = rows.withColumn("_hit", F.coalesce("_met", F.lit(False)) & F.col(f"_t{i}_{j}")).drop("_met")
        rows = rows.withColumn("_any", F.col("_any") | F.col("_hit"))
    return rows.where("_any").select(nodes.columns)


def select(pages: DataFrame, key: str, selector: str, html: str = "html", decode: Callable[[str], str] = entities.unescape) -> DataFrame:
    """Rows (key, node, tag, attributes, outer_html, inner_html, inner_text) of the elements that match; ``decode`` decodes the text's entities."""
    found = matching(node_table(pages, key, html), key, selector).select(F.col(key).alias("_key"), F.col("digest").alias("_digest"), "node")
    held = found.groupBy("_key", "_digest").agg(F.sort_array(F.collect_set("node")).alias("_nodes"))

    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in batches:
            out = []
            for page, wanted in zip(texts, lists, strict=True):
                nodes, text = h.parse(page, decode)
                mine = [nodes[n] for n in wanted]
                out.append([(n.node, n.tag, n.attributes, page[n.open : n.close], page[n.start : n.stop], text[n.text_from : n.text_to]) for n in mine])
            yield pd.Series(out, dtype=object)

    cut.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    piece = "array<struct<node:int,tag:string,attributes:map<string,string>,outer_html:string,inner_html:string,inner_text:string>>"
    mine = pages.select(F.col(key).alias("_own"), F.xxhash64(html).alias("_hash"), F.col(html).alias("_html")).where("_html is not null")
    both = mine.join(held, F.col("_own").eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_digest")))
    return both.select(F.col("_own").alias(key), F.inline(F.pandas_udf(cut, piece)("_html", "_nodes")))
