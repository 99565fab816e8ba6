"""URL filter: pattern rules found by their rarest token, so that a URL meets only the few expressions that may fit.

Rules are regular expressions. A rule's tokens are derived from the parsed expression: literal runs of letters and digits
that every match holds, with something else, or an end of the text, on both sides; where that is certain of one side only,
the run is the end or the beginning of a token. Each rule is indexed by the one of its tokens that the fewest URLs hold, as
counted over all URLs. A URL's distinct tokens, and their ends and beginnings in the lengths that rules ask for, fetch
candidate rules by an equi-join, and only candidates run their expressions. A rule that demands nothing of the kind has no
place in the index and runs on every URL; of the query's rules none does. Everything is DataFrame functions.

Base rules (host, path) hold on a host and its subdomains for paths that start with theirs; of those that fit the longest
decides. Without one the pattern rules decide: blocked if any blocking pattern fits, else allowed.

URLs are grouped first, so equal rows are judged once and one shuffle does all; a hot host is no hot key. The rules' side
is broadcast while it has at most ``BROADCAST_RULES`` rows and joined by shuffle beyond.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no base rule, and is judged by the patterns
(which do not fit an empty host); repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 50_000
INLINE_RULES = 200  # up to so many, expressions are literals of the plan and compiled once; beyond, a column
TOKEN = "[a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLAIN = frozenset(map(ord, _UPPER + _LOWER + "0123456789"))


@dataclass(frozen=True)
class Rule:
    """``regex`` runs on ``host#path#`` (host lower-cased); neither part can hold the mark."""

    name: str
    regex: str
    verdict: str
    length: int = -1  # of a base rule; -1 marks a pattern

    @property
    def tokens(self) -> tuple[str, ...]:
        """Keys of the index: ``whole`` tokens, ``*ends`` and ``beginnings*`` of tokens."""
        return keys_of(self.regex)


def _in_set(items) -> bool:
    """Whether a set of characters holds a letter or digit."""
    if items[0][0] is op.NEGATE:
        taken = {c for kind, x in items[1:] for c in (range(x[0], x[1] + 1) if kind is op.RANGE else [x] if kind is op.LITERAL else [])}
        return not _PLAIN <= taken
    return any((kind is op.LITERAL and x in _PLAIN) or (kind is op.RANGE and any(x[0] <= c <= x[1] for c in _PLAIN)) or kind is op.CATEGORY for kind, x in items)


def _edge(items: list, last: bool, beyond: bool) -> bool:
    """Whether a letter or digit may stand at the end (``last``) or the beginning of what the items match; ``beyond`` is the
    answer for what lies further on, which counts where the items match nothing."""
    for kind, x in items[-1:] if last else items[:1]:
        if kind is op.LITERAL:
            return x in _PLAIN
        if kind is op.IN:
            return _in_set(x)
        if kind is op.AT:
            return x not in (op.AT_BEGINNING, op.AT_BEGINNING_STRING, op.AT_END, op.AT_END_STRING, op.AT_BOUNDARY)
        if kind is op.SUBPATTERN:
            return _spliced(items, list(x[3]), last, beyond)
        if kind is op.BRANCH:
            return any(_spliced(items, list(way), last, beyond) for way in x[1])
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, _, inner = x
            return _spliced(items, list(inner), last, beyond) or (least == 0 and _spliced(items, [], last, beyond))
        return True  # any character, classes, look-arounds: nothing is known
    return beyond


def _spliced(items: list, by: list, last: bool, beyond: bool) -> bool:
    """``_edge`` with an item at the asked end replaced by others."""
    rest = items[:-1] if last else items[1:]
    return _edge([*rest, *by] if last else [*by, *rest], last, beyond)


def keys_of(regex: str) -> tuple[str, ...]:
    """What every match holds, lower-cased: ``token`` as a whole one, ``*token`` as a token's end, ``token*`` as its beginning."""
    items, found, i = list(parser.parse(regex)), [], 0
    while i < len(items):
        j = i
        while j < len(items) and items[j][0] is op.LITERAL and items[j][1] in _PLAIN:
            j += 1
        if j > i:
            before, after = _edge(items[:i], True, True), _edge(items[j:], False, True)
            if not (before and after):
                found.append("*" * before + "".join(chr(x) for _, x in items[i:j]).lower() + "*" * after)
        i = max(j, i + 1)
    return tuple(dict.fromkeys(found))


def whole_tokens(regex: str) -> tuple[str, ...]:
    """Tokens that whatever the expression matches holds whole, lower-cased; none if that is not certain."""
    return tuple(k for k in keys_of(regex) if "*" not in k)


def base_rule(verdict: str, text: str) -> Rule:
    """A rule like ``example.org/es/``: host, then path."""
    host, slash, path = text.partition("/")
    return Rule(text, rf"^(?:[^#]*\.)?{re.escape(host.translate(str.maketrans(_UPPER, _LOWER)))}#{re.escape(slash + path)}", verdict, len(text))


def pattern_rule(name: str, regex: str) -> Rule:
    return Rule(name, regex, "block")


# Fixed values of the query.
BASE_RULES = (
    base_rule("allow", "org/"),
    base_rule("block", "example.org/es/"),
    base_rule("block", "example.org/en/1"),
    base_rule("allow", "com/fr/"),
    base_rule("block", "com/de/"),
)
PATTERN_RULES = (
    pattern_rule("pills", r"^(?:[^#]*\.)?cheap-pills\."),
    pattern_rule("spam-farm", r"^(?:[^#]*\.)?spam-farm\."),
    pattern_rule("casino", r"^(?:[^#]*[.-])?casino[.-]"),
    # Letters may stand right before "free", and "downloads" may stand for "download": found by the end and the beginning of tokens.
    pattern_rule("free-download", r"^[^#]*free-downloads?[.-]"),
    pattern_rule("bets", r"^(?:[^#]*[.-])?bets[.-]"),
    pattern_rule("betting", r"^(?:[^#]*[.-])?betting[.-]"),
    pattern_rule("ads", r"^(?:[^#]*[.-])?ads[.-]"),
    pattern_rule("adult", r"^(?:[^#]*[.-])?adult[.-]"),
    pattern_rule("click-tracker", r"^(?:[^#]*\.)?(?:click|track)\.[^#]+#/redirect[/#]"),
    pattern_rule("click-out", r"^(?:[^#]*\.)?(?:click|track)\.[^#]+#/out[/#]"),
)


def host_and_path(url):
    """Columns host and path of a URL column."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _affixes(tokens: Column, n: int, last: bool) -> Column:
    """Keys of the last or first ``n`` characters of the tokens that have so many."""
    long_enough = F.filter(tokens, lambda t: F.char_length(t) >= n)
    return F.transform(long_enough, lambda t: F.concat(F.lit("*"), F.right(t, F.lit(n))) if last else F.concat(F.left(t, F.lit(n)), F.lit("*")))


def filtered_urls(pages: DataFrame, base: tuple[Rule, ...] = BASE_RULES, patterns: tuple[Rule, ...] = PATTERN_RULES) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one for each row of ``pages``."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("copies")).select("page_id", "url", "copies", host.alias("host"), path.alias("path"))
    rules = [*base, *patterns]
    whole = F.regexp_extract_all(F.translate(F.concat("host", F.lit("#"), "path"), _UPPER, _LOWER), F.lit(f"({TOKEN})"), F.lit(1))
    # Ends and beginnings of tokens in the lengths that some rule demands.
    ends = sorted({len(t) - 1 for r in rules for t in r.tokens if t[0] == "*"})
    heads = sorted({len(t) - 1 for r in rules for t in r.tokens if t[-1] == "*"})
    parts = [_affixes(whole, n, last) for lengths, last in ((ends, True), (heads, False)) for n in lengths]
    tokens = F.array_distinct(F.concat(whole, *parts))
    wanted = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in r.tokens], "rule_id int, token string")
    small = wanted.count() <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda df: df)
    # How many URLs hold each token that some rule demands; then each rule's rarest.
    held = urls.select(F.explode(tokens).alias("token")).join(hint(wanted.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    index = wanted.join(hint(held), "token", "left").groupBy("rule_id").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    facts = spark.createDataFrame([(i, r.name, r.regex, r.verdict, r.length) for i, r in enumerate(rules)], "rule_id int, name string, regex string, verdict string, length int")
    index = facts.join(hint(index), "rule_id")
    tried = urls.withColumn("token", F.explode_outer(tokens)).join(hint(index), "token", "left")
    # Base rules before patterns, longest first; among patterns the first by name.
    place = F.concat("host", F.lit("#"), "path", F.lit("#"))
    fits = F.rlike(place, F.col("regex"))
    if len(rules) <= INLINE_RULES:
        fits = F.coalesce(*[F.when(F.col("rule_id") == i, place.rlike(r.regex)) for i, r in enumerate(rules)], F.lit(False))
    best = F.max(F.when(fits, F.struct("length", F.col("verdict").alias("v"), F.col("name").alias("r"))))
    judged = tried.groupBy("page_id", "url", "copies", "host", "path").agg(best.alias("best"))
    # Rules without a token are in no index: every URL meets them.
    loose = [F.when(place.rlike(r.regex), F.struct(F.lit(r.length).alias("length"), F.lit(r.verdict).alias("v"), F.lit(r.name).alias("r"))) for r in rules if not r.tokens]
    if loose:
        judged = judged.withColumn("best", F.greatest("best", F.array_max(F.array(*loose))))
    return (
        judged
        .withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
        .select(
            "page_id", "host", "path",
            F.when(F.col("best.length") >= 0, F.col("best.r")).alias("rule"), F.coalesce("best.v", F.lit("allow")).alias("verdict"),
        )
    )


#: The same judgement in DuckDB: every URL against every rule.
ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(host_of, path_of, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), hit AS (
  SELECT page_id, host, path, (SELECT max_by(host_of || path_of || ' ' || v, length(host_of || path_of)) FROM r
    WHERE (p.host = host_of OR ends_with(p.host, '.' || host_of)) AND starts_with(p.path, path_of)) AS best FROM p
)
SELECT page_id, host, path, split_part(best, ' ', 1) AS rule,
       CASE WHEN best IS NOT NULL THEN split_part(best, ' ', 2)
            WHEN regexp_matches(host, '(?s)^(.*\.)?(cheap-pills|spam-farm)\.') OR regexp_matches(host, '(?s)^(.*[.-])?(casino|bets|betting|ads|adult)[.-]')
              OR regexp_matches(host, 'free-downloads?[.-]')
              OR (regexp_matches(host, '(?s)^(.*\.)?(click|track)\..') AND regexp_matches(path, '^/(redirect|out)(/|$)')) THEN 'block'
            ELSE 'allow' END AS verdict
FROM hit
"""
