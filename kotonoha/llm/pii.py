"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span classifier decides.

Base spans (e-mail, IP address, card and phone number by fixed patterns and checks) always stay. The method adds spans
that the base patterns miss: bank accounts, keys and tokens, assigned passwords, national ids and phone numbers, spelled-out
addresses, handles and personal names. A broad pattern proposes candidates, and labelers vote on each for, against or not
at all:

* regex: the candidate's own shape (prefixed key, digest length, grouped digits, bracketed ``at``, form of address),
* check: what can be computed of it (IBAN remainder, variety of characters, valid groups, known top-level domain),
* gazetteer: words of a list in it (given names from a file, providers, area codes; sample values vote against),
* context: words before it in English, German, French and Spanish (``call``, ``Passwort``, ``isbn``),
* bounds: what stands right before and after it (assignment or quotes; units and currency vote against).

A Dawid-Skene model without gold labels, with a prior for each shape, gives the labelers' reliabilities by expectation-
maximisation. Its posteriors train a logistic classifier over the votes and over features of the span that the model does
not see: length, share of digits, variety of characters and case. Both run on the table of distinct patterns of votes and
features with their counts over all documents; features are binned, so the table's size is bounded whatever the corpus.

Everything over documents is DataFrame functions. A pattern runs once: its matches are put between marks, and running sums
over the pieces between marks, in blocks, give starts (a text that holds the mark itself is matched and split instead).
Patterns take whole runs with possessive quantifiers, entered at their beginning only, so that time stays linear in a text's
length and nothing is hidden in part. Hiding
spans costs their number times the text's length.

Defined cases: a null text is an empty one and has no spans; repeated rows give repeated results; spans of different
kinds may overlap; method spans that overlap a base span are dropped; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

KINDS = ("email", "ip", "card", "phone")
# Each equals the plain pattern: a run can only be entered at its start, or where the match before ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señora|Señor|Sra|Sr)\.?\x20"
_CAPITAL = r"[A-ZÀ-Þ][a-zß-ÿ]++"
_AT = r"(?:\x20?[(\[](?:at|arroba)[)\]]\x20?|\x20(?:at|arroba)\x20)"
_SPELLED_DOT = r"(?:\x20?[(\[](?:dot|punkt|point|punto)[)\]]\x20?|\x20(?:dot|punkt|point|punto)\x20)"
_DOT = rf"(?:{_SPELLED_DOT}|\.)"
_LABEL = r"[A-Za-z0-9_-]++"
_ASSIGN = r"(?i:password|passwd|passwort|kennwort|contraseña|clave|mot\x20de\x20passe|secret|token|api[_\x20-]?key)[\"']?\x20{0,2}[=:]\x20{0,2}[\"']?"
_PREFIXED = r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsur]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_.-]{10,}+"
#: Shapes by the order in which they are tried on a candidate. ``name`` comes from the gazetteer and forms of address.
_SHAPES = {
    "secret": rf"^(?:{_PREFIXED}|[A-Fa-f0-9]{{24,}}|[A-Za-z0-9_-]{{32,}})$",
    "national": r"^[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}$",
    "phone10": r"^[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}$",
    "spelled": rf"^{_LABEL}(?:{_DOT}{_LABEL}){{0,3}}{_AT}",
    "iban": r"^[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{11,}$",
    "phone": r"^[0-9][0-9\x20./-]+$",
    "handle": r"^@",
    "name": rf"^(?:{_TITLE})?{_CAPITAL}(?:\x20{_CAPITAL})?$",
    "password": r"",
}
_NUMBERS = (
    r"[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    r"0[1-9](?:[\x20.-][0-9]{2}){4}(?![0-9])", r"[679][0-9]{2}(?:[\x20.-][0-9]{3}){2}(?![0-9])", r"9[0-9]{2}(?:\x20[0-9]{2}){3}(?![0-9])",
    r"0[1-9][0-9]{1,4}[\x20/-][0-9]{4,9}(?:[\x20-][0-9]{1,6})?(?![0-9])",
)


def given_names(path: str | None = None) -> tuple[str, ...]:
    """The gazetteer of given names: a file with one name in a line."""
    return tuple((Path(path) if path else Path(__file__).with_name("given_names.txt")).read_text(encoding="utf-8").split())


@cache
def _candidate(names: tuple[str, ...]) -> str:
    """One expression for all candidates; the first alternative that fits at a place counts."""
    iban = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){3,7}+(?:\x20[A-Z0-9]{1,3}+)?)(?![A-Za-z0-9])"
    assigned = _ASSIGN + r"[^\s\"'<>,;]{6,}+"
    person = rf"{_TITLE}{_CAPITAL}(?:\x20{_CAPITAL})?" + (rf"|(?:{'|'.join(names)})\x20{_CAPITAL}" if names else "")
    # Either the at-sign stands in brackets or the dots are words. A label is entered at its beginning only.
    local = rf"(?<![A-Za-z0-9_-]){_LABEL}(?:{_DOT}{_LABEL}){{0,3}}"
    spelled = rf"{local}\x20?[(\[](?:at|arroba)[)\]]\x20?{_LABEL}(?:{_DOT}{_LABEL}){{1,4}}|{local}\x20(?:at|arroba)\x20{_LABEL}(?:{_SPELLED_DOT}{_LABEL}){{1,4}}"
    handle = r"(?<![._%+-])@[A-Za-z0-9_]{2,}+(?![A-Za-z0-9_@.-])"
    return r"(?<![A-Za-z0-9])(?:" + "|".join([iban, assigned, spelled, _PREFIXED, r"[A-Fa-f0-9]{24,}+", *_NUMBERS, r"[A-Za-z0-9_-]{32,}+", handle, person]) + ")"


BEFORE, AFTER = 24, 16  # characters of context
_CONTEXT_FOR = (
    r"(?i)(?:token|secret|key|password|passwd|passwort|kennwort|contraseña|clave|mot de passe|api|auth|ssn|social|iban|konto|compte|cuenta|account|tel|tél|phone|telefon|téléphone|teléfono|call|fax|mobile|handy|móvil|portable|rufen"
    r"|appelez|llame|mail|correo|courriel|contact|kontakt|reach|follow|twitter|user|benutzer|name|nombre|nom|sincerely|grüßen|cordialement|saludos|dear|liebe|cher|estimado)[^A-Za-z0-9]{0,6}$"
)
_CONTEXT_AGAINST = r"(?i)(?:isbn|issn|page|pages|seite|página|vol|no|nr|commit|sha|md5|sha1|sha256|hash|version|id|doi|http|https|www|import|street|straße|rue|calle|saint|sankt|san|article|artikel|figure|table)[^A-Za-z0-9]{0,4}$"
_GAZETTEER_FOR = r"(?i)(?:gmail|yahoo|hotmail|outlook|web\.de|gmx|orange|example|mail|proton|icloud)|^(?:212|213|310|312|415|510|555|617|650|702|713|800|888)[^0-9]|^0(?:30|40|89|69|221|711)[^0-9]|^(?:06|07|91|93)[^0-9]"
_GAZETTEER_AGAINST = r"(?i)(?:000000|123456789|deadbeef|ffffffff|xxxxxx|changeme|your[_-])"
_TLD = r"(?i)(?:com|org|net|info|edu|gov|io|eu|de|fr|es|uk|ch|at|mx)$"
#: At-signs of programs and markup.
_NO_HANDLES = ("@media", "@import", "@param", "@return", "@returns", "@override", "@deprecated", "@property", "@staticmethod", "@classmethod", "@font", "@author")
_MARK = "\x01"
_BLOCK = 500  # matches whose starts are summed up one after the other


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, s, before, after>> of the pattern's matches; offsets are code points.

    ``before`` and ``after`` are the pieces of text to the matches next to it.
    """
    kind = "array<struct<start:int,end:int,s:string,before:string,after:string>>"

    def pieces_of(matches: Column, gaps: Column) -> Column:
        return F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g"), F.slice(gaps, F.lit(2), F.size(matches)).alias("n"))

    def every_second(pieces: Column, first: int) -> Column:
        return F.filter(pieces, lambda x, i: i % 2 == first)

    marked = F.split(F.regexp_replace(text, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    steps = F.when(F.contains(text, F.lit(_MARK)), _let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)), lambda m: pieces_of(m, F.split(text, pattern, -1)))).otherwise(
        _let(marked, lambda p: _let(every_second(p, 1), lambda m: pieces_of(m, every_second(p, 0))))
    )

    def placed(some: Column, start: Column) -> Column:
        def step(acc, x):
            begin = acc["at"] + F.char_length(x["g"])
            end = begin + F.char_length(x["m"])
            one = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("s"), x["g"].alias("before"), x["n"].alias("after"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(some, F.struct(start.cast("int").alias("at"), F.array().cast(kind).alias("out")), step, lambda acc: acc["out"])

    def in_blocks(all_: Column) -> Column:
        # Lengths of blocks are summed first, so no list of all matches grows one by one.
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _BLOCK).cast("int")), lambda b: F.slice(all_, b * _BLOCK + 1, F.lit(_BLOCK)))
        sized = F.transform(blocks, lambda b: F.struct(b.alias("b"), F.aggregate(b, F.lit(0), lambda a, x: a + F.char_length(x["g"]) + F.char_length(x["m"])).alias("l")))
        return _let(sized, lambda z: F.flatten(F.transform(z, lambda x, i: placed(x["b"], F.aggregate(F.slice(z, F.lit(1), i), F.lit(0), lambda a, y: a + y["l"])))))

    return _let(steps, lambda all_: F.when(F.size(all_) == 0, F.array().cast(kind)).when(F.size(all_) <= _BLOCK, placed(all_, F.lit(0))).otherwise(in_blocks(all_)))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the string of digits passes the Luhn test."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _kept(spans: Column, test) -> Column:
    return F.filter(spans, lambda x: test(x["s"]))


def base_spans(text: Column) -> dict[str, Column]:
    """For each kind array<struct<start, end, s>> of the base spans. A cheap test spares most texts the pattern."""
    none = F.array().cast("array<struct<start:int,end:int,s:string,before:string,after:string>>")

    def where(test: Column, spans: Column) -> Column:
        return F.when(test, spans).otherwise(none)

    def n(s):
        return F.char_length(_digits(s))

    return {
        "email": where(F.contains(text, F.lit("@")), _matches(text, _EMAIL)),
        "ip": where(text.rlike(r"[0-9]\.[0-9]"), _kept(_matches(text, _IP), lambda s: s.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"))),
        "card": where(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _kept(_matches(text, _CARD), lambda s: (n(s) >= 12) & (n(s) <= 19) & luhn(_digits(s)))),
        "phone": where(F.contains(text, F.lit("+")), _kept(_matches(text, _PHONE), lambda s: (n(s) >= 9) & (n(s) <= 15))),
    }


def _remainder(s: Column) -> Column:
    """An account number's remainder by 97, its first four characters moved to the end and letters counted from 10."""
    bare = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))

    def step(acc, c):
        letter = c.rlike("[A-Z]")
        value = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (acc * F.when(letter, 100).otherwise(10) + value) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def _candidates(text: Column, names: tuple[str, ...]) -> Column:
    """array<struct<start, end, shape, votes, looks>>: the broad pattern's matches, their labelers' votes (1, 0, -1), and the
    features that only the classifier sees."""
    order = {name: i for i, name in enumerate(_SHAPES)}

    def vote(yes: Column, no: Column) -> Column:
        return (F.when(yes, 1).otherwise(0) - F.when(no, 1).otherwise(0)).cast("int")

    def is_(shape: Column, *wanted: str) -> Column:
        return shape.isin([order[w] for w in wanted])

    def value(x):
        """The candidate without the assignment in front of it."""
        lead = F.regexp_extract(x["s"], f"^{_ASSIGN}", 0)
        s = F.substring(x["s"], F.char_length(lead) + 1, F.char_length(x["s"]))
        return F.struct((x["start"] + F.char_length(lead)).alias("start"), x["end"].alias("end"), s.alias("s"), F.right(F.concat(F.right(x["before"], F.lit(BEFORE)), lead), F.lit(BEFORE)).alias("before"), F.left(x["after"], F.lit(AFTER)).alias("after"))

    def shaped(x):
        s = x["s"]
        shape = F.coalesce(*[F.when(s.rlike(rx), F.lit(i)) for i, rx in enumerate(_SHAPES.values())])
        characters = F.filter(F.split(s, ""), lambda c: c != "")
        digits = F.char_length(F.regexp_replace(s, "[^0-9]", ""))
        return F.struct(*[x[k].alias(k) for k in ("start", "end", "s", "before", "after")], shape.alias("shape"), F.char_length(s).alias("n"), F.size(F.array_distinct(characters)).alias("variety"), digits.alias("digits"))

    def judge(x):
        s, before, shape, n, variety = x["s"], x["before"], x["shape"], x["n"], x["variety"]
        hexadecimal = s.rlike("^[A-Fa-f0-9]{24,}$")
        mixed = s.rlike("[0-9]") & s.rlike("[A-Za-z]")
        # A digest of published data: hexadecimal after a word like commit.
        digest = is_(shape, "secret") & hexadecimal & before.rlike(_CONTEXT_AGAINST)
        regex = vote(
            (is_(shape, "secret") & ~digest & ((hexadecimal & mixed & n.isin(32, 40, 48, 56, 64, 96, 128)) | s.rlike(f"^(?:{_PREFIXED})$")))
            | is_(shape, "phone10", "iban", "spelled") | (is_(shape, "national") & ~s.rlike("^(?:000|666|9)|^...[^0-9]00")) | (is_(shape, "phone") & s.rlike(r"^0[1-9](?:[\x20.-][0-9]{2}){4}$"))
            | (is_(shape, "name") & s.rlike(f"^{_TITLE}")) | (is_(shape, "password") & mixed),
            digest | (hexadecimal & ~mixed) | (is_(shape, "password") & ~s.rlike("[0-9]")),
        )
        check = vote(
            (is_(shape, "iban") & (_remainder(s) == 1)) | (is_(shape, "secret", "password") & ~digest & mixed & (variety >= 7)) | (is_(shape, "national") & ~s.rlike("^(?:000|666|9)|^...[^0-9]00"))
            | (is_(shape, "phone", "phone10") & x["digits"].between(9, 12) & (variety >= 4)) | (is_(shape, "spelled") & s.rlike(_TLD)) | (is_(shape, "handle") & s.rlike("[A-Za-z]") & s.rlike("[0-9_]")),
            (is_(shape, "iban") & (_remainder(s) != 1)) | (is_(shape, "secret", "password") & ((variety <= 4) | ~mixed)) | (is_(shape, "national") & s.rlike("^(?:000|666|9)|^...[^0-9]00"))
            | (is_(shape, "phone", "phone10") & (variety <= 3)) | (is_(shape, "spelled") & ~s.rlike(_TLD)) | (is_(shape, "handle") & F.lower(s).isin(*_NO_HANDLES)),
        )
        known = F.regexp_extract(s, rf"^(?:{_TITLE})?({_CAPITAL})", 1).isin(*names) if names else F.lit(False)
        gazetteer = vote((~is_(shape, "name") & s.rlike(_GAZETTEER_FOR)) | (is_(shape, "name") & known), s.rlike(_GAZETTEER_AGAINST))
        context = vote(before.rlike(_CONTEXT_FOR), before.rlike(_CONTEXT_AGAINST))
        bounds = vote(is_(shape, "secret", "password", "iban") & before.rlike("[\"'=:]\\s*[\"']?$"), x["after"].rlike("(?i)^\\s?(?:km|kg|mb|gb|usd|eur|%|€|\\$)"))
        share = x["digits"] / n
        looks = F.array(
            F.when(n < 8, 0).when(n < 14, 1).when(n < 24, 2).when(n < 41, 3).otherwise(4), F.when(share == 0, 0).when(share < 0.3, 1).when(share < 0.8, 2).otherwise(3),
            F.when(variety < 5, 0).when(variety < 10, 1).otherwise(2), (F.when(s.rlike("[a-z]"), 1).otherwise(0) + F.when(s.rlike("[A-Z]"), 2).otherwise(0)),
        )
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), shape.alias("shape"), F.array(regex, check, gazetteer, context, bounds).alias("votes"), looks.cast("array<int>").alias("looks"))

    return F.transform(F.transform(F.transform(_matches(text, _candidate(names)), value), shaped), judge)


# ---------------------------------------------------------------- the models, on the table of patterns


@dataclass(frozen=True)
class PiiModel:
    """Reliabilities of the labelers and the score of each pattern (shape, votes and, if there are any, features)."""

    prior: dict[int, float]
    reliability: list[float]
    scores: dict[tuple, float]


def _squashed(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(patterns: dict[tuple, int], rounds: int = 25, steps: int = 300) -> PiiModel:
    """EM over votes, then a logistic classifier on shape, votes and features, weighted by counts (their square roots, so that
    one common pattern does not outweigh all others)."""
    if not patterns:
        return PiiModel({}, [], {})
    keys = list(patterns)
    n = np.array([patterns[k] for k in keys], float)
    shapes, votes = np.array([k[0] for k in keys]), np.array([k[1] for k in keys], float)
    kinds, shape = np.unique(shapes, return_inverse=True)
    prior, right = np.full(len(kinds), 0.5), np.full(votes.shape[1], 0.8)  # chance that a vote, if cast, is right
    for _ in range(rounds):
        post = _squashed(np.log(prior / (1 - prior))[shape] + votes @ np.log(right / (1 - right)))
        held = np.bincount(shape, n, len(kinds))
        prior = np.clip((np.bincount(shape, n * post, len(kinds)) + 1) / (held + 2), 0.05, 0.95)
        good = (n[:, None] * np.where(votes > 0, post[:, None], 1 - post[:, None]) * (votes != 0)).sum(0)
        right = np.clip((good + 4) / ((n[:, None] * (votes != 0)).sum(0) + 5), 0.55, 0.99)  # labelers are taken to beat chance
    looks = [tuple(x for part in k[2:] for x in part) for k in keys]
    columns = [np.ones((len(keys), 1)), shape[:, None] == np.arange(len(kinds)), votes > 0, votes < 0]
    for j in range(len(looks[0])):
        value = np.array([x[j] for x in looks])
        columns.append(value[:, None] == np.unique(value))
    x = np.concatenate([np.asarray(c, float) for c in columns], 1)
    weight, heat = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-6)
    share = np.sqrt(n) / np.sqrt(n).sum()
    for _ in range(steps):
        grad = x.T @ (share * (_squashed(x @ weight) - post)) + 1e-4 * weight
        heat += grad * grad
        weight -= 0.5 * grad / np.sqrt(heat)
    return PiiModel(dict(zip(kinds.tolist(), prior.tolist(), strict=True)), right.tolist(), dict(zip(keys, _squashed(x @ weight).tolist(), strict=True)))


def _patterns(found: DataFrame) -> dict:
    rows = found.select(F.explode("candidates").alias("c")).groupBy("c.shape", "c.votes", "c.looks").agg(F.count("*").alias("n")).collect()
    return {(r["shape"], tuple(r["votes"]), tuple(r["looks"])): r["n"] for r in rows}


# ---------------------------------------------------------------- the operator


def _found(docs: DataFrame, keep: Column, names: tuple[str, ...] | None) -> DataFrame:
    """Base spans and candidates of each row beside the column ``keep``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = base_spans(text)

    def bare(kind: str, i: int) -> Column:
        return F.transform(spans[kind], lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    return docs.select(keep, F.sort_array(F.flatten(F.array(*[bare(k, i) for i, k in enumerate(KINDS)]))).alias("base"), _candidates(text, given_names() if names is None else names).alias("candidates"))


def _all_spans(model: PiiModel, threshold: float) -> Column:
    """Base spans and the accepted candidates that overlap none of them."""
    accepted = [x for x, s in model.scores.items() if s >= threshold]
    base = F.col("base")
    names = F.array(*[F.lit(n) for n in _SHAPES])
    if not accepted:
        return base
    wanted = [f"{shape}:{','.join(map(str, (*votes, *looks)))}" for shape, votes, looks in accepted]
    good = F.filter("candidates", lambda c: F.concat_ws(":", c["shape"].cast("string"), F.array_join(F.transform(F.concat(c["votes"], c["looks"]), lambda v: v.cast("string")), ",")).isin(wanted))
    free = F.filter(good, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    more = F.transform(free, lambda c: F.struct(c["start"].alias("start"), (F.lit(len(KINDS)) + c["shape"]).alias("rank"), F.element_at(names, c["shape"] + 1).alias("kind"), c["end"].alias("end")))
    return F.sort_array(F.concat(base, more))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, threshold: float = 0.5, names: tuple[str, ...] | None = None) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one for each row of ``docs``."""
    found = settle(_found(docs, F.col("doc_id"), names))
    model = fit(_patterns(found))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(_all_spans(model, threshold)).alias("spans"))


def redacted(docs: DataFrame, threshold: float = 0.5, names: tuple[str, ...] | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; ``n_chars``, if there, is counted anew."""
    found = settle(_found(docs, F.struct(*docs.columns).alias("doc"), names))
    model = fit(_patterns(found))
    text, spans = F.col("doc.text"), F.col("spans")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        # A span that starts inside one already replaced only lengthens it.
        mark = F.when(x["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], mark).alias("out"))

    clean = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))))
    out = found.withColumn("spans", _all_spans(model, threshold)).select("doc", "spans", F.when(F.size(spans) > 0, clean).otherwise(text).alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size(spans) > 0, F.char_length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return out.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
