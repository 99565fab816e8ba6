"""Mixing sources to target weights by hierarchical budgeting over a domain-language-source tree.

Every node of the tree has a weight among its siblings. A token budget is handed down from the root; a node can take at
most what its documents hold times ``max_epochs``. Where a child cannot use its share, the rest goes to its siblings by
their weights, and only what the siblings cannot take either goes up to be shared among the parent's siblings: with
subtree capacities known from below, that is water-filling at each node from the top, in closed form by window sums over
the siblings. A leaf's quota is met by whole passes over its documents (epochs) and a token-prefix of one more, in an
order drawn from the seed, the epoch and the id.

The prefix is found without sorting a leaf: a histogram over the first 12 bits of the order's hash gives the slice in
which the quota ends, a second one over the next 12 bits the slice of that slice, and only its documents (a 16-millionth
of the leaf) are summed in order. So one source with a third of all rows makes no large task. The tree's tables have one
row for each source that occurs. Everything is DataFrame functions.

Defined cases: tokens are words ``[^\\x20\\x09-\\x0D]+``; a document without words (or null text) has none and belongs
to every full pass, and to the prefix if it comes before its end; null language or source is the text ``none``;
sources without a weight have weight 1; a document whose tokens would pass the quota ends the prefix. Repeated rows of
one id are one unit of order each, and equal hashes go by id. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

LEAF = ["domain", "lang", "source"]


@dataclass(frozen=True)
class MixParams:
    #: Weights by path: ``web``, ``web/en``, ``web/en/src0``; others count 1.
    weights: dict[str, float] = field(default_factory=lambda: {"web": 4.0, "library": 2.0, "forum": 1.0, "web/en": 4.0, "library/en": 2.0, "web/de": 2.0, "web/en/src0": 3.0})
    budget: float = 0.8  # share of all tokens
    max_epochs: int = 2
    seed: int = 42


def domain_of(source: Column) -> Column:
    """Domain of a source by its number: every fourth a library, every seventh a forum, others the web."""
    number = F.regexp_extract(source, "([0-9]+)$", 1)
    number = F.when(number == "", F.lit(0)).otherwise(number.cast("decimal(38,0)"))
    return F.when(number % 4 == 3, "library").when(number % 7 == 5, "forum").otherwise("web")


def _other() -> Column:
    """Hash of the text of a row without an id; a null adds nothing to a hash, so rows with an id are ordered by it alone."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("other")


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(weights: dict[str, float], path: Column) -> Column:
    out = F.lit(1.0)
    for name, w in weights.items():
        out = F.when(path == name, F.lit(float(w))).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Adds ``budget`` of each node: ``given`` of its parent, water-filled by ``weight`` up to ``capacity``."""
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), key)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("_c", F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("_w", F.sum("weight").over(onwards))
    # In order of how soon they fill, children fill up as long as the level at which one fills is affordable.
    nodes = nodes.withColumn("_level", (F.col("given") - F.col("_c")) / F.col("_w"))
    full = F.col("capacity") <= F.col("_level") * F.col("weight")
    first_open = F.min(F.when(~full, F.struct(F.col("capacity") / F.col("weight"), F.col(key).alias("k"), F.col("_level").alias("l")))).over(Window.partitionBy(*parent))
    share = F.floor(F.greatest(F.lit(0.0), F.col("weight") * first_open["l"]) + 1e-9)
    budget = F.when(full, F.col("capacity")).otherwise(F.least(F.col("capacity"), share.cast("long")))
    return nodes.withColumn("budget", budget).drop("_c", "_w", "_level")


def leaf_budgets(leaves: DataFrame, p: MixParams) -> DataFrame:
    """From (domain, lang, source, tokens): adds the leaf's budget in tokens. Each level is written, so that plans stay small."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * p.max_epochs)
    # One row for each domain: the root's budget is a sum over them.
    domains = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("held")).withColumn("_root", F.lit(0))
    given = F.floor(F.sum("held").over(Window.partitionBy("_root")) * p.budget).cast("long")
    domains = domains.withColumn("weight", _weight(p.weights, F.col("domain"))).withColumn("given", given)
    domains = settle(_share(domains, ["_root"], "domain").select("domain", F.col("budget").alias("given")))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(p.weights, F.concat_ws("/", "domain", "lang")))
    langs = settle(_share(langs.join(domains, "domain"), ["domain"], "lang").select("domain", "lang", F.col("budget").alias("given")))
    leaves = leaves.withColumn("weight", _weight(p.weights, F.concat_ws("/", *LEAF)))
    return _share(leaves.join(langs, ["domain", "lang"]), ["domain", "lang"], "source").select(*LEAF, "tokens", "budget")


def _cut(units: DataFrame, bits: Column, over: list[str], left: str) -> DataFrame:
    """Per key: the slice in which ``left`` tokens end and what is left at its start."""
    slices = units.groupBy(*over, bits.alias("slice")).agg(F.sum("tokens").alias("t"), F.first(left).alias("_left"))
    order = Window.partitionBy(*over).orderBy("slice")
    slices = slices.withColumn("_upto", F.sum("t").over(order))
    return slices.where("_upto > _left").groupBy(*over).agg(F.min(F.struct("slice", (F.col("_left") - F.col("_upto") + F.col("t")).alias("rest"))).alias("cut"))


def mixed(docs: DataFrame, params: MixParams = MixParams(), domain: Column | None = None) -> DataFrame:
    """Rows (doc_id, domain, lang, source, tokens, epoch) of the selected documents, one for each pass that takes one."""
    return _selected(docs, params, domain).drop("other")


def _selected(docs: DataFrame, p: MixParams, domain: Column | None = None) -> DataFrame:
    """``mixed`` with ``other``: what tells rows without an id apart, their text's hash; null for rows that have one."""
    source, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))
    units = settle(
        docs.select("doc_id", lang.alias("lang"), source.alias("source"), tokens_of(F.col("text")).alias("tokens"), _other())
        .withColumn("domain", domain if domain is not None else domain_of(F.col("source")))
        .select("doc_id", "other", *LEAF, "tokens")
    )
    leaves = settle(units.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens")))
    budgets = settle(
        leaf_budgets(leaves, p)
        .withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).cast("int"))
        .withColumn("left", F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)))
        .select(*LEAF, "passes", "left")
    )
    placed = units.join(budgets, LEAF).withColumn("hash", F.xxhash64(F.lit(p.seed), F.col("passes"), F.col("doc_id"), F.col("other")))
    first, second = F.shiftrightunsigned("hash", 52), F.shiftrightunsigned("hash", 40).bitwiseAND(4095)
    # Quota ends: slice, slice of the slice, then the documents there in order.
    cut = settle(_cut(placed.where("left > 0"), first, LEAF, "left").select(*LEAF, F.col("cut.slice").alias("s1"), F.col("cut.rest").alias("r1")))
    at = placed.join(cut, LEAF).where(first == F.col("s1"))
    cut2 = _cut(at, second, LEAF, "r1").select(*LEAF, F.col("cut.slice").alias("s2"), F.col("cut.rest").alias("r2"))
    # One row for each source holds all that its documents ask for.
    plan = settle(budgets.join(cut, LEAF, "left").join(cut2, LEAF, "left").select(*LEAF, "passes", "left", "s1", "s2", "r2"))
    placed = units.join(plan, LEAF).withColumn("hash", F.xxhash64(F.lit(p.seed), F.col("passes"), F.col("doc_id"), F.col("other")))
    in_order = Window.partitionBy(*LEAF).orderBy(F.shiftrightunsigned("hash", 1), "hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.where((F.col("left") > 0) & (first == F.col("s1")) & (second == F.col("s2"))).withColumn("_upto", F.sum("tokens").over(in_order))
    edge = edge.where("_upto <= r2").select("doc_id", "other", *LEAF, "tokens", F.col("passes").alias("epoch"))
    before = F.coalesce((F.col("left") > 0) & ((first < F.col("s1")) | ((first == F.col("s1")) & (second < F.col("s2")))), F.lit(False))
    passes = F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(F.array().cast("array<int>"))
    epochs = F.concat(passes, F.when(before, F.array("passes")).otherwise(F.array().cast("array<int>")))
    return placed.select("doc_id", "other", *LEAF, "tokens", F.explode(epochs).alias("epoch")).unionByName(edge)


def mixed_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The selected documents with all their columns, repeated for each pass that takes them."""
    key = ["_id", "_other", "_l", "_s", "_t"]
    filler = F.lit(0).cast(docs.schema["doc_id"].dataType)

    def keys(tokens: Column, other: Column) -> dict[str, Column]:
        # Plain keys, those of null ids told apart by their texts: numbering and join then share one shuffle.
        return {"_id": F.coalesce("doc_id", filler), "_other": F.when(F.col("doc_id").isNull(), F.concat(F.lit("t"), F.coalesce(other.cast("string"), F.lit("")))).otherwise(""), "_l": F.coalesce("lang", F.lit("none")), "_s": F.coalesce("source", F.lit("none")), "_t": tokens}

    taken = _selected(docs.select("doc_id", "text", "lang", "source"), params).withColumns(keys(F.col("tokens"), F.col("other")))
    taken = taken.groupBy(*key, "epoch").agg(F.count("*").alias("n")).groupBy(*key).agg(F.collect_list("n").alias("_taken"))
    # Rows that share a key are numbered, and a pass that takes m of them takes the first m.
    keyed = docs.withColumns(keys(tokens_of(F.col("text")), _other()))
    keyed = keyed.withColumn("_row", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text"))))
    times = F.size(F.filter("_taken", lambda n: n >= F.col("_row")))
    joined = keyed.join(taken, key).select(*docs.columns, times.alias("_times"))
    return joined.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select(docs.columns)
