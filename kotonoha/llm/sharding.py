"""Balanced label propagation: linked documents gather in shards whose row counts differ by one at most.

Documents are linked when their texts are equal (``links`` may name other columns), and by ``edges`` between documents, if
given: pairs of ids, say of near copies or of pages that cite each other. Labels are shard numbers. At first a
document's label is a hash; in each round every group of linked documents looks at its members' labels, takes the one
most of them have among the shards with room, and its members move there as far as the shard's quota allows: members that
are there already first, then small groups before large ones. What finds no room after the last round fills the roomiest
shards in order of group, so a group larger than a shard takes whole shards; unlinked documents level all shards to quota.

With edges, groups of equal documents are nodes. In each round of joins a node takes the label that most of its edges lead
to, its own members counting for where it is; of those that wish for one shard no more move than it has room for, drawn by
a hash. Groups then move as before. ``cut_edges`` counts the edges between shards.

Quotas are exact, since places come from ``ranked``: a range shuffle over the whole order and a sum of counts by part. The
joins of a round are on group and label together, so a group holding a third of all rows is dealt over as many tasks as
there are shards. What reaches the driver are counts by shard.

Law ``rows``: shards' counts are at most one apart. Defined cases: a null text counts as an empty one; repeated rows each
take a place; null ids are placed like others; with fewer rows than shards the last shards stay empty; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, settle

GROUP = ["h", "text_crc32", "size"]


def _interval(starts: list[int]):
    """Number of the last start that is not above the column ``pos``."""
    bounds = F.array(*[F.lit(x).cast("long") for x in starts])
    return F.size(F.filter(bounds, lambda x: x <= F.col("pos"))) - 1


def _by(df: DataFrame, key: str) -> dict[int, int]:
    return {r[key]: r["n"] for r in df.groupBy(key).agg(F.count("*").alias("n")).collect()}


def _targets(rows: DataFrame, room: dict[int, int] | None) -> DataFrame:
    """(group, label) -> members of the group and the label that most of them have, among shards with room."""
    counts = rows.groupBy(*GROUP, "label").agg(F.count("*").alias("c"))
    votes = F.struct(F.col("c"), (-F.col("label")).alias("low"))
    if room is not None:
        open_shards = [s for s, left in room.items() if left > 0]
        best = F.coalesce(F.max_by("label", F.when(F.col("label").isin(open_shards), votes)), F.lit(max(room, key=lambda s: (room[s], -s))))
    else:
        best = F.max_by("label", votes)
    return (
        counts.groupBy(*GROUP)
        .agg(F.sum("c").alias("members"), best.alias("target"), F.collect_list("label").alias("labels"))
        .withColumn("label", F.explode("labels")).drop("labels")
    )


def _move(rows: DataFrame, room: dict[int, int]) -> DataFrame:
    """Adds ``place`` (0 and up, in the target's order) and ``moved`` (whether the target's room reaches that far)."""
    rows = rows.withColumn("away", (F.col("label") != F.col("target")).cast("int"))
    order = ranked(rows, "target", "away", "members", *GROUP, "doc_id")
    wishes, starts, done = _by(rows, "target"), {}, 0
    for shard in sorted(wishes):
        starts[shard], done = done, done + wishes[shard]
    limits = order.sparkSession.createDataFrame([(s, starts[s], room.get(s, 0)) for s in starts] or [(0, 0, 0)], "target int, _start long, _room long")
    return (
        order.join(F.broadcast(limits), "target").withColumn("place", F.col("pos") - F.col("_start"))
        .withColumn("moved", F.col("place") < F.col("_room")).drop("_start", "_room", "pos", "away")
    )


def _propagated(nodes: DataFrame, edges: DataFrame, quota: dict[int, int], rounds: int) -> DataFrame:
    """(group, target) after rounds over the edges (group, group as o_*, w) between nodes (group, members, target)."""
    total, other = sum(quota.values()), [f"o_{c}" for c in GROUP]
    state = settle(nodes.select(*GROUP, "members", "target"))
    for turn in range(rounds):
        near = state.select(*[F.col(c).alias(o) for c, o in zip(GROUP, other, strict=True)], F.col("target").alias("label"))
        votes = edges.join(near, other).groupBy(*GROUP, "label").agg(F.sum("w").alias("w"))
        own = state.select(*GROUP, F.col("target").alias("label"), F.lit(0.5).alias("w"))  # of equal votes the present shard wins
        wish = votes.unionByName(own.withColumn("w", F.col("w").cast("double"))).groupBy(*GROUP, "label").agg(F.sum("w").alias("w"))
        wish = wish.groupBy(*GROUP).agg(F.max_by("label", F.struct("w", -F.col("label"))).alias("wish"))
        state = settle(state.join(wish, GROUP))
        held = {r["target"]: r["n"] for r in state.where("wish = target").groupBy("target").agg(F.sum("members").alias("n")).collect()}
        asked = {r["wish"]: r["n"] for r in state.where("wish <> target").groupBy("wish").agg(F.sum("members").alias("n")).collect()}
        # Half of what a shard lacks or will lose moves in a round, so that two shards do not swap their members for ever.
        share = {s: max(0.0, min(1.0, (1.1 * total / len(quota) - held.get(s, 0)) / n)) for s, n in asked.items()}
        admitted = F.coalesce(*[F.when(F.col("wish") == s, F.lit(x)) for s, x in share.items()], F.lit(0.0)) * (0.5 if turn + 1 < rounds else 1.0)
        moves = F.pmod(F.xxhash64(F.lit(turn), *GROUP), F.lit(1_000_003)) < admitted * 1_000_003
        state = settle(state.select(*GROUP, "members", F.when((F.col("wish") != F.col("target")) & moves, F.col("wish")).otherwise(F.col("target")).alias("target")))
    return state.select(*GROUP, "target")


def cut_edges(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """One row (n_edges, n_cut): edges (a, b) between documents of ``placed`` (doc_id, shard), and those between shards."""
    shard = placed.groupBy("doc_id").agg(F.min("shard").alias("shard"))
    both = edges.select("a", "b").join(shard.select(F.col("doc_id").alias("a"), F.col("shard").alias("x")), "a").join(shard.select(F.col("doc_id").alias("b"), F.col("shard").alias("y")), "b")
    return both.agg(F.count("*").alias("n_edges"), F.coalesce(F.sum((F.col("x") != F.col("y")).cast("long")), F.lit(0)).alias("n_cut"))


def balanced_shards(docs: DataFrame, shards: int = 40, rounds: int = 2, links: list[str] | None = None, edges: DataFrame | None = None, edge_rounds: int = 6) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard), one for each row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    names = ["doc_id", *GROUP, "label"]
    rows = docs.select(
        "doc_id", F.xxhash64(*[F.col(c) for c in links] if links else [text]).alias("h"),
        F.crc32(text.cast("binary")).alias("text_crc32"), (F.octet_length(text) + 16).cast("long").alias("size"),
    )
    rows = settle(rows.withColumn("label", F.pmod(F.xxhash64("doc_id", "h"), F.lit(shards)).cast("int")).select(names))
    total = rows.count()
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    rows = settle(rows.join(_targets(rows, None), [*GROUP, "label"]).select(*names, "members", "target"))
    linked = F.col("members") > 1
    if edges is not None:
        ids = rows.where("doc_id is not null").select("doc_id", *GROUP).distinct()
        ends = [ids.select(F.col("doc_id").alias(end), *[F.col(c).alias(o + c) for c in GROUP]) for end, o in (("a", ""), ("b", "o_"))]
        between = edges.select("a", "b").where("a <> b").join(ends[0], "a").join(ends[1], "b").where("not (h = o_h and text_crc32 = o_text_crc32 and size = o_size)")
        turned = between.select(*[F.col(f"o_{c}").alias(c) for c in GROUP], *[F.col(c).alias(f"o_{c}") for c in GROUP])
        between = settle(between.select(turned.columns).unionByName(turned).groupBy(turned.columns).agg(F.count("*").cast("double").alias("w")))
        nodes = between.select(*GROUP).distinct().join(rows.groupBy(*GROUP).agg(F.first("members").alias("members"), F.first("target").alias("target")), GROUP)
        moved = _propagated(nodes, between, quota, edge_rounds).withColumnRenamed("target", "_to")
        rows = settle(rows.join(moved, GROUP, "left").select(*names, "members", F.coalesce("_to", "target").alias("target"), F.col("_to").isNotNull().alias("tied")))
        linked = linked | F.col("tied")
    waiting, room, base, seated = rows.where(linked).select(*names, "members", "target"), dict(quota), dict.fromkeys(quota, 0), []
    for turn in range(rounds):
        if turn:
            waiting = settle(waiting.join(_targets(waiting, room).drop("members"), [*GROUP, "label"]).select(*names, "members", "target"))
        placed = settle(_move(waiting, room))
        firsts = placed.sparkSession.createDataFrame(list(base.items()), "target int, _base long")
        seated.append(
            placed.where("moved").join(F.broadcast(firsts), "target")
            .select("doc_id", "size", "text_crc32", F.col("target").alias("shard"), (F.col("_base") + F.col("place")).alias("slot"))
        )
        for shard, n in _by(placed.where("moved"), "target").items():
            room[shard] -= n
            base[shard] += n
        waiting = placed.where("not moved").select(*names, "members")
        if waiting.isEmpty():
            break
    # What is left fills the shards, roomiest first: groups in order, then documents without links.
    rest = ranked(waiting.withColumn("alone", F.lit(0)).unionByName(rows.where(~linked).select(*names, "members").withColumn("alone", F.lit(1))), "alone", "members", *GROUP, "doc_id")
    order, starts, done = sorted(room, key=lambda s: (-room[s], s)), [], 0
    for shard in order:
        starts.append(done)
        done += room[shard]
    table = rest.sparkSession.createDataFrame([(i, s, starts[i], base[s]) for i, s in enumerate(order)], "_i int, shard int, _start long, _base long")
    seated.append(
        rest.withColumn("_i", _interval(starts)).join(F.broadcast(table), "_i")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_base") + F.col("pos") - F.col("_start")).alias("slot"))
    )
    out = reduce(DataFrame.unionByName, seated)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
