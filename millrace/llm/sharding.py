"""Sharding by balanced label propagation.

Linked documents start in shards drawn by hash and move, round by round, to the shard that holds most
of their neighbours, as far as that shard has room once those have left that want to. Documents that
follow the same neighbour are let in together or not at all, unless they alone exceed the room: then as
many as fit. In even rounds a document listens only to neighbours before it, so that two neighbours
don't swap for ever; in odd rounds to all.

A last step makes the sizes exact: in every shard the linked documents come first, group by group, and
what is over the shard's quota fills the others' vacancies in the same order. So a group is cut only
where a quota or a vacancy ends, and one that fits no shard goes on in few others. The numbers that
place a row are sums over small chunks of rows, so no shard's rows are ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.scratch import cut_lineage

SHARDS = 16
ROUNDS = 4
CHUNK_ROWS = 50_000
SLACK = 0.1  # by which a shard may exceed its quota while documents move
LAW = "rows"


def propagate(
    links: DataFrame, nodes: int, shards: int = SHARDS, rounds: int = ROUNDS, start: DataFrame | None = None
) -> DataFrame:
    """(node, shard) for every node of the links (a, b), under quotas of ``nodes / shards`` rows.

    ``start`` (node, shard) places nodes at first, instead of a hash. Moves into a shard are drawn by hash for the room it has, so quotas hold within about ``SLACK``;
    ``settle`` makes them exact. Loads and demands, a number per shard, are read by the driver each
    round. Links may repeat, go both ways or lead to themselves; without links there are no rows.
    """
    both = cut_lineage(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct().toDF("node", "near"), "links"
    )
    placed = F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")
    labels = both.select("node").distinct()
    if start is not None:
        labels = labels.join(start.select("node", F.col("shard").alias("given")), "node", "left")
        placed = F.coalesce("given", placed)
    labels = cut_lineage(labels.select("node", placed.alias("shard")), "labels")
    quota = -(-nodes // shards)
    for turn in range(rounds):
        heard = both if turn % 2 else both.where("near < node")
        of = labels.select(F.col("node").alias("near"), F.col("shard").alias("near_shard"))
        votes = heard.join(of, "near").groupBy("node", F.col("near_shard").alias("vote")).agg(
            F.count("*").alias("count"), F.min("near").alias("lead")
        )
        first = F.struct("count", -F.col("vote"))
        best = votes.groupBy("node").agg(
            F.max_by("vote", first).alias("best"), F.max("count").alias("most"), F.max_by("lead", first).alias("lead")
        )
        own = votes.select("node", F.col("vote").alias("shard"), F.col("count").alias("stay"))
        wish = labels.join(best, "node", "left").join(own, ["node", "shard"], "left")
        wishes = F.col("best").isNotNull() & (F.col("most") > F.coalesce("stay", F.lit(0)))
        wish = cut_lineage(
            wish.select("node", "shard", F.when(wishes, F.col("best")).alias("goal"), F.when(wishes, F.col("lead")).alias("lead")),
            "wishes",
        )
        moving = wish.where("goal is not null")
        stays = {r["shard"]: r["count"] for r in wish.where("goal is null").groupBy("shard").count().collect()}
        asked = {r["goal"]: r["count"] for r in moving.groupBy("goal").count().collect()}
        if not asked:
            break
        room = {s: max(0, int(quota * (1 + SLACK)) - stays.get(s, 0)) for s in asked}
        of_goal = F.create_map(*[F.lit(x) for s, n in room.items() for x in (s, n)])
        chance = F.create_map(*[F.lit(x) for s, n in asked.items() for x in (s, min(1.0, room[s] / n))])
        # Followers of one neighbour share their dice, those that exceed the room by themselves don't.
        large = moving.groupBy("goal", "lead").count().where(F.col("count") > of_goal[F.col("goal")])
        large = cut_lineage(large.select("goal", "lead", F.lit(True).alias("alone")), "large")
        wish = wish.join(large, ["goal", "lead"], "left")
        drawn = F.when(F.col("alone"), F.col("node")).otherwise(F.col("lead"))
        dice = F.pmod(F.xxhash64(drawn, F.lit(f"move {turn}")), F.lit(1_000_000)) / 1_000_000
        moves = F.col("goal").isNotNull() & (dice < chance[F.col("goal")])
        labels = cut_lineage(
            wish.select("node", F.when(moves, F.col("goal")).otherwise(F.col("shard")).alias("shard")), "labels"
        )
    return labels


def _step(position: Column, bounds: list[int]) -> Column:
    """In which of the stretches that end at ``bounds`` a position lies."""
    return sum((F.when(position >= b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))


def settle(rows: DataFrame, nodes: int, shards: int = SHARDS) -> DataFrame:
    """Rows (node, shard, linked, lead, held, ...) in shards of sizes at most one apart, with a gapless slot.

    ``lead`` names a row's group and ``held`` its size: a group's rows follow one another. Only one
    that exceeds a chunk is dealt over several.
    """
    chunks = max(1, -(-nodes // CHUNK_ROWS))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("held") / CHUNK_ROWS))
    own_chunk = F.pmod(F.xxhash64("lead", part, F.lit("chunk")), F.lit(chunks)).cast("int")
    rows = rows.withColumn("chunk", own_chunk)
    rows = cut_lineage(rows, "settling")
    place = ["shard", "late", "chunk"]
    rows = rows.withColumn("late", (~F.col("linked")).cast("int"))
    counts = rows.groupBy(*place).count()
    before = Window.partitionBy("shard").orderBy("late", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*place, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    load = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
    quota = [nodes // shards + (s < nodes % shards) for s in range(shards)]
    over = [max(0, load.get(s, 0) - quota[s]) for s in range(shards)]
    free = [max(0, quota[s] - load.get(s, 0)) for s in range(shards)]
    over_before = [sum(over[:s]) for s in range(shards)]
    free_until = [sum(free[: s + 1]) for s in range(shards)]
    inside = Window.partitionBy("chunk", "shard", "late").orderBy("lead", "node")
    ranked = rows.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, place)
    ranked = ranked.withColumn("rank", F.col("offset") + F.col("inside"))

    def at(values: list[int], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index + 1)

    stays = F.col("rank") < at(quota, F.col("shard"))
    spare = F.col("rank") - at(quota, F.col("shard")) + at(over_before, F.col("shard"))
    ranked = ranked.withColumn("spare", F.when(~stays, spare))
    ranked = ranked.withColumn("goal", F.when(~stays, _step(F.col("spare"), free_until)))
    taken = [min(load.get(s, 0), quota[s]) for s in range(shards)]
    moved_slot = at(taken, F.col("goal")) + F.col("spare") - at([u - f for u, f in zip(free_until, free, strict=True)], F.col("goal"))
    return ranked.select(
        *[c for c in rows.columns if c not in ("shard", "late", "chunk", "linked", "lead", "held")],
        F.coalesce("goal", "shard").cast("int").alias("shard"),
        F.when(stays, F.col("rank")).otherwise(moved_slot).cast("long").alias("slot"),
    )


def by_equal_texts(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard; equal texts are linked.

    The law is ``rows``: counts at most one apart. A null text has no bytes and no links; size is the
    text's bytes plus 1. Null and repeated ids pass through; further columns are ignored; an empty
    table gives no rows. Of shards with equal votes the smallest is taken; which rows of an oversized group
    go together is drawn by hash. Equal texts are found by two hashes and the size (128 bits in all); each
    group is linked as a star around its first row.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text))).alias("hash"),
    )
    rows = cut_lineage(rows.withColumn("node", F.monotonically_increasing_id()), "nodes")
    same = ["hash", "text_crc32", "size"]
    stars = rows.where("hash is not null").groupBy(*same).agg(F.min("node").alias("a"), F.count("*").alias("n"))
    stars = cut_lineage(stars.where("n > 1"), "stars")  # stored, so that a hot group's join can be split
    rows = cut_lineage(rows.join(stars, same, "left"), "grouped")
    links = rows.where("node > a").select("a", F.col("node").alias("b"))
    nodes = rows.count()
    # A group that exceeds a shard starts in as many as it needs, and has no reason to leave them.
    ways = F.ceil(F.col("n") / max(1, nodes // shards))
    first = F.xxhash64("a", F.lit("start")) + F.pmod(F.xxhash64("node", F.lit("start")), ways)
    start = rows.where(ways > 1).select("node", F.pmod(first, F.lit(shards)).cast("int").alias("shard"))
    labels = propagate(links, nodes, shards, start=start).withColumn("linked", F.lit(True))
    draw = F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")
    started = rows.drop("hash").join(labels, "node", "left").select(
        "node", "doc_id", "size", "text_crc32",
        F.coalesce("shard", draw).alias("shard"), F.coalesce("linked", F.lit(False)).alias("linked"),
        F.coalesce("a", "node").alias("lead"), F.coalesce("n", F.lit(1)).alias("held"),
    )
    return settle(started, nodes, shards).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
