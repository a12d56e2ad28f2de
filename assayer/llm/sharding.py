"""Sharding by balanced label propagation: linked documents move to their neighbours' shards, sizes stay even.

Documents are linked if they are in one group (equal texts in the query).
They start dealt evenly.  In each round, joins count each group's members by
shard; members outside the shard that holds most of their group ask to move
there.  Moves between two shards are granted in equal numbers both ways: first
against each other, then against documents without links, which can be
anywhere.  So the number of documents in each shard never changes.  A shard
without free documents to give is closed to further groups; what is left of a
group that is larger than a shard gathers in its next best one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.joins import lookup_join

from .shared import cut, order_key, running_before

SHARDS = 16
ROUNDS = 12
ORDER = ["doc_id", "crc", "size"]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, size, crc, group, key) of documents; the group is of equal texts, null for one that has no equal."""
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("crc"),
        F.coalesce(F.sha2("text", 256), F.lit("null")).alias("text"),
        order_key("doc_id").alias("key"),
    )
    rows = cut(rows)
    several = rows.groupBy("text").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    found = lookup_join(rows, several.select(F.col("text").alias("group")), "text", "group", "left")
    return found.select("doc_id", "size", "crc", "group", "key")


def _start(rows: DataFrame, shards: int) -> DataFrame:
    """Deal the rows evenly: their number in the order of the key, modulo the shards."""
    numbered = running_before(rows, [], "key", ORDER, F.lit(1), "number")
    return numbered.withColumn("shard", F.pmod("number", F.lit(shards)).cast("int")).drop("number")


def _votes(state: DataFrame, closed: list[int], shards: int) -> DataFrame:
    """(group, goal): the shard, among the open ones, that holds most of the group; ties go by the group's own order."""
    counts = state.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    if closed:
        counts = counts.filter(~F.col("shard").isin(closed))
    # Groups spread their ties over all shards.
    turn = F.pmod(F.conv(F.substring("group", 1, 8), 16, 10).cast("bigint") + F.col("shard"), F.lit(shards))
    best = counts.groupBy("group").agg(F.max(F.struct("n", turn.alias("turn"), "shard")).alias("best"))
    return best.select(F.col("group").alias("voter"), F.col("best.shard").alias("goal"))


def _granted(asked: dict, free: dict, shards: int) -> tuple[dict, dict]:
    """How many may move from a to b, and how many free documents move back, for all pairs of shards."""
    moves, returns = {}, {}
    left = dict(free)
    for (a, b), n in sorted(asked.items(), key=lambda x: (-x[1], x[0])):
        against = min(n, asked.get((b, a), 0))
        filler = min(n - against, left.get(b, 0))
        left[b] = left.get(b, 0) - filler
        if against + filler:
            moves[a, b] = against + filler
        if filler:
            returns[b, a] = returns.get((b, a), 0) + filler
    return moves, returns


def _limits(granted: dict) -> Column:
    """A map of 'from:to' to the number granted; at most shards * shards entries."""
    pairs = [x for (a, b), n in granted.items() for x in (F.lit(f"{a}:{b}"), F.lit(n))]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,int>")


def propagate(state: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Move linked rows round by round; ``state`` has doc_id, size, crc, group, key and shard."""
    closed: list[int] = []
    state = cut(state)
    for _ in range(rounds):
        # Free documents don't take part in the join: without a group they would all meet in one task.
        linked = state.filter("group is not null")
        voted = lookup_join(linked, _votes(linked, closed, shards), "group", "voter", "left").drop("voter")
        voted = voted.unionByName(state.filter("group is null").withColumn("goal", F.lit(None).cast("int")))
        stays = F.col("goal").isNull() | F.col("shard").isin(closed) | (F.col("goal") == F.col("shard"))
        voted = cut(voted.withColumn("goal", F.when(~stays, F.col("goal"))))
        counts = voted.groupBy("shard", "goal", F.col("group").isNull().alias("free")).count().collect()
        asked = {(r.shard, r.goal): r["count"] for r in counts if r.goal is not None}
        free = {r.shard: r["count"] for r in counts if r.free}
        moves, returns = _granted(asked, free, shards)
        if not moves:
            full = [s for s in range(shards) if s not in closed and any(b == s for _, b in asked)]
            if not full:
                break
            closed += full
            continue
        state = cut(_moved(voted, moves, returns))
    return state.select("doc_id", "size", "crc", "group", "key", "shard")


def _moved(voted: DataFrame, moves: dict, returns: dict) -> DataFrame:
    """Move the first of those that asked, as many as were granted, and the free ones that make room for them."""
    asks = voted.withColumn("_lane", F.concat_ws(":", "shard", F.coalesce("goal", F.lit(-1))))
    lane = F.when(F.col("goal").isNotNull(), F.col("_lane")).when(
        F.col("group").isNull(), F.concat(F.lit("free:"), F.col("shard").cast("string"))
    )
    laned = asks.withColumn("_lane", lane)
    still = laned.filter("_lane is null").drop("_lane", "goal")
    ranked = running_before(laned.filter("_lane is not null"), ["_lane"], "key", ORDER, F.lit(1), "_turn")
    asked = F.col("goal").isNotNull() & (F.col("_turn") < F.coalesce(_limits(moves)[F.col("_lane")], F.lit(0)))
    # The free ones of a shard go out in its order: the first to one shard, the next to another.
    ways = F.lit(None).cast("int")
    starts: dict[int, int] = {}
    for (a, b), n in sorted(returns.items()):
        first = starts.get(a, 0)
        starts[a] = first + n
        here = (F.col("shard") == a) & (F.col("_turn") >= first) & (F.col("_turn") < first + n)
        ways = F.when(here & F.col("goal").isNull(), F.lit(b)).otherwise(ways)
    moved = ranked.withColumn("shard", F.when(asked, F.col("goal")).otherwise(F.coalesce(ways, F.col("shard"))))
    return moved.drop("_lane", "_turn", "goal").unionByName(still)


def cut_links(state: DataFrame) -> DataFrame:
    """One row: the links of the groups' members with their groups' largest shards, and how many are cut."""
    counts = state.filter("group is not null").groupBy("group", "shard").count()
    by_group = counts.groupBy("group").agg(F.sum("count").alias("all"), F.max("count").alias("most"))
    return by_group.agg(F.sum("all").alias("links"), F.sum(F.col("all") - F.col("most")).alias("cut"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    The law is ``rows``: the shards' numbers of documents are at most one
    apart, and ``grown_shard`` is null.  A null text has size 1 and checksum
    0; null texts are equal to each other.  Slots count from 0 in each shard.
    Documents without an id, and repeated rows, are dealt like others.
    """
    state = propagate(_start(described(docs), shards), shards)
    placed = running_before(state, ["shard"], "key", ORDER, F.lit(1), "slot")
    return placed.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
