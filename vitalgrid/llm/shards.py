"""Shards of nearly equal bytes by a k-d tree over document metadata.

Documents of equal text are one group and stay together. The groups are split in two
again and again, each time along the dimension in which the part is widest (text size,
bytes per character, language, source; each scaled to the whole corpus), at the median
weighted by bytes, until as many leaves are left as there are shards. Splitting along
what differs most keeps like documents in like shards.

A median is found by counting bytes in 4096 bins of a part's key, then in 4096 bins of
the bin that holds it, until the bin weighs a quarter of ``SLACK`` of a shard or is one key.
The key is the scaled value with a hash of the text behind it, so ties part evenly and
groups stay whole. Only bin counts reach the driver.

All groups go through the tree but those heavier than a whole shard. These are split by a
hash of the doc_id into parts of a sixty-fourth of a shard, which are dealt first, the
largest to the emptiest shard, and the tree fills up what they leave; this is the only
case in which equal texts part. Where groups are heavy a median can miss its goal by half
of one. So in the end some groups of over ``SLACK`` of a shard, of which there are at most
shards / SLACK, are moved from a shard over its goal to one under it, as long as that
brings the two nearer to each other. Groups with so many rows that a join would feel it
are listed with them and joined by broadcast.

Slots number the rows of a shard from 0: per bucket of rows first, then offset by the
counts of the buckets before.

Defined cases: null text has no bytes and is a text of its own kind, equal to the empty
one; null language or source is a value of its own; rows with equal doc_id are rows on
their own; an empty table gives no rows, and fewer rows than shards leave shards empty.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import staged

SHARDS, SLACK, BIN_BITS = 16, 0.01, 12
DIMENSIONS = ("size", "width", "lang", "source")
VALUE_BITS, KEY_BITS = 24, 60


def keyed_rows(docs: DataFrame) -> DataFrame:
    """One row per document: id, size, checksum and group, without the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    raw = text.cast("binary")
    # Names stand for their place in a hash order; copies may differ in them.
    place = lambda c: F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), 1) / F.lit(2.0**63)
    return docs.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        (F.octet_length(raw) / F.greatest(F.length(text), F.lit(1))).alias("width"),
        place("lang").alias("lang"),
        place("source").alias("source"),
    )


GROUP = ["hash", "text_crc32", "size"]


def text_groups(rows: DataFrame) -> DataFrame:
    """One row per text with its weight in bytes and its place in every dimension."""
    grouped = rows.groupBy(GROUP).agg(F.count("*").alias("n"), F.first("width").alias("width"), F.min("lang").alias("lang"), F.min("source").alias("source"))
    # The size of one text, on a scale on which doubling counts the same everywhere.
    return grouped.withColumn("weight", F.col("n") * F.col("size")).withColumn("log_size", F.log2("size"))


def scaled(name: str, low: float, high: float) -> Column:
    column = F.col("log_size" if name == "size" else name)
    span = high - low if high > low else 1.0
    return F.least(F.greatest((column - F.lit(low)) / F.lit(span), F.lit(0.0)), F.lit(1.0))


def key_of(name: str, low: float, high: float) -> Column:
    """Value in the high bits, hash of the text in the low ones."""
    value = (scaled(name, low, high) * F.lit(2**VALUE_BITS - 1)).cast("long")
    return F.shiftleft(value, KEY_BITS - VALUE_BITS).bitwiseOR(F.shiftrightunsigned("hash", 64 - KEY_BITS + VALUE_BITS))


def cut_points(parts: DataFrame, goals: dict[int, float], slack: float) -> dict[int, int]:
    """For every part (node, key, weight) the key below which about ``goals[node]``
    bytes lie, nearest to it of the bin edges seen; at most ``slack`` bytes off unless
    one group weighs more."""
    at = {node: (0, 0.0) for node in goals}  # start of the bin that holds the goal, bytes before it
    done: dict[int, int] = {}
    for shift in range(KEY_BITS - BIN_BITS, -1, -BIN_BITS):
        if not at:
            break
        start = F.create_map(*[F.lit(x) for node, (low, _) in at.items() for x in (node, low)])[F.col("node")]
        inside = parts.where(F.col("node").isin(list(at))).withColumn("start", start).where((F.col("key") >= F.col("start")) & (F.shiftrightunsigned(F.col("key") - F.col("start"), shift + BIN_BITS) == 0))
        bins = inside.groupBy("node", F.shiftrightunsigned(F.col("key") - F.col("start"), shift).alias("bin")).agg(F.sum("weight").alias("weight")).collect()
        for node, (low, before) in list(at.items()):
            total = before
            for row in sorted((r for r in bins if r.node == node), key=lambda r: r.bin):
                if total + row.weight > goals[node]:
                    edge = low + (row.bin << shift)
                    if row.weight <= slack or shift == 0:
                        done[node] = edge if goals[node] - total <= total + row.weight - goals[node] else edge + (1 << shift)
                        del at[node]
                    else:
                        at[node] = (edge, total)
                    break
                total += row.weight
            else:
                done[node] = low + (1 << (shift + BIN_BITS))
                del at[node]
    return done


def shard_of_groups(groups: DataFrame, heavy_bytes: list[int], shards: int) -> DataFrame:
    """Groups with their leaf as ``shard``. ``heavy_bytes``: what every shard holds
    already."""
    bounds = groups.agg(F.sum("weight").alias("w"), *[f(F.col("log_size" if d == "size" else d)).alias(f"{d}_{k}") for d in DIMENSIONS for k, f in (("low", F.min), ("high", F.max))]).first()
    total = bounds.w or 0
    goal = (total + sum(heavy_bytes)) / shards
    room = [max(goal - h, 0.0) for h in heavy_bytes]
    edges = {d: (bounds[f"{d}_low"] or 0.0, bounds[f"{d}_high"] or 0.0) for d in DIMENSIONS}
    # A node is a range of shards; a leaf has one. Its column value is its first shard.
    node, open_ = F.lit(0), [(0, shards)]
    while any(b - a > 1 for a, b in open_):
        wide = [(a, b) for a, b in open_ if b - a > 1]
        held = groups.withColumn("node", node)
        spread = held.where(F.col("node").isin([a for a, _ in wide])).groupBy("node").agg(
            F.sum("weight").alias("weight"), *[(F.max(scaled(d, *edges[d])) - F.min(scaled(d, *edges[d]))).alias(d) for d in DIMENSIONS]
        )
        found = {r.node: r for r in spread.collect()}
        widest = {a: max(DIMENSIONS, key=lambda d: found[a][d]) if a in found else DIMENSIONS[0] for a, _ in wide}
        key = F.coalesce(*[F.when(F.col("node") == a, key_of(widest[a], *edges[widest[a]])) for a, _ in wide])
        goals = {}
        for a, b in wide:
            middle = (a + b + 1) // 2
            left, whole = sum(room[a:middle]), sum(room[a:b])
            weight = found[a].weight if a in found else 0
            goals[a] = weight * (left / whole if whole else (middle - a) / (b - a))
        cuts = cut_points(held.select("node", key.alias("key"), "weight"), goals, SLACK * goal / 4)
        step = F.lit(0)
        for a, b in wide:
            middle = (a + b + 1) // 2
            step = F.when((node == a) & (key_of(widest[a], *edges[widest[a]]) >= F.lit(cuts.get(a, 0))), F.lit(middle - a)).otherwise(step)
        node = node + step
        open_ = [x for a, b in open_ for x in (((a, (a + b + 1) // 2), ((a + b + 1) // 2, b)) if b - a > 1 else ((a, b),))]
        groups = staged(groups.withColumn("leaf", node), "groups")
        node = F.col("leaf")
    return groups.withColumn("shard", node.cast("int")).select(*GROUP, "weight", "n", "shard")


def deal(parts: list[tuple], shards: int) -> tuple[list[tuple], list[int]]:
    """The parts (weight, ...) with a shard, and bytes per shard: the largest part goes
    to the emptiest shard."""
    held, out = [0] * shards, []
    for weight, *row in sorted(parts, reverse=True):
        shard = min(range(shards), key=lambda s: (held[s], s))
        held[shard] += weight
        out.append((*row, shard))
    return out, held


def even_out(heavy: list[tuple[int, int]], held: list[int]) -> dict[int, int]:
    """Which of the heavy groups (weight, shard) go to which other shard. ``held``: bytes
    by shard. Of the fullest shard and another, the group is moved, or the two groups are
    exchanged, that leave the greater of the two smallest."""
    held, shard_of = list(held), [s for _, s in heavy]
    members = [sorted((w, i) for i, (w, s) in enumerate(heavy) if s == shard) for shard in range(len(held))]
    for _ in range(4 * len(heavy)):
        full = max(range(len(held)), key=lambda s: (held[s], s))
        best = None
        for other in sorted(range(len(held)), key=lambda s: (held[s], s)):
            gap = held[full] - held[other]
            for w, i in members[full]:
                # Alone, or for the group there that is next to leaving both equal.
                at = bisect.bisect_left(members[other], (w - gap / 2, -1))
                for back, j in [(0, None), *members[other][max(at - 1, 0) : at + 1]]:
                    if 0 < w - back < gap:
                        left = max(held[full] - w + back, held[other] + w - back)
                        if best is None or left < best[0]:
                            best = left, i, j, other
        if best is None:
            break
        _, i, j, other = best
        for k, a, b in ((i, full, other), (j, other, full)):
            if k is not None:
                w = heavy[k][0]
                members[a].remove((w, k))
                bisect.insort(members[b], (w, k))
                held[a], held[b], shard_of[k] = held[a] - w, held[b] + w, b
    return {i: s for i, (s, (_, before)) in enumerate(zip(shard_of, heavy)) if s != before}


def with_slots(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of every shard numbered from 0 without gaps."""
    bucketed = staged(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(buckets))), "sharded")
    counts = bucketed.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard and bucket, whatever the number of rows.
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "hash")
    return bucketed.join(F.broadcast(offsets), ["shard", "bucket"]).withColumn("slot", F.col("offset") + F.row_number().over(within) - 1)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    spark = docs.sparkSession
    rows = staged(keyed_rows(docs), "rows")
    groups = staged(text_groups(rows), "groups")
    all_ = groups.agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).first()
    goal, many = (all_.weight or 0) / shards, (all_.n or 0) / shards
    # Fewer groups than shards weigh more than one.
    over = groups.where(F.col("weight") > goal).select(*GROUP, F.ceil(64 * F.col("weight") / F.lit(goal or 1.0)).cast("long").alias("parts"))
    over_rows = rows.join(F.broadcast(over), GROUP).select("doc_id", *GROUP, F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("part"))
    weighed = over_rows.groupBy(*GROUP, "part").agg(F.sum("size").cast("long").alias("weight")).collect()
    dealt, held = deal([(r.weight, r.hash, r.text_crc32, r.size, r.part) for r in weighed], shards)
    placed = shard_of_groups(groups.where(F.col("weight") <= goal), held, shards)
    # At most shards / SLACK groups are over the one limit, as many over the other.
    is_listed = (F.col("weight") > SLACK * goal) | (F.col("n") > SLACK * many + 100)
    listed = placed.where(is_listed).orderBy(*GROUP).collect()
    for r in placed.groupBy("shard").agg(F.sum("weight").alias("weight")).collect():
        held[r.shard] += r.weight
    moved = even_out([(r.weight, r.shard) for r in listed], held)
    places = [(r.hash, r.text_crc32, r.size, moved.get(i, r.shard)) for i, r in enumerate(listed)]
    places = F.broadcast(spark.createDataFrame(places, "hash long, text_crc32 long, size long, shard int"))
    parts = F.broadcast(spark.createDataFrame(dealt, "hash long, text_crc32 long, size long, part long, shard int"))
    apart = rows.join(F.broadcast(over), GROUP, "left_anti")
    some = over_rows.join(parts, [*GROUP, "part"]).select("doc_id", *GROUP, "shard")
    some = some.unionByName(apart.join(places, GROUP).select("doc_id", *GROUP, "shard"))
    rest = apart.join(places, GROUP, "left_anti").join(placed.where(~is_listed).select(*GROUP, "shard"), GROUP).select("doc_id", *GROUP, "shard")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return with_slots(some.unionByName(rest), buckets).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
