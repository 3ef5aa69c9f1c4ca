"""Chat formatting of logged conversations, each kept once at its full length.

A chat client that logs the whole conversation after every turn leaves one log per
turn, and every log is a prefix of the next. Cumulative-snapshot collapse: every turn
gets a rolling hash of all turns up to it; the hash at a log's last turn is compared
with the hashes inside longer logs, and only maximal logs are rendered.
Of equal logs the one with the least conv_id stays.

The rolling hash is the running XOR of a hash of (place, role, text), two of them with
different seeds: 128 bits with the number of turns beside them. Turns are sorted and
numbered over ranges of (conv_id, turn, role, text), and what stands in earlier ranges is
added to counts and hashes, so a log of any length is spread over tasks. Prefixes and
ends are counted with partial aggregation before they meet, so a first turn or a log that
is everywhere is one row per task. Texts are read again for maximal logs only. Only
DataFrame functions are used.

A row of a table holds 2 GB at most. A log of more than ``BLOCK`` bytes is therefore
several rows, each of them with its conv_id, the text of some turns, and as n_turns the
turns up to the end of that text: put in the order of n_turns they are the whole chat.

Defined cases: a log's turns are ordered by turn (null first), then role, then text;
rows that are equal in all of these are turns of their own; null role or text counts as
empty; all rows of a null conv_id are one log; a control mark inside a text is broken
up by a space so that it can't end its turn. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import staged

#: Fixed format of a rendered turn.
START, END = "<|im_start|>", "<|im_end|>"
#: Bytes of chat after which a log goes on in another row.
BLOCK = 1 << 26
#: Characters of role and text that part ranges; the bounds go through the driver.
LEAD = 64


def rendered_turn(role: Column, text: Column) -> Column:
    safe = lambda c: F.regexp_replace(c, r"<\|", "< |")
    return F.concat(F.lit(START), safe(role), F.lit("\n"), safe(text), F.lit(END), F.lit("\n"))


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, id, part, h1, h2, line, size: ids ascend in the order of logs and turns,
    by one within a part, the range that a task sorted."""
    clean = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turn, lead = F.col("turn").asc_nulls_first(), F.when(F.length("role") < LEAD, F.substring("text", 1, LEAD))
    ranges = clean.repartitionByRange("conv_id", turn, F.substring("role", 1, LEAD), lead)
    rows = ranges.sortWithinPartitions("conv_id", turn, "role", "text").withColumn("id", F.monotonically_increasing_id())
    line, hashed = rendered_turn(F.col("role"), F.col("text")), [F.xxhash64(F.lit(seed), "role", "text").alias(f"h{seed}") for seed in (1, 2)]
    rows = rows.select("conv_id", "id", F.shiftright("id", 33).alias("part"), *hashed, line.alias("line"))
    return staged(rows.withColumn("size", F.octet_length("line").cast("long")), "turns")


def with_earlier(rows: DataFrame, **totals: Column) -> DataFrame:
    """``rows`` with the totals over the earlier parts of their log, null if it has none.
    Only the first log of a part can have some, so these are few."""
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    fold = lambda c: F.bit_xor(c) if c in "ab" else F.sum(c)
    chunks = rows.groupBy("part", "conv_id").agg(*(c.alias(name) for name, c in totals.items()))
    few = chunks.select("part", "conv_id", *(fold(c).over(earlier).alias(f"{c}0") for c in totals), F.row_number().over(Window.partitionBy("conv_id").orderBy("part")).alias("nth")).where("nth > 1")
    few = few.select(F.col("part").alias("part0"), F.col("conv_id").alias("conv0"), *(f"{c}0" for c in totals))
    return rows.join(F.broadcast(few), (F.col("part") == F.col("part0")) & F.col("conv_id").eqNullSafe(F.col("conv0")), "left").drop("part0", "conv0")


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, id, part, place, a, b, block: turns with their rolling hashes and the row
    of the log that they are rendered in."""
    so_far = Window.partitionBy("part", "conv_id").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = with_earlier(rows.select("conv_id", "id", "part", "h1", "h2", "size"), place=F.count("*"), size=F.sum("size"))
    place = F.row_number().over(so_far) + F.coalesce("place0", F.lit(0))
    ends = F.sum("size").over(so_far) + F.coalesce("size0", F.lit(0))
    rows = rows.select("conv_id", "id", "part", "h1", "h2", place.alias("place"), F.floor((ends - F.col("size")) / BLOCK).alias("block"))
    rows = rows.select("conv_id", "id", "part", "place", "block", *(F.xxhash64(F.lit(seed), "place", f"h{seed}").alias(c) for seed, c in ((1, "a"), (2, "b"))))
    rows = with_earlier(staged(rows, "places"), a=F.bit_xor("a"), b=F.bit_xor("b"))
    rolling = (F.bit_xor(c).over(so_far).bitwiseXOR(F.coalesce(f"{c}0", F.lit(0))).alias(c) for c in "ab")
    return staged(rows.select("conv_id", "id", "part", "place", "block", *rolling), "prefixes")


def maximal(every: DataFrame) -> DataFrame:
    """conv_id of the numbered logs that no longer log begins with."""
    last = every.groupBy("conv_id").agg(F.max(F.struct("place", "a", "b")).alias("end")).select("conv_id", "end.*")
    ends = last.groupBy("place", "a", "b").agg(F.min("conv_id").alias("least"), F.max(F.col("conv_id").isNull()).alias("has_null"), F.count("*").alias("ended"))
    met = every.groupBy("place", "a", "b").agg(F.count("*").alias("met"))
    # A prefix that is met more often than logs end with it is inside a longer one.
    kept = ends.join(met, ["place", "a", "b"]).where("met = ended")
    # min() passes over null; a log without id comes first like any null.
    return kept.select(F.when(~F.col("has_null"), F.col("least")).alias("conv_id"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, chat: every maximal log as one text, in rows of about ``BLOCK``
    bytes if it is longer."""
    rows = ordered(turns)
    every = numbered(rows)
    kept = maximal(every).withColumnRenamed("conv_id", "kept_id")
    # By part too, so that a log of many turns does not go to one task.
    parts = every.select("conv_id", "part").distinct().join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))).select("kept_id", F.col("part").alias("kept_part"))
    mine = every.join(parts, (F.col("part") == F.col("kept_part")) & F.col("conv_id").eqNullSafe(F.col("kept_id"))).select("conv_id", "id", "place", "block")
    mine = mine.join(rows.select("id", "line"), "id")
    lines = F.array_sort(F.collect_list(F.struct("place", "line")))
    chat = F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("chat")
    return mine.groupBy("conv_id", "block").agg(F.max("place").cast("long").alias("n_turns"), chat).drop("block")


#: The same on the test tables, comparing whole prefixes instead of hashes.
SQL = f"""
WITH clean AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
    ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS place
  FROM conversations),
logs AS (
  SELECT conv_id, COUNT(*) AS n_turns, LIST(role || CHR(1) || text ORDER BY place) AS turns,
    STRING_AGG('{START}' || REPLACE(role, '<|', '< |') || CHR(10) || REPLACE(text, '<|', '< |') || '{END}' || CHR(10), '' ORDER BY place) AS chat
  FROM clean GROUP BY conv_id),
prefixes AS (
  SELECT DISTINCT LIST_SLICE(turns, 1, k) AS turns
  FROM (SELECT turns, UNNEST(GENERATE_SERIES(1, n_turns - 1)) AS k FROM logs))
SELECT MIN(conv_id) AS conv_id, n_turns, chat
FROM logs WHERE turns NOT IN (SELECT turns FROM prefixes)
GROUP BY turns, n_turns, chat
"""
