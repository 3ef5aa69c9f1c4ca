"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set is that of its distinct shingles of five words (A-Z lower-cased); of
fewer words the whole sequence is one shingle. Two documents are linked if their sets
have a Jaccard similarity of 0.75 or more, always confirmed on the full sets; groups
are the connected components of the links.

1.  Documents with equal sets are one class, standing under its least doc_id.
2.  A class has a signature of 128 min-hash coordinates. It is posted under each
    (coordinate, value) pair of a prefix of 10 coordinates. Classes that meet nowhere
    are done with: a pair of similarity 0.75 misses all of the prefix once in 10^6.
    With a posting travels one byte of each coordinate's value.
3.  Within a posting list the collisions of two members are counted; half of the
    coordinates settle most pairs, and the rest are skipped; so are sets whose sizes
    alone keep them under 0.75. A pair with at least 72 is kept (a pair of similarity 0.75 falls short once in 10^6), then confirmed. A list
    of over 4000 is first split by further coordinates, ten at a time: its members are
    posted again under the list and a second pair, and so on, so that documents that
    only share a frequent passage part. Where that would not halve the pairs to count,
    the list stays long and is dealt into blocks, each member into one.
4.  Links are sought where they can still change a group. In the first rounds a list
    proposes only a forest of most collisions over its members' groups, so a family of n
    near copies takes n proposals, not n squared, and becomes one group. Each round deals
    long lists anew, so that the groups of one round's blocks meet in the next's. At last
    all pairs between groups that are still apart are proposed, if they also have 516 of
    768 coordinates in common (a pair of similarity 0.75 falls short once in 10^6). In a
    long list these are the pairs between its largest group and the rest, and those
    within the rest; the largest group's members do not meet each other any more.

Pairs within one group are not listed; copies and members are told by class and group.

Defined cases: null or blank text has an empty set and is linked with nothing; a null
doc_id comes first and is output as null; rows with equal doc_id are one node, each
with its own text. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm import spans
from vitalgrid.llm.components import components
from vitalgrid.session import staged

SHINGLE, COORDINATES, PREFIX, MATCHES = 5, 128, 10, 72
#: Further coordinates, looked at before a pair is proposed without a forest.
WIDE, WIDE_MATCHES = 768, 516
SHARE = (75, 100)
ROUNDS, LIST = 2, 4000
LEAST_ID = -(2**63)

_seeds = np.random.default_rng(20240229)
XORS = _seeds.integers(0, 2**63, WIDE).astype(np.uint64)
FACTORS = _seeds.integers(0, 2**63, WIDE).astype(np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of a slice, sorted by both."""
    data = LOWER[data]
    starts, ends, first = spans.word_spans(data, offsets)
    words, size = spans.word_hashes(data, starts, ends, 1), np.diff(first)
    row = np.repeat(np.arange(len(size)), size)
    runs = spans.run_hashes(words, SHINGLE, 2)
    at = np.flatnonzero(row[: len(runs)] == row[SHINGLE - 1 :]) if len(runs) else np.zeros(0, np.int64)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    row = np.concatenate([row[at], short])
    value = np.concatenate([runs[at], spans.unit_range_hashes(words, first[short], size[short], 3)])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (doc, k1, k2, n, keys, prints): a key is a coordinate of the
    prefix and its value; prints are the low bytes of all values, then n."""
    for batch in batches:
        for first, end, data, offsets in spans.slices(batch.column(1), 500_000):
            rows = end - first
            row, value = shingle_sets(data, offsets)
            n = np.bincount(row, minlength=rows)
            some = np.flatnonzero(n)
            at = (np.cumsum(n) - n)[some]
            signature = np.zeros((rows, COORDINATES), np.uint32)
            key = np.zeros((2, rows), np.uint64)
            if len(some):
                for j in range(COORDINATES):
                    signature[some, j] = np.minimum.reduceat(((value ^ XORS[j]) * FACTORS[j]) >> np.uint64(32), at)
                # The set as a whole: sums of two independent hashes of its members.
                for j in (0, 1):
                    key[j, some] = np.add.reduceat(spans.mix(value * FACTORS[j] + XORS[j + 2]), at)
            keys = (np.arange(PREFIX, dtype=np.int64) << 32) | signature[:, :PREFIX]
            prints = low_bytes(signature)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, rows),
                    pa.array(key[0].view(np.int64)),
                    pa.array(key[1].view(np.int64)),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * PREFIX), pa.array(keys.ravel())),
                    pa.array([s.tobytes() + c.tobytes() for s, c in zip(prints, n.astype(np.int32))], pa.binary()),
                ],
                names=["doc", "k1", "k2", "n", "keys", "prints"],
            )


def low_bytes(values: np.ndarray) -> np.ndarray:
    return (values ^ (values >> np.uint32(9))).astype(np.uint8)


def wider(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, text) to (cls, wide): the low bytes of the further coordinates, then the
    whole values of the prefix."""
    for batch in batches:
        for first, end, data, offsets in spans.slices(batch.column(1), 500_000):
            row, value = shingle_sets(data, offsets)
            n = np.bincount(row, minlength=end - first)
            some = np.flatnonzero(n)
            at = (np.cumsum(n) - n)[some]
            values = np.zeros((end - first, WIDE), np.uint32)
            for j in (*range(PREFIX), *range(COORDINATES, WIDE)) if len(some) else ():
                values[some, j] = np.minimum.reduceat(((value ^ XORS[j]) * FACTORS[j]) >> np.uint64(32), at)
            wide = [v.tobytes() + p.tobytes() for v, p in zip(low_bytes(values[:, COORDINATES:]), values[:, :PREFIX])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(wide, pa.binary())], names=["cls", "wide"])


def columns_of(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def matrix(column: pa.Array) -> np.ndarray:
    """Low bytes of the coordinates, one row each."""
    return columns_of(column)[:, :COORDINATES]


def set_sizes(column: pa.Array) -> np.ndarray:
    four = np.ascontiguousarray(columns_of(column)[:, COORDINATES : COORDINATES + 4])
    return four.view(np.int32)[:, 0].astype(np.int64)


def near_sizes(some: np.ndarray, one: int) -> np.ndarray:
    """Whether sets of these sizes can be similar at all: the smaller one's size over
    the larger one's bounds the similarity."""
    return SHARE[1] * np.minimum(some, one) >= SHARE[0] * np.maximum(some, one)


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep (u, v, text of u, text of v) whose full sets are similar enough."""
    for batch in batches:
        step = 200
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            texts = pa.concat_arrays([part.column(2), part.column(3)])
            rows, values = [], []
            for first, _, data, offsets in spans.slices(texts):
                row, value = shingle_sets(data, offsets)
                rows.append(row + first)
                values.append(value)
            pair, value = np.concatenate(rows), np.concatenate(values)
            n = np.bincount(pair, minlength=2 * part.num_rows)
            pair = pair % part.num_rows
            order = np.lexsort((value, pair))
            pair, value = pair[order], value[order]
            both = np.bincount(pair[1:][(pair[1:] == pair[:-1]) & (value[1:] == value[:-1])], minlength=part.num_rows)
            union = n[: part.num_rows] + n[part.num_rows :] - both
            keep = pa.array((both * SHARE[1] >= SHARE[0] * union) & (both > 0))
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["u", "v"])


def finer(level: int):
    """(key, cls, prints) to the same rows once for each of the level's coordinates,
    with a key that tells the old one (now the parent) and the value. Such keys are
    negative, those of the prefix are not."""
    low, high = level * PREFIX, min((level + 1) * PREFIX, COORDINATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                old = np.asarray(part.column(0)).view(np.uint64)[:, None]
                values = matrix(part.column(2))[:, low:high].astype(np.uint64) | (np.arange(low, high, dtype=np.uint64) << np.uint64(32))
                key = spans.mix(spans.mix(np.repeat(old, high - low, 1) + np.uint64(0x9E3779B97F4A7C15)) ^ values) | np.uint64(1 << 63)
                take = pa.array(np.repeat(np.arange(part.num_rows), high - low))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), *(part.column(i).take(take) for i in (1, 2, 0))], names=["key", "cls", "prints", "parent"])

    return run


def list_key(*parts) -> Column:
    """The key of a list made out of others; negative, those of the prefix are not."""
    return F.xxhash64(*parts).bitwiseOR(F.lit(LEAST_ID)).alias("key")


def dealt(lists: DataFrame, longest: int, turn: int) -> DataFrame:
    """Lists of over ``longest`` members as blocks, other ones in every turn."""
    block = F.pmod(F.xxhash64("cls", F.lit(turn)), F.ceil(F.col("members") / longest).cast("long"))
    key = F.when(F.col("members") <= longest, F.col("key")).otherwise(list_key("key", block, F.lit(turn)))
    return lists.withColumn("key", key)


def across(lists: DataFrame, longest: int) -> DataFrame:
    """Long lists (key, cls, label, prints) as lists of at most about twice ``longest``,
    such that every two members with different labels share one."""
    sizes = lists.groupBy("key", "label").agg(F.count("*").alias("n"))
    top = sizes.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("top"), F.max("n").alias("tops"), F.sum("n").alias("n"))
    parts = lambda n: F.greatest(F.ceil(n / longest).cast("long"), F.lit(1))
    rows = lists.join(top, "key").withColumns({"ours": parts(F.col("tops")), "theirs": parts(F.col("n") - F.col("tops"))})
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("other")
    block = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).alias("mine")
    largest = rows.where("label = top").select("key", "cls", "label", "prints", block("ours"), each("theirs"))
    rest = rows.where("label <> top")
    # One label for all of the rest, other than that of the largest group.
    met = rest.select("key", "cls", F.bitwise_not("top").alias("label"), "prints", block("theirs"), each("ours"))
    pairs = largest.select(list_key("key", "mine", "other", F.lit(1)), "cls", "label", "prints").unionByName(
        met.select(list_key("key", "other", "mine", F.lit(1)), "cls", "label", "prints")
    )
    among = rest.select("key", "cls", "label", "prints", block("theirs"), each("theirs"))
    among = among.select(list_key("key", F.least("mine", "other"), F.greatest("mine", "other"), F.lit(2)), "cls", "label", "prints")
    return pairs.unionByName(among)


def tree_edges(label: np.ndarray, prints: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges of a forest of most collisions over the members of a list, where those
    of one label hang together already; none with too few collisions."""
    n = len(label)
    out = np.ones(n, bool)
    most, source, us, vs = np.full(n, MATCHES - 1), np.full(n, -1), [], []
    while out.any():
        i = int(np.where(out, most, -1).argmax())
        if source[i] >= 0:
            us.append(source[i])
            vs.append(i)
        mine = np.flatnonzero(out & (label == label[i]))
        out[mine] = False
        rest = np.flatnonzero(out)
        for j in mine if len(rest) else ():
            count = (prints[rest] == prints[j]).sum(axis=1)
            more = (count > most[rest]) & near_sizes(size[rest], size[j])
            most[rest[more]], source[rest[more]] = count[more], j
    return np.array(us, np.int64), np.array(vs, np.int64)


def all_edges(
    key: int, label: np.ndarray, prints: np.ndarray, size: np.ndarray, wide: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of a list with different labels and enough collisions, counted over
    few coordinates first and over many of what is left."""
    wide, whole = wide[:, : WIDE - COORDINATES], np.ascontiguousarray(wide[:, WIDE - COORDINATES :]).view(np.uint32)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(label) - 1):
        other = np.flatnonzero((label[i + 1 :] != label[i]) & near_sizes(size[i + 1 :], size[i])) + i + 1
        half = (prints[other, :64] == prints[i, :64]).sum(axis=1)
        other, half = other[half >= MATCHES - 64], half[half >= MATCHES - 64]
        count = half + (prints[other, 64:] == prints[i, 64:]).sum(axis=1)
        other, count = other[count >= MATCHES], count[count >= MATCHES]
        other = other[count + (wide[other] == wide[i]).sum(axis=1) >= WIDE_MATCHES]
        # Of the lists in which two meet, the one of their first common coordinate
        # proposes them; a list that was split may do so again. Lists go by whole values.
        first = (whole[other] == whole[i]).argmax(axis=1)
        other = other[first == key >> 32] if key >= 0 else other
        us.append(np.full(len(other), i))
        vs.append(other)
    return np.concatenate(us), np.concatenate(vs)


def list_pairs(tree: bool):
    """(key, cls, label, prints) of some lists, sorted by key, to pairs (u, v) of a
    list with different labels and enough collisions: all, or those of a forest."""

    def pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, cls, label = (np.asarray(rows.column(i)) for i in range(3))
        prints, size = matrix(rows.column(3)), set_sizes(rows.column(3))
        wide = columns_of(rows.column(3))[:, COORDINATES + 4 :]
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        found = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if (label[a:b] != label[a]).any():
                mine = label[a:b], prints[a:b], size[a:b]
                u, v = tree_edges(*mine) if tree else all_edges(int(key[a]), *mine, wide[a:b])
                found.append((cls[a:b][u], cls[a:b][v]))
        if found:
            u, v = (np.concatenate(x) for x in zip(*found))
            one = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(one[0]), pa.array(one[1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        whole = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column(0))
            cut = int(np.searchsorted(keys, keys[-1]))  # the last list may go on
            if held and (cut or np.asarray(held[-1].column(0))[-1] != keys[-1]):
                held.append(batch.slice(0, cut))
                yield from pairs(whole())
                held = [batch.slice(cut)]
            elif cut:
                yield from pairs(batch.slice(0, cut))
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield from pairs(whole())

    return run


def bounded_lists(classes: DataFrame, longest: int) -> DataFrame:
    """(key, cls, prints, members) of posting lists of two or more such that two classes
    that share a key of the prefix share one here. Lists of over ``longest`` members are
    those that further coordinates don't part."""
    fields = ["key", "cls", "prints", "members"]
    posted = classes.select("cls", F.explode("keys").alias("key"))
    sizes = posted.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    # Lists of one are left out before anything else is joined to them.
    live = staged(posted.join(sizes, "key"), "postings")
    lists = staged(live.join(classes.select("cls", "prints"), "cls"), "lists")
    ready, level = lists.where(F.col("members") <= longest).select(fields), 1
    while True:
        long = lists.where(F.col("members") > longest).select(fields)
        if (level + 1) * PREFIX > COORDINATES or long.isEmpty():
            return ready.unionByName(long)
        parts = staged(long.mapInArrow(finer(level), "key long, cls long, prints binary, parent long"), "lists")
        sizes = staged(parts.groupBy("parent", "key").agg(F.count("*").alias("members")), "sizes")
        work = sizes.groupBy("parent").agg(F.sum(F.col("members") * F.col("members")).alias("work"))
        pays = long.select("key", "members").distinct().join(work.withColumnRenamed("parent", "key"), "key").where("2 * work < members * members").select("key")
        ready = ready.unionByName(long.join(pays, "key", "left_anti").select(fields))
        parts = parts.join(pays.withColumnRenamed("key", "parent"), "parent", "left_semi")
        lists = staged(parts.join(sizes.where("members > 1"), ["parent", "key"]).select(*fields), "lists")
        ready = ready.unionByName(lists.where(F.col("members") <= longest))
        level += 1


def links(classes: DataFrame, texts: DataFrame, rounds: int = ROUNDS, longest: int = LIST) -> DataFrame:
    """Confirmed links (u, v) that join every pair of similar classes, directly or by
    others. ``classes``: cls, keys, prints; ``texts``: cls, text."""
    lists = staged(bounded_lists(classes, longest), "lists")
    texts = staged(texts.join(lists.select("cls").distinct(), "cls", "left_semi"), "texts")
    fields = ["key", "cls", "label", "prints"]
    found, labelled = None, lists.select("key", "cls", F.col("cls").alias("label"), "prints", "members")
    for turn in range(rounds + 1):
        # A list whose members are all of one group has nothing to propose.
        mixed = labelled.groupBy("key").agg((F.min("label") != F.max("label")).alias("mixed")).where("mixed").select("key")
        asked = labelled.join(mixed, "key", "left_semi") if turn else labelled
        if turn < rounds:
            asked = dealt(asked, longest, turn).select(fields)
        else:
            asked = staged(asked, "asked")
            short, long = (asked.where(c).select(fields) for c in (F.col("members") <= longest, F.col("members") > longest))
            asked = short.unionByName(across(long, longest))
            some = texts.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "text")
            more = staged(some.mapInArrow(wider, "cls long, wide binary"), "wide")
            asked = asked.join(more, "cls").select("key", "cls", "label", F.concat("prints", "wide").alias("prints"))
        pairs = asked.repartition("key").sortWithinPartitions("key").mapInArrow(list_pairs(turn < rounds), "u long, v long")
        pairs = staged(pairs.where("u <> v").distinct(), "pairs")
        # Texts that no pair asks for are left out before they are moved.
        wanted = (pairs.select(F.col(c).alias("cls")).distinct() for c in "uv")
        left, right = (texts.join(a, "cls", "left_semi").select(F.col("cls").alias(c), F.col("text").alias(f"t{c}")) for c, a in zip("uv", wanted))
        pairs = pairs.join(left, "u").join(right, "v").select("u", "v", "tu", "tv")
        new = staged(pairs.mapInArrow(confirmed, "u long, v long"), "links")
        found = new if found is None else found.unionByName(new)
        if turn < rounds:
            labels = components(found).withColumnRenamed("node", "cls")
            labelled = lists.join(labels, "cls", "left").select("key", "cls", F.coalesce("label", "cls").alias("label"), "prints", "members")
    return found


def groups(docs: DataFrame, rounds: int = ROUNDS, longest: int = LIST) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of ``docs``; class_id is
    the least doc_id with the same set."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("doc")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    keyed = docs.select(doc, text)
    sets = staged(keyed.mapInArrow(signatures, "doc long, k1 long, k2 long, n long, keys array<long>, prints binary"), "sets")
    classes = staged(sets.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc").alias("cls"), F.first("keys").alias("keys"), F.first("prints").alias("prints")), "classes")
    texts = keyed.withColumnRenamed("doc", "cls")
    labels = components(links(classes, texts, rounds, longest))
    member = classes.select("k1", "k2", "n", "cls").join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("k1", "k2", "n", "cls", F.coalesce("label", "cls").alias("label"))
    out = sets.select("doc", "k1", "k2", "n").join(member, ["k1", "k2", "n"], "left")
    component = F.coalesce("label", "doc")
    shown = lambda c: F.when(c != LEAST_ID, c)
    return out.select(
        shown(F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        shown(component).alias("component_id"),
        (F.col("doc") == component).alias("kept"),
        shown(F.coalesce("cls", "doc")).alias("class_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, that with the least doc_id; a repeated
    row of it stays."""
    kept = groups(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
