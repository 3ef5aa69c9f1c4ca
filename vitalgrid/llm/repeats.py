"""Which units (bytes or words) lie in a window that also starts earlier.

Shared by the two exact substring operators, which differ in the unit, in what counts
as earlier and in how repeated keys are told from single ones (``repeated``).

A window is ``size`` consecutive units of one document. Shipping a key for each of
them would move many times the input, so three steps narrow them down, and none of
them can lose a repeat:

1.  Every window names an *anchor*: its leftmost run of ``gram`` units with the least
    hash. Equal windows name the same run at the same offset. Consecutive windows with
    one anchor form a *span*, some thirty windows of a byte text. Per span two hashes
    travel: that of the anchor and that of everything its windows cover.
2.  Equal spans: all windows of all but the earliest one are repeats, without looking
    at any of them. A span whose anchor stands in no other span is done with. What is
    left are the earliest ones of spans that share an anchor and differ around it:
    the edges of copied passages.
3.  Only for those are single windows hashed (96 bits) and grouped.

Before each shuffle a task keeps the earliest of equal keys among the rows of a batch and
marks the others at once, and it remembers ``REMEMBERED`` of the keys that it has sent, the
repeated ones longest: a later row that equals one of them is marked too. So a passage in
a third of all documents sends a few keys per task, however many batches that has: one,
and another each time an earlier document turns up. An anchor with many different surroundings within a batch is known to need step
3 and skips step 2 but for a few of its spans. Keys go to partitions by their leading
bits; intermediate tables are written to the shared folder, and a lost executor's
tasks are recomputed from them.

Documents are told apart and ordered by (doc_id, hash of the text): a null id comes
first, rows with equal id and text are one document, and rows with equal id but other
text are ordered by the hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.llm import spans
from vitalgrid.session import staged

#: Spans per anchor and batch that go through step 2; the others go to step 3.
SURROUNDINGS = 4
LEAST_ID = -(2**63)
PACKED = "shard int, kind int, size int, places binary, a binary, b binary"
MARKS = "doc long, tie long, lo int, n int, resolve boolean"
OUT_ROWS = 100_000
#: Keys that a task remembers.
REMEMBERED = 300_000
#: Bytes of text whose spans a task holds at a time.
HELD_BYTES = 5_000_000


class Bytes:
    """The bytes of a text as units."""

    slice_bytes = 250_000

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def runs(self, length: int) -> np.ndarray:
        return spans.short_runs(self.data, length)

    def ranges(self, starts: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
        return spans.range_hashes(self.data, starts, lengths, salt)


class Words:
    """The words of a text as units."""

    slice_bytes = 1_000_000

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.offsets = spans.word_spans(data, offsets)
        self.words = spans.word_hashes(data, self.starts, self.ends, 1)

    def runs(self, length: int) -> np.ndarray:
        return spans.short_runs(self.words >> np.uint64(32), length)

    def ranges(self, starts: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
        return spans.unit_range_hashes(self.words, starts, lengths, salt)


@dataclass(frozen=True)
class Windows:
    size: int
    gram: int
    units: type
    #: Whether an earlier start in the same document counts.
    same_document: bool
    #: Groups of equal keys: (keys, groups so far or None) to the rows of groups of two
    #: or more, in order of the groups, and the numbers of these. With groups so far,
    #: they are divided further and no row is left out.
    grouped: Callable[[np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray]]
    #: A broadcast that tells which anchors may stand twice, asked before anything is
    #: shuffled, or None; see ``substring``.
    sketch: object = None

    def may_repeat(self, anchors: np.ndarray) -> np.ndarray:
        return np.ones(len(anchors), bool) if self.sketch is None else self.sketch.value.repeated(anchors)


def doc_keys() -> tuple[Column, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("doc"), F.xxhash64(text).alias("tie")


def spans_of(cut, how: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor of every span of a slice."""
    size, total = how.size, int(cut.offsets[-1])
    runs = cut.runs(how.gram)
    if total < size:
        none = np.zeros(0, np.int64)
        return none, none, none
    keyed = (runs.astype(np.uint64) << np.uint64(32)) | np.arange(len(runs), dtype=np.uint64)
    at = (spans.sliding(keyed, size - how.gram + 1, np.minimum) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows that cross the end of a row are none.
    change = np.zeros(len(at) + 1, np.int32)
    inner = cut.offsets[1:-1]
    np.add.at(change, np.clip(inner - size + 1, 0, len(at)), 1)
    np.add.at(change, np.minimum(inner, len(at)), -1)
    valid = np.cumsum(change[:-1]) == 0
    new = at[1:] != at[:-1]
    lo = np.flatnonzero(valid & np.concatenate([[True], new | ~valid[:-1]]))
    hi = np.flatnonzero(valid & np.concatenate([new | ~valid[1:], [True]]))
    return lo, hi, at[lo]


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Whether a row of sorted keys differs from the row before."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for key in keys:
        out[1:] |= key[1:] != key[:-1]
    return out


def first_of(new: np.ndarray) -> np.ndarray:
    """For every row of sorted keys the index of the first of its group."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def rank_documents(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    order = np.lexsort((tie, doc))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(starts_of(doc[order], tie[order])) - 1
    return rank


def joined(rank: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one document that touch or overlap, as one run each."""
    if not len(lo):
        return rank, lo, n
    order = np.lexsort((lo, rank))
    rank, lo, end = rank[order], lo[order], (lo + n)[order]
    base = rank * (int(end.max()) + 2)
    reach = np.maximum.accumulate(base + end)
    new = np.concatenate([[True], (base + lo)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:] - 1, [len(lo) - 1]])
    return rank[at], lo[at], (reach[last] - base[last]) - lo[at]


def pack(shard: int, kind: int, doc: np.ndarray, tie: np.ndarray, lo: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> list:
    """One row for many. Places are in order, so their differences compress well."""
    step = lambda x: np.diff(x.astype(np.int64), prepend=np.int64(0)).tobytes()
    places = zstandard.ZstdCompressor(level=1).compress(step(doc) + step(tie) + step(lo) + n.astype(np.int32).tobytes())
    return [shard, kind, len(doc), places, a.tobytes(), b.tobytes()]


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    press = zstandard.ZstdDecompressor()
    for _, kind, size, places, a, b in zip(*(c.to_pylist() for c in batch.columns)):
        raw = press.decompress(places)
        doc, tie, lo = (np.cumsum(np.frombuffer(raw, np.int64, size, 8 * size * i)) for i in range(3))
        n = np.frombuffer(raw, np.int32, size, 24 * size)
        yield kind, [doc, tie, lo, n, np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64 if len(b) == len(a) else np.uint32)]


def packed_batch(rows: list[list]) -> pa.RecordBatch:
    types = [pa.int32()] * 3 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f.split()[0] for f in PACKED.split(", ")])


COVERED, RESOLVE, KEYED = 0, 1, 2


def sharded(kind_rows: list[list], shards: int, doc, tie, lo, n, a, b) -> pa.RecordBatch:
    """Packed rows of keyed entries by the leading bits of ``a``, with ``kind_rows``."""
    shard = ((a >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(starts_of(shard[order]))
    rows = [
        pack(int(shard[part[0]]), KEYED, doc[part], tie[part], lo[part], n[part], a[part], b[part])
        for part in np.split(order, cuts[1:])
        if len(part)
    ]
    return packed_batch(kind_rows + rows) if kind_rows or rows else None


def earliest(how: Windows, doc_key: np.ndarray, lo: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a row of sorted groups is (as good as) the earliest of its group."""
    same = doc_key == doc_key[first]
    return same & (lo == lo[first]) if how.same_document else same


def marks(doc, tie, lo, n, resolve: bool) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(doc), OUT_ROWS):
        part = slice(i, i + OUT_ROWS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[part]), pa.array(tie[part]), pa.array(lo[part].astype(np.int32)), pa.array(n[part].astype(np.int32)), pa.array(np.full(len(doc[part]), resolve))],
            names=["doc", "tie", "lo", "n", "resolve"],
        )


def parts(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``HELD_BYTES`` bytes of text, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy())
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(ends, before + HELD_BYTES, "right")))
            yield batch.slice(first, end - first)
            first = end


class Sent:
    """Keys that a task has sent on, with the earliest place it knows of each."""

    def __init__(self, how: Windows):
        self.how = how
        self.key = np.zeros(0, np.uint64)
        self.columns = [np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool)]

    def covers(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, tie: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Which rows repeat an earlier one sent before; the others are remembered. No
        two rows have the same keys and document."""
        key = spans.mix(a + spans.mix(b.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
        out = np.zeros(len(key), bool)
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            known = [c[at] for c in self.columns]
            hit = (self.key[at] == key) & (known[0] == a) & (known[1] == b)
            same = (known[2] == doc) & (known[3] == tie)
            before = (known[2] < doc) | ((known[2] == doc) & (known[3] < tie))
            if self.how.same_document:
                before |= same & (known[4] < lo)
            out = hit & before
            self.columns[5][at[hit]] = True
            for mine, new in zip(self.columns[2:5], (doc, tie, lo)):
                mine[at[hit & ~out]] = new[hit & ~out]  # the new one is earlier
            new = ~hit & (self.key[at] != key)
        else:
            new = np.ones(len(key), bool)
        first = np.flatnonzero(new)
        first = first[np.unique(key[first], return_index=True)[1]]
        added = [key[first], a[first], b[first].astype(np.uint64), doc[first], tie[first], lo[first], np.zeros(len(first), bool)]
        whole = [np.concatenate(x) for x in zip([self.key, *self.columns], added)]
        if len(whole[0]) > REMEMBERED:
            # The newest come last; those met again go to the end.
            keep = np.argsort(whole[6], kind="stable")[-REMEMBERED:]
            whole = [x[keep] for x in whole]
        order = np.argsort(whole[0], kind="stable")
        self.key, *self.columns = (x[order] for x in whole)
        return out


def batch_spans(how: Windows, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 1 of a task: (doc, tie, text) to packed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent(how)
        for batch in parts(batches, 2):
            doc, tie = (np.asarray(batch.column(i)) for i in (0, 1))
            rank = rank_documents(doc, tie)
            found = []
            for first, _, data, offsets in spans.slices(batch.column(2), how.units.slice_bytes):
                cut = how.units(data, offsets)
                lo, hi, anchor = spans_of(cut, how)
                a = cut.ranges(anchor, np.full(len(anchor), how.gram), 5)
                some = how.may_repeat(a)
                lo, hi, anchor, a = lo[some], hi[some], anchor[some], a[some]
                row = np.searchsorted(cut.offsets, lo, "right") - 1
                b = spans.mix(cut.ranges(lo, hi - lo + how.size, 6) + (anchor - lo).astype(np.uint64))
                found.append((row + first, lo - cut.offsets[row], hi - lo + 1, a, b))
            if not found:
                continue
            row, lo, n, a, b = (np.concatenate(c) for c in zip(*found))
            where = rank[row] << 32 | lo
            order = np.lexsort((where, b, a))
            row, lo, n, a, b = row[order], lo[order], n[order], a[order], b[order]
            of = rank[row]
            new = starts_of(a, b)
            own = earliest(how, of, lo, first_of(new))
            # Of equal rows, those of a repeated document, one stands for all.
            twin = ~new & own & (of == np.roll(of, 1)) & (lo == np.roll(lo, 1))
            classes = np.cumsum(new)
            group = first_of(starts_of(a))
            direct = own & (classes - classes[group] >= SURROUNDINGS) if len(group) else own
            go = np.flatnonzero(own & ~direct & ~twin)
            again = go[sent.covers(a[go], b[go], doc[row[go]], tie[row[go]], lo[go])]
            own[again] = False
            kinds = []
            for kind, mask in ((COVERED, ~own), (RESOLVE, direct & ~twin)):
                if mask.any():
                    at_rank, at, length = joined(of[mask], lo[mask], n[mask])
                    some = np.empty(int(rank.max()) + 1, np.int64)
                    some[rank] = np.arange(len(rank))
                    none = np.zeros(0, np.uint64)
                    kinds.append(pack(int(rank.size * 7919 + doc[0]) % shards, kind, doc[some[at_rank]], tie[some[at_rank]], at, length, none, none))
            go = np.flatnonzero(own & ~direct & ~twin)
            go = go[np.lexsort((lo[go], of[go]))]
            out = sharded(kinds, shards, doc[row[go]], tie[row[go]], lo[go], n[go], a[go], b[go])
            if out is not None:
                yield out

    return run


def anchors(how: Windows, batches: Iterator[pa.RecordBatch], text: int) -> Iterator[np.ndarray]:
    """Keys of the anchors of all spans, as step 1 sees them."""
    for batch in batches:
        for _, _, data, offsets in spans.slices(batch.column(text), how.units.slice_bytes):
            cut = how.units(data, offsets)
            _, _, anchor = spans_of(cut, how)
            yield cut.ranges(anchor, np.full(len(anchor), how.gram), 5)


def gather(batches: Iterator[pa.RecordBatch], keyed: list) -> Iterator[pa.RecordBatch]:
    """Collect the keyed rows of a partition and pass the others on as marks."""
    for batch in batches:
        for kind, columns in unpack(batch):
            if kind == KEYED:
                keyed.append(columns)
            else:
                yield from marks(*columns[:4], kind == RESOLVE)


def equal_spans(how: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 2 of a partition: marks of covered spans and of spans to resolve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed: list = []
        yield from gather(batches, keyed)
        if not keyed:
            return
        doc, tie, lo, n, a, b = (np.concatenate(c) for c in zip(*keyed))
        keyed.clear()
        some, group = how.grouped(a, None)
        doc, tie, lo, n, b = (x[some] for x in (doc, tie, lo, n, b))
        some, class_ = how.grouped(b, group)
        doc, tie, lo, n, group = (x[some] for x in (doc, tie, lo, n, group))
        rank = rank_documents(doc, tie)
        order = np.lexsort((lo, rank, class_))  # within each class the earliest first
        doc, tie, lo, n, rank = (x[order] for x in (doc, tie, lo, n, rank))
        new, group = starts_of(class_[order]), starts_of(group[order])
        own = earliest(how, rank, lo, first_of(new))
        of = np.cumsum(group) - 1
        resolve = own & (np.bincount(of, new, minlength=1)[of] > 1)
        yield from marks(doc[~own], tie[~own], lo[~own], n[~own], False)
        yield from marks(doc[resolve], tie[resolve], lo[resolve], n[resolve], True)

    return run


def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tie, rest, text) with the text as zstandard frame, for the shuffle."""
    tool = zstandard.ZstdCompressor(level=3)
    for batch in parts(batches, 3):
        frames = [tool.compress(t.as_buffer()) for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(frames, pa.binary())], names=["doc", "tie", "rest", "frame"])


def texts_of(frames: pa.Array) -> pa.Array:
    tool = zstandard.ZstdDecompressor()
    return pa.array([tool.decompress(f.as_buffer()) for f in frames], pa.large_binary())


def batch_windows(how: Windows, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 3 of a task: (doc, tie, rest, frame, spans) to packed windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent(how)
        for whole in batches:
            asked = whole.filter(pc.is_valid(whole.column(4)))
            for start in range(0, asked.num_rows, 500):
                batch = asked.slice(start, 500)
                doc, tie = (np.asarray(batch.column(i)) for i in (0, 1))
                rank = rank_documents(doc, tie)
                lists = batch.column(4)
                bounds = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
                packed = np.asarray(lists.flatten())
                found = []
                for first, end, data, offsets in spans.slices(texts_of(batch.column(3)), 1_000_000):
                    cut = how.units(data, offsets)
                    mine = packed[bounds[first] : bounds[end]]
                    row = np.repeat(np.arange(first, end), np.diff(bounds[first : end + 1]))
                    lo, n = mine >> 32, mine & 0xFFFFFFFF
                    row, lo = np.repeat(row, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    at, size = lo + cut.offsets[row - first], np.full(len(lo), how.size)
                    found.append((row, lo, cut.ranges(at, size, 7), (cut.ranges(at, size, 8) >> np.uint64(32)).astype(np.uint32)))
                if not found:
                    continue
                row, lo, a, b = (np.concatenate(c) for c in zip(*found))
                of = rank[row]
                order = np.lexsort((of << 32 | lo, b, a))
                row, lo, a, b, of = row[order], lo[order], a[order], b[order], of[order]
                new = starts_of(a, b)
                own = earliest(how, of, lo, first_of(new))
                twin = ~new & (of == np.roll(of, 1)) & (lo == np.roll(lo, 1))
                go = np.flatnonzero(own & ~twin)
                own[go[sent.covers(a[go], b[go], doc[row[go]], tie[row[go]], lo[go])]] = False
                kinds = []
                if not own.all():
                    at_rank, at, length = joined(of[~own], lo[~own], np.ones(int((~own).sum()), np.int64))
                    some = np.empty(int(rank.max()) + 1, np.int64)
                    some[rank] = np.arange(len(rank))
                    none = np.zeros(0, np.uint64)
                    kinds.append(pack(int(rank.size * 7919 + doc[0]) % shards, COVERED, doc[some[at_rank]], tie[some[at_rank]], at, length, none, none))
                go = np.flatnonzero(own & ~twin)
                go = go[np.lexsort((lo[go], of[go]))]
                out = sharded(kinds, shards, doc[row[go]], tie[row[go]], lo[go], np.ones(len(go)), a[go], b[go])
                if out is not None:
                    yield out

    return run


def equal_windows(how: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 3 of a partition: marks of windows that are not the earliest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed: list = []
        yield from gather(batches, keyed)
        if not keyed:
            return
        doc, tie, lo, _, a, b = (np.concatenate(c) for c in zip(*keyed))
        keyed.clear()
        some, group = how.grouped(a, None)
        doc, tie, lo, b = (x[some] for x in (doc, tie, lo, b))
        some, class_ = how.grouped(b, group)
        doc, tie, lo = (x[some] for x in (doc, tie, lo))
        rank = rank_documents(doc, tie)
        order = np.lexsort((lo, rank, class_))
        doc, tie, lo, rank, class_ = doc[order], tie[order], lo[order], rank[order], class_[order]
        own = earliest(how, rank, lo, first_of(starts_of(class_)))
        at_rank, at, length = joined(rank[~own], lo[~own].astype(np.int64), np.ones(int((~own).sum()), np.int64))
        some = np.zeros(int(rank.max(initial=-1)) + 1, np.int64)
        some[rank] = np.arange(len(rank))
        yield from marks(doc[some[at_rank]], tie[some[at_rank]], at, length, False)

    return run


def repeated_windows(docs: DataFrame, how: Windows) -> DataFrame:
    """``docs`` (doc_id, text, others) as (rest, frame, repeats): all columns but the
    text as a struct; the text compressed, see ``texts_of``; and the starts of its
    windows that also start earlier, as array<long> of first start << 32 | count, null
    if there are none. Runs may overlap and are in no order."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("rest")
    keyed = docs.select(*doc_keys(), rest, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = keyed.select("doc", "tie", "text").mapInArrow(batch_spans(how, shards), PACKED).repartitionById(shards, "shard")
    found = staged(found.mapInArrow(equal_spans(how), MARKS), "spans")
    run = (F.shiftleft(F.col("lo").cast("long"), 32) + F.col("n")).alias("run")

    def listed(some: DataFrame) -> DataFrame:
        return some.select("doc", "tie", run).groupBy("doc", "tie").agg(F.collect_list("run").alias("repeats"))

    # Both joins read one exchange of the texts: the same rows, columns and join type.
    fields = [keyed.schema[c] for c in ("doc", "tie", "rest")]
    texts = keyed.mapInArrow(press, T.StructType([*fields, T.StructField("frame", T.BinaryType())]))
    asked = texts.join(listed(found.where("resolve")), ["doc", "tie"], "left").select("doc", "tie", "rest", "frame", "repeats")
    more = asked.mapInArrow(batch_windows(how, shards), PACKED).repartitionById(shards, "shard").mapInArrow(equal_windows(how), MARKS)
    every = found.where("not resolve").unionByName(more)
    return texts.join(listed(every), ["doc", "tie"], "left").select("rest", "frame", "repeats")


def covered(runs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of units that lie in a repeated window."""
    lo, end = runs >> 32, (runs >> 32) + (runs & 0xFFFFFFFF) + size - 1
    _, start, length = joined(np.zeros(len(lo), np.int64), lo, end - lo)
    return start, start + length
