"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, A-Z lower-cased; everything else separates. The
words of the test items are counted over the whole corpus. An n-gram whose words would
meet by chance less than once in ``RARE`` places is a seed, and in any case the rarer
half of an item's n-grams are. (The words are counted and not the n-grams, because the
n-grams that an edited copy lacks would be the rarest.) Where ``HITS`` seeds of an item
stand near each other in a document, the item is aligned with the words around them,
twice over its length, by Smith-Waterman: a match counts 1, another word or a gap takes
``PENALTY``. The score is the best sum over the item's words; a document holds the item
if it reaches ``LEAST``. With n = 2, a copy in which every third word is another still
has seeds.

Items, counts, seeds and hits are tables; none of them passes through the driver. The
corpus is read twice at any size of the benchmark. The first time tasks count the words
that a filter of the items' words lets pass, the second time they look for n-grams that a
filter of the seeds lets pass, and hand on the hashed words of documents that hold any. Both filters are bitmaps of ``FILTER_BITS`` bits; what they let pass
beyond the words and seeds, the joins that follow drop. Seeds are joined to the n-grams of
documents; where enough of an item's seeds stand together, the words of the document
around them and those of the item meet in one row and are aligned. Documents go by 128
bits of their text, so copies are looked at once.

Defined cases: null and empty texts and items have no words and match nothing; an item
of fewer words than n matches nothing; repeated items and repeated rows match each on
its own; a null id is output as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm import spans
from vitalgrid.session import staged

N, PENALTY, LEAST = 2, 0.5, 0.5
RARE, HITS = 1_000_000, 2
#: A filter; 4 MB.
FILTER_BITS = 1 << 25

#: Bytes of words: letters and digits, and all bytes of other scripts' characters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
APART = np.array([not (c >= 128 or chr(c).isalnum()) for c in range(256)])
FOLD = np.where(APART, np.uint8(0x20), LOWER)


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a slice, and the first word of every row."""
    folded = FOLD[data]
    starts, ends, first = spans.word_spans(folded, offsets)
    return spans.word_hashes(folded, starts, ends, 1), first


def grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and place in the slice of every n-gram within a row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    runs = spans.run_hashes(words, n, 4)
    at = np.flatnonzero(row[: len(runs)] == row[n - 1 :]) if len(runs) else np.zeros(0, np.int64)
    return runs[at], row[at], at


def align(item: np.ndarray, words: np.ndarray, penalty: float = PENALTY) -> tuple[float, int]:
    """Best local alignment: its sum and the end of its words. Row by row; a run of
    gaps along the row is a running maximum."""
    slope = penalty * np.arange(len(words) + 1)
    above, best, end = np.zeros(len(words) + 1), 0.0, 0
    for word in item:
        row = np.zeros(len(words) + 1)
        row[1:] = np.maximum(above[:-1] + np.where(words == word, 1.0, -penalty), above[1:] - penalty)
        np.maximum(row, 0.0, out=row)
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.argmax())
        if above[top] > best:
            best, end = float(above[top]), top
    return best, end


def filter_of(keys: DataFrame, bits: int) -> bytes:
    """A bitmap with a bit for every ``key``; its size is fixed."""
    at = F.pmod(F.col("key"), F.lit(bits)) + 1  # bitmap buckets count from 1
    buckets = keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
    size = 4096  # bytes of a bucket
    out = bytearray(-(-bits // (8 * size)) * size)
    for r in buckets.collect():
        out[(r.bucket - 1) * size : r.bucket * size] = r.bitmap
    return bytes(out)


def passing(held: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Which keys (int64) a filter lets pass."""
    at = np.mod(keys, bits)
    return held[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def item_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) to (item, place, word)."""
    for batch in batches:
        for first, end, data, offsets in spans.slices(batch.column(1), 500_000):
            words, start = hashed_words(data, offsets)
            row = np.repeat(np.arange(first, end), np.diff(start))
            place = np.arange(len(words)) - np.repeat(start[:-1], np.diff(start))
            columns = [batch.column(0).take(pa.array(row)), pa.array(place), pa.array(signed(words))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "place", "word"])


#: In place of a word: the row counts all words.
EVERY = -(2**63)


def count_task(shipped, bits: int):
    """(text) to (word, n) of the words that a filter lets pass, and of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, every = np.frombuffer(shipped.value, np.uint8), 0
        words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, _, data, offsets in spans.slices(batch.column(0), 500_000):
                found = signed(hashed_words(data, offsets)[0])
                every += len(found)
                found = found[passing(held, bits, found)]
                both = np.concatenate([words, found])
                words, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, np.ones(len(found), np.int64)]), len(words)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([EVERY, *words.tolist()], pa.int64()), pa.array([every, *counts.tolist()], pa.int64())], names=["word", "n"])

    return run


def seeds_of(words: np.ndarray, counts: np.ndarray, every: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the seeds of an item."""
    runs = spans.run_hashes(words, n, 4)
    share = np.log((counts + 1) / (every + 1))
    chance = sum(share[k : len(share) - n + 1 + k] for k in range(n))
    rare = chance < -np.log(RARE)
    rare[np.argsort(chance, kind="stable")[: (len(runs) + 1) // 2]] = True
    return runs[rare], np.flatnonzero(rare)


def seed_task(every: int, n: int):
    """(item, words, counts) to (key, item, place, size): the seeds of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words, counts in zip(*(c for c in batch.columns)):
                words, counts = (np.array(x.values) for x in (words, counts))
                if len(words) >= n:
                    key, place = seeds_of(words.view(np.uint64), counts, every, n)
                    size = len(key)
                    columns = [signed(key), np.full(size, item.as_py()), place, np.full(size, len(words))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "item", "place", "size"])

    return run


def items_and_seeds(docs: DataFrame, benchmark: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, words) and (key, item, place, size) of all items."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = staged(benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", text.alias("text")), "items")
    words = staged(named.select("item", "text").mapInArrow(item_task, "item long, place long, word long"), "item-words")
    asked = spark.sparkContext.broadcast(filter_of(words.select(F.col("word").alias("key")), FILTER_BITS))
    counted = docs.select(text).mapInArrow(count_task(asked, FILTER_BITS), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = staged(counted, "word-counts")
    every = counted.where(F.col("word") == EVERY).agg(F.sum("n")).first()[0] or 0
    met = words.join(counted, "word", "left").select("item", F.struct("place", "word", F.coalesce("n", F.lit(0)).alias("n")).alias("w"))
    # As long as an item's text.
    each = met.groupBy("item").agg(F.sort_array(F.collect_list("w")).alias("w"))
    each = staged(each.select("item", F.col("w.word").alias("words"), F.col("w.n").alias("counts")), "counted-items")
    seeds = staged(each.mapInArrow(seed_task(every, n), "key long, item long, place long, size long"), "seeds")
    return each.join(named.select("item", "item_id"), "item").select("item", "item_id", "words"), seeds


def regions(item: np.ndarray, size: np.ndarray, place: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, start, end) of the words to align, overlapping ones of an item merged.
    An item of few n-grams needs one seed there, any other ``HITS``."""
    low, high = at - place - size // 2, at - place + size + size // 2
    out: list[list] = []
    for k in np.lexsort((low, item)).tolist():
        i, a, b = int(item[k]), int(low[k]), int(high[k])
        if out and out[-1][0] == i and a <= out[-1][2]:
            out[-1][2] = max(out[-1][2], b)
            out[-1][3].add(int(place[k]))
        else:
            out.append([i, a, b, {int(place[k])}, int(size[k])])
    return [(i, a, b) for i, a, b, places, words in out if len(places) >= HITS or words < 4 * HITS]


KEY = ["k1", "k2"]


def text_keys() -> list[Column]:
    """128 bits that stand for a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(F.lit(i), text).alias(k) for i, k in enumerate(KEY, 1)]


def hit_task(shipped, bits: int, n: int):
    """(k1, k2, text) to (k1, k2, words, keys, places) of the documents that hold enough
    n-grams which the filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shipped.value, np.uint8)
        for batch in batches:
            for first, end, data, offsets in spans.slices(batch.column(2), 500_000):
                words, start = hashed_words(data, offsets)
                keys, row, at = grams(words, start, n)
                keys = signed(keys)
                some = passing(held, bits, keys)
                keys, row, at = keys[some], row[some], at[some]
                number = np.bincount(row, minlength=end - first)
                rows = np.flatnonzero(number)
                cuts = np.concatenate([[0], np.cumsum(number[rows])]).astype(np.int32)
                texts = [words[start[r] : start[r + 1]].tobytes() for r in rows.tolist()]
                taken = pa.array(rows + first)
                columns = [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(texts, pa.binary())]
                columns += [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (keys, at - start[row])]
                yield pa.RecordBatch.from_arrays(columns, names=[*KEY, "words", "keys", "places"])

    return run


def region_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, item, size, hits) to (k1, k2, item, low, high): the words to align."""
    for batch in batches:
        rows, low, high = [], [], []
        for i, (size, hits) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4))):
            at, place = (x.to_numpy() for x in hits.values.flatten())
            found = regions(np.zeros(len(at), np.int64), np.full(len(at), size), place, at)
            rows += [i] * len(found)
            low += [max(a, 0) for _, a, _ in found]
            high += [b for _, _, b in found]
        taken = pa.array(rows, pa.int64())
        columns = [*(batch.column(i).take(taken) for i in range(3)), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*KEY, "item", "low", "high"])


def cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, item, low, high, words of the text) to (.., low, the words between)."""
    for batch in batches:
        low, high = (batch.column(i).to_pylist() for i in (3, 4))
        parts = [raw.as_buffer()[8 * a : 8 * b].to_pybytes() for raw, a, b in zip(batch.column(5), low, high)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(parts, pa.binary())], names=[*KEY, "item", "low", "part"])


def align_task(least: float):
    """(k1, k2, item_id, low, part, words of the item) to (k1, k2, item_id, score, end_word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, ends = [], []
            for low, part, item in zip(batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                item = np.array(item.values).view(np.uint64)
                total, end = align(item, np.frombuffer(part.as_buffer(), np.uint64))
                scores.append(total / len(item))
                ends.append(low + end)
            found = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores, pa.float64()), pa.array(ends, pa.int64())], names=[*KEY, "item_id", "score", "end_word"])
            yield found.filter(pc.greater_equal(found.column(3), least))

    return run


def held_items(docs: DataFrame, benchmark: DataFrame, n: int, least: float) -> DataFrame:
    """(k1, k2, item, item_id, score, end_word) of every text and item that it holds."""
    spark = docs.sparkSession
    items, seeds = items_and_seeds(docs, benchmark, n)
    asked = spark.sparkContext.broadcast(filter_of(seeds.select("key"), FILTER_BITS))
    texts = docs.select(*text_keys(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = "k1 long, k2 long, words binary, keys array<long>, places array<long>"
    found = texts.mapInArrow(hit_task(asked, FILTER_BITS, n), schema)
    # Copies are one.
    found = staged(found.groupBy(KEY).agg(*[F.first(c).alias(c) for c in ("words", "keys", "places")]), "hits")
    grams_ = found.select(*KEY, F.explode(F.arrays_zip("keys", "places")).alias("g")).select(*KEY, F.col("g.keys").alias("key"), F.col("g.places").alias("at"))
    hits = grams_.join(seeds, "key").groupBy(*KEY, "item", "size").agg(F.collect_list(F.struct("at", "place")).alias("hits"))
    # One seed is not enough but for an item of few n-grams.
    near = hits.where((F.size("hits") >= HITS) | (F.col("size") < 4 * HITS))
    regions_ = near.mapInArrow(region_task, "k1 long, k2 long, item long, low long, high long")
    parts = regions_.join(found.select(*KEY, "words"), KEY).select(*KEY, "item", "low", "high", "words")
    parts = parts.mapInArrow(cut_task, "k1 long, k2 long, item long, low long, part binary")
    pairs = parts.join(items.withColumnRenamed("item", "number"), F.col("item") == F.col("number"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = f"k1 long, k2 long, item struct<number:bigint,item_id:{kind}>, score double, end_word long"
    rows = pairs.select(*KEY, F.struct("number", "item_id").alias("item"), "low", "part", "words")
    aligned = rows.mapInArrow(align_task(least), out.replace("item struct", "item_id struct"))
    best = F.max_by(F.struct("score", "end_word"), F.struct("score", -F.col("end_word")))
    best = aligned.groupBy(*KEY, "item_id").agg(best.alias("best"))
    return best.select(*KEY, F.col("item_id.number").alias("item"), F.col("item_id.item_id").alias("item_id"), "best.*")


def matches(docs: DataFrame, benchmark: DataFrame, n: int = N, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score, end_word (in the document) for every document that
    holds an item; the best place, or the first of equal ones."""
    found = staged(held_items(docs, benchmark, n, least), "matches")
    return docs.select("doc_id", *text_keys()).join(found, KEY).select("doc_id", "item_id", "score", "end_word")


def clean(docs: DataFrame, benchmark: DataFrame, n: int = N, least: float = LEAST) -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    bad = staged(held_items(docs, benchmark, n, least).select(*KEY).distinct(), "held")
    # The row goes along whole, so its columns may have any names.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *text_keys())
    kept = rows.join(bad, KEY, "left_anti")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
