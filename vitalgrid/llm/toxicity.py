"""Toxicity by class-conditional Kneser-Ney models.

Two models of pairs of words, one of toxic and one of ordinary text, give the pairs of a
document a likelihood; the score follows from the difference of the two log-likelihoods,
divided by the number of pairs. An occurrence is a document that holds a pair, so a
document counts each of its pairs once, in learning as in scoring. With n the labelled
documents of class c that hold something, the models interpolate as Kneser and Ney do:

    P_c(w | v) = (n_c(v w) - D) / h_c(v) + l_c(v) * P_c(w)
    P_c(w)     = (n_c(w) - D) / N_c      + l_c * P(w)
    P(w)       = (contexts(w) + 1/2) / (all contexts + vocabulary / 2)

h and N are the sums of the counts, l the mass that the discounts D freed, so all three
are probabilities that add up to 1. The last is shared: ``contexts`` counts after how many
different words (or the start of a text) a word is met in the whole corpus, labelled or
not. As in modified Kneser-Ney smoothing the discount depends on the count: it takes all
that the classes' shares explain, with a margin for chance,

    D = min(n_c, E + kappa * sqrt(E * (1 - share_c))),   E = share_c * (n_toxic + n_ordinary)

so expressions that are rare, or as frequent in both classes as the classes are, are left
to the shared counts in both models. ``kappa`` is chosen from ``KAPPAS``, and the
difference at which the score is 0.5 is set, by the errors on the labelled documents,
each scored with its own occurrences taken out of the counts n.

Words stand under hashes of 48 bits, and the contexts of a word are told apart by 32 of
them. The counts n are those of about ``LABELS`` labelled documents at most, the contexts
those of all documents: a task hands on every word once, with the set of its contexts, and
the sets of a word, or of a part of a frequent one, are united where they meet. Only
expressions whose count exceeds its discount differ from the shared model; they are
broadcast after a count, and beyond ``BROADCAST`` values joined to the texts' pairs.

Defined cases: null and empty texts have no pairs and the difference of a text of unknown
words, below any threshold; null labels are no labels; with labels of one class or none
every difference is 0 and nothing is toxic; a null doc_id counts as the empty text where
the held-out fold is chosen; repeated labels of a document count as toxic if one of them
says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.llm import spans
from vitalgrid.llm.contamination import hashed_words
from vitalgrid.session import staged

KAPPAS = (4.0, 5.0, 6.0)
LABELS = 32_000
#: Numbers that a broadcast of expressions may hold; 8 bytes each.
BROADCAST = 8_000_000
HELD = 1 << 21  # pairs that a task adds up before it hands them on
PARTS = 4096  # a word with more than one in so many occurrences has its contexts counted in parts
TOGETHER = 1 << 14  # contexts that a row holds
BINS = 1000  # of the histogram, per unit of difference
#: In place of the word before: the row holds occurrences of the word itself, or of all
#: pairs that it begins. 0 is the start of a text.
ITSELF, BEGINS = -1, -2
ORDINARY = 1 << 32  # an ordinary occurrence within a packed count; a toxic one is 1


# -- expressions of texts ------------------------------------------------------------


def pair_keys(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    return spans.mix(before.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + spans.mix(word.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))


def pairs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, word before and row of every place of a slice."""
    words, first = hashed_words(data, offsets)
    word = np.maximum((words >> np.uint64(16)).astype(np.int64), 1)
    before = np.concatenate([[0], word[:-1]])[: len(word)]
    before[first[:-1][first[:-1] < len(word)]] = 0
    return word, before, np.repeat(np.arange(len(first) - 1), np.diff(first))


def once_per_row(word: np.ndarray, before: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places that hold the first of equal pairs of a row."""
    key = pair_keys(word, before) ^ spans.mix((row + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(key, return_index=True)[1]


def found(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where in the sorted ``keys`` those asked for stand; behind the last if nowhere."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, len(keys))


def added_up(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Parts of (word, before, count) with every pair once."""
    word, before, count = (np.concatenate(x) for x in zip(*held))
    key = pair_keys(word, before)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    first = np.flatnonzero(new)
    return [word[order[first]], before[order[first]], np.add.reduceat(count[order], first) if len(first) else count]


def once(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Parts of (word, before) with every pair once."""
    word, before = (np.concatenate(x) for x in zip(*held))
    at = np.unique(pair_keys(word, before), return_index=True)[1]
    return [word[at], before[at]]


def in_turn(parts: Iterator[list[np.ndarray]], merge, send) -> Iterator[pa.RecordBatch]:
    """Parts merged while they are few; a task never holds much over ``HELD`` rows."""
    held, rows, merged = [], 0, 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows > merged + HELD // 2:
            held = [merge(held)]
            rows = merged = len(held[0][0])
            if merged > HELD:
                yield from send(*held[0])
                held, rows, merged = [], 0, 0
    if held:
        yield from send(*merge(held))


def sent(word: np.ndarray, before: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    # In order, so that rows of one word compress.
    order = np.lexsort((before, word))
    for at in range(0, len(order), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[order[at : at + 100_000]]) for c in (word, before, n)], names=["word", "before", "n"])


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) of labelled documents to (word, before, n): every pair of the task,
    with the documents that hold it; likewise words, and the pairs that a word begins."""

    def parts() -> Iterator[list[np.ndarray]]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for start, end, data, offsets in spans.slices(batch.column(0), 1_000_000):
                word, before, row = pairs_of(data, offsets)
                mine = label[start:end]
                at = once_per_row(word, before, row)
                word, before, row = word[at], before[at], row[at]
                n = np.where(mine[row] == 1, 1, ORDINARY).astype(np.int64)
                at = once_per_row(word, np.zeros(len(word), np.int64), row)
                yield added_up([[word, before, n], [before, np.full(len(n), BEGINS), n], [word[at], np.full(len(at), ITSELF), n[at]]])

    yield from in_turn(parts(), added_up, sent)


def context_task(frequent):
    """(text) to (word, part, contexts): the words of a task with the sets of 32 bits of
    the words before them. ``frequent`` is a broadcast of words and their parts."""

    def rows(word: np.ndarray, before: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, parts = frequent.value
        context = before.astype(np.uint32)
        part = context % np.append(parts, 1)[found(words, word)]
        order = np.lexsort((context, part, word))
        word, part, context = word[order], part[order], context[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        within = np.arange(len(word)) - np.repeat(first, np.diff(np.append(first, len(word))))
        first = np.flatnonzero(within % TOGETHER == 0)
        for at in range(0, len(first), 20_000):
            some = first[at : at + 20_000]
            ends = np.append(first, len(word))[at : at + len(some) + 1]
            held = pa.py_buffer(context[ends[0] : ends[-1]].tobytes())
            sets = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(((ends - ends[0]) * 4).astype(np.int32).tobytes()), held])
            yield pa.RecordBatch.from_arrays([pa.array(word[some]), pa.array(part[some].astype(np.int32)), sets], names=["word", "part", "contexts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                for _, _, data, offsets in spans.slices(batch.column(0), 1_000_000):
                    word, before, _ = pairs_of(data, offsets)
                    yield once([[word, before]])

        yield from in_turn(parts(), once, rows)

    return run


def union_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, part, contexts), in order of word and part, to (word, contexts): the sizes
    of the united sets. What a batch ends with is held for the next."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        word, part = (batch.column(i).to_numpy() for i in (0, 1))
        sets = batch.column(2)
        ends = np.frombuffer(sets.buffers()[1], np.int32, len(sets) + 1, sets.offset * 4)
        context = np.frombuffer(sets.buffers()[2], np.uint32, (ends[-1] - ends[0]) // 4, ends[0])
        size = np.diff(ends) // 4
        if held is not None:
            word, part = np.concatenate([[held[0]], word]), np.concatenate([[held[1]], part])
            context, size = np.concatenate([held[2], context]), np.concatenate([[len(held[2])], size])
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (part[1:] != part[:-1])
        group = np.cumsum(new) - 1
        every = np.unique(np.repeat(group, size).astype(np.int64) << 32 | context)
        count = np.bincount(every >> 32, minlength=group[-1] + 1)
        first = np.flatnonzero(new)
        held = word[first[-1]], part[first[-1]], (every[len(every) - count[-1] :] & 0xFFFFFFFF).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(word[first[:-1]]), pa.array(count[:-1])], names=["word", "contexts"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([len(held[2])], pa.int64())], names=["word", "contexts"])


PAIRS = "word long, before long, n long"


# -- learning ------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_labels(labels: DataFrame, bound: int = LABELS) -> DataFrame:
    """(label_id, label) of the documents to learn from, about ``bound`` at most."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    share = bound / max(bound, known.count())
    return known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def toxic_of(n: Column) -> Column:
    return n.bitwiseAND(F.lit(ORDINARY - 1)).cast("double")


def ordinary_of(n: Column) -> Column:
    return F.shiftright(n, 32).cast("double")


def excess(n: Column, both: Column, share: float, kappa: float) -> Column:
    """What the discount leaves of a count."""
    return F.greatest(F.lit(0.0), n - (both * share + F.sqrt(both * (share * (1 - share))) * kappa))


@dataclass(frozen=True)
class Variant:
    """A margin, and the class of the document whose own occurrence is taken out."""

    kappa: float
    own: int | None = None

    def counts(self, n: Column) -> tuple[Column, Column]:
        """Ordinary and toxic occurrences."""
        o, t = ordinary_of(n), toxic_of(n)
        return (F.greatest(o - 1, F.lit(0.0)) if self.own == 0 else o), (F.greatest(t - 1, F.lit(0.0)) if self.own == 1 else t)

    def excesses(self, n: Column, share: float) -> tuple[Column, Column]:
        o, t = self.counts(n)
        return excess(o, o + t, 1 - share, self.kappa), excess(t, o + t, share, self.kappa)


#: Whoever's occurrence is taken out.
OWNS = (None, 0, 1)


def may_tell(n: Column, share: float) -> Column:
    """Whether a count exceeds its discount in any variant."""
    least = [x for own in OWNS for x in Variant(min(KAPPAS), own).excesses(n, share)]
    return F.greatest(*least) > 0


@dataclass(frozen=True)
class Counts:
    """``words``: word, itself, begins (packed counts), contexts. ``pairs``: word, before,
    n, of those pairs whose count may exceed its discount. Sums are of ordinary and toxic
    occurrences; ``share`` is that of the toxic among the labelled documents."""

    words: DataFrame
    pairs: DataFrame
    share: float
    sums: tuple[float, float]
    contexts: float
    vocabulary: float


def contexts(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(word, contexts) of all words of all texts. Words with more than one in ``PARTS``
    occurrences in ``words``, so fewer than that many, are counted in parts; results do
    not depend on it."""
    n = ordinary_of(F.col("itself")) + toxic_of(F.col("itself"))
    every = words.agg(F.sum(n)).first()[0] or 0.0
    parts = F.ceil(n * PARTS / max(every, 1.0)).cast("int").alias("parts")
    rows = words.select("word", parts).where("parts > 1").toArrow().sort_by("word")
    frequent = texts.sparkSession.sparkContext.broadcast((rows.column("word").to_numpy(), rows.column("parts").to_numpy().astype(np.uint32)))
    sets = texts.mapInArrow(context_task(frequent), "word long, part int, contexts binary")
    met = sets.repartition("word", "part").sortWithinPartitions("word", "part").mapInArrow(union_task, "word long, contexts long")
    return met.groupBy("word").agg(F.sum("contexts").alias("contexts"))


def count(docs: DataFrame, labels: DataFrame) -> Counts | None:
    """Counts of the labelled documents and contexts of the whole corpus; None without
    labels of both classes."""
    # About LABELS rows of 12 bytes at most.
    known = F.broadcast(staged(fit_labels(labels), "labels"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    labelled = docs.select(F.col("doc_id").cast("long").alias("label_id"), text).join(known, "label_id").select("text", "label")
    n, m = labelled.agg(F.count("*"), F.sum("label")).first()
    if not m or m == n:
        return None
    share = m / n
    summed = labelled.mapInArrow(count_task, PAIRS).groupBy("word", "before").agg(F.sum("n").alias("n"))
    summed = staged(summed.where((F.col("before") < 0) | may_tell(F.col("n"), share)), "expressions")
    of = lambda mark: F.sum(F.when(F.col("before") == mark, F.col("n")).otherwise(0))
    words = summed.where("before < 0").groupBy("word").agg(of(ITSELF).alias("itself"), of(BEGINS).alias("begins"))
    words = staged(words, "words")
    o, t = words.agg(F.sum(ordinary_of(F.col("itself"))), F.sum(toxic_of(F.col("itself")))).first()
    met = staged(contexts(docs.select(text), words), "contexts")
    every, vocabulary = met.agg(F.sum("contexts"), F.count("*")).first()
    words = words.join(met, "word", "left").fillna(0, ["contexts"])
    return Counts(staged(words, "words"), summed.where("before >= 0"), share, (o or 1.0, t or 1.0), float(every or 0), float(vocabulary))


def as_array(columns: list[Column], name: str) -> Column:
    return F.array(*columns).alias(name)


@dataclass(frozen=True)
class Tables:
    """What expressions add to the log ratio of a text, in several variants: ``words``
    (word, itself, begins) for a word and for the pairs that it begins, ``pairs`` (word,
    before, value). ``unknown`` is the ratio of every other pair, by variant."""

    words: DataFrame
    pairs: DataFrame
    unknown: tuple[float, ...]

    def size(self) -> int:
        """Numbers in both tables."""
        return (2 * self.words.count() + self.pairs.count()) * len(self.unknown)


def tables(c: Counts, variants: list[Variant]) -> Tables:
    """The models' log ratios, toxic over ordinary, as sums of what differs from the
    shared model."""
    kappas = sorted({v.kappa for v in variants})
    left = {}  # mass that the discounts freed, by kappa
    sums = c.words.agg(*[F.sum(x) for k in kappas for x in Variant(k).excesses(F.col("itself"), c.share)]).first()
    for i, k in enumerate(kappas):
        left[k] = tuple(1 - sums[2 * i + j] / c.sums[j] for j in (0, 1))
    shared = (F.col("contexts") + 0.5) / (c.contexts + c.vocabulary / 2)

    def models(n: Column, v: Variant) -> list[Column]:
        """P_c(w), ordinary and toxic."""
        return [x / c.sums[j] + shared * left[v.kappa][j] for j, x in enumerate(v.excesses(n, c.share))]

    # What the pairs that a word begins leave of the counts of those pairs.
    taken = c.pairs.groupBy("before").agg(*[F.sum(x).alias(f"x{j}_{i}") for i, k in enumerate(kappas) for j, x in enumerate(Variant(k).excesses(F.col("n"), c.share))])
    begins = c.words.join(taken.withColumnRenamed("before", "word"), "word", "left")
    sizes = [ordinary_of(F.col("begins")), toxic_of(F.col("begins"))]

    def kept(i: int, j: int) -> Column:
        return F.coalesce(1 - F.col(f"x{j}_{i}") / F.when(sizes[j] > 0, sizes[j]), F.lit(1.0))

    unknown = tuple(float(np.log(left[v.kappa][1] / left[v.kappa][0])) for v in variants)
    itself = []
    for v, u in zip(variants, unknown):
        o, t = models(F.col("itself"), v)
        itself.append(F.log(t / o) - u)
    at = {k: i for i, k in enumerate(kappas)}
    starts = [F.log(kept(at[v.kappa], 1) / kept(at[v.kappa], 0)) for v in variants]
    tells = F.greatest(*[F.abs(F.col("itself_value")[i]) for i in range(len(variants))], *[F.abs(F.col("begins_value")[i]) for i in range(len(variants))]) > 1e-12
    words = begins.select("word", as_array(itself, "itself_value"), as_array(starts, "begins_value")).where(tells)
    words = words.select("word", F.col("itself_value").alias("itself"), F.col("begins_value").alias("begins"))

    ends = c.words.select("word", "itself", "contexts")
    before = begins.select(
        F.col("word").alias("before"), *[s.alias(f"h{j}") for j, s in enumerate(sizes)], *[kept(i, j).alias(f"l{j}_{i}") for i in range(len(kappas)) for j in (0, 1)]
    )
    joined = c.pairs.join(ends, "word").join(before, "before")
    values = []
    for v in variants:
        i, x, p = at[v.kappa], v.excesses(F.col("n"), c.share), models(F.col("itself"), v)
        more = [F.coalesce(F.log1p(x[j] / F.when(F.col(f"h{j}") > 0, F.col(f"h{j}") * F.col(f"l{j}_{i}") * p[j])), F.lit(0.0)) for j in (0, 1)]
        values.append(more[1] - more[0])
    pairs = joined.select("word", "before", as_array(values, "value"))
    told = F.greatest(*[F.abs(F.col("value")[i]) for i in range(len(variants))], F.lit(0.0)) > 1e-12
    return Tables(staged(words, "word-values"), staged(pairs.where(told), "pair-values"), unknown)


# -- scoring -------------------------------------------------------------------------


def arrays(t: Tables) -> dict[str, np.ndarray]:
    """Both tables by key, each with a last row of zeros for what is not in them."""

    def values(column: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
        flat = column.combine_chunks().flatten().to_numpy().reshape(-1, len(t.unknown))
        return np.concatenate([flat[order], np.zeros((1, len(t.unknown)))])

    words, pairs = t.words.toArrow(), t.pairs.toArrow()
    word = words.column("word").to_numpy()
    key = pair_keys(pairs.column("word").to_numpy(), pairs.column("before").to_numpy())
    by_word, by_key = np.argsort(word), np.argsort(key)
    return {
        "word": word[by_word], "itself": values(words.column("itself"), by_word), "begins": values(words.column("begins"), by_word),
        "pair": key[by_key], "value": values(pairs.column("value"), by_key), "unknown": np.array(t.unknown),
    }


def differences(held, text: int):
    """Of a batch, the mean log ratio of each row's pairs, by variant. ``held`` is a
    broadcast of ``arrays``."""

    def run(batch: pa.RecordBatch) -> np.ndarray:
        m = held.value
        out = np.zeros((batch.num_rows, len(m["unknown"])))
        for start, end, data, offsets in spans.slices(batch.column(text), 1_000_000):
            word, before, row = pairs_of(data, offsets)
            at = once_per_row(word, before, row)
            word, before, row = word[at], before[at], row[at]
            size = np.maximum(np.bincount(row, minlength=end - start), 1)
            for keys, asked, value in (("word", word, "itself"), ("word", before, "begins"), ("pair", pair_keys(word, before), "value")):
                place = found(m[keys], asked)
                hit = place < len(m[keys])
                for i in range(out.shape[1]):
                    out[start:end, i] += np.bincount(row[hit], m[value][place[hit], i], end - start) / size
        return out + m["unknown"]

    return run


def expression_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, text) to (uid, word, before, n): the pairs of every row, and their number;
    one row without a word for a text without any."""
    for batch in batches:
        for start, end, data, offsets in spans.slices(batch.column(1), 1_000_000):
            word, before, row = pairs_of(data, offsets)
            at = once_per_row(word, before, row)
            empty = np.flatnonzero(np.bincount(row, minlength=end - start) == 0)
            row = np.concatenate([row[at], empty])
            word, before = (np.concatenate([c[at], np.full(len(empty), -9)]) for c in (word, before))
            size = np.bincount(row, minlength=end - start)
            uid = batch.column(0)[start:end].take(pa.array(row))
            yield pa.RecordBatch.from_arrays([uid, pa.array(word), pa.array(before), pa.array(size[row])], names=["uid", "word", "before", "n"])


def joined_differences(texts: DataFrame, t: Tables) -> DataFrame:
    """(uid, x) of (uid, text), the same as ``differences`` by joins: for more
    expressions than fit a broadcast. Rows of a frequent word are many only on the side
    of the texts, where adaptive execution splits them."""
    rows = texts.select("uid", "text").mapInArrow(expression_task, "uid long, word long, before long, n long")
    begins = t.words.select(F.col("word").alias("before"), "begins")
    rows = rows.join(t.words.select("word", "itself"), "word", "left").join(begins, "before", "left").join(t.pairs, ["word", "before"], "left")
    sums = rows.groupBy("uid").agg(
        *[sum((F.sum(F.coalesce(F.col(c)[i], F.lit(0.0))) for c in ("itself", "begins", "value")), F.lit(0.0)).alias(f"s{i}") for i in range(len(t.unknown))],
        F.max("n").alias("n"),
    )
    return sums.select("uid", as_array([F.col(f"s{i}") / F.col("n") + u for i, u in enumerate(t.unknown)], "x"))


def with_differences(texts: DataFrame, t: Tables, broadcast: int = BROADCAST) -> DataFrame:
    """``texts`` with ``x``, the differences by variant as array<double>; its column
    ``text`` is never null."""
    if t.size() > broadcast:
        # Written, so that a row has the same number on both sides.
        marked = staged(texts.withColumn("uid", F.monotonically_increasing_id()), "numbered")
        return marked.join(joined_differences(marked, t), "uid").drop("uid")
    difference = differences(texts.sparkSession.sparkContext.broadcast(arrays(t)), texts.columns.index("text"))
    width = len(t.unknown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            x = pa.ListArray.from_arrays(offsets, pa.array(difference(batch).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, x], names=[*batch.schema.names, "x"])

    return texts.mapInArrow(run, T.StructType([*texts.schema.fields, T.StructField("x", T.ArrayType(T.DoubleType()))]))


@dataclass(frozen=True)
class Model:
    """Tables of the chosen margin, the difference at which the score is 0.5, and the
    one of unknown words. Without tables every difference is 0."""

    tables: Tables | None = None
    kappa: float = KAPPAS[0]
    threshold: float = 1.0
    unknown: float = 0.0


def best_threshold(bins: list[tuple[int, int, int]], least_cut: int) -> tuple[int, float]:
    """Errors, and the middle of the cuts above which to say toxic makes the fewest.
    ``bins``: (bin, ordinary, toxic). A cut lies above bin ``least_cut``."""
    bins = sorted(bins)
    errors = sum(t for _, _, t in bins)
    fewest, cuts = errors, [max([least_cut, *(b for b, _, _ in bins)]) + 1.0]
    for i in range(len(bins) - 1, -1, -1):
        b, o, t = bins[i]
        if b <= least_cut:
            break
        errors += o - t  # with the cut below this bin
        below = max(bins[i - 1][0] if i else b - 1, least_cut)
        if errors < fewest:
            fewest, cuts = errors, []
        if errors == fewest:
            cuts.append((below + 1 + b) / 2)
    return fewest, cuts[len(cuts) // 2] / BINS


def fit(docs: DataFrame, labels: DataFrame, broadcast: int = BROADCAST) -> Model:
    """Learn from the labels outside the held-out fold and from all texts."""
    c = count(docs, labels)
    if c is None:
        return Model()
    variants = [Variant(k, own) for k in KAPPAS for own in (0, 1)]
    trial = tables(c, variants)
    known = F.broadcast(staged(fit_labels(labels), "labels"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    labelled = docs.select(F.col("doc_id").cast("long").alias("label_id"), text).join(known, "label_id").select("text", "label")
    scored = with_differences(labelled, trial, broadcast)
    own = F.array(*[F.when(F.col("label") == 1, F.col("x")[2 * i + 1]).otherwise(F.col("x")[2 * i]) for i in range(len(KAPPAS))])
    one = scored.select("label", F.posexplode(own).alias("kappa", "x")).withColumn("bin", F.floor(F.col("x") * BINS))
    # A row per margin and bin; differences are within some tens.
    bins = one.groupBy("kappa", "bin").agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).collect()
    best = None
    for i, k in enumerate(KAPPAS):
        unknown = trial.unknown[2 * i]
        errors, cut = best_threshold([(r.bin, r.n - r.toxic, r.toxic) for r in bins if r.kappa == i], int(np.floor(unknown * BINS)))
        if best is None or errors < best[0]:
            best = errors, k, cut, unknown
    _, kappa, cut, unknown = best
    return Model(tables(c, [Variant(kappa)]), kappa, cut, unknown)


def with_scores(docs: DataFrame, model: Model, broadcast: int = BROADCAST) -> DataFrame:
    """(the columns of ``docs``, text never null), difference, score."""
    texts = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    if model.tables is None:
        return texts.withColumns({"difference": F.lit(0.0), "score": 1 / (1 + F.exp(F.lit(2.0)))})
    x = F.col("x")[0]
    # -2 for unknown words, 0 at the threshold.
    slope = 2 / max(model.threshold - model.unknown, 1e-9)
    scored = with_differences(texts, model.tables, broadcast)
    away = F.least(F.greatest((x - model.threshold) * slope, F.lit(-40.0)), F.lit(40.0))
    return scored.withColumns({"difference": x, "score": 1 / (1 + F.exp(-away))}).drop("x")


def scores(docs: DataFrame, labels: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """doc_id, held_out, score, predicted, difference of every document."""
    model = fit(docs, labels, broadcast)
    scored = with_scores(docs.select("doc_id", "text"), model, broadcast)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "difference")


def keep_ordinary(docs: DataFrame, labels: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """``docs`` without the documents predicted toxic. Where the expressions are broadcast
    the decision is made where the text is, so nothing is joined."""
    model = fit(docs, labels, broadcast)
    if model.tables is None:
        return docs
    # The row goes along whole, so its columns may have any names.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col("text"))
    kept = with_scores(rows, model, broadcast).where("score < 0.5")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
