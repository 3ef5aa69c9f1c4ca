"""Both substring operators against brute force."""

import hashlib
import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import repeats, substring, suffix

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def ordered(rows):
    """Documents in order; equal rows are one."""
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))


def brute_bytes(rows, size):
    seen, out = set(), {}
    for doc_id, text in ordered(rows):
        raw = (text or "").encode()
        gone = set()
        for i in range(len(raw) - size + 1):
            window = raw[i : i + size]
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        kept = bytes(b for i, b in enumerate(raw) if i not in gone)
        spans = sum(i - 1 not in gone for i in gone)
        out[doc_id] = (len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, size):
    seen, out = {}, {}
    for doc_id, text in ordered(rows):
        words = WORD.findall((text or "").encode())
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if seen.setdefault(window, doc_id) != doc_id:
                gone.update(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    """Copies, edited copies, shared passages, runs, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(rng.randint(15, 40)) for _ in range(4)]
    texts = [None, "", "   ", "ab", "a" * 700, "ab " * 300, "a" * 650, "\n\t x" * 90]
    for _ in range(40):
        words = prose(rng.randint(1, 120))
        if rng.random() < 0.6:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    for _ in range(25):
        words = (rng.choice(texts) or "").split(" ")
        if rng.random() < 0.6:
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    ids = rng.sample(range(-50, 400), len(texts))
    rows = list(zip(ids, texts))
    return [*rows, rows[10], (None, texts[20])]


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for size in (100, 12) if seed == 1 else (41,):
        got = suffix.digests(docs, size).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: tuple(r)[1:] for r in got} == brute_bytes(rows, size)


@pytest.mark.parametrize("seed", [3, 4])
def test_words_against_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for size in (13, 3) if seed == 3 else (6,):
        got = substring.digests(docs, size).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: tuple(r)[1:4] for r in got} == brute_words(rows, size)


def test_real_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: tuple(r)[1:] for r in suffix.digests(docs).collect()} == brute_bytes(rows, 100)
    assert {r.doc_id: tuple(r)[1:4] for r in substring.digests(docs).collect()} == brute_words(rows, 13)


def test_many_surroundings(spark):
    """One passage in every document, each time between other words."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) + f" {passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: tuple(r)[1:] for r in suffix.digests(docs).collect()} == brute_bytes(rows, 100)
    assert {r.doc_id: tuple(r)[1:4] for r in substring.digests(docs).collect()} == brute_words(rows, 13)


def test_same_id_other_text(spark):
    """Rows that share an id but not the text: one of the two comes first."""
    shared = " ".join(f"s{i}" for i in range(50))
    docs = spark.createDataFrame([(7, shared + " one"), (7, shared + " two")], "doc_id long, text string")
    assert sorted(r.n_removed > 0 for r in suffix.digests(docs).collect()) == [False, True]


def test_empty_and_extra_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, lo string, repeats int, tie int, text string")
    assert suffix.digests(docs).count() == 0 and substring.digests(docs).count() == 0
    one = spark.createDataFrame([(1, "x", 2, 3, "a b")], docs.schema)
    assert suffix.digests(one).collect()[0][:4] == (1, 3, 0, 0)


def test_removal_keeps_whole_characters():
    assert suffix.clean_text("aéb".encode(), [{"start": 2, "end": 3}]) == "ab"


@pytest.mark.parametrize("grouped", [suffix.by_digit, substring.exactly])
@pytest.mark.parametrize("kind", [np.uint64, np.uint32])
def test_groups_are_those_of_equal_keys(grouped, kind):
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 2**31, 3000), np.arange(50), np.arange(50), rng.integers(0, 30, 400)]).astype(kind) * kind(0x10003)
    for given in (None, rng.integers(0, 3, len(keys))):
        left, group = grouped(keys, given)
        found, want = {}, {}
        for i, g in zip(left.tolist(), group.tolist()):
            found.setdefault(g, set()).add(i)
        for i, k in enumerate(keys.tolist()):
            want.setdefault((k, None if given is None else int(given[i])), set()).add(i)
        if given is None:
            want = {k: v for k, v in want.items() if len(v) > 1}
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
        assert (np.diff(group) >= 0).all() and set(group.tolist()) == set(range(len(found)))
        if given is not None:
            assert (np.diff(given[left]) >= 0).all()
    assert [len(x) for x in grouped(keys[:0], None)] == [0, 0] == [len(x) for x in grouped(keys[:0], keys[:0].astype(int))]


@pytest.mark.parametrize("cells", [16, 1000, 1 << 20])
def test_sketch_never_underestimates(spark, cells):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += texts[:20]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    how = substring.windows(6, 3)
    found = substring.sketch(docs, how, cells)
    assert len(found.bits) == substring.ROWS
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    keys = np.concatenate(list(repeats.anchors(how, [batch], 0)))
    once, at, count = np.unique(keys, return_index=True, return_counts=True)
    estimate = found.repeated(once)
    assert estimate[count > 1].all()
    if cells == 1 << 20:
        assert estimate[count == 1].mean() < 0.01
    # By the definition, cell by cell.
    for row in range(substring.ROWS):
        cell, n = np.unique(substring.cells_of(keys, row, cells), return_counts=True)
        bits = np.unpackbits(np.frombuffer(found.bits[row], np.uint8), bitorder="little")[:cells]
        assert set(np.flatnonzero(bits)) == set(cell[n > 1])


@pytest.mark.parametrize("cells", [16, 4096])
def test_the_size_of_the_sketch_does_not_change_the_result(spark, cells):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring.digests(docs, 6, cells).collect()
    assert {r.doc_id: tuple(r)[1:4] for r in got} == brute_words(rows, 6)


def test_only_what_may_repeat_is_shuffled(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**7)}" for _ in range(200)) for _ in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string").repartition(3)
    how = substring.windows()
    how = replace(how, sketch=spark.sparkContext.broadcast(substring.sketch(docs, how)))
    keyed = docs.select(*repeats.doc_keys(), F.col("text"))
    sizes = [keyed.mapInArrow(repeats.batch_spans(h, 4), repeats.PACKED).agg(F.sum("size")).first()[0] for h in (substring.windows(), how)]
    assert sizes[1] < 0.05 * sizes[0]


@pytest.mark.parametrize("remembered", [5, 300_000])
def test_tasks_of_many_batches_against_brute_force(spark, monkeypatch, remembered):
    monkeypatch.setattr(repeats, "HELD_BYTES", 300)
    monkeypatch.setattr(repeats, "REMEMBERED", remembered)
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert {r.doc_id: tuple(r)[1:] for r in suffix.digests(docs, 30).collect()} == brute_bytes(rows, 30)
    assert {r.doc_id: tuple(r)[1:4] for r in substring.digests(docs, 6).collect()} == brute_words(rows, 6)


@pytest.mark.parametrize("how", [suffix.windows(), substring.windows()])
def test_a_passage_in_every_batch_sends_few_keys(spark, monkeypatch, how):
    """Thousands of batches in two tasks; without the memory every one sends a key."""
    monkeypatch.setattr(repeats, "HELD_BYTES", 600)
    rng = random.Random(5)
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(10)) + f" {passage}") for i in range(4000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).repartition(2)
    packed = docs.select(*repeats.doc_keys(), "text").mapInArrow(repeats.batch_spans(how, 4), repeats.PACKED).toArrow()
    keys = []
    for batch in packed.to_batches():
        for kind, (_, _, _, _, a, b) in repeats.unpack(batch):
            if kind == repeats.KEYED:
                keys.append(np.stack([a, b]))
    _, number = np.unique(np.concatenate(keys, 1), axis=1, return_counts=True)
    assert number.max() < 60  # an earlier document turns up some log(2000) times a task
    assert packed.num_rows > 2000


def test_join_runs():
    rank, lo, n = repeats.joined(np.array([1, 0, 0, 1]), np.array([5, 3, 0, 0]), np.array([2, 2, 3, 4]))
    assert list(zip(rank, lo, n)) == [(0, 0, 5), (1, 0, 4), (1, 5, 2)]
