"""Decontamination against plain alignment, and edited copies."""

import random
import re

import numpy as np

from vitalgrid.llm import contamination


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_align(item, text, penalty=contamination.PENALTY):
    table = [[0.0] * (len(text) + 1) for _ in range(len(item) + 1)]
    best = 0.0
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            same = 1.0 if item[i - 1] == text[j - 1] else -penalty
            table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] - penalty, table[i][j - 1] - penalty)
            best = max(best, table[i][j])
    return best


def prose(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def test_align_against_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        item, text = ([rng.randrange(5) for _ in range(rng.randint(1, n))] for n in (12, 30))
        got, end = contamination.align(np.array(item, np.uint64), np.array(text, np.uint64))
        assert got == brute_align(item, text)
        assert got == 0 or brute_align(item, text[:end]) == got


def test_edited_copies_are_found_and_others_not(spark):
    rng = random.Random(2)
    items = [prose(rng, rng.randint(15, 60)) for _ in range(30)]
    docs, want = [], {}
    for d in range(300):
        text = prose(rng, rng.randint(20, 300))
        if d % 3 == 0:
            i = rng.randrange(30)
            copy = list(items[i])
            kind = d % 4
            if kind == 1:  # every fourth word is another
                copy[::4] = prose(rng, len(copy[::4]))
            elif kind == 2:  # words are left out and put in
                del copy[5], copy[9]
                copy[3:3] = prose(rng, 1)
            elif kind == 3:
                copy = [w.upper() + "," for w in copy]
            at = rng.randint(0, len(text))
            text[at:at] = copy
            want[d] = i
        docs.append((d, " ".join(text)))
    docs.append((300, " ".join(items[3] + items[4])))
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows = contamination.matches(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {*want.items(), (300, 3), (300, 4)}
    texts = dict(docs)
    for r in rows:
        assert r.score == brute_align(items[r.item_id], words(texts[r.doc_id])) / len(items[r.item_id])
    kept = contamination.clean(documents, benchmark)
    assert {r.doc_id for r in kept.collect()} == set(range(300)) - set(want)


def test_the_size_of_the_filters_changes_nothing(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = {(r.doc_id, r.item_id, r.score, r.end_word) for r in contamination.matches(docs, benchmark).collect()}
    monkeypatch.setattr(contamination, "FILTER_BITS", 64)
    assert {(r.doc_id, r.item_id, r.score, r.end_word) for r in contamination.matches(docs.repartition(5), benchmark.repartition(3)).collect()} == whole
    for text in [r for r in docs.collect()][:40]:
        for item in benchmark.collect()[:10]:
            a, b = words(item.text), words(text.text)
            if a and brute_align(a, b[:400]) / len(a) >= 0.6:
                assert (text.doc_id, item.item_id) in {w[:2] for w in whole}


def test_filter_lets_all_of_its_keys_pass(spark):
    rng = random.Random(5)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(5000)] + [-(2**63), 2**63 - 1, 0, -1]
    table = spark.createDataFrame([(k,) for k in keys], "key long").repartition(3)
    for bits, most in ((64, 1), (100_000, 0.07), (contamination.FILTER_BITS, 0.001)):
        held = np.frombuffer(contamination.filter_of(table, bits), np.uint8)
        assert len(held) * 8 >= bits and contamination.passing(held, bits, np.array(keys, np.int64)).all()
        others = np.array([rng.randrange(-(2**63), 2**63) for _ in range(5000)], np.int64)
        assert contamination.passing(held, bits, others).mean() <= most


def test_seeds_are_rare_or_the_rarer_half():
    words_ = np.arange(9, dtype=np.uint64)
    counts = np.array([1, 1, 900, 900, 900, 900, 900, 1, 900])
    _, places = contamination.seeds_of(words_, counts, 100_000, 2)
    assert {0, 1, 6, 7} <= set(places.tolist()) and len(places) >= 4
    _, places = contamination.seeds_of(words_, np.zeros(9), 10**9, 2)
    assert len(places) == 8


def test_words_are_counted_over_the_whole_corpus(spark):
    docs = spark.createDataFrame([("a b a",), ("A, b",), (None,), ("x " * 50,)], "text string").repartition(2)
    benchmark = spark.createDataFrame([(1, "a b c d"), (2, "x y")], "item_id long, text string")
    items, seeds = contamination.items_and_seeds(docs, benchmark, 2)
    assert {r.item_id: len(r.words) for r in items.collect()} == {1: 4, 2: 2}
    assert {(r.place, r["size"]) for r in seeds.where("size = 2").collect()} == {(0, 2)}


def test_nulls_empty_and_extra_columns(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    schema = "held int, doc_id long, item_id int, text string"
    docs = spark.createDataFrame([(1, None, 1, item), (1, 2, 1, None), (1, 3, 1, ""), (1, 4, None, "one"), (1, 5, 1, item), (1, 5, 1, item)], schema)
    benchmark = spark.createDataFrame([(7, item, 1), (8, None, 1), (9, "", 1), (10, "one", 1), (None, item, 1)], "item_id long, text string, doc_id int")
    rows = sorted((r.doc_id or -1, r.item_id or -1, r.score) for r in contamination.matches(docs, benchmark).collect())
    assert rows == [(-1, -1, 1.0), (-1, 7, 1.0), (5, -1, 1.0), (5, -1, 1.0), (5, 7, 1.0), (5, 7, 1.0)]
    kept = contamination.clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert contamination.matches(docs.limit(0), benchmark).count() == 0
    assert contamination.matches(docs, benchmark.limit(0)).count() == 0
