"""Near-duplicate groups against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import neardup
from vitalgrid.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = WORD.findall(raw)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(s), least[root(i)], d == least[root(i)]) for i, (d, s) in enumerate(sets)}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n", "one", "One", "two words", "two  WORDS", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 300))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    for _ in range(60):  # a passage that many share
        texts.append(" ".join(passage + [word() for _ in range(rng.randint(10, 60))]))
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed, longest", [(1, 4000), (2, 6)])
def test_against_brute_force(spark, seed, longest):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs, rounds=0 if seed == 2 else 2, longest=longest).collect()}
    assert got == brute(rows)


def test_family(spark):
    """Many near copies of one text make one group."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(5):
            copy[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs).collect()}
    assert got == brute(rows)


def family_lists(spark, n):
    """Posting lists of one family of near copies, of up to 50 members where split."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(5):
            copy[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc long, text string").repartition(4)
    sets = docs.mapInArrow(neardup.signatures, "doc long, k1 long, k2 long, n long, keys array<long>, prints binary")
    classes = sets.withColumnRenamed("doc", "cls")
    lists = neardup.staged(neardup.bounded_lists(classes, 50), "lists")
    return lists.withColumn("label", F.lit(0).cast("long"))


def test_rows_of_a_family_grow_in_proportion(spark):
    """What a turn deals, and what is left for the last turn when the family is one group
    but for two members."""
    counts = []
    for n in (400, 800, 1600):
        lists = family_lists(spark, n)
        turns = [neardup.dealt(lists, 50, t).groupBy("key").count().agg(F.sum("count"), F.max("count")).first() for t in (0, 1)]
        assert all(most < 110 for _, most in turns) and turns[0][0] == turns[1][0]
        long = lists.where("members > 50").withColumn("label", F.when(F.col("cls") < 2, F.col("cls") + 1).otherwise(0))
        last = neardup.across(long, 50).count()
        assert last <= 1.2 * long.count()
        counts.append(turns[0][0])
    assert counts[1] < 2.5 * counts[0] and counts[2] < 2.5 * counts[1]


def test_members_of_different_labels_meet(spark):
    rng = random.Random(5)
    rows = [(key, cls, rng.choice([0, 0, 0, 0, 1, 2, cls + 10]), b"") for key in (3, 9) for cls in range(120)]
    lists = spark.createDataFrame(rows, "key long, cls long, label long, prints binary").repartition(3)
    met = {}
    for r in neardup.across(lists, 20).collect():
        met.setdefault(r.key, []).append((r.cls, r.label))
    assert all(k < 0 for k in met) and max(map(len, met.values())) < 80
    pairs = {(a, b) for some in met.values() for a, x in some for b, y in some if x != y and a < b}
    label = {(k, c): x for k, c, x, _ in rows}
    for a in range(120):
        for b in range(a + 1, 120):
            if any(label[k, a] != label[k, b] for k in (3, 9)):
                assert (a, b) in pairs


def test_long_lists_in_all_turns(spark):
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs, longest=3).collect()}
    assert got == brute(rows)


def test_nulls_repeated_rows_and_extra_columns(spark):
    schema = "cls int, doc_id long, label string, text string, key int, prints binary"
    same = "some text that is long enough to have shingles"
    docs = spark.createDataFrame([(1, None, "", same, 1, None), (1, 5, "", same.upper(), 1, None), (1, 5, "", same.upper(), 1, None), (None, 6, None, None, None, None)], schema)
    got = sorted(((r.doc_id or -1), r.component_id, r.kept) for r in neardup.groups(docs).collect())
    assert got == [(-1, None, True), (5, None, False), (5, None, False), (6, 6, True)]
    assert neardup.groups(spark.createDataFrame([], schema)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    edges = spark.createDataFrame(chain, "u long, v long").repartition(6)
    for chunk in (10**6, 7):
        got = {r.node: r.label for r in components(edges, chunk).collect()}
        assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components(edges.limit(0)).count() == 0


def test_pairs_with_a_chance_byte_before_their_first_common_value(spark):
    """A byte of the prefix that agrees by chance doesn't hide the list where two meet."""
    rng = random.Random(4)
    texts = []
    for i in range(4000):
        base = [f"w{i}x{j}" for j in range(104)]
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(5, 99)] = f"y{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(copy + [f"z{j}" for j in range(8)])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc", "text"])
    keys, prints = [], []
    for out in neardup.signatures(iter([batch])):
        keys += out.column(4).to_pylist()
        prints += [p[: neardup.PREFIX] for p in out.column(5).to_pylist()]
    byte = [np.array([a == b for a, b in zip(*prints[i : i + 2])]) for i in range(0, len(texts), 2)]
    value = [np.array([a == b for a, b in zip(*keys[i : i + 2])]) for i in range(0, len(texts), 2)]
    odd = [i for i, (a, b) in enumerate(zip(byte, value)) if b.any() and a.argmax() != b.argmax()]
    assert odd
    rows = [(j, texts[j]) for i in odd for j in (2 * i, 2 * i + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs, rounds=0).collect()}
    assert got == brute(rows) and sum(k for _, _, k in got.values()) == len(odd)
