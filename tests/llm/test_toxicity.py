"""Toxicity: counts against plain Python, held-out accuracy, defined cases."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from vitalgrid.llm import toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, truth[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in truth]
    hits = sum(p and t for p, t, _ in held)
    assert hits >= 0.9 * sum(t for _, t, _ in held)
    assert hits >= 0.97 * sum(p for p, _, _ in held)


def probabilities(rows, labels, kappa, own=None):
    """The models by the formulas of the module, with dictionaries: P_c(w | v) of class c,
    with the occurrences of a document of class ``own`` taken out of the counts n."""
    words = {d: re.findall(r"[^\W_]+", (t or "").lower()) for d, t in rows}
    pairs = {d: set(zip([None, *w], w)) for d, w in words.items()}
    contexts = {}
    for p in set().union(*pairs.values()):
        contexts[p[1]] = contexts.get(p[1], 0) + 1
    every, docs = sum(contexts.values()), [0, 0]
    n, begins = ({}, {}), ({}, {})
    for d, y in labels.items():
        if zlib.crc32(str(d).encode()) % 5 and d in words:
            docs[y] += 1
            for e in pairs[d] | {w for _, w in pairs[d]}:
                n[y][e] = n[y].get(e, 0) + 1
            for v, _ in pairs[d]:
                begins[y][v] = begins[y].get(v, 0) + 1
    share = [c / sum(docs) for c in docs]
    totals = [sum(k for e, k in n[y].items() if isinstance(e, str)) for y in (0, 1)]

    def left(e, y, out):
        both = [max(n[c].get(e, 0) - (out == c), 0) for c in (0, 1)]
        mean = share[y] * sum(both)
        return both[y] - min(both[y], mean + kappa * math.sqrt(mean * (1 - share[y])))

    freed = [1 - sum(left(e, y, None) for e in n[y] if isinstance(e, str)) / totals[y] for y in (0, 1)]
    freed_after = [{}, {}]
    for y in (0, 1):
        for v in begins[y]:
            freed_after[y][v] = 1 - sum(left(e, y, None) for e in n[y] if isinstance(e, tuple) and e[0] == v) / begins[y][v]

    def word(w, y):
        return left(w, y, own) / totals[y] + freed[y] * (contexts[w] + 0.5) / (every + len(contexts) / 2)

    def pair(v, w, y):
        if v not in begins[y]:
            return word(w, y)
        return left((v, w), y, own) / begins[y][v] + freed_after[y][v] * word(w, y)

    return pairs, contexts, word, pair, math.log(freed[1] / freed[0])


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(200)]
    rows, labels = [], {}
    for d in range(n):
        y = int(rng.random() < 0.2)
        w = [rng.choice(common) for _ in range(rng.randint(5, 60))]
        if y:
            w[rng.randrange(len(w))] = rng.choice(["Foul", "nasty", "vile"])
            w[rng.randrange(len(w))] = "w1"
            w[:2] = "gar stig"
        elif rng.random() < 0.1:
            w[:2] = ["gar", rng.choice(common)]
        rows.append((d, " ".join(w)))
        if d % 3:
            labels[d] = y
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame([(d, y) for d, y in labels.items()], "doc_id long, toxic int")


@pytest.mark.parametrize("broadcast", [toxicity.BROADCAST, 0])
def test_against_brute_force(spark, broadcast):
    rows, labels = corpus()
    docs, table = frames(spark, [*rows, (1000, ""), (1001, None)], labels)
    model = toxicity.fit(docs, table, broadcast)
    got = {r.doc_id: r.difference for r in toxicity.scores(docs, table, broadcast).collect()}
    pairs, _, _, pair, unknown = probabilities(rows, labels, model.kappa)
    assert model.unknown == pytest.approx(unknown, abs=1e-12) and got.pop(1000) == got.pop(1001) == model.unknown
    want = {d: sum(math.log(pair(v, w, 1) / pair(v, w, 0)) for v, w in p) / len(p) for d, p in pairs.items()}
    assert set(got) == set(want) and max(abs(got[d] - want[d]) for d in want) < 1e-9
    assert max(want.values()) > model.threshold > unknown


def test_models_are_probabilities():
    rows, labels = corpus(300)
    for kappa in toxicity.KAPPAS:
        _, contexts, word, pair, _ = probabilities(rows, labels, kappa)
        for y in (0, 1):
            assert sum(word(w, y) for w in contexts) == pytest.approx(1)
            assert sum(pair("gar", w, y) for w in contexts) == pytest.approx(1)


def test_labelled_documents_are_judged_without_themselves(spark):
    rows, labels = corpus()
    docs, table = frames(spark, rows, labels)
    c = toxicity.count(docs, table)
    variants = [toxicity.Variant(k, own) for k in toxicity.KAPPAS for own in (0, 1)]
    scored = toxicity.with_differences(docs, toxicity.tables(c, variants)).collect()
    for i, v in enumerate(variants):
        pairs, _, _, pair, _ = probabilities(rows, labels, v.kappa, v.own)
        for r in scored[:100]:
            p = pairs[r.doc_id]
            assert r.x[i] == pytest.approx(sum(math.log(pair(a, b, 1) / pair(a, b, 0)) for a, b in p) / len(p), abs=1e-9)


def test_both_ways_of_scoring_keep_the_same_documents(spark):
    rows, labels = corpus()
    docs, table = frames(spark, rows, labels)
    kept = [{r.doc_id for r in toxicity.keep_ordinary(docs, table, b).collect()} for b in (toxicity.BROADCAST, 0)]
    assert kept[0] == kept[1] and 0.7 * len(rows) < len(kept[0]) < 0.9 * len(rows)


def test_threshold():
    assert toxicity.best_threshold([(0, 10, 0), (50, 0, 5)], 0) == (0, pytest.approx(0.0255))
    assert toxicity.best_threshold([(-9, 10, 0), (1, 10, 9)], 0)[1] > 0.0005
    assert toxicity.best_threshold([(0, 10, 0)], 0) == (0, pytest.approx(0.001))
    assert toxicity.best_threshold([(0, 10, 1), (20, 3, 0), (40, 0, 9)], 0) == (1, pytest.approx(0.0305))
    errors, cut = toxicity.best_threshold([(-20, 50, 1), (-5, 0, 9)], -19)
    assert (errors, cut) == (1, pytest.approx(-0.0115))


def test_no_labels_nulls_and_extra_columns(spark):
    schema = "label int, label_id int, doc_id long, score string, text string, x int"
    docs = spark.createDataFrame([(1, 1, None, "", "a b", 1), (1, 1, 2, "", None, 1), (1, 1, 3, "", "", 1), (1, 1, 3, "", "x " * 30000, 1)], schema)
    none = spark.createDataFrame([(2, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.scores(docs, none).collect()
    assert [r.predicted for r in rows] == [0] * 4 and all(0 < r.score < 0.5 for r in rows)
    one = spark.createDataFrame([(i, 1) for i in range(1, 4)] * 2, "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.scores(docs, one).collect()] == [0] * 4
    kept = toxicity.keep_ordinary(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4
    assert toxicity.scores(docs.limit(0), one).count() == 0
    both = spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, toxic int")
    kept = toxicity.keep_ordinary(docs, both)
    assert kept.columns == docs.columns and sorted(map(str, (r.text for r in kept.collect()))) == sorted(["a b", "None", "", "x " * 30000])


def test_label_bound(spark):
    labels = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    assert toxicity.fit_labels(labels).count() == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(5000))
    assert 900 < toxicity.fit_labels(labels, 1000).count() < 1100


def test_words_stand_alone_and_contexts_are_counted_in_full(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(20000)).encode()
    word, before, _ = toxicity.pairs_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(np.unique(word)) == 20000 == len(np.unique(toxicity.pair_keys(word, before)))
    rows = [(i, f"w{i % 40} foul" if i % 5 == 0 else f"w{i % 40} fine") for i in range(3000)]
    labels = {i: int(i % 5 == 0) for i, _ in rows}
    # In few parts, and with tasks that hold little.
    for parts, held in ((4096, 1 << 21), (3, 50)):
        monkeypatch.setattr(toxicity, "PARTS", parts)
        monkeypatch.setattr(toxicity, "HELD", held)
        c = toxicity.count(*frames(spark, rows, labels))
        assert sorted(r.contexts for r in c.words.collect()) == [0, *[1] * 40, 8, 32]
        assert (c.contexts, c.vocabulary) == (80, 42)
