"""Vector codes against plain Python, SQL, and defined cases."""

import hashlib
import math
import random

import numpy as np

from tests.oracle import connect, rows_of, spark_rows
from vitalgrid.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, part int, code int, far int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3) for i, v, label in rows], SCHEMA).repartition(5)


def plain(rows):
    """{vec_id: (code, error, label_error)} and the digest, one distance after another."""
    kept = []
    for i, v, label in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(4096 * float(np.float32(x))) for x in v], label))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 8) * 8
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    w = width // 8
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[v[p * w : (p + 1) * w] for _, v, _ in first] for p in range(8)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))

    for _ in range(6):
        for p, book in enumerate(books):
            parts = [v[p * w : (p + 1) * w] for _, v, _ in kept]
            owners = [near(x, book)[1] for x in parts]
            for e in range(len(book)):
                mine = [x for x, o in zip(parts, owners) if o == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine)]
    out, sums = [], {}
    for i, v, label in kept:
        found = [near(v[p * w : (p + 1) * w], books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    digest = hashlib.sha256(",".join(str(c) for b in books for y in b for c in y).encode()).hexdigest()
    return sorted((*r, sums[r[1]], digest) for r in out)


def coded(df):
    rows = vectors.compress(df).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_equals_plain_python(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(16)], i % 3) for i in range(150)]
    rows += [(200 + i, [rng.choice([0.0, 0.25, -0.25]) for _ in range(16)], 7) for i in range(60)]  # many ties
    rows += [(300 + i, rows[3][1], 9) for i in range(40)]  # one very common vector
    assert coded(table(spark, rows)) == sorted(plain(rows), key=repr)


def test_large_and_far_values(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e4, 9999.99, -1e4, 0.0001]) * rng.random() for _ in range(8)], None) for i in range(50)]
    assert coded(table(spark, rows)) == sorted(plain(rows), key=repr)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [0.5, None], 1), (3, [nan] * 8, 1), (4, [inf] * 8, None), (5, [0.5] * 8, None), (6, [0.25] * 3, 2), (7, [], 2)]
    got = coded(table(spark, rows))
    assert got == sorted(plain(rows), key=repr) and [r[0] for r in got] == [5, 6, 7]
    assert coded(table(spark, [(1, None, 1)])) == [] and coded(table(spark, [])) == []
    same = [(1, [0.5] * 8, None)] * 4  # repeated rows keep their number
    assert coded(table(spark, same)) == sorted(plain(same), key=repr)
    huge = vectors.compress(table(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1)])).collect()
    assert all(r.error == 0 for r in huge)


def test_errors_of_rare_labels_are_joined(spark):
    coded = spark.createDataFrame([(i, i % 5 if i % 7 else None, "00", i) for i in range(200)], "vec_id long, label int, code string, error long")
    want = vectors.with_label_errors(coded).collect()
    sums = {}
    for r in coded.collect():
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert len(want) == 200 and all(r.label_error == sums[r.label] for r in want)
    assert sorted(vectors.with_label_errors(coded, 4).collect()) == sorted(want) == sorted(vectors.with_label_errors(coded, 0).collect())


def test_bounds_prune_and_never_mislead():
    rng = np.random.default_rng(3)
    centres = rng.integers(-500, 500, (16, 8))
    x = centres[rng.integers(0, 16, 4000)] + rng.integers(-40, 40, (4000, 8))
    pivots = vectors.choose_pivots(centres)
    which, best = vectors.nearest(x, vectors.distances(x, pivots), centres, pivots)
    square = ((x[:, None, :] - centres[None]) ** 2).sum(2)
    assert (which == square.argmin(1)).all() and (best == square.min(1)).all()


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = vectors.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))
    assert spark_rows(got) == rows_of(connect(sf).execute(vectors.SQL))
