"""Compression of vectors to codes by product quantization, with LAESA pivots.

Vectors become integers, are cut into ``PARTS`` parts, and every part position has a
codebook of up to ``ENTRIES`` entries, improved over ``ROUNDS`` rounds of assignment and
integer means. The nearest entry is found as LAESA does: the distances of every part to
a few fixed pivots are reckoned once and stored with the parts. A round reckons only the
distances of the pivots to the entries. The greatest difference of the two, over the
pivots, is a lower bound of a part's distance to an entry; entries are tried in the order
of their bounds, and once the bound is over the least distance found no other entry can
be nearer. What is compared in the end are exact integers, ties going to the lower index.

A round reads the stored parts and shuffles one sum per codebook component and task. The
driver sees the codebooks, whose size is that of ``ENTRIES`` vectors.

Defined cases: rows whose vector is null or holds null or non-finite components are left
out. Vectors shorter than the longest are filled up with zeros, as is a length that
``PARTS`` does not divide. Among equal vec_ids the vector decides which comes first, a
null vec_id comes last. With fewer vectors than ``ENTRIES`` there are fewer entries, and
equal ones stay. Integers are held at such a bound that an error fits 64 bits: 2^30 over
the root of the length, that is components of up to 32,768 for vectors of 64. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.session import staged

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
PIVOTS = 4
#: A label with more than one of so many rows gets its sum by broadcast, so that there
#: are fewer of them than this.
HOT_LABELS = 100_000


def integers(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` integers."""
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    bound = int(2**30 / max(width, 1) ** 0.5)
    values = np.clip(values, -bound, bound).astype(np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """From every row of ``x`` to every row of ``y``."""
    square = ((x[:, None, :] - y[None, :, :]) ** 2).sum(2)
    return np.sqrt(square.astype(np.float64)).astype(np.float32)


def choose_pivots(entries: np.ndarray) -> np.ndarray:
    """Of the first entries those farthest from the pivots before, beginning with the first."""
    chosen = [0] if len(entries) else []
    while len(chosen) < min(PIVOTS, len(entries)):
        chosen.append(int(distances(entries, entries[chosen]).min(1).argmax()))
    return entries[chosen]


def nearest(x: np.ndarray, far: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of ``entries`` to every row of ``x``, and its squared distance.
    ``far``: the stored distances of the rows to the pivots."""
    between = distances(entries, pivots)
    low = np.zeros((len(x), len(entries)), np.float32)
    for p in range(len(pivots)):
        np.maximum(low, np.abs(far[:, p, None] - between[None, :, p]), out=low)
    # Both distances are rounded to 24 bits; the bound may be too great by that much.
    slack = 1e-6 * (far.max(1, initial=0).astype(np.float64) + float(between.max(initial=0)) + 1)
    which = np.zeros(len(x), np.int64)
    best = np.full(len(x), np.iinfo(np.int64).max)
    rows = np.arange(len(x))
    for _ in range(len(entries)):
        at = low.argmin(1)
        bound = low[np.arange(len(rows)), at]
        alive = bound <= np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-9) + slack[rows]
        if not alive.all():
            rows, at, low = rows[alive], at[alive], low[alive]
        if not len(rows):
            break
        found = ((x[rows] - entries[at]) ** 2).sum(1)
        better = (found < best[rows]) | ((found == best[rows]) & (at < which[rows]))
        best[rows[better]], which[rows[better]] = found[better], at[better]
        low[np.arange(len(rows)), at] = np.inf
    return which, best


class Codebooks:
    """Entries by part position, and the pivots of each position."""

    def __init__(self, first: np.ndarray):
        self.entries = first.reshape(len(first), PARTS, first.shape[1] // PARTS).transpose(1, 0, 2)
        self.pivots = [choose_pivots(e) for e in self.entries]

    def parts(self, rows: np.ndarray) -> np.ndarray:
        return rows.reshape(len(rows), PARTS, self.entries.shape[2])

    def far(self, rows: np.ndarray) -> np.ndarray:
        parts = self.parts(rows)
        return np.concatenate([distances(parts[:, p], self.pivots[p]) for p in range(PARTS)], 1)

    def assign(self, rows: np.ndarray, far: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(parts, nearest entry, squared distance) by position."""
        parts, n = self.parts(rows), far.shape[1] // PARTS
        for p in range(PARTS):
            x = np.ascontiguousarray(parts[:, p])
            yield x, *nearest(x, far[:, p * n : (p + 1) * n], self.entries[p], self.pivots[p])

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def unpacked(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Integers and stored distances of a batch of the staged table."""
    rows, far = (batch.column(batch.schema.get_field_index(c)) for c in ("ints", "far"))
    n = batch.num_rows
    return (
        np.frombuffer(b"".join(rows.to_pylist()), np.int32).reshape(n, width).astype(np.int64),
        np.frombuffer(b"".join(far.to_pylist()), np.float32).reshape(n, -1),
    )


def packed(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def prepare_task(books: Codebooks, width: int):
    """(vec_id, label, embedding) to (vec_id, label, ints, far)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = integers(batch.column(2), width)
                columns = [batch.column(0), batch.column(1), packed(rows.astype(np.int32)), packed(books.far(rows))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "ints", "far"])

    return run


def sum_task(books: Codebooks, width: int):
    """(ints, far) to (slot, total, n): one row per codebook component the task met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(books.entries.shape, np.int64)
        met = np.zeros(books.entries.shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, (x, which, _) in enumerate(books.assign(*unpacked(batch, width))):
                np.add.at(totals[p], which, x)
                met[p] += np.bincount(which, minlength=met.shape[1])
        n = np.broadcast_to(met[:, :, None], totals.shape).ravel()
        slot = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(totals.ravel()[slot]), pa.array(n[slot])], names=["slot", "total", "n"])

    return run


def code_task(books: Codebooks, width: int):
    """(vec_id, label, ints, far) to (vec_id, label, code, error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = list(books.assign(*unpacked(batch, width)))
            codes = np.stack([which for _, which, _ in found], 1).astype(np.uint8)
            error = sum(d for _, _, d in found)
            columns = [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return run


def with_label_errors(coded: DataFrame, hot_labels: int = HOT_LABELS) -> DataFrame:
    """Add ``label_error``, the sum of ``error`` over equal labels. Sums combine before
    their shuffle. Labels that hold more than one in ``hot_labels`` rows, so fewer than
    that many, are broadcast; no other can fill a task."""
    sums = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    rows = sums.agg(F.sum("n")).first()[0] or 0
    sums = sums.withColumnRenamed("label", "sum_label")
    same = F.col("label").eqNullSafe(F.col("sum_label"))
    hot = sums.where(F.col("n") * hot_labels > rows).drop("n")
    cold = sums.where(F.col("n") * hot_labels <= rows).drop("n")
    common = coded.join(F.broadcast(hot), same)
    rare = coded.join(F.broadcast(hot), same, "left_anti").join(cold, same)
    return common.unionByName(rare).drop("sum_label")


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 (and label) of every vector
    of (vec_id, embedding, label)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.where(F.col("embedding").isNotNull() & finite)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    least = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).select("embedding").collect()
    books = Codebooks(integers(pa.array([r.embedding for r in least], pa.list_(pa.float64())), width))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    ids = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    parts = staged(kept.mapInArrow(prepare_task(books, width), f"{ids}, ints binary, far binary"), "parts")
    for _ in range(ROUNDS):
        summed = parts.select("ints", "far").mapInArrow(sum_task(books, width), "slot long, total long, n long")
        # One row per codebook component.
        for r in summed.groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books.entries[np.unravel_index(r.slot, books.entries.shape)] = r.total // r.n
    coded = staged(parts.mapInArrow(code_task(books, width), f"{ids}, code string, error long"), "codes")
    return with_label_errors(coded).withColumn("codebooks_sha256", F.lit(books.digest()))


def _sql() -> str:
    """The same on DuckDB: six rounds as one common table expression after another."""
    steps = [
        f"""ints AS MATERIALIZED (
  SELECT vec_id, label, LIST_TRANSFORM(embedding, lambda x: CAST(FLOOR({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
pieces AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (LEN(v) // {PARTS}) + 1 : (p + 1) * (LEN(v) // {PARTS})] AS x
  FROM ints, RANGE({PARTS}) r(p)),
book0 AS MATERIALIZED (
  SELECT p, e, x AS y FROM (SELECT p, x, ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM pieces) t WHERE e < {ENTRIES})"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, label, p, FIRST(x) AS x, MIN(d) AS d, ARG_MIN(e, (d, e)) AS e
  FROM (SELECT vec_id, label, c.p, x, e, CAST(LIST_SUM(LIST_TRANSFORM(LIST_ZIP(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM pieces c JOIN book{i} b ON c.p = b.p) t
  GROUP BY vec_id, label, p)""")
        if i < ROUNDS:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, COALESCE(m.y, b.y) AS y FROM book{i} b LEFT JOIN (
    SELECT p, e, LIST(y ORDER BY k) AS y FROM (
      SELECT p, e, k, (SUM(v) - ((SUM(v) % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*) AS y
      FROM (SELECT p, e, UNNEST(x) AS v, UNNEST(RANGE(LEN(x))) AS k FROM near{i}) u GROUP BY p, e, k) w
    GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH {(',' + chr(10)).join(steps)},
coded AS (
  SELECT vec_id, label, STRING_AGG(PRINTF('%02x', e), '' ORDER BY p) AS code, CAST(SUM(d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, label, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT SHA256(STRING_AGG(CAST(v AS STRING), ',' ORDER BY p, e, k))
   FROM (SELECT p, e, UNNEST(y) AS v, UNNEST(RANGE(LEN(y))) AS k FROM book{ROUNDS}) t) AS codebooks_sha256
FROM coded"""


SQL = _sql()
