"""Remove bytes of long passages that already stand earlier (suffix-array dedup).

Depth-limited radix sort: suffixes are ordered only through ``window`` bytes, by passes
from the most significant digit on, and a suffix whose digit stands alone drops out;
groups that stay equal through the last digit are the repeated windows. Only equality
matters, not which of two unequal digits is less, so a digit is the hash of a block.
The first pass reads one suffix per span (see ``repeats``): that at the window's
anchor, with the anchor's bytes as digit. The next takes the span's whole surroundings
as digit. What is equal in the first and not in the second is sorted suffix by suffix,
by the digits of a 96-bit hash of its window.

Defined cases: null text counts as empty; a text shorter than a window loses nothing;
a run of one byte is its own repeat, so all but its first window goes; of equal texts
the one with the least doc_id keeps its bytes (see ``repeats`` for ties and nulls).
Removal works on bytes and may cut a character in two; ``clean_text`` drops the rest of
a character that it cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.llm import repeats

WINDOW, GRAM = 100, 50


def by_digit(keys: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Radix passes of 16 bits, the most significant digit first: each pass divides the
    groups that the passes before have left by the next digit. At first all keys are one
    group, and a key that is alone after a pass is not looked at again. What hangs
    together after the last pass is equal: rows in order of their groups, and the number
    of each one's group."""
    drop = group is None
    left = np.arange(len(keys))
    group = np.zeros(len(keys), np.int64) if drop else group
    for shift in range(8 * keys.dtype.itemsize - 16, -1, -16):
        digit = (keys[left] >> keys.dtype.type(shift)).astype(np.uint16)
        order = np.lexsort((digit, group))
        left, digit, group = left[order], digit[order], group[order]
        new = repeats.starts_of(digit, group)
        group = np.cumsum(new) - 1
        if drop and len(group):
            many = np.bincount(group)[group] > 1
            left, group = left[many], group[many]
    return left, np.cumsum(repeats.starts_of(group)) - 1 if len(group) else group


def windows(size: int = WINDOW, gram: int = GRAM) -> repeats.Windows:
    return repeats.Windows(size, min(gram, size), repeats.Bytes, True, by_digit)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def find(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """rest (all columns of ``docs`` but the text, as a struct), text, spans: array of
    (start, end) of the maximal byte runs to remove, in order; one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch, spans = whole.slice(first, 500), []
                for listed in batch.column(2):
                    at = [] if not listed.is_valid else zip(*(x.tolist() for x in repeats.covered(np.asarray(listed.values), size)))
                    spans.append([{"start": a, "end": b} for a, b in at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), repeats.texts_of(batch.column(1)).cast(pa.large_string()).cast(pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    names=["rest", "text", "spans"],
                )

    found = repeats.repeated_windows(docs, windows(size))
    return found.mapInArrow(run, T.StructType([found.schema["rest"], T.StructField("text", T.StringType()), T.StructField("spans", SPANS)]))


def kept_bytes(raw: bytes, spans: list) -> bytes:
    parts, at = [], 0
    for span in spans:
        parts.append(raw[at : span["start"]])
        at = span["end"]
    parts.append(raw[at:])
    return b"".join(parts)


def digests(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                raw = text.as_buffer().to_pybytes()
                kept = kept_bytes(raw, spans.as_py())
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, [pa.int64()] * 3 + [pa.string()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = find(docs.select("doc_id", "text"), size).select("rest.doc_id", "text", "spans")
    return found.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def clean_text(raw: bytes, spans: list) -> str:
    return kept_bytes(raw, spans).decode("utf-8", "ignore")


def remove(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated runs taken out of the text; all rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean_text(t.as_buffer().to_pybytes(), s.as_py()) for t, s in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["rest", "text"])

    found = find(docs, size)
    cut = found.mapInArrow(run, T.StructType([found.schema["rest"], T.StructField("text", T.StringType())]))
    return cut.select(*(F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))
