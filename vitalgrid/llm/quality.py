"""Compression bands: keep documents whose text compresses as prose does.

A zstandard ratio (compressed by raw bytes) below the band means repetition, above it
text without structure. Short texts compress less whatever they say, so each length
class has limits of its own. The same is asked of fixed chunks: a document fails too
when more than ``bad_chunks`` of its chunks lie outside the chunk band, which a mixed
document would otherwise hide in its average. A text of less than a chunk has none to ask
about; what is left over at the end of a longer one belongs to its last chunk, which so
has up to twice the bytes and is judged by the same limits.

Besides there is a base rule: too few words, or too many words in three-word windows
that the text repeats. Words are runs of bytes other than space and 0x09 to 0x0D.

Defined cases: null text counts as empty; an empty text has no words, fails the base
rule, and its ratio is null. Copies are judged alike. Nothing is cut from a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from vitalgrid.llm import spans


@dataclass(frozen=True)
class Bands:
    """Limits on the ratio: (bytes up to, least, most), the first that fits."""

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.20, 1.05),
        (512, 0.45, 0.85),
        (1024, 0.45, 0.80),
        (2048, 0.44, 0.72),
        (4096, 0.435, 0.68),
        (16384, 0.405, 0.64),
        (65536, 0.38, 0.60),
        (float("inf"), 0.36, 0.60),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.41, 0.68)
    bad_chunks: float = 0.25
    level: int = 3
    min_words: int = 50
    max_repeat_pct: int = 50


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_bytes long, ratio double, n_chunks long, n_bad_chunks long"
)
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


def per_row(rows: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(rows, minlength=count).astype(np.int64)


def earlier(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the same key stands before in the same row; rows ascend."""
    order = np.lexsort((key, row))
    same = (row[order][1:] == row[order][:-1]) & (key[order][1:] == key[order][:-1])
    out = np.zeros(len(row), bool)
    out[order[1:]] = same
    return out


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of every row of a slice."""
    rows = len(offsets) - 1
    starts, ends, first = spans.word_spans(data, offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    words = spans.word_hashes(data, starts, ends, 1)
    size = np.diff(first)

    # Code points are bytes that do not continue another; none of them is in a gap.
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])

    # Lines are compared byte for byte, by a hash; those without a word don't count.
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.minimum(np.concatenate([line_start[1:], [len(data)]]), len(data))
    line_end = np.where(data[np.maximum(line_end - 1, 0)] == 0x0A, line_end - 1, line_end)
    line_end = np.maximum(line_end, line_start)
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    twice = earlier(line_row, spans.word_hashes(data, line_start, line_end, 2))

    # Windows of three words within one row.
    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) >= 3:
        window = spans.run_hashes(words, 3, 3)
        at = np.flatnonzero(row[:-2] == row[2:])
        window, of = window[at], row[at]
        order = np.lexsort((window, of))
        same = (of[order][1:] == of[order][:-1]) & (window[order][1:] == window[order][:-1])
        hit = np.zeros(len(at), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        covered[at[hit]] += 1
        covered[at[hit] + 3] -= 1
    return {
        "n_words": size,
        "word_chars": np.bincount(row, points[ends] - points[starts], rows).astype(np.int64),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": per_row(line_row[twice], rows),
        "n_repeat_words": per_row(row[np.cumsum(covered[:-1]) > 0], rows),
    }


def judge(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: the counts, the ratio, the chunks outside the band, and
    whether it is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for first, end, data, offsets in spans.slices(batch.column(1), 500_000):
                out = counts(data, offsets)
                failed = (out["n_words"] < bands.min_words) | (100 * out["n_repeat_words"] > bands.max_repeat_pct * out["n_words"])
                raw, n_bytes = data.tobytes(), np.diff(offsets)
                ratio, chunks, bad, kept = [], [], [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    whole = len(press.compress(raw[a:b])) / (b - a) if b > a else None
                    # A last piece shorter than a chunk joins the one before it.
                    cuts = [*range(a, max(a + 1, b - bands.chunk_bytes + 1), bands.chunk_bytes)] if b > a else []
                    parts = [len(press.compress(raw[x:y])) / (y - x) for x, y in zip(cuts, [*cuts[1:], b])]
                    low, high = next((lo, hi) for most, lo, hi in bands.whole if b - a <= most)
                    wrong = sum(not bands.chunk[0] <= r <= bands.chunk[1] for r in parts) if b - a >= bands.chunk_bytes else 0
                    ratio.append(whole)
                    chunks.append(len(parts))
                    bad.append(wrong)
                    kept.append(bool(not failed[i] and low <= whole <= high and wrong <= bands.bad_chunks * len(parts)))
                columns = [batch.column(0).slice(first, end - first), *out.values(), failed, kept, n_bytes, pa.array(ratio, pa.float64()), chunks, bad]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)
