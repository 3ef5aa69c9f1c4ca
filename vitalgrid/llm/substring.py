"""Remove words of long passages that a document with a smaller id holds too.

Count-min prefilter in two passes. In the first, tasks count the windows of their texts
by the keys of their anchors (see ``repeats``: equal windows have equal anchors) in a
sketch of ``ROWS`` rows of ``CELLS`` cells, and hand on which cells they met once or more
often. The sketches are added up by ranges of cells, and what is left of the sum is one
bit per cell: met twice or more. Those bits, ``ROWS * CELLS / 8`` bytes at any size of the
corpus, are broadcast. In the second pass only windows all of whose cells say so are
shuffled and grouped exactly. An estimate is never too low, so no repeat is lost; cells
that too many windows share cost shuffle and nothing else.

Defined cases: words are runs of bytes other than space and 0x09 to 0x0D, unchanged;
null text has none; a text of fewer words than a window loses nothing; a repeat within
one document alone is kept; of equal texts the one with the least doc_id keeps its
words (see ``repeats`` for ties and nulls).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm import repeats, spans

WINDOW, GRAM = 13, 5
#: The sketch; 32 MB of bits.
ROWS, CELLS = 2, 1 << 27
#: Ranges of cells that are added up one by one.
RANGES = 512
HELD = 1 << 20  # keys that a task adds up before it hands them on


def cells_of(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (spans.mix(keys ^ np.uint64((row + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(cells)).astype(np.int64)


def range_width(cells: int) -> int:
    """Cells of a range, whole bytes of bits."""
    return -(-cells // (8 * RANGES)) * 8


class Sketch:
    """Bits of the cells met twice or more, by row."""

    def __init__(self, bits: list[bytes], cells: int):
        self.bits, self.cells = bits, cells

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Whether the estimate of a key is two or more."""
        out = np.ones(len(keys), bool)
        for row, raw in enumerate(self.bits):
            some = np.flatnonzero(out)
            cell = cells_of(keys[some], row, self.cells)
            out[some] = np.frombuffer(raw, np.uint8)[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 == 1
        return out


def sketch_task(how: repeats.Windows, cells: int):
    """(text) to (row, part, once, often): the cells of a range that the task met, as
    compressed differences."""
    width = range_width(cells)
    press = lambda x: zstandard.ZstdCompressor(level=1).compress(np.diff(x, prepend=np.int64(0)).astype(np.uint32).tobytes())

    def rows(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row in range(ROWS):
            met, count = np.unique(cells_of(keys, row, cells), return_counts=True)
            cuts = np.searchsorted(met, np.arange(RANGES + 1) * width)
            out = [
                (row, part, *(press(met[a:b][mask[a:b]] - part * width) for mask in (count == 1, count > 1)))
                for part, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if b > a
            ]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "part", "once", "often"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for keys in repeats.anchors(how, batches, 0):
            held.append(keys)
            size += len(keys)
            if size > HELD:
                yield from rows(np.concatenate(held))
                held, size = [], 0
        if size:
            yield from rows(np.concatenate(held))

    return run


def add_task(cells: int):
    """Sketches of a partition to (row, part, bits): a range is added up over all tasks;
    a partition holds the two bitmaps of each of its ranges."""
    width = range_width(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for row, part, once, often in zip(*(c.to_pylist() for c in batch.columns)):
                seen, twice = sums.setdefault((row, part), (np.zeros(width, bool), np.zeros(width, bool)))
                once, often = (np.cumsum(np.frombuffer(tool.decompress(x), np.uint32), dtype=np.int64) for x in (once, often))
                twice[once[seen[once]]] = True
                twice[often] = True
                seen[once] = True
                seen[often] = True
        for (row, part), (_, twice) in sums.items():
            bits = np.packbits(twice, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([part], pa.int32()), pa.array([bits], pa.binary())], names=["row", "part", "bits"])

    return run


def sketch(docs: DataFrame, how: repeats.Windows, cells: int = CELLS) -> Sketch:
    """The sum of all tasks' sketches."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(text).mapInArrow(sketch_task(how, cells), "row int, part int, once binary, often binary")
    added = found.repartition("row", "part").mapInArrow(add_task(cells), "row int, part int, bits binary")
    # One bit per cell of a fixed number.
    size = range_width(cells) // 8
    bits = [bytearray(RANGES * size) for _ in range(ROWS)]
    for r in added.collect():
        bits[r.row][r.part * size : (r.part + 1) * size] = r.bits
    return Sketch([bytes(b) for b in bits], cells)


def exactly(keys: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal keys, within the groups given; see ``repeats.Windows``."""
    order = np.argsort(keys, kind="stable") if group is None else np.lexsort((keys, group))
    new = repeats.starts_of(keys[order]) if group is None else repeats.starts_of(group[order], keys[order])
    found = np.cumsum(new) - 1
    if group is None and len(found):
        many = np.bincount(found)[found] > 1
        order, found = order[many], found[many]
    return order, np.cumsum(repeats.starts_of(found)) - 1 if len(found) else found


def windows(size: int = WINDOW, gram: int = GRAM) -> repeats.Windows:
    return repeats.Windows(size, min(gram, size), repeats.Words, False, exactly)


def digests(docs: DataFrame, size: int = WINDOW, cells: int = CELLS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text of every document. ``cells``
    of the sketch are a matter of memory and shuffle, not of the result."""
    how = windows(size)
    how = replace(how, sketch=docs.sparkSession.sparkContext.broadcast(sketch(docs, how, cells)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch, out = whole.slice(first, 500), []
                for raw, listed in zip(repeats.texts_of(batch.column(1)).to_pylist(), batch.column(2)):
                    words = [w for w in raw.translate(SPACED).split(b" ") if w]
                    kept = words
                    if listed.is_valid:
                        kept, at = [], 0
                        for a, b in zip(*(x.tolist() for x in repeats.covered(np.asarray(listed.values), size))):
                            kept += words[at:a]
                            at = b
                        kept += words[at:]
                    out.append((len(words), len(words) - len(kept), b" ".join(kept)))
                n, gone, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array([k.decode() for k in kept], pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    found = repeats.repeated_windows(docs.select("doc_id", "text"), how).select("rest.doc_id", "frame", "repeats")
    return found.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string, kept_text string")


SPACED = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
