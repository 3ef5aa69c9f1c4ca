"""Byte-level BPE: text to token ids by a rank table, and ids back to bytes.

Text is split by a pattern, and each piece is merged on its own. A segment tree over
the byte positions of a piece holds, per live position, the rank of the pair that
starts there; its root is the leftmost pair of least rank. A merge takes the root,
frees the right neighbour's leaf and updates the two live neighbours' leaves, each
in logarithmic time. Short pieces are merged side by side, one tree per row of a
matrix; a longer piece has a tree of its own, so that a text without any break costs
n log n.

Defined cases: null text counts as empty and has no ids; ids are those of ordinary
text, special tokens are not recognised; every row gives one row, copies included.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pieces up to so many bytes are merged side by side.
MATRIX_BYTES = 64
#: A worker remembers the ids of so many different pieces, then starts afresh.
REMEMBERED = 400_000
#: Bytes of text encoded at a time.
SLICE_BYTES = 1_000_000

NONE = np.int64(2**62)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_tables(ranks: dict[bytes, int]) -> dict:
    """What merging needs, of plain types: the rank of every pair of tokens that forms
    a token, as dict and as sorted arrays; and room for the pieces a worker has met."""
    pairs = {
        (ranks[token[:i]] << 32) | ranks[token[i:]]: rank
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    }
    keys = np.array(sorted(pairs), np.int64)
    return {"ranks": ranks, "pairs": pairs, "keys": keys, "found": np.array([pairs[k] for k in keys.tolist()], np.int64), "known": {}}


class Merges:
    """Ranks of pairs of tokens, and the two ways to merge a piece."""

    def __init__(self, tables: dict):
        self.ranks, self.pairs, self.keys, self.found = (tables[k] for k in ("ranks", "pairs", "keys", "found"))
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.found[at], NONE >> 16)

    def long_piece(self, piece: bytes) -> list[int]:
        """One piece, one tree. A leaf is (rank, position) as one number."""
        n, pairs, none = len(piece), self.pairs, int(NONE)
        leaves = 1 << max(1, (n - 1).bit_length())
        ids: list[int] = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

        def leaf(i: int) -> int:
            j = after[i]
            rank = pairs.get((ids[i] << 32) | ids[j]) if j < n else None
            return none if rank is None else (rank << 32) | i

        tree = [none] * (2 * leaves)
        for i in range(n):
            tree[leaves + i] = leaf(i)
        for k in range(leaves - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def update(i: int, value: int) -> None:
            k = leaves + i
            tree[k] = value
            while k > 1:
                k >>= 1
                least = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == least:
                    return
                tree[k] = least

        while tree[1] < none:
            i, rank = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            j = after[i]
            ids[i] = rank
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            update(j, none)
            update(i, leaf(i))
            if before[i] >= 0:
                update(before[i], leaf(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def short_pieces(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Pieces of at most ``leaves`` bytes, a power of two: one tree a row. Gives
        the ids of each as int32 bytes."""
        rows = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, rows)
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(rows, leaves)
        ids = self.single[raw]
        place = np.arange(leaves)
        after = np.tile(place + 1, (rows, 1))
        before = np.tile(place - 1, (rows, 1))
        live = place < sizes[:, None]
        tree = np.full((rows, 2 * leaves), NONE)
        if leaves > 1:
            paired = place[:-1] + 1 < sizes[:, None]
            rank = self.rank(ids[:, :-1], ids[:, 1:])
            tree[:, leaves : 2 * leaves - 1] = np.where(paired & (rank < NONE >> 16), (rank << 16) | place[:-1], NONE)
        for k in range(leaves - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])

        def update(row: np.ndarray, i: np.ndarray, value: np.ndarray | np.int64) -> None:
            k = i + leaves
            tree[row, k] = value
            for _ in range(leaves.bit_length() - 1):
                k = k >> 1
                tree[row, k] = np.minimum(tree[row, 2 * k], tree[row, 2 * k + 1])

        def leaf(row: np.ndarray, i: np.ndarray) -> np.ndarray:
            j = after[row, i]
            inside = j < sizes[row]
            rank = self.rank(ids[row, i], ids[row, np.where(inside, j, 0)])
            return np.where(inside & (rank < NONE >> 16), (rank << 16) | i, NONE)

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            i, rank = tree[row, 1] & 0xFFFF, tree[row, 1] >> 16
            j = after[row, i]
            ids[row, i] = rank
            live[row, j] = False
            end = after[row, j]
            after[row, i] = end
            inside = end < sizes[row]
            before[row[inside], end[inside]] = i[inside]
            update(row, j, NONE)
            update(row, i, leaf(row, i))
            left = before[row, i]
            has = left >= 0
            update(row[has], left[has], leaf(row[has], left[has]))
            row = row[tree[row, 1] < NONE]
        flat, counts = ids[live].astype(np.int32).tobytes(), live.sum(axis=1) * 4
        ends = np.cumsum(counts).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of different pieces, as int32 bytes."""
        out, groups = {}, {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if raw in self.ranks:
                out[piece] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) > MATRIX_BYTES:
                out[piece] = np.array(self.long_piece(raw), np.int32).tobytes()
            else:
                groups.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for leaves, group in groups.items():
            for k in range(0, len(group), 20_000):
                part = group[k : k + 20_000]
                out.update(zip((p for p, _ in part), self.short_pieces([r for _, r in part], leaves)))
        return out


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as array<int> column ``out``, which
    replaces a column of that name. ``ranks_path`` is read on the driver."""
    tables = docs.sparkSession.sparkContext.broadcast(merge_tables(read_ranks(ranks_path)))
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps its copy of a broadcast, and with it the pieces it has met.
        merges, split, known = Merges(tables.value), regex.compile(pattern), tables.value["known"]
        for batch in batches:
            texts = batch.column(at)
            sizes = np.cumsum([0, *((n or 0) for n in pa.compute.binary_length(texts).to_pylist())])
            first = 0
            while first < batch.num_rows:
                end = max(first + 1, int(np.searchsorted(sizes, sizes[first] + SLICE_BYTES, "right")) - 1)
                end = min(end, batch.num_rows)
                pieces = [split.findall(t) if t else [] for t in texts[first:end].to_pylist()]
                coded = [list(map(known.get, doc)) for doc in pieces]
                late = [i for i, doc in enumerate(coded) if None in doc]
                new = {p for i in late for p, c in zip(pieces[i], coded[i]) if c is None}
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new.update(*(pieces[i] for i in late))
                known.update(merges.encode(list(new)))
                for i in late:
                    coded[i] = map(known.__getitem__, pieces[i])
                coded = list(map(b"".join, coded))
                offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns, ids], names=[*kept, out])
                first = end

    return docs.select(*(docs[c] for c in kept)).mapInArrow(run, schema)


def decode(coded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the bytes of the tokens ``ids`` as binary column ``out``, which
    replaces a column of that name; null ids give no bytes. Bytes, not text, because
    ids from elsewhere need not form valid UTF-8. An id outside the table fails."""
    table = coded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [c for c in coded.columns if c.lower() != out.lower()]
    schema = T.StructType([*(f for f in coded.schema.fields if f.name in kept), T.StructField(out, T.BinaryType(), False)])
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: raw for raw, rank in table.value.items()}
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                lists = part.column(at)
                flat = list(map(token.__getitem__, lists.flatten().to_numpy(zero_copy_only=False).tolist()))
                ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())]).tolist()
                raw = [b"".join(flat[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*kept, out])

    return coded.select(*(coded[c] for c in kept)).mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    coded = decode(encode(docs.select("doc_id", "text"), ranks_path, pattern).drop("text"), ranks_path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
