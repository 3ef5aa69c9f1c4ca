"""Alignment of the tokens of two tokenizers over the same texts.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces with byte
fallback, which adds that space itself) the text, both whole and without special tokens.
Where a token of both starts at the same byte, and both tokens begin with a space, the
text is cut: such a place is an anchor, verified on byte offsets. Between two anchors lies
a window of a few ids of each. How the tokens of a window overlap depends on its ids
alone, so it is worked out once and kept under the tuples of ids.

A pair of ids counts the documents that hold it linked, over the whole corpus. A task
gathers its documents in chunks of some bytes of text and hands on every pair of a chunk
once, with the number of its documents that hold it: this is what is shuffled, added up,
and joined back, so a pair that every document holds costs one row per chunk. The
documents' own links stay with their chunk, as places in its list of pairs.

For A the ``tokenizers`` library reads its file. Where that file is a plain byte-level BPE
whose merges are in the order of their ids, texts of Latin letters (up to U+024F) go to
``tiktoken`` with the same vocabulary, which gives the same ids and takes a quarter of the
time; all others stay with the library.

Defined cases: texts that are null or empty, or whose joined token bytes differ from
space and text under either tokenizer, have no tokens, zeros and an empty digest; a null
doc_id is kept; repeated rows count as documents of their own; an empty table gives no
rows; other columns are not looked at. A text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm import spans
from vitalgrid.session import staged

CHUNK_BYTES = 2_500_000
SLICE_BYTES = 500_000  # of text that is encoded at a time
REMEMBERED = 1_000_000  # ids in the windows that a task keeps


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for every byte: printable bytes of
    Latin-1 stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: The pattern that byte-level pre-tokenizers split by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN = "\u024f"


def plain_ranks(stored: dict, letters: dict[str, int]) -> dict[bytes, int] | None:
    """Ids by the tokens' bytes, if the merges alone and in the order of the ids make the
    vocabulary: then the id of a token is its rank."""
    model, before = stored["model"], stored.get("pre_tokenizer") or {}
    added = {t["content"] for t in stored.get("added_tokens", ())}
    odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")]
    if stored.get("normalizer") or before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space") or any(odd):
        return None
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if set(letters) - set(vocab) or [vocab.get(m) for m in merged] != list(range(len(letters), len(vocab))):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocab.items()}


class Tokenizers:
    """Both tokenizers from the contents of their files, and the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters, stored = byte_letters(), json.loads(a_json)
        ranks = plain_ranks(stored, letters)
        self.quick = ranks and tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in stored["model"]["vocab"].items():
            # A token with other letters is none of a text.
            self.a_bytes[i] = bytes(letters.get(c, 0) for c in token)
        self.b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        quick = [bool(self.quick) and (t.isascii() or max(t) <= LATIN) for t in texts]
        rest = iter(self.a.encode_batch_fast([t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.quick.encode_ordinary(t) if q else next(rest).ids for t, q in zip(texts, quick)]

    def encode(self, texts: list[str]) -> Iterator[tuple[list, list]]:
        """Ids of A and B; none where the bytes of either are not those of the text."""
        for text, a, b in zip(texts, self.encode_a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)):
            raw = b" " + text.encode()
            same = raw == b"".join(map(self.a_bytes.__getitem__, a)) and raw == b"".join(map(self.b_bytes.__getitem__, b))
            yield (a, b) if text and same else ([], [])


class Windows:
    """The windows met, by their ids: text and number of their groups, and their links as
    codes of pairs (the id of A times 2^32, and that of B)."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.sizes = [np.array([len(x) for x in t], np.int64) for t in (tokenizers.a_bytes, tokenizers.b_bytes)]
        self.spaced = [np.array([x[:1] == b" " for x in t]) for t in (tokenizers.a_bytes, tokenizers.b_bytes)]
        self.names = [list(map(str, range(max(map(len, self.sizes)))))] * 2
        self.forget()

    def forget(self) -> None:
        self.known, self.texts, self.ids = {}, [], 0
        self.groups, self.links, self.ends = array("q"), array("q"), array("q", [0])

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows of some texts one after the other, in order, and the first token
        of A of each. Every text has the same bytes in both, so its end is an anchor."""
        ids = a.astype(np.int64), b.astype(np.int64)
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids)]
        marked = [np.flatnonzero(spaced[i]) for spaced, i in zip(self.spaced, ids)]
        starts = [end[m] - size[i[m]] for end, m, size, i in zip(ends, marked, self.sizes, ids)]
        place = np.minimum(np.searchsorted(starts[1], starts[0]), max(len(starts[1]) - 1, 0))
        at_a = np.flatnonzero(starts[1][place] == starts[0])
        at_b = place[at_a]
        cuts = [np.append(m[at], len(i)) for m, at, i in zip(marked, (at_a, at_b), ids)]
        which, place = self.alike(ids, cuts)
        # The id tuples of both sides as one key each: those of A, a mark, those of B.
        sizes = [c[place + 1] - c[place] for c in cuts]
        bounds = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1] + 1)])
        blob = np.full(bounds[-1], -1, np.int32)
        for i, c, size, start in zip(ids, cuts, sizes, (bounds[:-1], bounds[:-1] + sizes[0] + 1)):
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            blob[np.repeat(start, size) + within] = i[np.repeat(c[place], size) + within]
        raw, ends_of = blob.tobytes(), (bounds * 4).tolist()
        known, at_first, new = self.known, [], []
        for k, key in zip(place.tolist(), map(raw.__getitem__, map(slice, ends_of, ends_of[1:]))):
            at = known.get(key)
            if at is None:
                at = known[key] = len(known)
                new.append(k)
            at_first.append(at)
        self.add(ids, ends, cuts, np.array(new, np.int64))
        return np.array(at_first, np.int64)[which], cuts[0][:-1]

    @staticmethod
    def alike(ids: list, cuts: list) -> tuple[np.ndarray, np.ndarray]:
        """Number equal windows alike: the number of each window, and a window for each
        number, in order of the texts. A sum of hashes finds equals, which are then compared id by id."""
        n = len(cuts[0]) - 1
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        places = []  # window and place within it of every token
        for side, (i, c) in enumerate(zip(ids, cuts)):
            of = np.repeat(np.arange(n), np.diff(c))
            within = np.arange(len(i)) - c[of]
            places.append((of, within))
            total += np.add.reduceat(spans.mix((i << 24 | within << 1 | side).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), c[:-1])
        _, first, which = np.unique(total, return_index=True, return_inverse=True)
        same = np.ones(n, bool)
        for c in cuts:
            size = np.diff(c)
            same &= size == size[first[which]]
        for (of, within), i, c in zip(places, ids, cuts):
            other = np.minimum(c[first[which[of]]] + within, len(i) - 1)
            same[of[i != i[other]]] = False
        odd = np.flatnonzero(~same)  # of one hash and yet different
        which[odd] = len(first) + np.arange(len(odd))
        place = np.concatenate([first, odd])
        order = np.argsort(place)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        return rank[which], place[order]

    def add(self, ids: tuple, ends: list, cuts: list, new: np.ndarray) -> None:
        """Work out windows not met before: every end of a token of A or B closes one
        overlap, an end of both closes a group."""
        if not len(new):
            return
        chosen = []  # places of the windows' tokens
        for c in cuts:
            size = c[new + 1] - c[new]
            chosen.append(np.repeat(c[new] - (np.cumsum(size) - size), size) + np.arange(size.sum()))
            self.ids += int(size.sum())
        closed = [end[at] for end, at in zip(ends, chosen)]
        every = np.sort(np.concatenate(closed), kind="stable")  # two sorted runs
        every = every[np.concatenate([[True], every[1:] != every[:-1]])]
        at = [np.searchsorted(end, every) for end in closed]
        codes = ids[0][chosen[0][at[0]]] << 32 | ids[1][chosen[1][at[1]]]
        last = ends[0][cuts[0][new + 1] - 1]  # where each window ends
        until = np.searchsorted(every, last, "right")
        both = np.flatnonzero((closed[0][at[0]] == every) & (closed[1][at[1]] == every))
        groups = np.diff(np.searchsorted(both, until), prepend=0)
        self.ends.frombytes((until + len(self.links)).tobytes())
        self.links.frombytes(codes.tobytes())
        self.groups.frombytes(groups.tobytes())
        # Names of the ids of each group, A before B.
        tokens = [list(map(names.__getitem__, i[at].tolist())) for names, i, at in zip(self.names, ids, chosen)]
        sides = []
        for name, place in zip(tokens, at):
            cut = [0, *(place[both] + 1).tolist()]
            sides.append([name[x] if y - x == 1 else ",".join(name[x:y]) for x, y in zip(cut, cut[1:])])
        texts = [f"{x}|{y}" for x, y in zip(*sides)]
        cut = [0, *np.cumsum(groups).tolist()]
        self.texts += [texts[x] if y - x == 1 else ";".join(texts[x:y]) for x, y in zip(cut, cut[1:])]


def expanded(ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of some rows of a list of lists, and which row each is of."""
    first, count = ends[rows], ends[rows + 1] - ends[rows]
    of = np.repeat(np.arange(len(rows)), count)
    before = np.cumsum(count) - count
    return first[of] + np.arange(len(of)) - before[of], of


def chunk_row(windows: Windows, texts: list[str | None]) -> dict[str, list]:
    """Figures of the documents of a chunk, its pairs with the number of documents that
    hold them, and for every document the places of its pairs and how often they occur."""
    if windows.ids > REMEMBERED:
        windows.forget()
    n_a, n_b, sides = [], [], ([], [])
    for first, end in pieces(texts):
        for coded in windows.tokenizers.encode([t or "" for t in texts[first:end]]):
            for ids, side, n in zip(coded, sides, (n_a, n_b)):
                side.append(np.array(ids, np.int32))
                n.append(len(ids))
    window, starts = windows.of(*map(np.concatenate, sides))
    cut = np.searchsorted(starts, np.concatenate([[0], np.cumsum(n_a)]))
    names, bounds = list(map(windows.texts.__getitem__, window.tolist())), cut.tolist()
    digests = [hashlib.sha256(";".join(names[x:y]).encode()).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]
    doc = np.repeat(np.arange(len(texts)), np.diff(cut))
    ends, links, groups = (np.array(x, np.int64) for x in (windows.ends, windows.links, windows.groups))
    n_groups = np.bincount(doc, groups[window], len(texts)).astype(np.int64)
    n_links = np.bincount(doc, ends[window + 1] - ends[window], len(texts)).astype(np.int64)
    # Pairs are numbered over the windows met, each once.
    place, _ = expanded(ends, np.unique(window))
    pair, number = np.unique(links[place], return_inverse=True)
    local = np.zeros(len(links), np.int64)
    local[place] = number
    place, of = expanded(ends, window)
    local, doc = local[place], doc[of]
    # Of a document each pair once, with the number of its links.
    held = np.sort(doc * max(len(pair), 1) + local)
    first = np.flatnonzero(np.diff(held, prepend=-1))
    doc, local = np.divmod(held[first], max(len(pair), 1))
    times = np.diff(np.append(first, len(held)))
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests,
        "a": pair >> 32, "b": pair & 0xFFFFFFFF, "docs": np.bincount(local, minlength=len(pair)),
        "links": [packed(np.bincount(doc, minlength=len(texts)), local, times)],
    }


def packed(sizes: np.ndarray, places: np.ndarray, times: np.ndarray) -> bytes:
    """The number of pairs of every document, their places and numbers, compressed."""
    parts = len(sizes).to_bytes(8, "little"), sizes.astype(np.int32).tobytes(), np.diff(places, prepend=0).astype(np.int32).tobytes(), times.astype(np.int32).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int.from_bytes(raw[:8], "little")
    sizes, rest = np.frombuffer(raw, np.int32, n, 8), np.frombuffer(raw, np.int32, offset=8 + 4 * n)
    return sizes, np.cumsum(rest[: len(rest) // 2], dtype=np.int64), rest[len(rest) // 2 :].astype(np.int64)


def pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of ``SLICE_BYTES`` letters together, a longer one by itself."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > SLICE_BYTES or i + 1 == len(texts):
            yield first, i + 1
            first, size = i + 1, 0


KINDS = {
    "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "a": "int", "b": "int",
    "docs": "int", "links": "binary",
}
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def chunk_task(files):
    """(doc_id, text) to one row per chunk, see ``chunk_row``. ``files`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps its copy of a broadcast, and with it the tokenizers.
        if "windows" not in files.value:
            files.value["windows"] = Windows(Tokenizers(*files.value["contents"]))
        windows, number = files.value["windows"], TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, end, _, _ in spans.slices(batch.column(1), CHUNK_BYTES):
                row = chunk_row(windows, batch.column(1)[first:end].to_pylist())
                columns = [pa.array([number], pa.int64()), one_list(batch.column(0)[first:end])]
                columns += [one_list(pa.array(row[c], ARROW[k])) for c, k in KINDS.items()]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_id", *KINDS])
                number += 1
        # The worker lives on, and its memory is wanted elsewhere.
        windows.forget()
        spans.release()

    return run


def one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def judge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks with the counts of their pairs to rows of documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].values for c in batch.schema.names if c != "chunk"}
            sizes, places, times = unpacked(row["links"][0].as_py())
            n, best = np.zeros((2, len(places)), np.int64)
            if len(places):
                answer = row["answer"].flatten()
                n, best = (x.to_numpy(zero_copy_only=False)[places].astype(np.int64) for x in answer[1:3])
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best, times * n)]
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            sums = [np.diff(x[ends]) for x in sums]
            columns = [row["doc_id"], *(row[c] for c in FIGURES[:4]), *map(pa.array, sums), row["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *FIGURES, "groups_sha256"])


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every
    document of (doc_id, text). The tokenizers' files are read on the driver."""
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            contents.append(f.read())
    files = docs.sparkSession.sparkContext.broadcast({"contents": tuple(contents)})
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<{k}>" for c, k in KINDS.items())
    text = F.col("text").cast("string").alias("text")
    chunks = staged(docs.select("doc_id", text).mapInArrow(chunk_task(files), f"chunk long, doc_id array<{kind}>, {lists}"), "chunks")

    met = chunks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).select("p.*")
    counts = staged(met.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
    # One row per id of A at most, so no more than its vocabulary.
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    known = counts.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))
    asked = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "p")).select("chunk", "pos", "p.a", "p.b")
    # A chunk has no more pairs than its text has bytes, twice over.
    answers = asked.join(known, ["a", "b"]).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "best"))).alias("answer"))
    judged = chunks.drop("a", "b", "docs").join(answers, "chunk", "left")
    figures = ", ".join(f"{c} long" for c in FIGURES)
    return judged.mapInArrow(judge_task, f"doc_id {kind}, {figures}, groups_sha256 string")
