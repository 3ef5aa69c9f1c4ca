"""BPE against the tiktoken library, and the round trip."""

import hashlib
import random

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from vitalgrid.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MERGES = bpe.Merges(bpe.merge_tables(RANKS))

TEXTS = [
    None, "", " ", "hello world", "<|endoftext|> is text", "é" * 300, "a" * 20000, "\n\n  x\t\ty   ", "日本語のテキスト 🙂🙃",
    "".join(random.Random(1).choice("abcdefghij") for _ in range(3000)), "don't we'll I'm", "1234567890" * 50, "hello world",
]


def test_against_library(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = LIBRARY.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_real_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns == [*docs.columns, "ids"]
    for r in coded.collect():
        assert r.ids == LIBRARY.encode_ordinary(r.text or "")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeéß rst'", min_size=1, max_size=200))
def test_both_forms_agree(piece):
    """The matrix and the single tree give what the library gives for one piece."""
    raw = piece.encode()
    want = LIBRARY._core_bpe.encode_single_piece(raw)
    assert MERGES.long_piece(raw) == want
    leaves = 1 << (len(raw) - 1).bit_length()
    assert MERGES.short_pieces([raw, raw], leaves) == [b"".join(i.to_bytes(4, "little") for i in want)] * 2


def test_clashing_and_extra_columns(spark):
    docs = spark.createDataFrame([("x", "ids", "some text"), (None, None, None)], "key string, IDS string, text string")
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["key", "text", "ids"]
    out = {r.key: bytes(r.decoded) for r in bpe.decode(coded, PATH).collect()}
    assert out == {"x": b"some text", None: b""}
    assert bpe.decode(spark.createDataFrame([], "ids array<int>"), PATH).count() == 0
