"""Token alignment against a plain version: all pairs of tokens of a document compared."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vitalgrid.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", *alignment.FIGURES, "groups_sha256"]


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(rows, coders):
    a_coder, b_coder = coders
    letters = alignment.byte_letters()
    docs = []
    for doc_id, text in rows:
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        a_raw = [bytes(letters[c] for c in a_coder.id_to_token(i)) for i in a]
        b_raw = [bytes([int(b_coder.id_to_piece(i)[3:5], 16)]) if b_coder.is_byte(i) else b_coder.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if b"".join(a_raw) != whole or b"".join(b_raw) != whole:
            a, b, a_raw, b_raw = [], [], [], []

        def ranges(raw):
            at, out = 0, []
            for r in raw:
                out.append((at, at + len(r)))
                at += len(r)
            return out

        ra, rb = ranges(a_raw), ranges(b_raw)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(ra) for j, (t, f) in enumerate(rb) if s < f and t < e]
        shared = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, low = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(x) for x, (s, e) in zip(ids, r) if low <= s and e <= end) for ids, r in ((a, ra), (b, rb))))
            low = end
        docs.append((doc_id, a, b, links, groups))
    counts = Counter(p for *_, links, _ in docs for p in set(links))
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    return [
        (i, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for i, a, b, links, groups in docs
    ]


def aligned(spark, rows, parts=4):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, chunk int, n_a int").repartition(parts)
    return sorted((tuple(r) for r in alignment.align(docs, *PATHS).select(COLUMNS).collect()), key=repr)


def test_equals_plain(spark, coders, monkeypatch):
    rng = random.Random(2)
    letters = ["the", "Straße", "naïve", "token", "  ", "\n", "\t", "1234", "日本語", "🙂", "<s>", "<|endoftext|>", "<0x41>", "don't", "...", "▁", "\x00", "é", "é", " ", " ", "ﬁ"]
    rows = [(i, rng.choice(["", " "]).join(rng.choice(letters) for _ in range(rng.randrange(1, 30)))) for i in range(120)]
    assert aligned(spark, rows) == sorted(plain(rows, coders), key=repr)
    # Many chunks and a memory that forgets.
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 300)
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 40)
    assert aligned(spark, rows) == sorted(plain(rows, coders), key=repr)


def test_given_texts(spark, coders):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len(rows) > 50 and aligned(spark, rows) == sorted(plain(rows, coders), key=repr)


def test_defined_cases(spark, coders):
    rows = [(1, None), (2, ""), (None, "a null id"), (4, "twice the same"), (4, "twice the same"), (5, " "), (6, "\n"), (7, "a▁b")]
    got = aligned(spark, rows)
    assert got == sorted(plain(rows, coders), key=repr)
    assert [r for r in got if r[0] in (1, 2, 7)] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 7)]
    assert aligned(spark, []) == []


def test_very_long_text(spark):
    text = "word " * 300_000 + "x" * 200_000
    (row,) = aligned(spark, [(1, text)])
    assert row[1] > 300_000 and row[4] == row[1] + row[2] - row[3]


def test_both_libraries_give_the_same_ids(spark):
    with open(PATHS[0], "rb") as a, open(PATHS[1], "rb") as b:
        coders = alignment.Tokenizers(a.read(), b.read())
    assert coders.quick
    rng = random.Random(4)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["".join(chr(rng.randrange(1, 0x250)) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["".join(rng.choice("'sStTreveld 19 \n\t\x85\xa0éß.,<|endoftext|>") for _ in range(rng.randrange(80))) for _ in range(3000)]
    want = [x.ids for x in coders.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert coders.encode_a(texts) == want
    with open(PATHS[0], encoding="utf-8") as f:
        stored = json.load(f)
    stored["model"]["merges"].reverse()
    assert alignment.plain_ranks(stored, alignment.byte_letters()) is None


def test_bytes_of_tokens():
    with open(PATHS[0], "rb") as a, open(PATHS[1], "rb") as b:
        coders = alignment.Tokenizers(a.read(), b.read())
    assert set(map(len, alignment.byte_letters())) == {1} and sorted(alignment.byte_letters().values()) == list(range(256))
    assert b"".join(coders.a_bytes[i] for i in json.loads("[464, 290]")) == b"The and"
