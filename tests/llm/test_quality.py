"""Compression bands against plain Python."""

import re
from collections import Counter

import pytest
import zstandard

from vitalgrid.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")

TEXTS = {
    1: None,
    2: "",
    3: " \t\n\x0b\x0c\r ",
    4: "a a a a a",
    5: "one two three\none two three\n\n \none two three",
    6: "é#% ü|x <b>\né#% ü|x <b>",
    7: "x" * 30000,
    8: " ".join(f"w{i * 7919 % 1009}" for i in range(900)),
    9: "same line here\n" * 400,
    10: "a b c d a b c e f   g\x1ch",
    11: " ".join(f"w{i * 7919 % 1009}" for i in range(900)),
    12: "tail\nline\ntail",
    13: "\nx\n\nx",
}


def brute(text, bands=quality.Bands()):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    raw = text.encode()
    press = lambda b: len(zstandard.ZstdCompressor(level=bands.level).compress(b)) / len(b)
    kept = False
    if raw and not failed:
        low, high = next((a, b) for n, a, b in bands.whole if len(raw) <= n)
        size, parts = bands.chunk_bytes, []
        for i in range(len(raw) // size):
            parts.append(raw[i * size : len(raw) if i + 1 == len(raw) // size else (i + 1) * size])
        bad = sum(not bands.chunk[0] <= press(p) <= bands.chunk[1] for p in parts)
        kept = low <= press(raw) <= high and bad <= bands.bad_chunks * len(parts)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(hit), failed, kept,
    )


def test_counts_and_verdict(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").repartition(2)
    got = {r.doc_id: tuple(r)[1:8] for r in quality.judge(docs).collect()}
    assert got == {k: brute(v) for k, v in TEXTS.items()}


def test_real_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r)[1:8] for r in quality.judge(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert 0 < sum(v[-1] for v in got.values()) < len(got)


def test_limits_follow_length(spark):
    """The same ratio passes in one length class and not in the other."""
    words = [f"w{i * 7919 % 100003}" for i in range(2000)]
    docs = spark.createDataFrame([(1, " ".join(words[:150])), (2, " ".join(words))], "doc_id long, text string")
    free = {r.doc_id: r for r in quality.judge(docs, quality.Bands(whole=((float("inf"), 0, 2),), chunk=(0, 2))).collect()}
    assert free[1].kept and free[2].kept and free[2].n_chunks > 1
    between = (free[1].ratio + free[2].ratio) / 2
    split = {r.doc_id: r.kept for r in quality.judge(docs, quality.Bands(whole=((2000, between, 2), (float("inf"), 0, between)), chunk=(0, 2))).collect()}
    assert split == {1: True, 2: True}
    strict = {r.doc_id: r.kept for r in quality.judge(docs, quality.Bands(whole=((float("inf"), between, 2),), chunk=(0, 2))).collect()}
    assert strict == {1: True, 2: False}
    chunks = {r.doc_id: r.kept for r in quality.judge(docs, quality.Bands(whole=((float("inf"), 0, 2),), chunk=(0, 0.01))).collect()}
    assert chunks == {1: True, 2: False}


@pytest.mark.parametrize("rows", [[]])
def test_empty_and_extra_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, kept string, n_words string, text string")
    assert quality.judge(docs).columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert quality.judge(docs).count() == 0
