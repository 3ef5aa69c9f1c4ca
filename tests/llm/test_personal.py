"""Personal data: base spans against the rules as plain patterns, accuracy on documents
that the trees have not seen, and defined cases."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from vitalgrid.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digit(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and check_digit(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if fine[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for alphabet in ("a@.-1", "0123456789. -", "+1 ().-a", "12.", "4 -", "é@a.b+ 19"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert personal.written(personal.base_spans(text)).split(",") == (plain(text) or [""]), text


@pytest.mark.parametrize("piece", ["1", "1.", "a", "a@", "+1", "+", "1 ", "1-", ".", "1.1.1.1.", "a.b@c.d ", " at a.b", "(at)", "é", "1 (2) "])
def test_hostile_texts_take_linear_time(piece):
    text = piece * (200_000 // len(piece))
    began = time.time()
    base = personal.base_spans(text)
    personal.without_inner(personal.candidates(text), base)
    assert time.time() - began < 4


@pytest.fixture(scope="module")
def model(spark):
    return personal.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_unseen_spellings(model):
    rng, kinds = random.Random(8), {k: [0, 0] for k in range(4)}
    for i in range(400):
        kind = i % 4
        raw = [
            f"{rng.choice(['anna', 'j.doe', 'kim_77'])}@{rng.choice(['post.example.net', 'mail.example.org', 'uni.example.de'])}",
            ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
            "4111111111111111",
            f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
        ][kind]
        spelled = personal.rewritten(kind, raw, rng)
        text = f"It was said there and then: {spelled} and so it went on."
        base = personal.base_spans(text)
        start = text.index(spelled)
        spans = base + model.added(text, base)
        kinds[kind][0] += any(k == kind and s <= start + 1 and start + len(spelled) <= e for k, s, e in spans)
        kinds[kind][1] += 1
    assert all(hit >= 0.8 * n for hit, n in kinds.values()), kinds


def test_numbers_side_by_side(model):
    text = "to ring +1 (961) 555-6946 4111111111111111 or 43.21.141.162"
    assert personal.base_spans(text) == [(1, 46, 59)]
    added = personal.apart(model.added(text, personal.base_spans(text)), dict.fromkeys(personal.candidates(text), 1.0))
    assert {(k, text[s:e]) for k, s, e in added} == {(3, "+1 (961) 555-6946"), (2, "4111111111111111")}


def test_what_is_none_is_left_alone(model):
    rng, wrong = random.Random(9), 0
    for _ in range(1000):
        text = f"there were {personal.no_datum(rng)} of them in all"
        base = personal.base_spans(text)
        wrong += bool(model.added(text, base))
    assert wrong <= 30


def test_clean_documents_are_left_alone(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = personal.find(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k + ":") for w in want) for k in PATTERNS]
        assert set(want) <= set(r.spans.split(",")) | {""} and len(r.spans.split(",")) == max(len(want) + r.n_added, 1)
    added = sum(r.n_added for r in rows)
    assert added <= 0.002 * len(rows)


def test_trees_learn_and_score():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5) | (x[:, 2] > 1.5)).astype(int)
    trees = personal.fit_trees(x[:2000], y[:2000], rounds=30)
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95 and len(trees.score(x[:0])) == 0


def test_threshold():
    assert personal.threshold([]) == 2.0 and personal.threshold([(150, 0, 5)]) == 2.0
    assert personal.threshold([(190, 1, 1000), (100, 0, 500), (20, 1, 10)]) == 0.505
    assert personal.threshold([(200, 1, 300), (180, 0, 40)]) == 0.905


def test_defined_cases(spark):
    schema = "doc_id long, text string, spans int, n_added string"
    rows = [(1, None), (2, ""), (None, "mail a@b.cd"), (4, "mail a@b.cd"), (4, "mail a@b.cd"), (5, "x" * 500_000 + " 1.2.3.4")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], schema)
    got = {(r.doc_id, r.n_email, r.n_ip, r.spans) for r in personal.find(docs).collect()}
    assert got == {(1, 0, 0, ""), (2, 0, 0, ""), (None, 1, 0, "email:5:11"), (4, 1, 0, "email:5:11"), (5, 0, 1, "ip:500001:500008")}
    assert personal.find(docs).count() == len(rows)
    assert personal.find(docs.limit(0)).collect() == []
    cut = personal.redact(docs.where("doc_id is null or doc_id < 5"))
    assert cut.schema == docs.schema
    assert {r.text for r in cut.collect()} == {None, "", "mail [email]"}
