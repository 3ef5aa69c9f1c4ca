"""The pipeline's stages, each against brute force on its own input."""

import hashlib

import corpus_pipeline
from tests.llm.test_bpe import LIBRARY
from tests.llm.test_contamination import brute_align, words
from tests.llm.test_neardup import brute as brute_groups
from vitalgrid import session
from vitalgrid.llm import suffix, toxicity

SF = "/root/testdata/sf0.001"


def cut(rows, size=100):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw, gone = text.encode(), set()
        for i in range(len(raw) - size + 1):
            window = raw[i : i + size]
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        out[doc_id] = bytes(b for i, b in enumerate(raw) if i not in gone).decode("utf-8", "ignore")
    return out


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()

    def step(name, docs):
        out = stages[name](spark, docs, SF)
        if name != "encode":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = out.collect()
        return rows, spark.createDataFrame(rows, out.schema)

    rows, kept = step("toxicity", docs)
    assert {r.doc_id for r in rows} == {r.doc_id for r in toxicity.scores(docs, labels).where("predicted = 0").collect()}
    assert 0.8 * docs.count() < len(rows)

    want = {d for d, (_, _, first) in brute_groups([(r.doc_id, r.text) for r in rows]).items() if first}
    rows, kept = step("near-dedup", kept)
    assert {r.doc_id for r in rows} == want

    want = cut([(r.doc_id, r.text) for r in rows])
    rows, kept = step("suffix-dedup", kept)
    assert {r.doc_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)

    before = {r.doc_id: words(r.text) for r in rows}
    rows, kept = step("decontamination", kept)
    left = {r.doc_id for r in rows}
    for d, text in before.items():
        # A whole item, or hardly anything of one; between lie edited copies.
        best = max((brute_align(words(i.text), text) / len(words(i.text)) for i in items if set(words(i.text)) & set(text)), default=0) if len(text) < 400 else None
        if best is not None and (best > 0.8 or best < 0.4):
            assert (d in left) == (best < 0.4)

    texts = {r.doc_id: r.text for r in rows}
    rows, _ = step("encode", kept)
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    # Of each stage only its result is left in the shared folder.
    names = [e.name.rsplit("-", 1)[0] for e in session.list_folder(spark, session.run_dir(spark))]
    assert all(names.count(name) >= 1 for name, _ in corpus_pipeline.STAGES[:-1])


def test_remove_keeps_rows_and_columns(spark):
    schema = "text string, doc int, doc_id long, lang string, n_chars long"
    rows = [("ab " * 100, 1, 1, "x", 300), (None, 2, 2, None, None), ("ab " * 100, 3, 3, "y", 300)]
    out = suffix.remove(spark.createDataFrame(rows, schema))
    assert out.columns == ["text", "doc", "doc_id", "lang", "n_chars"]
    assert {(r.doc_id, r.text, r.lang) for r in out.collect()} == {(1, cut([(1, rows[0][0])])[1], "x"), (2, "", None), (3, "", "y")}
