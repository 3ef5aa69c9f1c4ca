"""Shards: near equal bytes, whole groups, gapless slots."""

import random
import zlib
from collections import Counter, defaultdict

from vitalgrid.llm import shards


def check(rows, docs, tolerance):
    """Laws that hold for any input; returns bytes by shard."""
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in docs)
    by_id = {d[0]: d[1] or "" for d in docs}
    slots, bytes_, of_text = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        text = by_id[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        assert 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
        bytes_[r.shard] += r.size
        of_text[text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    goal = sum(bytes_.values()) / 16
    assert all(abs(bytes_[s] - goal) <= tolerance * goal for s in range(16)), (goal, bytes_)
    return of_text, bytes_


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdé") for _ in range(5)) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string"


def test_near_equal_and_whole_groups(spark):
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["en", "de", None]), f"s{rng.randrange(9)}") for i in range(3000)]
    docs += [(5000 + i, docs[i % 7][1], "fr", None) for i in range(70)]
    docs += [(6000 + i, None if i % 2 else "", "en", "s1") for i in range(200)]
    docs += [(7000 + i, "one copy of many " * 4, rng.choice(["en", "de"]), f"s{rng.randrange(9)}") for i in range(60)]
    rows = shards.assign(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()
    of_text, _ = check(rows, docs, 0.02)
    assert all(len(s) == 1 for s in of_text.values())


def test_group_of_a_third_of_all_rows(spark):
    rng = random.Random(2)
    docs = [(i, prose(rng, 20), "en", "s0") for i in range(1500)] + [(5000 + i, "x" * 200, "en", "s0") for i in range(750)]
    rows = shards.assign(spark.createDataFrame(docs, SCHEMA)).collect()
    of_text, _ = check(rows, docs, 0.1)
    assert sum(len(s) > 1 for s in of_text.values()) == 1


def test_real_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in table.collect()]
    check(shards.assign(table).collect(), docs, 0.05)


def test_few_rows_and_extra_columns(spark):
    schema = "hash int, shard string, slot int, weight int, n int, key int, node int, " + SCHEMA
    docs = [(1, "", 1, 1, 1, 1, 1, None, "a", None, None), (1, "", 1, 1, 1, 1, 1, 2, "b", None, None), (1, "", 1, 1, 1, 1, 1, 2, "b", None, None)]
    rows = shards.assign(spark.createDataFrame(docs, schema)).collect()
    assert len(rows) == 3 and len({r.shard for r in rows if r.doc_id == 2}) == 1
    assert shards.assign(spark.createDataFrame([], schema)).count() == 0


def test_leaves_are_those_of_a_plain_tree(spark):
    """Every split is along the widest dimension, at the edge nearest to the goal."""
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randint(1, 90)), rng.choice("ab"), f"s{rng.randrange(5)}") for i in range(400)]
    groups = shards.text_groups(shards.keyed_rows(spark.createDataFrame(docs, SCHEMA)))
    rows = [r.asDict() for r in groups.collect()]
    ends = {d: [f(r["log_size" if d == "size" else d] for r in rows) for f in (min, max)] for d in shards.DIMENSIONS}
    keyed = groups.select("hash", *[shards.key_of(d, *ends[d]).alias(f"key_{d}") for d in shards.DIMENSIONS], *[shards.scaled(d, *ends[d]).alias(f"at_{d}") for d in shards.DIMENSIONS])
    keys = {r.hash: r for r in keyed.collect()}
    want = {}

    def split(part, first, end):
        if end - first == 1:
            want.update((r["hash"], first) for r in part)
            return
        width = {d: max(keys[r["hash"]][f"at_{d}"] for r in part) - min(keys[r["hash"]][f"at_{d}"] for r in part) for d in shards.DIMENSIONS}
        along = max(shards.DIMENSIONS, key=lambda d: width[d])
        part = sorted(part, key=lambda r: keys[r["hash"]][f"key_{along}"])
        middle = (first + end + 1) // 2
        goal, below, cut = sum(r["weight"] for r in part) * (middle - first) / (end - first), 0, 0
        for i, r in enumerate(part):
            if below + r["weight"] > goal:
                cut = i if goal - below <= below + r["weight"] - goal else i + 1
                break
            below += r["weight"]
        split(part[:cut], first, middle)
        split(part[cut:], middle, end)

    split(rows, 0, 8)
    got = {r.hash: r.shard for r in shards.shard_of_groups(groups, [0] * 8, 8).collect()}
    assert got == want


def test_nearly_all_bytes_go_through_the_tree(spark):
    for sf, tolerance in (("0.001", 0.01), ("0.01", 0.01)):
        table = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
        groups = shards.text_groups(shards.keyed_rows(table)).collect()
        goal = sum(r.weight for r in groups) / 16
        assert sum(r.weight for r in groups if r.weight <= goal) > 0.95 * 16 * goal
        docs = [(r.doc_id, r.text, r.lang, r.source) for r in table.collect()]
        check(shards.assign(table).collect(), docs, tolerance)


def test_even_out():
    rng = random.Random(7)
    heavy = [(rng.randint(50, 900), rng.randrange(16)) for _ in range(300)]
    held = [sum(w for w, s in heavy if s == shard) for shard in range(16)]
    moved = shards.even_out(heavy, held)
    after = [sum(w for i, (w, s) in enumerate(heavy) if moved.get(i, s) == shard) for shard in range(16)]
    assert sum(after) == sum(held) and max(after) - min(after) < 0.02 * sum(after) / 16
    assert shards.even_out([], [0, 0]) == {} and shards.even_out([(7, 0)], [7, 0]) == {}
