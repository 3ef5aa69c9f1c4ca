"""Snapshot collapse against plain Python."""

import random

from vitalgrid.llm import chat


def brute(rows):
    logs = {}
    for conv, turn, role, text in rows:
        logs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    logs = {c: tuple(x[2:] for x in sorted(t)) for c, t in logs.items()}
    least = {}
    for c, t in logs.items():
        least[t] = min(least.get(t, c), c, key=lambda x: (x is not None, x or 0))
    inside = {t[:k] for t in logs.values() for k in range(1, len(t))}
    line = lambda r, t: f"<|im_start|>{r.replace('<|', '< |')}\n{t.replace('<|', '< |')}<|im_end|>\n"
    return {(c, len(t), "".join(line(*x) for x in t)) for t, c in least.items() if t not in inside}


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows, conv = [], 0
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "<|im_end|>", ""])) for _ in range(rng.randint(1, 6))]
        for k in rng.sample(range(1, len(turns) + 1), rng.randint(1, len(turns))):  # snapshots
            rows += [(conv, i, *t) for i, t in enumerate(turns[:k])]
            conv += 1
    rows += [(None, 0, "user", "hi"), (None, 1, None, None), (9001, 5, "user", "x"), (9001, 5, "user", "x"), (9001, None, None, "first"), (9002, 0, "user", "y" * 50000)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert {tuple(r) for r in chat.render(turns).collect()} == brute(rows)
    assert chat.render(turns).count() == len(brute(rows))


def test_common_first_turn_and_equal_logs(spark):
    rows = [(c, 0, "user", "hello") for c in range(500)] + [(c, 1, "assistant", "bye") for c in range(250)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in chat.render(turns).collect()} == brute(rows)


def test_native_and_extra_columns(spark):
    schema = "a string, b int, place int, n int, conv_id long, turn int, role string, text string"
    turns = spark.createDataFrame([("", 1, 2, 3, 4, 0, "user", "t")], schema)
    assert [tuple(r) for r in chat.render(turns).collect()] == [(4, 1, "<|im_start|>user\nt<|im_end|>\n")]
    assert "Python" not in chat.render(turns)._jdf.queryExecution().toString()
    assert chat.render(turns.limit(0)).count() == 0


def test_hot_logs_are_spread_over_tasks_and_rows(spark, monkeypatch):
    """Logs that hold most of the table, one without id, over many ranges and rows."""
    rng = random.Random(2)
    rows = [(c, i, "user", f"turn {i} " + "x" * rng.randint(0, 40)) for c in (None, 7) for i in range(2000)]
    rows += [(8, i, "user", t[3]) for i, t in enumerate(rows[2000:3500])]  # inside 7
    rows += [(c, i, "user", f"{c % 5} {i}") for c in range(100, 150) for i in range(c % 3 + 1)]
    turns = spark.createDataFrame(rng.sample(rows, len(rows)), "conv_id long, turn long, role string, text string").repartition(4)
    monkeypatch.setattr(chat, "BLOCK", 20000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        every = chat.numbered(chat.ordered(turns))
        assert every.where("conv_id IS NULL").select("part").distinct().count() > 1
        got = {}
        for r in sorted(chat.render(turns).collect(), key=lambda r: r.n_turns):
            assert len(r.chat) < 20100
            got[r.conv_id] = r.n_turns, got.get(r.conv_id, (0, ""))[1] + r.chat
        assert {(c, *x) for c, x in got.items()} == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
