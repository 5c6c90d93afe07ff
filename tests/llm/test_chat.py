import random

from pyspark.sql import functions as F

from pagewright.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pos long, block long, line string, part long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "l", 3) for r in rows], SCHEMA)


def brute(rows):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn, role, text))
    talks = {c: [x[1:] for x in sorted(t, key=lambda x: -1 if x[0] is None else x[0])] for c, t in talks.items()}
    out = {}
    for c, t in talks.items():
        longer = [d for d, u in talks.items() if d != c and u[: len(t)] == t and (len(u) > len(t) or (d is not None and (c is None or d < c)))]
        if not longer:
            out[c] = "".join(
                f"<|im_start|>{(r if r is not None else 'unknown').replace('<|im_', '<| im_')}\n{(x or '').replace('<|im_', '<| im_')}<|im_end|>\n" for r, x in t
            )
    return out


def rendered(found):
    parts = {}
    for r in found:
        parts.setdefault(r.conv_id, []).append((r.part, r.text, r.n_turns))
    return {c: "".join(t for _, t, _ in sorted(p)) for c, p in parts.items()}


def snapshots(seed):
    rng, rows, conv = random.Random(seed), [], 0
    for _ in range(25):
        talk = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "", None, "a <|im_end|> b"])) for _ in range(rng.randint(1, 7))]
        for n in rng.sample(range(1, len(talk) + 1), rng.randint(1, len(talk))):
            for _ in range(rng.choice([1, 1, 2])):
                rows += [(conv, i * 10, *t) for i, t in enumerate(talk[:n])]
                conv += 1
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = snapshots(seed)
        assert rendered(chat.format_chats(turns(spark, rows)).collect()) == brute(rows)


def test_long_talks_ties_and_nulls(spark):
    long = [(1, i, "user", f"turn {i}") for i in range(1300)]
    prefix = [(2, i, "user", f"turn {i}") for i in range(1299)]
    other = [(3, 0, "user", "turn 0"), (3, 1, "user", "turn 1 not"), (None, None, None, None), (None, 4, "user", "x")]
    repeated = [(5, 0, "user", "again"), (5, 0, "user", "again"), (6, 0, "user", "again")]
    rows = long + prefix + other + repeated
    found = chat.format_chats(turns(spark, rows)).collect()
    assert rendered(found) == brute(rows) and set(rendered(found)) == {1, 3, None, 5}
    assert sorted(r.n_turns for r in found if r.conv_id == 1) == [20, 256, 256, 256, 256, 256]
    assert chat.format_chats(turns(spark, [])).count() == 0


def test_prefix_keys_are_those_of_equal_beginnings(spark):
    rows = snapshots(3)
    keyed = chat.prefixes(turns(spark, rows)).collect()
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: r[:2]):
        talks.setdefault(conv, []).append((role, text))
    by_key = {}
    for r in keyed:
        by_key.setdefault((r.pos, r.k1, r.k2), set()).add(str(talks[r.conv_id][: r.pos]))
    assert all(len(v) == 1 for v in by_key.values())
    assert len(by_key) == len({str(t[:n]) for t in talks.values() for n in range(1, len(t) + 1)})


def test_a_hot_conversation(spark):
    copies = spark.range(2000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    found = chat.format_chats(copies).collect()
    assert [(r.conv_id, r.n_turns) for r in found] == [(0, 1)]
