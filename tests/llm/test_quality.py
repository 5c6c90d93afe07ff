import pytest
from pyspark.sql import functions as F

from pagewright.llm import quality
from pagewright.llm.common import split_words
from tests.llm.helpers import awkward, docs


def brute_repeats(words, window=5):
    seen, hit = {}, set()
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit |= {p + k for p in places for k in range(window)}
    return len(hit)


def test_features_equal_brute_force(spark):
    pairs = awkward() + [(300, "a b " * 40), (301, "x\nx\n \nx y\nx\n" * 3), (302, "one two three four five six one two three four five")]
    table = docs(spark, pairs).withColumn("words", split_words(F.col("text")))
    text, words = F.col("text"), F.col("words")
    got = table.select(
        "text", F.size(words), quality.word_chars(words), quality.n_symbols(text), quality.n_dup_lines(text), quality.n_repeat_words(words)
    ).collect()
    import re

    for row in got:
        t = row[0] or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), len("".join(w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), brute_repeats(w))
        assert tuple(row[1:]) == want


def test_the_order_is_greedy_among_the_rows_left():
    """Rule b rejects most, but nothing beyond a, which is cheaper; so c comes before it."""
    patterns = [({"a": True, "b": True, "c": False}, 50), ({"a": False, "b": False, "c": True}, 10), ({"a": False, "b": False, "c": False}, 40)]
    order = quality.greedy_order({"a": 1.0, "b": 0.9, "c": 1.0}, patterns[:1] + patterns[2:] + [({"a": True, "b": False, "c": False}, 30)] + patterns[1:2])
    assert [m["rule"] for m in order] == ["a", "c", "b"]
    assert [round(m["rejected"], 3) for m in order] == [round(80 / 130, 3), round(10 / 50, 3), 0.0]
    assert [m["rule"] for m in quality.greedy_order({"x": 1.0, "y": 1.0}, [])] == ["x", "y"]


def test_the_order_does_not_change_the_verdict(spark):
    table = docs(spark, awkward())
    rules = quality.default_rules(F.col("text"))
    names = [m["rule"] for m in quality.plan_cascade(table, rules)]
    assert set(names) == set(rules)
    kept = lambda order: sorted(str(r.doc_id) for r in table.filter(quality.verdict(rules, order).isNull()).collect())
    assert kept(names) == kept(names[::-1]) == sorted(str(r.doc_id) for r in quality.filter_documents(table).collect())


def test_costly_rules_cost_more(spark):
    text = F.concat_ws(" ", *[F.col("id") % k for k in range(3, 200)])
    table = spark.range(600).select(F.col("id").alias("doc_id"), text.alias("text"))
    plan = {m["rule"]: m for m in quality.plan_cascade(table, {"dear": quality.default_rules(F.col("text"))["repeats"], "cheap": F.length("text") < 0})}
    assert plan["dear"]["seconds"] > plan["cheap"]["seconds"]


def test_later_rules_do_not_run(spark):
    """The second rule raises where it is evaluated."""
    rules = {"first": F.col("text").isNotNull(), "second": F.raise_error(F.lit("ran")).cast("boolean")}
    table = docs(spark, [(1, "a"), (2, "b")])
    assert [r[0] for r in table.select(quality.verdict(rules, ["first", "second"])).collect()] == ["first", "first"]


@pytest.mark.parametrize(("text", "kept"), [
    ("Plain words that make up a line of quite ordinary prose here.", True),
    (None, False), ("", False), ("too short", False),
    ("WHY IS ALL OF THIS SHOUTED AT EVERY READER OF THE PAGE", False),
    ("w### x$$$ y%%% z&&& a### b$$$ c%%% d&&& e### f$$$", False),
    ("spam spam spam spam spam spam spam spam spam spam spam", False),
    ("what! is! this! all! about! here! in! this! little! text!", False),
])
def test_verdicts(spark, text, kept):
    got = quality.filter_documents(docs(spark, [(1, text)]))
    assert got.count() == kept and got.columns == docs(spark, []).columns


def test_empty_table(spark):
    assert quality.filter_documents(docs(spark, [])).count() == 0
