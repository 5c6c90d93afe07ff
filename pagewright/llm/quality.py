"""Quality rules as a short-circuit cascade, all in built-in functions.

A document is kept if no rule rejects it, so the order of the rules never changes the verdict, only
its price. :func:`plan_cascade` runs each rule over a bounded sample to learn what it costs and which rows it
rejects, and takes them by rejections per second among the rows that are left; :func:`verdict` evaluates the rules in that
order inside one CASE expression, which stops at the first that fires.

Nulls and empty texts have no words and fall to the ``words`` rule. Repeated rows and ties are judged
row by row and alike. An empty table gives an empty result; the rules then keep their given order.
Further columns pass through unread.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import let, split_words
from pagewright.sources.storage import stored

WINDOW = 5
SAMPLE_FILES = 6
CLEAR = 0.25  # seconds that a rule has to take for one run over the sample to tell its cost
SYMBOLS = r"[#*$%&|<>]+"


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more, the first occurrence included. Windows are
    compared by a 64-bit hash; only texts with a repeated one pay for the sort."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        firsts = F.slice(h, 1, F.greatest(F.size(h) - (window - 1), F.lit(0)))
        return F.transform(firsts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, window)]))

    def covered(wins: Column) -> Column:
        order = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(rows: Column) -> Column:
            twin = F.filter(
                rows,
                lambda r, k: (F.get(rows, k - 1)["h"] == r["h"]) | (F.get(rows, k + 1)["h"] == r["h"]),
            )
            return F.sort_array(F.transform(twin, lambda r: r["i"]))

        start = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, at: F.struct(
            at.alias("last"), (acc["n"] + F.least(F.lit(window), at - acc["last"])).alias("n")
        )
        return F.aggregate(let(order, repeated), start, step, lambda acc: acc["n"])

    none = F.lit(0).cast("long")
    found = let(
        let(hashes, windows),
        lambda w: F.when(F.size(w) == F.size(F.array_distinct(w)), none).otherwise(covered(w)),
    )
    return F.when(F.size(words) <= window, none).otherwise(found)


def default_rules(text: Column, words: Column | None = None, facts: dict[str, Column] | None = None) -> dict[str, Column]:
    """Rule name -> condition that rejects; NULL counts as not rejected. ``words`` and ``facts`` (n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words) are taken as given if they are at hand."""
    facts, given = facts or {}, words is not None
    words = words if given else split_words(text)
    whole = F.coalesce(text, F.lit(""))
    # words that are not at hand are split once per rule
    of_words = lambda rule: rule(words) if given else let(words, rule)
    n = lambda w: facts.get("n_words", F.size(w))
    chars = lambda w: facts.get("word_chars", word_chars(w))
    symbols, same = facts.get("n_symbols", n_symbols(text)), facts.get("n_dup_lines", n_dup_lines(text))
    kept = lambda pattern: F.length(F.regexp_replace(whole, pattern, ""))
    return {
        "words": n(words) < 10,
        "repeats": of_words(lambda w: 100 * facts.get("n_repeat_words", n_repeat_words(w)) > 20 * n(w)),
        "symbols": 10 * symbols > n(words),
        "shouting": of_words(lambda w: 10 * kept("[^A-Z]+") > 3 * chars(w)),
        "exclaiming": 2 * kept("[^!]+") > n(words),
        "same_lines": 10 * same > 4 * F.size(F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))),
        "word_length": of_words(lambda w: (chars(w) < 2 * n(w)) | (chars(w) > 20 * n(w))),
    }


def greedy_order(seconds: dict[str, float], patterns: list[tuple[dict[str, bool], int]]) -> list[dict]:
    """The rules by rejections per second, each judged on the rows that those before it leave. ``patterns``
    says which rules reject how many rows. Equal rules keep their given order."""
    left, order = list(seconds), []
    while left:
        alive = [(rejects, n) for rejects, n in patterns if not any(rejects[m["rule"]] for m in order)]
        total = sum(n for _, n in alive)
        share = {r: sum(n for rejects, n in alive if rejects[r]) / total if total else 0.0 for r in left}
        best = max(left, key=lambda r: share[r] / seconds[r])
        order.append({"rule": best, "seconds": seconds[best], "rejected": share[best]})
        left.remove(best)
    return order


def plan_cascade(docs: DataFrame, rules: dict[str, Column], sample_rows: int = 2000, repeats: int = 8, runs: int = 2, prepare=None) -> list[dict]:
    """The order of the rules, from a random sample of about ``sample_rows`` rows of ``docs`` (it decides the
    order, never the verdict): each with its ``seconds``, the time that the sample takes beyond that of a job
    without a rule (for cheap rules a part of that of the sample ``repeats`` times over), and the share it ``rejected`` of the rows that rules before it
    left. ``prepare`` adds to the sample the columns that the rules read beyond those of ``docs``."""
    fraction = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.sample(fraction, seed=17).repartition(SAMPLE_FILES)
    sample = stored(prepare(sample) if prepare else sample, "quality-sample")
    judged = {name: F.coalesce(rejects, F.lit(False)).alias(name) for name, rejects in rules.items()}
    patterns = sample.select(*judged.values()).groupBy(*judged).agg(F.count("*").alias("_n")).collect()
    again = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def best_time(rows: DataFrame, value: Column) -> float:
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            rows.agg(F.count_if(value)).first()
            taken.append(time.perf_counter() - started)
        return min(taken)

    # what a job takes without a rule
    idle, idle_again = best_time(sample, F.lit(False)), best_time(again, F.col("_again") < 0)

    def cost(value: Column) -> float:
        once = best_time(sample, value) - idle
        if once < CLEAR:  # too short to tell from the job itself
            once = (best_time(again, value) - idle_again) / repeats
        return max(once, 1e-4)

    seconds = {name: cost(value) for name, value in judged.items()}
    return greedy_order(seconds, [({r: row[r] for r in rules}, row["_n"]) for row in patterns])


def verdict(rules: dict[str, Column], order: list[str]) -> Column:
    """Name of the first rule in ``order`` that rejects, else NULL; later rules are not evaluated."""
    found = F.when(rules[order[0]], F.lit(order[0]))
    for name in order[1:]:
        found = found.when(rules[name], F.lit(name))
    return found


def filter_documents(docs: DataFrame, text: str = "text", sample_rows: int = 2000, rules=None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    rules = rules or default_rules(F.col(text))
    order = [m["rule"] for m in plan_cascade(docs, rules, sample_rows)]
    return docs.filter(verdict(rules, order).isNull())
