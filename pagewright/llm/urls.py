"""URL filter: pattern rules indexed by their rarest literal token, all in built-in functions.

A rule is a pattern over ``host + path`` with ``||`` (start of the host or of one of its labels), ``*``
(anything) and ``^`` (a separator or the end). Each rule is filed under the one of its whole literal
tokens that the fewest URLs have; a rule without a whole token is filed under the empty token, which
every URL has. The tokens of a URL fetch the rules filed under them, and only those run their regular
expression. The verdict is the same as that of running all rules.

Among the rules that fit, ranked ones (``rank`` not NULL) come first, the longest of them winning; of
the others an allowing one wins over blocking ones. Without a rule a URL is allowed.

A NULL URL, or one without ``://``, has an empty host and path. Repeated rows each get the same
verdict. Equal rules give equal verdicts; the one listed first is named. An empty table gives an empty
result. Further columns are not read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import lower_az, parameter_table, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN_GAPS = "[^A-Za-z0-9]+"


class Rule(NamedTuple):
    verdict: str
    pattern: str
    rank: int | None = None  # length of a host and path rule; NULL for a plain pattern
    name: str | None = None


def host_rule(verdict: str, rule: str) -> Rule:
    """A rule ``host/path`` that fits the host and its subdomains where the path starts with its path."""
    return Rule(verdict, f"||{rule}*", len(rule), rule)


def rule_regex(pattern: str) -> str:
    """Regular expression over host + path; it has to match from the start."""
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    parts = [{"*": ".*", "^": r"([^A-Za-z0-9_.%-]|$)"}.get(c) or re.escape(c) for c in body]
    return ("(?s)^" + (r"([^/]*\.)?" if anchored else ".*")) + "".join(parts)


def rule_tokens(pattern: str) -> list[str]:
    """Literal tokens that a fitting URL has as whole tokens: those with a separator, an anchor or the
    pattern's end mark on both sides."""
    body = "^" + pattern[2:] if pattern.startswith("||") else "*" + pattern
    tokens = re.finditer(r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", body)
    return sorted({m.group() for m in tokens})


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_az(host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(address: Column) -> Column:
    return F.array_distinct(F.concat(F.split(address, TOKEN_GAPS), F.array(F.lit(""))))


def rule_index(addresses: DataFrame, rules: list[Rule]) -> DataFrame:
    """(id, token, regex, verdict, rank, name): each rule under its rarest whole token. ``addresses`` has
    the token array of each URL in ``tokens``; how many URLs have a token is counted over all of them."""
    spark = addresses.sparkSession
    rows = [(i, *r, rule_regex(r.pattern), rule_tokens(r.pattern) or [""]) for i, r in enumerate(rules)]
    table = parameter_table(spark, rows, "id int, verdict string, pattern string, rank int, name string, regex string, literals array<string>")
    filed = table.select("*", F.explode("literals").alias("token")).drop("literals")
    seen = addresses.select(F.explode("tokens").alias("token"))
    counts = seen.join(small(filed.select("token").distinct(), len(rows)), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    ranked = filed.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = ranked.groupBy("id").agg(F.min(F.struct("n", "token")).getField("token").alias("token"))
    return filed.join(best, ["id", "token"])


def rules_of(table: DataFrame, most: int = 100_000) -> list[Rule]:
    """The rules of a table (verdict, pattern, and for host rules rank and name, else NULL) in the order of its
    column ``ord``. A rule list is a parameter of a job, ``most`` rows at most; more are an error."""
    rows = table.orderBy("ord").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the table has over {most} rules")
    return [Rule(r["verdict"], r["pattern"], r["rank"], r["name"]) for r in rows]


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule (name of the ranked rule or NULL), pattern that decided, verdict."""
    address = F.col(url)
    rows = pages.select(key, F.col(url).alias("_url"), host_of(address).alias("host"), path_of(address).alias("path"))
    rows = rows.withColumn("address", F.concat("host", "path"))
    bare = rows.filter("address = ''")
    rows = rows.filter("address <> ''")
    found = rows.select("address", tokens_of(F.col("address")).alias("tokens"))
    index = rule_index(found, rules)
    fetched = found.select("address", F.explode("tokens").alias("token")).join(small(index, len(rules)), "token")
    fits = fetched.filter(F.expr("address RLIKE regex"))
    order = F.struct(
        F.coalesce("rank", F.lit(-1)), (F.col("verdict") == "allow").cast("int"), -F.col("id"),
        F.col("name"), F.col("verdict"), F.col("pattern"),
    )
    # equal addresses meet here, however many rows have them
    best = fits.groupBy("address").agg(F.max(order).alias("best"))
    best = best.select("address", F.col("best.name").alias("rule"), F.col("best.pattern").alias("pattern"), F.col("best.verdict").alias("verdict"))
    # URLs without host and path fit no rule and need not meet
    out = rows.join(best, "address", "left").unionByName(bare, allowMissingColumns=True)
    return out.select(key, "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "pattern")
