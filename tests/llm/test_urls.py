import random
import re

import pytest

from pagewright.llm import urls
from pagewright.llm.queries import RULES

URLS = [
    "http://example.net/en/", "https://M.Example.NET/en/x?y=/de/", "http://a.net", "http://a.net/", "net/", None, "", "http://notexample.com/de/",
    "http://x.example.com/de/1#q", "http://example.com/DE/1", "http://b.org/fr/z", "http://org/fr/", "ftp://c://d.net/x", "http://u@e.net:80/",
    "https://spam-farm.example.org/fr/1", "http://a.b/casino/x", "http://a.b/myadserverx", "http://cheap-pills.example.com/about/us",
    "http://a.b/about/casino/x", "http://x.net?q#r", "http://\u00c4.NET/\n/x", "http://example.net/en/casino/", "://", "http:///en/",
]


def brute(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for rule in RULES[:4]:
        where, start = rule.name.split("/", 1)
        if (host == where or host.endswith("." + where)) and path.startswith("/" + start) and (best is None or rule.rank > best.rank):
            best = rule
    if best:
        return host, path, best.name, best.verdict
    fits = [r for r in RULES[4:] if host + path and re.match(urls.rule_regex(r.pattern), host + path)]
    verdict = "allow" if not fits or any(r.verdict == "allow" for r in fits) else "block"
    return host, path, None, verdict


def test_verdicts_equal_running_all_rules(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[0], "x", "y"), (None, URLS[1], "x", "y")]
    table = spark.createDataFrame(rows, "page_id long, url string, verdict string, token string")
    got = urls.judge(table, RULES).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, *brute(u))) for i, u, *_ in rows)
    assert sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in got) == want
    assert {r.verdict for r in got} == {"allow", "block"}
    assert urls.judge(table.limit(0), RULES).count() == 0


def test_a_list_of_thousands_equals_running_all(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(60)}"
    rows = []
    for k in range(3000):
        kind, verdict = rng.randrange(4), rng.choice(["block", "allow"])
        if kind == 0:
            rule = urls.host_rule(verdict, f"{word()}.com/{word()}/")
            rows.append((k, *rule))
        else:
            rows.append((k, verdict, [f"||{word()}.com/*/{word()}^", f"*/{word()}/{word()}*", f"*{word()}-{word()}*"][kind - 1], None, None))
    table = spark.createDataFrame(rows, "ord int, verdict string, pattern string, rank int, name string").repartition(3)
    rules = urls.rules_of(table)
    assert [tuple(r) for r in rules] == [r[1:] for r in rows]
    addresses = [f"http://{word()}.{rng.choice(['com', 'net'])}/{word()}/{word()}-{word()}/{word()}" for _ in range(150)]
    got = urls.judge(spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string"), rules).collect()
    compiled = [(i, r, re.compile(urls.rule_regex(r.pattern))) for i, r in enumerate(rules)]
    decided = 0
    for row in got:
        address = row.host + row.path
        fits = [(r.rank if r.rank is not None else -1, r.verdict == "allow", -i, r) for i, r, pattern in compiled if pattern.match(address)]
        best = max(fits)[3] if fits else None
        assert (row.verdict, row.rule, row.pattern) == ((best.verdict, best.name, best.pattern) if best else ("allow", None, None))
        decided += best is not None
    assert len(got) == 150 and decided > 20
    with pytest.raises(ValueError):
        urls.rules_of(table, most=2999)


def test_rules_are_filed_under_their_rarest_token(spark):
    addresses = spark.createDataFrame([(["net", "example", "en", ""],), (["net", "example", ""],), (["net", ""],)], "tokens array<string>")
    index = {r.id: r.token for r in urls.rule_index(addresses, RULES).collect()}
    assert index[0] == "net" and index[1] == "en" and index[7] == "" and index[6] == "casino" and len(index) == len(RULES)


def test_literal_tokens():
    assert urls.rule_tokens("||cheap-pills.*^") == ["cheap", "pills"]
    assert urls.rule_tokens("*adserver*") == [] and urls.rule_tokens("||a.b/foo") == ["a", "b"]


def test_no_python_in_the_plan(spark):
    table = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    plan = urls.judge(table, RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
