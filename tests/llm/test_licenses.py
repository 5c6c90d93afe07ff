import re

from pagewright.llm import licenses
from tests.llm.helpers import awkward, docs


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [
        (i, label) for label, phrase in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_phrases_equal_brute_force(spark):
    pairs = awkward() + [
        (300, "CC BY-NC 4.0, cc by nc cc by nc; under the MIT license"), (301, "under the mit under the mit license\nunder THE-mit LICENSE"),
        (302, "Apache License, Version 2.0 and apache license version 20"), (303, "filler " * 9000 + "under the MIT License"),
    ]
    got = licenses.scan(docs(spark, pairs)).collect()
    row = lambda r: (str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
    assert sorted(map(str, map(row, got))) == sorted(str((str(i), *brute(t))) for i, t in pairs)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_only_ascii_letters_are_lower_cased(spark):
    """The Kelvin sign and dotted capital I are no k and no i."""
    rows = [(1, "under the M\u0130T license"), (2, "CC BY NC"), (3, "apache \u212a license version 2"), (4, "UNDER THE MIT LICENSE")]
    got = {r.doc_id: (r.n_words, r.n_base) for r in licenses.scan(docs(spark, rows)).collect()}
    assert got == {1: (4, 0), 2: (3, 1), 3: (5, 0), 4: (4, 1)}


def test_notices_survive_small_changes(spark):
    label, notice = licenses.NOTICES[0]
    words = notice.split()
    less = " ".join(words[:20] + words[22:])
    more = " ".join([*words[:30], "and", "also", *words[30:]])
    other = " ".join(words[::3])
    rows = [(1, f"x y {notice} z"), (2, f"a {less}"), (3, more), (4, other), (5, " ".join(words[:12])), (6, f"{notice} " + "pad " * 500 + notice)]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, rows)).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4, 5, 6)] == ["mit", "mit", "mit", "", "", "mit"]
    assert got[1].score == 1.0 and 0.7 < got[2].score < 1 and got[4].score == 0.0


def test_no_rows_and_no_python(spark):
    assert licenses.scan(docs(spark, [])).count() == 0
    plan = licenses.scan(docs(spark, [(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
