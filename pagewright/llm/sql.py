"""DuckDB twins of the queries that SQL can express."""

from pagewright.llm import chat, licenses, urls
from pagewright.llm.queries import RULES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL = {
    "op3_quality_cascade": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), wins AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: {{'i': i, 'w': array_to_string(ws[i:i+4], ' ')}}), recursive := true)
  FROM w WHERE len(ws) > 5
), twice AS (
  SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY doc_id
), f AS (
  SELECT doc_id, t, len(ls) AS n_lines, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * len(regexp_extract_all(t, '[A-Z]')) > 3 * word_chars
    OR 2 * len(regexp_extract_all(t, '!')) > n_words OR 10 * n_dup_lines > 4 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b""",
    "op11_shared_search": rf"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents
), n AS (
  SELECT doc_id, count(*)::BIGINT AS n FROM t GROUP BY doc_id
), c AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark
), tf AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term
), s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), c GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50""",
}


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _url_sql() -> str:
    fits = lambda r: f"regexp_matches(host || path, {_quoted(urls.rule_regex(r.pattern))})"
    ranked = sorted((r for r in RULES if r.rank is not None), key=lambda r: (-r.rank, r.verdict != "allow"))
    plain = sorted((r for r in RULES if r.rank is None), key=lambda r: r.verdict != "allow")
    case = lambda field, rules: " ".join(f"WHEN {fits(r)} THEN {_quoted(getattr(r, field))}" for r in rules)
    address = "coalesce(url, '')"
    return rf"""
WITH a AS (
  SELECT page_id, translate(regexp_extract({address}, '(?s)^.*?://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
    regexp_extract({address}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
)
SELECT page_id, host, path, CASE WHEN host || path = '' THEN NULL {case("name", ranked)} END AS rule,
  CASE WHEN host || path = '' THEN 'allow' {case("verdict", [*ranked, *plain])} ELSE 'allow' END AS verdict,
  CASE WHEN host || path = '' THEN NULL {case("pattern", [*ranked, *plain])} END AS pattern
FROM a"""


def _license_sql(band: int = 3, cover: float = 0.7, stretch: float = 1.5) -> str:
    runs = licenses.template_runs([*licenses.PHRASES, *licenses.NOTICES])
    values = ", ".join(f"({t}, {_quoted(label)}, {n}, {r}, {at}, {_quoted(run)})" for t, label, n, r, at, run in runs)
    phrases = len(licenses.PHRASES)
    return rf"""
WITH t(template, label, words, runs, tpos, run) AS (VALUES {values}), w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), g AS (
  SELECT doc_id, unnest(list_transform(range(len(ws) - 2), lambda i: {{'pos': i, 'run': array_to_string(ws[i+1:i+3], ' ')}}), recursive := true)
  FROM w WHERE len(ws) > 2
), d AS (
  SELECT doc_id, template, label, words, runs, pos - tpos AS diagonal, min(pos) AS lo, max(pos) AS hi, list(tpos) AS held
  FROM g JOIN t USING (run) GROUP BY ALL
), marked AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {band}, true)::INT AS fresh
  FROM d WHERE template >= {phrases}
), spanned AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked
), spans AS (
  SELECT doc_id, label, words, min(lo) AS lo, max(hi) + 3 AS hi, len(list_distinct(flatten(list(held)))) / runs AS score
  FROM spanned GROUP BY doc_id, template, label, words, runs, span
), found AS (
  SELECT doc_id, label, diagonal, 1.0::DOUBLE AS score, true AS base FROM d WHERE template < {phrases} AND len(held) = runs
  UNION ALL
  SELECT doc_id, label, lo, score, false FROM spans WHERE score >= {cover} AND hi - lo <= {stretch} * words
), p AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(diagonal) FILTER (base) AS first_word, max(diagonal) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN p USING (doc_id)"""


SQL["op6_rarest_token"] = _url_sql()
SQL["op10_license_diagonals"] = _license_sql()

SQL["op4_snapshot_collapse"] = rf"""
WITH c AS (
  SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn) AS turns FROM conversations GROUP BY conv_id
), kept AS (
  SELECT * FROM c a WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.conv_id <> a.conv_id AND len(b.turns) >= len(a.turns) AND b.turns[1:len(a.turns)] = a.turns
      AND (len(b.turns) > len(a.turns) OR b.conv_id < a.conv_id))
), lines AS (
  SELECT conv_id, unnest(range(1, len(turns) + 1)) AS pos, unnest(turns) AS x FROM kept
)
SELECT conv_id, (pos - 1) // {chat.PART} AS part, count(*) AS n_turns,
  string_agg('{chat.START}' || replace(coalesce(x.r, 'unknown'), '<|im_', '<| im_') || chr(10)
    || replace(coalesce(x.t, ''), '<|im_', '<| im_') || '{chat.END}' || chr(10), '' ORDER BY pos) AS text
FROM lines GROUP BY ALL"""

SQL["op8_warc_salvage"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), f AS (
  SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""
