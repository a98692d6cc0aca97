"""DuckDB SQL for the queries that SQL can express, from the rules the operators compile."""

from __future__ import annotations

from lakevault.llm import quality_rules, url_filters, warc

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def _fails(rule: quality_rules.Rule) -> str:
    per = rule.per or "1"
    out = []
    if rule.low is not None:
        out.append(f"{rule.measure} < CAST({rule.low} AS DOUBLE) * {per}")
    if rule.high is not None:
        out.append(f"{rule.measure} > CAST({rule.high} AS DOUBLE) * {per}")
    return f"(n_words >= {rule.from_words} AND ({' OR '.join(out)}))"


def quality(source: str = "documents") -> str:
    """Rows of ``source`` with every measure, base_failed and kept."""
    stop = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    base = " OR ".join(map(_fails, quality_rules.BASE))
    table = " OR ".join(map(_fails, quality_rules.TABLE))
    return rf"""
WITH src AS (
  SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS t FROM {source}),
tok AS (
  SELECT *, {_WORDS} AS w,
    list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls
  FROM src),
win AS (
  SELECT rid, i, w[i:i + 4] AS five FROM (
    SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM tok)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS n FROM win)
  WHERE n > 1),
cover AS (
  SELECT rid, sum(least(5, coalesce(after - i, 5))) AS n FROM (
    SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after FROM twice)
  GROUP BY rid),
m AS (
  SELECT tok.* EXCLUDE (t, w, ls), CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS wc,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_extract_all(t, '!')) AS n_exclamations,
    len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
    len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(ls) AS n_lines
  FROM tok LEFT JOIN cover USING (rid)),
mm AS (SELECT * EXCLUDE (wc), coalesce(wc, 0) AS word_chars FROM m)
SELECT *, ({base}) AS base_failed, NOT ({base}) AND NOT ({table}) AS kept FROM mm"""


CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(replace(t, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'))
    + length(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'))
    + length('### ') + 1 + length('</turn>') + 1 AS chars
  FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t) AS told,
    coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '') AS loss,
    sum(chars) AS chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM g"""

URLS = rf"""
WITH p0 AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched,
    regexp_replace(regexp_extract(lower(url), '{url_filters.HOST}', 1), '\.+$', '') AS h,
    regexp_replace(url, '#.*$', '') AS address
  FROM pages),
p AS (SELECT * EXCLUDE (h), CASE WHEN length(h) BETWEEN 1 AND 253 THEN h END AS host FROM p0),
named AS (SELECT DISTINCT 'domain' AS kind, host AS value FROM p WHERE host IS NOT NULL),
above AS (
  SELECT DISTINCT kind, regexp_extract(value, '[^.]*(\.[^.]*)?$') AS value FROM named),
listed AS (
  SELECT *, CAST(('0x' || substr(md5(value), 1, 6)) AS BIGINT) AS d, 5 AS k FROM named
  UNION SELECT *, CAST(('0x' || substr(md5(value), 1, 6)) AS BIGINT), 3 FROM above
  UNION SELECT DISTINCT 'url', address, CAST(('0x' || substr(md5(address), 1, 6)) AS BIGINT), 40
  FROM p WHERE address IS NOT NULL),
chosen AS (SELECT DISTINCT kind, value, d FROM listed WHERE d % k = 0),
entries AS (
  SELECT kind, value, 'add' AS action, DATE '2024-01-01' + CAST(d % 300 AS INTEGER) AS day FROM chosen
  UNION ALL SELECT kind, value, 'remove', DATE '2024-01-01' + CAST(d % 300 + 60 AS INTEGER)
  FROM chosen WHERE d % 2 = 0 AND kind = 'domain'),
spans AS (
  SELECT * EXCLUDE (day), CAST(day AS DATE) AS from_day,
    lead(day) OVER (PARTITION BY kind, value ORDER BY day) AS to_day
  FROM entries),
hits AS (
  SELECT page_id, fetched, kind, value, from_day FROM p JOIN spans
    ON spans.action = 'add' AND from_day <= fetched AND (to_day IS NULL OR fetched < to_day)
    AND (kind = 'domain' AND (host = value OR ends_with(host, '.' || value))
      OR kind = 'url' AND address = value)),
best AS (
  SELECT page_id, count(*) AS n_active,
    max({{'n': length(value), 'value': value, 'day': from_day}}) FILTER (kind = 'domain') AS b
  FROM hits GROUP BY page_id)
SELECT page_id, fetched, host, n_active IS NOT NULL AS blocked, coalesce(n_active, 0) AS n_active,
  b.value AS domain, b.day AS since
FROM p LEFT JOIN best USING (page_id)"""

WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS size
  FROM pages),
q AS (SELECT *, CASE WHEN size >= {warc.LEAST_BYTES} THEN max(page_id) OVER (PARTITION BY h) END AS o
  FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN o <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN o <> page_id THEN o END AS refers_to
FROM q"""

_CRC = """
bits AS (
  SELECT range AS n, list_reduce(range(8), lambda a, i:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, CAST(range AS BIGINT)) AS c
  FROM range(256)),
crc AS (SELECT list(c ORDER BY n) AS steps FROM bits)"""


def _crc32(text: str) -> str:
    """Checksum of a text's bytes, beside the tables ``_CRC``."""
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), " \
             "lambda p: CAST(('0x' || p) AS BIGINT))"
    return (f"xor(list_reduce({bytes_}, lambda a, x: xor(a >> 8, steps[1 + (xor(a, x) & 255)]), "
            "4294967295), 4294967295)")


def _draw(child: str, weight: str) -> str:
    number = f"CAST(('0x' || substr(md5(k || '|' || {child}), 1, 13)) AS BIGINT)"
    return f"-ln(({number} + 0.5) / 4503599627370496.0) / {weight}"


SHARDS = f"""
WITH {_CRC.strip()},
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
    octet_length(encode(coalesce(text, ''))) + 8 AS size, {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc),
regions AS (SELECT 'r' || range AS name, 8.0 AS weight, true AS old FROM range(3)
  UNION ALL SELECT 'x24', 1.0, false),
region AS (
  SELECT rid, arg_min(name, {_draw("name", "weight")}) FILTER (old) AS r,
    arg_min(name, {_draw("name", "weight")}) AS grown
  FROM d, regions GROUP BY rid),
rack AS (
  SELECT rid, any_value(r) AS r, any_value(grown) AS grown,
    arg_min(r || '/k' || range, {_draw("r || '/k' || range", "4.0")}) AS rk
  FROM d JOIN region USING (rid), range(2) GROUP BY rid),
shard AS (
  SELECT rid, any_value(grown) AS grown, arg_min(s, {_draw("rk || '/s' || s", "1.0")}) AS s
  FROM (SELECT *, CAST(substr(r, 2) AS INT) * 8 + CAST(right(rk, 1) AS INT) * 4 + range AS s
    FROM d JOIN rack USING (rid), range(4)) GROUP BY rid)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
  CAST(s AS INT) AS shard, row_number() OVER (
    PARTITION BY s ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  CAST(CASE WHEN grown = 'x24' THEN 24 ELSE s END AS INT) AS grown_shard
FROM d JOIN shard USING (rid)"""

def _edit(state: str, cost: str, letter: str, turn: str = "''") -> str:
    """A state's (cost, audit, repaired text) after one more edit."""
    return (f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {turn}}}")


_LINE = "chr(10) || "
_PUT_USER, _PUT_ASSISTANT = _LINE + "'user:'", _LINE + "'assistant:'"
_NEVER = "{'c': 1000000, 'a': '', 't': ''}"
_OPEN = ("least(su, " + ", ".join(_edit(x, "2", "I", _PUT_USER) for x in ("s0", "ss", "sa")) + ")")
_CLOSED = "least(sa, " + _edit("pu", "2", "I", _PUT_ASSISTANT) + ")"


def _taken(letter: str, cost: str, role: str | None, when: str, *states: str) -> list[str]:
    """What a row that is kept or rerolled from these states makes, where it may be."""
    line = _LINE + (f"'{role}:' || text" if role else "role || ':' || text")
    return [f"CASE WHEN {when} THEN {_edit(x, f'{cost} + trunc::INT', letter, line)} ELSE {_NEVER} END"
            for x in states]


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STAYS = "NOT blank AND NOT dup"
_NEW_U = ", ".join([_edit("pu", "3", "D"),
                    *_taken("K", "0", None, f"{_STAYS} AND ini = 'u'", "s0", "ss", "pa"),
                    *_taken("R", "2", "user", _STAYS, "s0", "ss", "pa")])
_NEW_A = ", ".join([_edit("pa", "3", "D"), *_taken("K", "0", None, f"{_STAYS} AND ini = 'a'", "pu"),
                    *_taken("R", "2", "assistant", _STAYS, "pu")])
_NEW_S = ", ".join([_edit("ss", "3", "D"), *_taken("K", "0", None, f"{_STAYS} AND ini = 's'", "s0")])

REPAIR = f"""
WITH RECURSIVE {_CRC.strip()},
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}
      % 20 AS code
  FROM conversations, crc),
rows_ AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM src),
placed AS (
  SELECT *, trim(text, {_BLANKS}) AS body, left(role, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS i
  FROM rows_),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
f AS (
  SELECT *, body = '' AS blank, body <> '' AND again AS dup,
    body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS trunc,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM seen),
dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS s0, {_NEVER} AS ss,
    {_NEVER} AS su, {_NEVER} AS sa FROM conversations
  UNION ALL
  SELECT o.conv_id, f.i, {_edit("s0", "3", "D")}, least({_NEW_S}), least({_NEW_U}), least({_NEW_A})
  FROM (SELECT *, {_CLOSED} AS pa FROM (SELECT *, {_OPEN} AS pu FROM dp)) o
  JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.i = o.i + 1),
done AS (
  SELECT conv_id, least(s0, {_CLOSED}) AS best FROM (
    SELECT *, {_OPEN} AS pu FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
    count(*) FILTER (trunc) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT done.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
  sha256(substr(best.t, 2)) AS repaired_sha256
FROM done LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM done.conv_id"""

ORACLES: dict[str, str] = {
    "op2_chat_formatting": CHAT,
    "op3_url_filters": URLS,
    "op7_warc": WARC,
    "op11_sharding": SHARDS,
    "op13_conversation_repair": REPAIR,
    "op10_quality_rules":
        "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, "
        f"base_failed, kept FROM ({quality()})",
}
