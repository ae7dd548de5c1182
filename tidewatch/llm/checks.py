"""Check SQL (DuckDB) of the corpus queries."""

from __future__ import annotations

from tidewatch.llm import collocations as P
from tidewatch.llm import derivatives as D
from tidewatch.llm import line_rules as L
from tidewatch.llm import mixing as M
from tidewatch.llm import redirects as R
from tidewatch.llm import sharding as S

_WORDS = r"[^ \t\n\x0B\f\r]+"


def q(pattern: str) -> str:
    """A pattern as an SQL text."""
    return "'" + pattern.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    """The four-digit escapes of a pattern as the characters themselves."""
    import re

    return re.sub(r"\\u([0-9a-f]{4})", lambda m: chr(int(m[1], 16)), pattern)


_STRIP = "translate({}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"
_SAID = " OR ".join(f"contains(low, '{p}')" for p in L.BOILERPLATE)
_LOUD = " + ".join(f"(length(l) - length(replace(l, '{m}', ''))) / {len(m)}" for m in L.LOUD)
#: separators but for closing quotes and the dot of l·l
_CUTS = f"""(length(l) - length(translate(l, {q(L.SEPARATORS)}, '')) - (length(low) - length(replace(low, 'l·l', ''))) / 3
  - least(length(l) - length(replace(l, '«', '')), length(l) - length(replace(l, '»', ''))))"""
_FAULT = f"""CASE WHEN n = 0 THEN NULL WHEN n <= {L.MAX_BOILERPLATE_WORDS} AND ({_SAID}) THEN 'boilerplate'
  WHEN regexp_matches(l, {q(_re2(L.NAVIGATION))}) OR ({_CUTS} >= {L.MIN_SEPARATORS} AND {_CUTS} >= {L.LIST_SHARE} * n)
    OR (n <= 3 AND NOT regexp_matches(l, {q(_re2(L.SENTENCE_END))})) THEN 'navigation'
  WHEN length(l) - length(translate(l, '{L.SYMBOLS}', '')) > {L.MAX_SYMBOLS} * length(l) OR {_LOUD} > {L.MAX_LOUD} * n THEN 'punctuation' END"""

#: rows of the line rules over a table expression with doc_id and text; documents are told apart by r
LINE_RULES_CTES = f"""
t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, regexp_extract_all(x, '{_WORDS}') AS ws FROM t),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
gg AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM gg WHERE c > 1) GROUP BY r),
ln AS (SELECT r, unnest(range(1, len(a) + 1)) AS k, unnest(a) AS l FROM (SELECT r, string_split(x, chr(10)) AS a FROM t)),
lf AS (SELECT r, k, l, {_FAULT} AS f FROM (SELECT *, translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
  len(regexp_extract_all(l, '{_WORDS}')) AS n FROM ln)),
la AS (SELECT r, count(*) FILTER (length({_STRIP.format("l")}) > 0) AS n_lines,
  count(DISTINCT l) FILTER (length({_STRIP.format("l")}) > 0) AS n_distinct,
  count(*) FILTER (f = 'boilerplate') AS n_boilerplate, count(*) FILTER (f = 'navigation') AS n_navigation,
  count(*) FILTER (f = 'punctuation') AS n_punctuation,
  coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (f IS NULL), '') AS clean FROM lf GROUP BY r),
m AS (SELECT t.r, doc_id, len(ws)::BIGINT AS n_words, length({_STRIP.format("x")})::BIGINT AS word_chars,
  (length(x) - length(translate(x, '{L.SYMBOLS}', '')))::BIGINT AS n_symbols, (n_lines - n_distinct)::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, n_lines, n_boilerplate, n_navigation, n_punctuation, clean,
  CASE WHEN length({_STRIP.format("x")}) > 0 THEN 1 - length({_STRIP.format("clean")}) / length({_STRIP.format("x")}) ELSE 0 END AS lost
  FROM t JOIN w USING (r) JOIN la USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < {L.MIN_WORDS} OR 100 * n_repeat_words > {L.MAX_REPEATED} * n_words AS base_failed FROM m)"""

LINE_RULES = f"""WITH {LINE_RULES_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost <= {L.MAX_LOST} AS kept, n_lines, sha256(clean) AS clean_sha256,
  n_boilerplate, n_navigation, n_punctuation FROM judged"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _window_texts(length: str) -> str:
    return f"array_to_string(ws[i:i + {length} - 1], ' ')"


WINNOWING = f"""WITH
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, ws, least(10, len(ws)) AS n
  FROM (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}') AS ws FROM benchmark) WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, n, {_window_texts("n")} AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
dw AS (SELECT r, i, n, {_window_texts("n")} AS g FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
hits AS (SELECT r, i, n, item FROM dw JOIN bw USING (n, g)),
nh AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
ni AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (r) LEFT JOIN ni USING (r)"""


#: The operator fills until nothing fits or little is open; the statement has a fixed number of rounds, more than these tables need.
_ROUNDS = 12


def _round(r: int) -> str:
    """A round of filling: documents behind the last cut that fit the rest, up to the cut that the rest allows."""
    return f"""p{r} AS (SELECT s.none, s.name, h, size, sum(size) OVER (PARTITION BY s.none, s.name ORDER BY h) AS run
  FROM s JOIN k{r - 1} k USING (none, name) WHERE k.room >= 1 AND k.room >= {M.NEAR} * k.target AND h > k.cut AND size > 0 AND size <= k.room),
c{r} AS (SELECT none, name, max(h) AS cut, max(run) AS run FROM p{r} JOIN k{r - 1} k USING (none, name) WHERE run <= k.room GROUP BY ALL),
k{r} AS (SELECT none, name, source_size, target, epochs, k.cut AS cut0, k.room AS room0, coalesce(greatest(c.cut, k.cut), k.cut) AS cut,
  k.room - coalesce(c.run, 0) AS room FROM k{r - 1} k LEFT JOIN c{r} c USING (none, name))"""


MIXING_CTES = f"""s AS (SELECT row_number() OVER () AS r, doc_id, source IS NULL AS none, coalesce(source, '') AS name,
  len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size,
  ('0x' || substr(md5('{M.SEED}' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
z AS (SELECT none, name, sum(size)::BIGINT AS source_size FROM s GROUP BY ALL),
w AS (SELECT *, [{", ".join(map(str, M.WEIGHTS))}][(row_number() OVER (ORDER BY none, name) - 1) % {len(M.WEIGHTS)} + 1] AS weight, {M.MAX_EPOCHS} * source_size AS cap FROM z),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, none, name) AS place FROM w),
l AS (SELECT a.place, a.weight, a.cap, ((SELECT sum(source_size) FROM z) - coalesce((SELECT sum(cap) FROM o b WHERE b.place < a.place), 0))::DOUBLE
  / (SELECT sum(weight) FROM o b WHERE b.place >= a.place) AS level FROM o a),
v AS (SELECT coalesce((SELECT level FROM l WHERE level * weight <= cap ORDER BY place LIMIT 1), 0) AS level),
t AS (SELECT none, name, source_size, least(cap::DOUBLE, level * weight) AS target FROM o, v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least({M.MAX_EPOCHS}, floor((target + 0.5) / source_size))::BIGINT ELSE 0 END AS epochs FROM t),
k0 AS (SELECT *, (-1)::BIGINT AS cut, CASE WHEN epochs < {M.MAX_EPOCHS} THEN greatest(0, target - epochs * source_size) ELSE 0 END AS room FROM e),
{", ".join(_round(r) for r in range(1, _ROUNDS + 1))},
again AS ({" UNION ALL ".join(f"SELECT s.r FROM s JOIN k{r} k USING (none, name) WHERE k.room0 >= 1 AND s.h > k.cut0 AND s.h <= k.cut AND s.size <= k.room0" for r in range(1, _ROUNDS + 1))}),
spare AS (SELECT none, name, h, sum(size) AS size, max(room) AS room FROM s JOIN k{_ROUNDS} k USING (none, name)
  WHERE room > 0 AND size > 0 AND r NOT IN (SELECT r FROM again) GROUP BY ALL HAVING sum(size) < 2 * max(room)),
over AS (SELECT none, name, arg_min(h, (abs(size - room), size, h)) AS h FROM spare GROUP BY ALL),
mixed AS (SELECT s.r, doc_id, size, source_size, target, epochs + (s.r IN (SELECT r FROM again) OR over.h IS NOT NULL)::BIGINT AS copies
  FROM s JOIN e USING (none, name) LEFT JOIN over ON over.none = s.none AND over.name = s.name AND over.h = s.h)"""
MIXING = f"WITH {MIXING_CTES} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"

SHARDING_CTES = """sk AS (SELECT doc_id, text, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
sd AS (SELECT d::INTEGER AS depth, h >> (60 - d) AS prefix, sum(n_bytes)::BIGINT AS bytes, min(h) = max(h) AS alone
  FROM sk, (SELECT unnest(range(0, 41)) AS d) GROUP BY ALL),
leaf AS (SELECT * FROM sd a WHERE (bytes <= {limit} OR alone) AND (depth = 0
  OR EXISTS (SELECT 1 FROM sd b WHERE b.depth = a.depth - 1 AND b.prefix = a.prefix >> 1 AND b.bytes > {limit} AND NOT b.alone)))"""
_BITS = "CASE WHEN depth = 0 THEN 's' ELSE 's' || lpad(bin(prefix), depth, '0') END"
SHARDING = f"""WITH {SHARDING_CTES.format(limit=S.LIMIT_BYTES)}
SELECT doc_id, {_BITS} AS shard, depth, n_bytes, bytes AS shard_bytes FROM sk JOIN leaf ON sk.h >> (60 - depth) = prefix"""


def _fit(rule: str) -> str:
    name, _, tail = rule.partition("/")
    return f"((host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{tail}'))"


#: The tables hold no canonical link, refresh or redirect, so here only rules decide; tests cover the aliases.
URL_RULES = f"""WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {" ".join(f"WHEN {_fit(rule)} THEN '{rule}'" for _, rule in sorted(R.RULES, key=lambda x: (-len(x[1]), x[0])))} END AS rule FROM p)
SELECT page_id, host, path, rule, CASE {" ".join(f"WHEN rule = '{rule}' THEN '{v}'" for v, rule in R.RULES)} ELSE 'allow' END AS verdict FROM r"""


def _plain(x: str) -> str:
    text = f"regexp_replace({x}, {q(D._DROPPED)}, '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {q(D._BREAKS)}, chr(10), 'g'), '{D._TAGS}', '', 'g')"
    for entity, char in D._ENTITIES:
        text = f"replace({text}, '{entity}', {q(char)})"
    text = f"regexp_replace(regexp_replace({text}, '{D._BLANKS}', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"trim({text}, ' ' || chr(10))"


_CRLF = "chr(13) || chr(10)"
_URN = "'urn:uuid:' || regexp_replace(md5({}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def _head(name: str, value: str) -> str:
    return f"coalesce('{name}: ' || regexp_replace({value}, '[\\r\\n]+', ' ', 'g') || {_CRLF}, '')"


DERIVATIVES = f"""WITH r AS (SELECT page_id, coalesce(html, '') AS x, url AS target_uri, '1970-01-01T00:00:00Z' AS date,
  {_URN.format("'response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '')")} AS refers_to FROM pages),
s AS (SELECT *, 'sha256:' || sha256(x) AS payload_digest, 'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF}
  || 'Content-Length: ' || octet_length(encode(x)) || {_CRLF} AS source_headers FROM r),
b AS (SELECT *, {_plain("x")} AS t, replace({_plain("regexp_extract(x, '(?is)<title" + chr(92) + "b[^>]*>(.*?)</title" + chr(92) + "s*>', 1)")}, chr(10), ' ') AS title,
  regexp_extract(x, {q(r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([a-zA-Z-]+)""")}, 1) AS lang,
  len(regexp_extract_all(x, '(?i)<a\\b[^>]*\\bhref\\s*=')) AS links FROM s),
k AS (SELECT page_id, refers_to, target_uri, date, source_headers, payload_digest, 'conversion' AS record_type, 'text/plain' AS content_type, t AS block FROM b
  UNION ALL SELECT page_id, refers_to, target_uri, date, source_headers, payload_digest, 'metadata', 'application/warc-fields',
  {_head("title", "title")} || {_head("language", "lang")} || {_head("outlinks", "links::VARCHAR")} || {_head("payload-digest", "payload_digest")}
  || 'source-header: ' || replace(source_headers[:-3], {_CRLF}, {_CRLF} || 'source-header: ') || {_CRLF} FROM b),
d AS (SELECT *, {_URN.format("record_type || '|' || refers_to")} AS record_id, 'sha256:' || sha256(block) AS block_digest,
  octet_length(encode(block))::BIGINT AS content_length FROM k)
SELECT *, '{D.VERSION}' || {_CRLF} || {_head("WARC-Type", "record_type")} || {_head("WARC-Record-ID", "'<' || record_id || '>'")}
  || {_head("WARC-Refers-To", "'<' || refers_to || '>'")} || {_head("WARC-Refers-To-Target-URI", "target_uri")} || {_head("WARC-Refers-To-Date", "date")}
  || {_head("WARC-Target-URI", "target_uri")} || {_head("WARC-Date", "date")} || {_head("WARC-Block-Digest", "block_digest")}
  || {_head("Content-Type", "content_type")} || {_head("Content-Length", "content_length::VARCHAR")} AS warc_header FROM d"""


_PARTS = "[.,;:!?" + "".join(map(chr, (10, 11, 12, 13))) + "]"
COLLOCATIONS = f"""WITH p AS (SELECT coalesce(lang, '{P.NO_LANGUAGE}') AS lang, unnest(string_split_regex({_LOWER.format("text")}, '{_PARTS}')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {P.LONGEST + 1})) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {P.LEAST}),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS j FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.phrase, c.a, l.a AS l, r.a AS r, n, j, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM c JOIN n USING (lang) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[j + 1:], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
held AS (SELECT DISTINCT a.lang, a.phrase FROM low a JOIN low b ON a.lang = b.lang AND a.k < b.k AND b.a >= a.a
  AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM low ANTI JOIN held USING (lang, phrase) QUALIFY rank <= {P.TOP}"""
