"""DuckDB SQL that computes the same results over the same tables.

Written from the operators' definitions, not their plans: windows are compared as
texts, all queue copies are ordered at once, and so on.
"""

from __future__ import annotations

from changeflow.llm import conversation_repair, decontaminate, fill_middle, licenses, line_dedup, mixing, quality, url_filter

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _re(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("'", "''") + "'"


def quality_rules(table: str = "documents") -> str:
    q = quality
    phrases = " OR ".join(f"contains(lower(line), {_re(p)})" for p in q.BOILERPLATE)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM {table}),
places AS (SELECT doc_id, i, array_to_string(w[i:i + {q.WINDOW - 1}], ' ') AS content
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM d)),
twice AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, content) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range({q.WINDOW}) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
figures AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    len(regexp_extract_all(line, {_re(q.SEPARATOR)})) AS seps FROM lines),
judged AS (SELECT doc_id, line,
    (n < {q.SHORT_LINE} AND NOT regexp_matches(line, {_re(q.CLOSING)}))
    OR 10 * len(regexp_extract_all(line, {_re(q.SYMBOLS)})) > length(line)
    OR (seps >= 3 AND 5 * seps >= n - seps) OR regexp_matches(lower(line), {_re(q.NAVIGATION)})
    OR (n < {4 * q.SHORT_LINE} AND ({phrases})) AS bad
  FROM figures),
per AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(length(line)) AS chars,
    coalesce(sum(length(line)) FILTER (NOT bad), 0) AS good FROM judged GROUP BY doc_id),
base AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, {_re(q.SYMBOLS)}))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(chars, 0)::BIGINT AS line_chars,
    coalesce(good, 0)::BIGINT AS good_line_chars
  FROM d LEFT JOIN per USING (doc_id) LEFT JOIN repeated USING (doc_id)),
verdict AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM base)
SELECT verdict.*, NOT base_failed AND 100 * (line_chars - good_line_chars) <= {q.MAX_LOST_PERCENT} * line_chars AS kept,
    len(string_split(coalesce(text, ''), chr(10)))::BIGINT - len(clean_lines)::BIGINT AS n_removed_lines,
    CASE WHEN text IS NOT NULL THEN sha256(array_to_string(clean_lines, chr(10))) END AS clean_sha256
FROM verdict JOIN ({cleaned_texts(table)}) c USING (doc_id)"""


def cleaned_texts(table: str = "documents") -> str:
    """doc_id, text, and its lines without those that ``quality_rules`` takes for bad."""
    q = quality
    words, seps = r"len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))", f"len(regexp_extract_all(x, {_re(q.SEPARATOR)}))"
    phrases = " OR ".join(f"contains(lower(x), {_re(p)})" for p in q.BOILERPLATE)
    bad = (rf"regexp_matches(x, '[^\x20\x09-\x0D]') AND (({words} < {q.SHORT_LINE} AND NOT regexp_matches(x, {_re(q.CLOSING)}))"
           f" OR 10 * len(regexp_extract_all(x, {_re(q.SYMBOLS)})) > length(x)"
           f" OR ({seps} >= 3 AND 5 * {seps} >= {words} - {seps}) OR regexp_matches(lower(x), {_re(q.NAVIGATION)})"
           f" OR ({words} < {4 * q.SHORT_LINE} AND ({phrases})))")
    return f"""
SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: NOT ({bad})) AS clean_lines FROM {table}"""


def mix_sources(table: str = "documents", seed: int = 7) -> str:
    m = mixing
    weights = ", ".join(map(str, m.WEIGHTS))
    return rf"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('{seed}:' || doc_id) AS key FROM {table}),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, ([{weights}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(m.WEIGHTS)} + 1)::INT] AS w,
    {m.MAX_EPOCHS} * source_size AS cap FROM sizes),
levels AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
    / (sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM ranked),
water AS (SELECT arg_min(level, cap / w) AS level FROM levels WHERE level * w <= cap),
targets AS (SELECT source, source_size, least(water.level * w, cap::DOUBLE) AS target FROM ranked, water),
placed AS (SELECT s.*, t.source_size, t.target,
    (sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS served
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
items AS (SELECT *, (source_size * e + served)::DOUBLE / target AS finish
  FROM placed, range({m.MAX_EPOCHS}) AS r(e) WHERE size > 0 AND target > 0),
spent AS (SELECT *, sum(size) OVER (ORDER BY finish, source, e, key, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM items),
taken AS (SELECT doc_id, count(*) AS copies FROM spent WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT doc_id, source, size, source_size, target, coalesce(copies, 0)::INT AS copies,
  (coalesce(copies, 0) * size)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (doc_id)"""


def decontaminated(table: str = "documents", benchmark: str = "benchmark") -> str:
    """Windows as texts; proximity by every span of words around a term that a match can't do without."""
    n, d = decontaminate.WINDOW, decontaminate
    words = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS (SELECT doc_id, {words} AS w FROM {table}),
items AS (SELECT item_id, {words} AS w FROM {benchmark}),
windows AS (SELECT DISTINCT item_id, need, array_to_string(w[i:i + need - 1], ' ') AS content
  FROM (SELECT *, least({n}, len(w)) AS need, unnest(range(1, greatest(1, len(w) - {n} + 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, need, i, array_to_string(w[i:i + need - 1], ' ') AS content
  FROM (SELECT *, unnest(range(1, len(w) - need + 2)) AS i FROM d, (SELECT DISTINCT need FROM windows))),
hits AS (SELECT doc_id, item_id, need, i FROM places JOIN windows USING (need, content)),
words_hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, need, i, unnest(range(need)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM d),
counts AS (SELECT t, count(*) AS c FROM placed WHERE t IN (SELECT unnest(w) FROM items) GROUP BY t),
held AS (SELECT *, ceil({d.NEAR_SHARE} * len(held))::INT AS required, need + {d.NEAR_SLACK} AS span FROM
  (SELECT DISTINCT item_id, need, list_sort(list_distinct(w[i:i + need - 1])) AS held
    FROM (SELECT *, least({n}, len(w)) AS need, unnest(range(1, greatest(1, len(w) - {n} + 1) + 1)) AS i FROM items WHERE len(w) > 0))
  WHERE len(held) >= {d.NEAR_TERMS}),
needed AS (SELECT * FROM (SELECT *, unnest(held) AS t FROM held) LEFT JOIN counts USING (t)
  QUALIFY row_number() OVER (PARTITION BY item_id, held, need ORDER BY coalesce(c, 0), t) <= len(held) - required + 1),
asked AS (SELECT DISTINCT doc_id, item_id, held, required, span, i FROM needed JOIN placed USING (t)),
nears AS (SELECT doc_id, count(*) AS n_near, string_agg(id, ',' ORDER BY id) AS near_ids FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM asked JOIN d USING (doc_id)
    WHERE list_max(list_transform(range(greatest(1, i - span + 1), i + 1),
      lambda s: len(list_intersect(list_distinct(w[s:s + span - 1]), held)))) >= required
      AND (doc_id, item_id) NOT IN (SELECT (doc_id, item_id) FROM hits)) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0)::BIGINT AS n_near, sha256(coalesce(near_ids, '')) AS near_sha256
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN nears USING (doc_id)"""


def deduplicated_lines(table: str = "documents") -> str:
    t = line_dedup.MIN_WORDS
    blank = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH every AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM {table}),
numbered AS (SELECT doc_id, i - 1 AS line, trim(ls[i], {blank}) AS content
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM every)),
counted AS (SELECT *, len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS n FROM numbered WHERE content <> ''),
summed AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM counted),
placed AS (SELECT *, stop - n AS start FROM summed),
framed AS (SELECT *, list(content) OVER ahead AS xw, max(line) OVER ahead AS xb, max(stop) OVER ahead - start AS reach,
    list(content) OVER back AS yw, min(line) OVER back AS ya, stop - min(start) OVER back AS depth
  FROM placed WINDOW ahead AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {t - 1} FOLLOWING),
    back AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN {t - 1} PRECEDING AND CURRENT ROW)),
windows AS (SELECT doc_id, line AS a, xb AS b, xw AS w FROM framed WHERE reach >= {t}
  UNION ALL SELECT doc_id, ya, line, yw FROM framed WHERE depth >= {t}),
later AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS line FROM
  (SELECT *, min(row(doc_id, a)) OVER (PARTITION BY w) AS first FROM windows) WHERE row(doc_id, a) <> first),
gone AS (SELECT doc_id, list(line) AS gone FROM later GROUP BY doc_id)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN text ELSE array_to_string(
    [ls[i] FOR i IN range(1, len(ls) + 1) IF NOT list_contains(gone, i - 1)], chr(10)) END) AS kept_sha256
FROM every LEFT JOIN gone USING (doc_id)"""


def license_scan(table: str = "documents") -> str:
    """The operator's definition: comment leaders off, wordings made alike, rules as ordered identifiers whose places are
    found step by step, each at most the gap behind the one before."""
    m = licenses
    known = ", ".join(f"('{k}', '{p}')" for k, p in sorted({(k, m.plain(p)) for k, p in m.PIECES}))
    steps = ", ".join(f"('{r}', '{lic}', {k}, '{sid}', {len(ids)})"
                      for r, lic, ids in m.PIECE_RULES for k, sid in enumerate(ids))
    plus = f"regexp_replace(lower(x), {_re(m.PLUS)}, '\\1 or later ', 'g')"
    alike = f"regexp_replace(trim(regexp_replace({plus}, '[^a-z0-9]+', ' ', 'g')), {_re(m.GRANT)}, '\\1 under ')"
    owner = f"regexp_replace({alike}, {_re(m.OWNER)}, 'neither the name of the copyright holder nor the names of \\1 contributors may')"
    text = f"regexp_replace(coalesce(text, ''), {_re(m.LEADERS)}, '', 'g')"
    cut = lambda name, pattern: (
        f"SELECT doc_id, '{name}' AS cut, list_filter(list_transform(regexp_split_to_array({text}, {_re(pattern)}), "
        f"lambda x: {owner}), lambda x: x <> '') AS s FROM {table}")
    return rf"""
WITH RECURSIVE known(sid, sentence) AS (VALUES {known}),
steps(rule, license, step, sid, n) AS (VALUES {steps}),
cuts AS ({cut("sentence", m.SENTENCE_END)} UNION ALL {cut("line", m.LINE_END)}),
numbered AS (SELECT doc_id, cut, i AS pos, s[i] AS sentence FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM cuts)),
seen AS (SELECT DISTINCT doc_id, cut, pos, sid FROM numbered JOIN known USING (sentence)),
begun AS (
  SELECT doc_id, cut, rule, license, n, step, pos AS first, pos FROM seen JOIN steps USING (sid) WHERE step = 0
  UNION
  SELECT b.doc_id, b.cut, b.rule, b.license, b.n, t.step, b.first, s.pos FROM begun b
  JOIN steps t ON t.rule = b.rule AND t.step = b.step + 1
  JOIN seen s ON s.doc_id = b.doc_id AND s.cut = b.cut AND s.sid = t.sid AND s.pos > b.pos AND s.pos - b.pos <= {m.MAX_GAP + 1}),
found AS (SELECT doc_id, cut, rule, license, n, first, min(pos) AS last FROM begun WHERE step = n - 1
  GROUP BY doc_id, cut, rule, license, n, first),
best AS (SELECT * FROM found QUALIFY coalesce(max(last) OVER (PARTITION BY doc_id, cut ORDER BY first, last DESC, n DESC, rule
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < last, true)),
per AS (SELECT doc_id, list_sort(list(DISTINCT rule)) AS rules, list_sort(list(DISTINCT license)) AS licenses
  FROM best GROUP BY doc_id)
SELECT doc_id, coalesce(len(rules), 0)::BIGINT AS n_rules, coalesce(array_to_string(rules, ','), '') AS rules,
  coalesce(array_to_string(licenses, ','), '') AS licenses
FROM {table} LEFT JOIN per USING (doc_id)"""


def filtered_urls(table: str = "pages") -> str:
    """Links read from the pages, resolved and followed both ways from every node; then rule, alias and default."""
    u = url_filter
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in u.RULES)
    rest = "CASE WHEN contains({0}, '://') THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"
    host = low.format("regexp_extract({0}, '^[^/?#]*')")
    node = f"CASE WHEN {host} <> '' THEN {host} || regexp_extract({{0}}, '^[^/?#]*([^#]*)', 1) END"
    scheme = "'(?i)^[a-z][a-z0-9+.-]*:"
    fits = ("arg_max({0}, len(h || p)) FROM {1}, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)")
    return rf"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES {rules}),
tags AS (SELECT url, unnest(regexp_extract_all(html, {_re(u._LINK_TAG)})) AS tag FROM {table}),
links AS (SELECT url, regexp_replace(CASE WHEN regexp_matches(tag, {_re(u._CANONICAL)}) THEN regexp_extract(tag, {_re(u._HREF)}, 1)
    WHEN regexp_matches(tag, {_re(u._REFRESH)}) THEN regexp_extract(tag, {_re(u._REFRESH_URL)}, 1) ELSE '' END, '(?i)&amp;', '&', 'g') AS t FROM tags),
based AS (SELECT *, regexp_extract(url, '^(.*?)://', 1) AS scheme, {rest.format("url")} AS own FROM links WHERE t <> ''),
placed AS (SELECT *, scheme || '://' || regexp_extract(own, '^[^/?#]*') AS site, regexp_extract(own, '^[^/?#]*([^?#]*)', 1) AS path FROM based),
joined AS (SELECT own, CASE WHEN regexp_matches(t, {scheme}//') THEN t WHEN starts_with(t, '?') THEN site || path || t
    WHEN starts_with(t, '//') THEN scheme || ':' || t WHEN starts_with(t, '/') THEN site || t
    WHEN regexp_matches(t, {scheme}') OR starts_with(t, '#') THEN NULL
    ELSE site || coalesce(nullif(regexp_extract(path, '^(.*/)[^/]*$', 1), ''), '/') || t END AS full_url FROM placed),
cut AS (SELECT own, full_url, regexp_extract(full_url, '^([^:/?#]*://[^/?#]*)([^?#]*)(.*)$', 1) AS head,
    regexp_extract(full_url, '^([^:/?#]*://[^/?#]*)([^?#]*)(.*)$', 2) AS path,
    regexp_extract(full_url, '^([^:/?#]*://[^/?#]*)([^?#]*)(.*)$', 3) AS tail FROM joined WHERE full_url IS NOT NULL),
walked AS (SELECT *, string_split(path, '/') AS segs, list_reduce(list_transform(string_split(path, '/')[2:], lambda x: [x]),
    lambda kept, x: CASE x[1] WHEN '..' THEN kept[:greatest(len(kept) - 1, 0)] WHEN '.' THEN kept ELSE list_concat(kept, x) END,
    []::VARCHAR[]) AS kept FROM cut),
goals AS (SELECT own, CASE WHEN regexp_matches(path, '/\.\.?(/|$)') THEN head || '/' || array_to_string(kept, '/') ||
    CASE WHEN segs[-1] IN ('.', '..') AND len(kept) > 0 THEN '/' ELSE '' END || tail ELSE full_url END AS goal FROM walked),
sides AS (SELECT {node.format("own")} AS u, {node.format("(" + rest.format("goal") + ")")} AS v FROM goals),
edges AS (SELECT u, v FROM sides WHERE u <> v UNION SELECT v, u FROM sides WHERE u <> v),
reach AS (SELECT DISTINCT u AS a, u AS b FROM edges UNION SELECT a, v FROM reach JOIN edges ON b = u),
named AS (SELECT DISTINCT b AS node, {host.format("b")} AS host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
owned AS (SELECT node, (SELECT {fits.format("verdict", "(SELECT n.host, n.path) x")}) AS own FROM named n),
aliases AS (SELECT a AS node, CASE WHEN bool_or(own = 'allow') THEN 'allow' WHEN bool_or(own = 'block') THEN 'block' END AS alias_verdict
  FROM reach JOIN owned ON owned.node = b GROUP BY a),
parts AS (SELECT page_id, {host.format("rest")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, {node.format("rest")} AS node
  FROM (SELECT page_id, coalesce({rest.format("url")}, '') AS rest FROM {table})),
ruled AS (SELECT *, (SELECT {fits.format("h || p", "(SELECT q.host, q.path) x")}) AS rule,
    (SELECT {fits.format("verdict", "(SELECT q.host, q.path) x")}) AS own FROM parts q)
SELECT page_id, host, path, rule, coalesce(own, alias_verdict, '{u.DEFAULT}') AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN alias_verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS by
FROM ruled LEFT JOIN aliases USING (node)"""


def filled_middle(table: str = "documents", seed: int = 7, rate: int = 100, spm: int = 50) -> str:
    """Outputs built from the unit lists, and restored from them by one pattern each."""
    p, s, m = fill_middle.SENTINELS
    h = [f"cast('0x' || substr(h, {8 * k + 1}, 8) AS bigint) AS h{k + 1}" for k in range(4)]
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM {table}),
u AS (SELECT doc_id, t, {', '.join(h)}, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units FROM d),
n AS (SELECT *, len(units)::BIGINT AS n FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR h3 % 100 >= {rate} THEN 'plain'
         WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM n),
x AS (SELECT *, coalesce(array_to_string(list_filter(units, lambda y, i: i <= a), ''), '') AS pre,
    coalesce(array_to_string(list_filter(units, lambda y, i: i > a AND i <= b), ''), '') AS mid,
    coalesce(array_to_string(list_filter(units, lambda y, i: i > b), ''), '') AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid
    ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END AS output FROM x),
r AS (SELECT *, CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN regexp_replace(output, '(?s)^{p}(.*){s}(.*){m}(.*)$', '\1\3\2')
    ELSE regexp_replace(output, '(?s)^{s}(.*){p}(.*){m}(.*)$', '\2\3\1') END AS restored FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
    sha256(output) AS output_sha256, sha256(restored) AS restored_sha256
FROM r"""


def repaired_conversations(table: str = "conversations") -> str:
    """The edits as a walk over the turns by the role that came last, cheapest and least audit for each."""
    r = conversation_repair
    ops = ("flatten(list_transform(range(1, length(s) + 1), lambda i: list_concat([ascii(s[i])], [-1, -1, -1, -1, -1, -1, -1, -1])))")
    crc = (f"xor(list_reduce(list_concat([4294967295::BIGINT], {ops}), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)")
    i, k, d, t = r.INSERT, r.REROLE, r.DELETE, r.TRUNCATED
    return rf"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM {table}),
hashed AS (SELECT *, {crc} % 20 AS kind FROM named),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE kind <> 0),
numbered AS (SELECT *, role[1] AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    regexp_extract_all(text, '[^\x20\x09-\x0D]') AS chars FROM damaged),
seen AS (SELECT *, CASE WHEN len(chars) = 0 THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN chars[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM numbered),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM seen GROUP BY conv_id),
added(a, b, audit, cost) AS (VALUES ('-', '-', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0),
    ('-', 'u', 'I', {i}), ('s', 'u', 'I', {i}), ('a', 'u', 'I', {i}), ('u', 'a', 'I', {i}), ('-', 'a', 'II', {2 * i}), ('s', 'a', 'II', {2 * i})),
kept(a, b) AS (VALUES ('-', 's'), ('-', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, b AS last, cost::BIGINT AS cost, added.audit FROM (SELECT DISTINCT conv_id FROM seen), added WHERE a = '-'
  UNION ALL
  SELECT conv_id, i, last, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit FROM (
    SELECT m.conv_id, m.i, added.b AS last, m.cost + added.cost AS cost, m.audit || added.audit AS audit FROM (
      SELECT w.conv_id, s.i, w.last, w.cost + {d} AS cost, w.audit || 'D' AS audit
      FROM walk w JOIN seen s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1
      UNION ALL
      SELECT w.conv_id, s.i, k.b, w.cost + (s.initial <> k.b)::INT * {k} + (s.fault = 'truncated')::INT * {t},
          w.audit || CASE WHEN s.initial = k.b THEN 'K' ELSE 'R' END
      FROM walk w JOIN seen s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 JOIN kept k ON k.a = w.last
      WHERE s.fault IN ('none', 'truncated') AND (k.b <> 's' OR s.initial = 's')) m
    JOIN added ON added.a = m.last) GROUP BY conv_id, i, last),
best AS (SELECT w.conv_id, min(w.cost) AS cost, arg_min(w.audit, (w.cost, w.audit)) AS audit
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n WHERE w.last IN ('-', 'a') GROUP BY w.conv_id),
edits AS (SELECT conv_id, p, audit[p] AS edit, len(list_filter(string_split(audit[:p], ''), lambda y: y <> 'I')) AS i,
    len(list_filter(string_split(audit[:p], ''), lambda y: y <> 'D')) AS place,
    len(list_filter(string_split(audit, ''), lambda y: y <> 'D')) AS places
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM best)),
lines AS (SELECT e.conv_id, e.place, CASE WHEN edit = 'K' THEN s.role
      WHEN (place - 1 - places % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
      CASE WHEN edit = 'I' THEN '' ELSE s.text END AS line
  FROM edits e LEFT JOIN seen s ON s.conv_id IS NOT DISTINCT FROM e.conv_id AND s.i = e.i WHERE edit <> 'D'),
hashes AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY place)) AS h FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {table}) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM o.conv_id"""
