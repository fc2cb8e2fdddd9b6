"""SQL twins of the registered queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

SQL_TWINS = {}

SQL_TWINS["op1_benchmark_decontamination"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM cut)
),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, s, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, lengths WHERE len(w) >= n)
),
found AS (SELECT r, s, n, item_id FROM places JOIN windows USING (n, win)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r
),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
"""


def _license_twin() -> str:
    from tillscope.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, run_length, template_words

    phrases = ", ".join(f"({i}, string_split('{p}', ' '), '{label}')" for i, (p, label) in enumerate(PHRASES))
    templates = ", ".join(f"({i}, {template_words(t)!r}, '{label}', {run_length(t, THRESHOLD)})" for i, (label, t) in enumerate(TEMPLATES))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS low, {_ALNUM} AS w FROM documents),
phrases(i, p, label) AS (VALUES {phrases}),
templates(i, t, label, span) AS (VALUES {templates}),
starts AS (SELECT r, w, unnest(range(0, len(w))) AS s FROM docs),
places AS (SELECT r, s, label FROM starts JOIN phrases ON w[s + 1] = p[1] AND list_slice(w, s + 1, s + len(p)) = p),
base AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word FROM places GROUP BY r),
lines AS (SELECT r, unnest(string_split(low, chr(10))) AS x FROM docs),
blocks AS (SELECT r, regexp_split_to_array(x, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS b FROM lines),
shares AS (
  SELECT r, label, len(list_intersect(list_distinct(b), t)) / len(t) AS share, len(list_intersect(list_distinct(b), t)) AS n, len(t) AS of
  FROM blocks, templates WHERE len(b) >= {THRESHOLD} * len(t)
),
near AS (
  SELECT r, i, w, t, span, label, unnest(range(0, len(w))) AS s FROM docs, templates
  WHERE len(list_intersect(list_distinct(w), t)) >= ceil({THRESHOLD} * len(t) - 1e-9)
),
runs AS (
  SELECT r, label, len(t) AS of, max(len(list_intersect(list_distinct(list_slice(w, s + 1, s + span)), t))) AS n
  FROM near GROUP BY r, i, label, t
),
met AS (
  SELECT r, label, share FROM shares WHERE n >= ceil({THRESHOLD} * of - 1e-9)
  UNION ALL SELECT r, label, n / of FROM runs WHERE n >= ceil({THRESHOLD} * of - 1e-9)
),
top AS (SELECT r, max(share) AS share FROM met GROUP BY r),
b AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM places) GROUP BY r),
l AS (
  SELECT r, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM places UNION SELECT r, label FROM met) GROUP BY r
)
SELECT doc_id, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN top USING (r) LEFT JOIN b USING (r) LEFT JOIN l USING (r)
"""


SQL_TWINS["op2_license_scan"] = _license_twin()


def _sharding_twin() -> str:
    from tillscope.llm.sharding import BITS, LIMIT, ROW

    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) + {ROW} AS n_bytes,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, {BITS // 4}))::BIGINT AS h
  FROM documents
),
levels AS (SELECT r, h, n_bytes, d, h >> ({BITS} - d) AS p FROM docs, range(0, {BITS} + 1) AS x(d)),
nodes AS (
  SELECT d, p, sum(n_bytes) > {LIMIT} AND min(h) < max(h) AS open, sum(n_bytes) <= {LIMIT} AS whole
  FROM levels GROUP BY d, p
),
leaves AS (
  SELECT n.d, n.p, n.whole FROM nodes n LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p >> 1
  WHERE NOT n.open AND (n.d = 0 OR up.open)
),
placed AS (
  SELECT doc_id, l.n_bytes, d, whole, right(lpad(bin(p), {BITS}, '0'), CAST(d AS INTEGER)) AS bits,
    row_number() OVER (PARTITION BY h ORDER BY r) - 1 AS k
  FROM levels l JOIN leaves USING (d, p) JOIN docs USING (r, h)
)
SELECT doc_id, CAST(d AS INTEGER) AS depth, n_bytes,
  bits || CASE WHEN whole THEN '' ELSE '-' || CAST(k // greatest(1, {LIMIT} // n_bytes) AS VARCHAR) END AS shard
FROM placed
"""


SQL_TWINS["op10_extendible_sharding"] = _sharding_twin()


def _quality_twin() -> str:
    from tillscope.llm import quality as q

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    listed = lambda xs: "[" + ", ".join(map(quoted, xs)) + "]"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    found = ", ".join(f"length(t) - length(translate(t, {quoted(c)}, ''))" for c in q.CLASSES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT r, doc_id, lang, t, length(translate(t, {space}, '')) AS word_chars,
    list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: length(translate(x, {space}, '')) > 0) AS lines
  FROM docs
),
counted AS (
  SELECT r, doc_id, lang, w, len(w) AS n_words, word_chars, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    [{found}, length(t) - word_chars, strlen(t) - length(t)] AS known, strlen(t) AS n_bytes
  FROM cut
),
places AS (SELECT r, w, unnest(range(1, n_words - 1)) AS i FROM counted WHERE n_words >= 3),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM places),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) AS s(k) WHERE n > 1 GROUP BY r
),
words AS (SELECT r, unnest(w) AS word FROM counted),
tally AS (SELECT r, word, count(*) AS n FROM words WHERE word IN {tuple(q.BINS)!r} GROUP BY r, word),
bins AS (SELECT generate_subscripts({listed(q.BINS)}, 1) AS i, unnest({listed(q.BINS)}) AS word),
common AS (
  SELECT r, i, coalesce(n, 0) AS c FROM counted CROSS JOIN bins LEFT JOIN tally USING (r, word)
  UNION ALL
  SELECT r, {len(q.BINS) + 1}, n_words - coalesce((SELECT sum(n) FROM tally WHERE tally.r = counted.r), 0) FROM counted
),
classes AS (
  SELECT r, generate_subscripts(known, 1) AS i, unnest(known) AS c FROM counted
  UNION ALL SELECT r, {q.N_CLASSES}, n_bytes - list_sum(known) FROM counted
),
histograms AS (SELECT 'c' AS kind, r, i, c FROM classes UNION ALL SELECT 'w', r, i, c FROM common),
shares AS (SELECT kind, r, i, c, sum(c) OVER (PARTITION BY kind, r) AS total FROM histograms),
sums AS (
  SELECT kind, lang, i, sum(floor(c * {q.UNIT}::DOUBLE / total)) AS v
  FROM shares JOIN counted USING (r)
  WHERE lang IN {tuple(q.COMMON_WORDS)!r} AND n_words >= {q.LEAST_FOR_WORDS} GROUP BY kind, lang, i
),
refs AS (SELECT kind, lang, i, v / sum(v) OVER (PARTITION BY kind, lang) AS q FROM sums),
terms AS (
  SELECT kind, r, lang, c / total AS p, q, (c / total + q) / 2 AS m
  FROM shares JOIN refs USING (kind, i) WHERE total > 0
),
distances AS (
  SELECT kind, r, lang, sqrt(greatest(0, sum(
    CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END) / 2)) AS d
  FROM terms GROUP BY kind, r, lang
),
nearest AS (
  SELECT r, min(d) FILTER (kind = 'c') AS class_distance, min(d) FILTER (kind = 'w') AS word_distance FROM distances GROUP BY r
),
measured AS (
  SELECT doc_id, lang, n_words, word_chars, known[{len(q.CLASSES)}] AS n_symbols, n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    class_distance, word_distance,
    n_words < {q.LEAST_WORDS} OR 100 * coalesce(n, 0) > {q.MOST_REPEATED} * n_words AS base_failed
  FROM counted LEFT JOIN repeated USING (r) LEFT JOIN nearest USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance, base_failed,
  NOT base_failed AND NOT (
    coalesce(lang IN (SELECT lang FROM refs), false) AND (
      coalesce(n_words >= {q.LEAST_FOR_CLASSES} AND class_distance > {q.MOST_BY_CLASS}, false)
      OR coalesce(n_words >= {q.LEAST_FOR_WORDS} AND (word_distance > {q.MOST_BY_WORD}
        OR class_distance + word_distance > {q.MOST_BY_BOTH}), false))) AS kept
FROM measured
"""


SQL_TWINS["op5_quality_rules"] = _quality_twin()

SQL_TWINS["op11_filter_interactions"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
marked AS (
  SELECT d.*, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM docs d LEFT JOIN (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
  ) m USING (doc_id)
),
failed AS (
  SELECT part, good, toxic, list_filter([
    CASE WHEN len(w) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN e THEN 'E' END
  ], lambda x: x IS NOT NULL) AS fails FROM marked
),
sizes AS (SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
placed AS (SELECT o, step, o[step] AS own, o[1:step - 1] AS before FROM steps),
counts AS (
  SELECT part, o, step, own,
    sum(CASE WHEN NOT list_has_any(fails, list_append(before, own)) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, before) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN list_contains(fails, own) AND list_has_any(fails, before) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = [own] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN good AND list_contains(fails, own) AND NOT list_has_any(fails, before) THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN toxic AND list_contains(fails, own) AND NOT list_has_any(fails, before) THEN n ELSE 0 END) AS toxic_lost
  FROM sizes, placed GROUP BY ALL
)
SELECT part, array_to_string(o, '') AS filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counts
"""

SQL_TWINS["op12_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, row_number() OVER () AS r FROM pages
),
ranked AS (
  SELECT page_id, b, count(*) OVER (PARTITION BY b) AS n,
    row_number() OVER (PARTITION BY b ORDER BY page_id DESC NULLS LAST, r) AS k,
    max(page_id) OVER (PARTITION BY b) AS best
  FROM p
),
parts AS (
  SELECT *, [CAST('0x' || substr(sha1(b), g, 10) AS BIGINT) FOR g IN [1, 11, 21, 31]] AS five FROM ranked
)
SELECT page_id, octet_length(b) AS payload_bytes,
  array_to_string(flatten([
    [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INTEGER + 1, 1) FOR s IN [35, 30, 25, 20, 15, 10, 5, 0]]
    FOR v IN five]), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN best END AS refers_to
FROM parts
"""

SQL_TWINS["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM d),
found AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
mass AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(m.n, 0) + v.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 1)) // (v.n + v.v) AS q
  FROM groups g JOIN v USING (lang) JOIN kept k USING (lang)
    LEFT JOIN mass m ON m.lang = g.lang AND m.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM both_parts
) WHERE part = 'pair' OR rank <= 200
"""
