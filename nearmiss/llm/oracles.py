"""DuckDB SQL for the queries that SQL can express. The others hold trained models,
tokenizers, parsers or kernels over bytes, and are tested against brute force."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


def jaccard_join(width: int, percent: int) -> str:
    """Shingle sets, links and the smallest id reachable."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: {shingle})) END AS s
  FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b USING (t)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
heads AS (SELECT x, min(y) AS head FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(head, doc_id) AS component_id
FROM sets LEFT JOIN heads ON doc_id = x"""


def url_filter(rules, blocked) -> str:
    """Host and path, the longest fitting rule, and the block list where none fits."""
    parts = [(r, r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "", kind) for r, kind in rules]
    listed = [(b, b.partition("/")[0], "/" + b.partition("/")[2] if "/" in b else "") for b in blocked]
    fits = "(u.host = t.h OR ends_with(u.host, '.' || t.h)) AND starts_with(u.path, t.p)"
    return f"""WITH urls AS (
  SELECT row_number() OVER () AS k, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM urls),
rules(rule, h, p, kind) AS (VALUES {_values(parts)}),
listed(entry, h, p) AS (VALUES {_values(listed)}),
best AS (
  SELECT k, arg_max(rule, (length(rule), length(h))) AS rule, arg_max(kind, (length(rule), length(h))) AS kind
  FROM u JOIN rules t ON {fits} GROUP BY k),
found AS (SELECT k, arg_max(entry, length(entry)) AS listed FROM u JOIN listed t ON {fits} GROUP BY k)
SELECT page_id, host, path, rule,
  coalesce(kind, CASE WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM u LEFT JOIN best USING (k) LEFT JOIN found USING (k)"""


def neighbours(k: int, every: int) -> str:
    """All distances of each query, and the k smallest."""
    return f"""WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
    AND list_bool_or(list_transform(embedding, lambda c: c <> 0))),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])))) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= {k}"""


def importance_resampling(percent: int, least_words: int, buckets: int, seed: int) -> str:
    """Bucket gains of single words, document weights, noise and the draw."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{word}')"
    return f"""WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {words} AS w FROM documents),
d AS (SELECT k, unnest(w) AS w FROM docs),
b AS (SELECT unnest({words}) AS w FROM benchmark),
crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
vocabulary AS (SELECT w FROM d UNION SELECT w FROM b),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(w) + 1),
    lambda i: CAST('0x' || substr(hex(w), 2 * i - 1, 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % {buckets} AS bucket
  FROM vocabulary, crc_table),
raw AS (SELECT bucket, count(*) AS s FROM d JOIN hashed USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM d) AS s_all, (SELECT count(*) FROM b) AS t_all),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + {buckets}.0::DOUBLE)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * (t_all + {buckets}.0::DOUBLE)))) AS BIGINT) AS gain
  FROM range({buckets}) r(bucket) LEFT JOIN raw USING (bucket) LEFT JOIN target USING (bucket), totals),
sums AS (
  SELECT k, CAST(count(*) AS BIGINT) AS n, CAST(sum(gain) AS BIGINT) AS g
  FROM d JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY k),
weights AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(len(w) AS BIGINT) AS n_words,
    coalesce((g - ((g % n + n) % n)) // n, 0) AS weight,
    CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN sums USING (k)),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weights),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {least_words} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= {least_words}) OVER () AS n_able
  FROM scored)
SELECT doc_id, n_features, n_words, weight, score,
  CASE WHEN n_words >= {least_words} AND place <= {percent} * n_able // 100 THEN place END AS rank
FROM placed"""


def chat_format(template, added) -> str:
    """Digests of the turns and of the learnt texts, and the length that the template makes."""
    controls = "|".join("".join(f"\\{c}" if not c.isalnum() else c for c in mark) for mark in template.marks)
    grown = lambda c: f"length({c}) + len(regexp_extract_all({c}, '\\\\|{controls}'))"
    frame = len(template.open) + len(template.mid) + len(template.close)
    learnt = ", ".join(f"'{r}'" for r in template.learnt)
    extra = ", ".join(f"(-1, {k}, '{m['role']}', '{m['content']}')" for k, m in enumerate(added))
    return f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {extra}) t(conv_id, turn, role, text))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role IN ({learnt}) THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role IN ({learnt}) THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum({frame} + {grown('role')} + {grown('text')}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def source_divergence(least_docs: int, top: int) -> str:
    """Smoothed shares of kept terms by source and by language, in whole numbers."""
    share = "1 + (1000000000 * (CAST({n} AS HUGEINT) + 1)) // (total + n_terms)"
    excess = "CAST(sum((p - q) * (p - q) // q) AS BIGINT)"
    return f"""WITH docs AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
terms AS (SELECT k, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT k) >= {least_docs}),
n_kept AS (SELECT lang, count(*) AS n_terms, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM counts GROUP BY lang, source),
groups AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(n_terms, 0) AS n_terms
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN totals USING (lang, source)
    LEFT JOIN (SELECT lang, n_terms FROM n_kept) USING (lang)),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, {share.format(n="coalesce(c.n, 0)")} AS p
  FROM groups g JOIN kept USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
of_lang AS (SELECT lang, term, {share.format(n="n")} AS q FROM kept JOIN n_kept USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, {excess} AS value
  FROM p a JOIN (SELECT lang, source, term, p AS q FROM p) b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
tops AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM p JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM tops))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}"""
