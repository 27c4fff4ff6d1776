"""SQL twins of the queries that SQL can express."""

_GAP = r"[\x20\x09-\x0D]+"
_WORDS = "list_filter(string_split_regex({}, '" + _GAP + "'), lambda x: x <> '')"
_TERMS = (
    "list_filter(string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP1 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(r) + 1 + length(t)
      + len(regexp_extract_all(t, '<\\*\|')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(r, ',' ORDER BY turn, r, t),
                    '(system,)?user,assistant(,user,assistant)*') AS valid
FROM said GROUP BY conv_id
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT *, CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
    {_WORDS.format("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
tri AS (SELECT doc_id, s, list_slice(w, s, s + 2) AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS s FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, s FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM twice) GROUP BY doc_id),
ln AS (SELECT doc_id, host, unnest(lines) AS l FROM d),
norm AS (SELECT doc_id, host, len({_WORDS.format("l")}) AS n,
           regexp_replace(trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]+', '0', 'g') AS line
         FROM ln),
-- Distinct documents, copies included, against one limit for hosts of any size.
frequent AS (SELECT host, line FROM norm GROUP BY host, line HAVING count(DISTINCT doc_id) > 20),
lost AS (SELECT doc_id, sum(n)::BIGINT AS lost FROM norm JOIN frequent USING (host, line) GROUP BY doc_id),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.lost, 0)::BIGINT AS n_lost_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words <= 0.5 * n_words AS kept
FROM f
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, {_TERMS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_TERMS.format("coalesce(text, '')")} AS w FROM benchmark),
iw AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
            FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM iw)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
           FROM d, sizes WHERE len(w) >= n),
said AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g FROM places),
hits AS (SELECT doc_id, item_id, s, n FROM said JOIN windows USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_NEAREST = """
{name} AS (
  SELECT vec_id, label, part, x, min(d * 64 + e) AS m
  FROM (SELECT a.*, b.e, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts a JOIN {books} b USING (part))
  GROUP BY vec_id, label, part, x
)"""
_MEANS = """
{name} AS (
  SELECT part, e, coalesce(y, x) AS x
  FROM {books} LEFT JOIN (
    SELECT part, e, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY j) AS y
    FROM (SELECT part, m % 64 AS e, j, sum(x[j]) AS s, count(*) AS c
          FROM (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM {near}) GROUP BY ALL)
    GROUP BY part, e
  ) USING (part, e)
)"""

OP11 = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
parts AS (
  SELECT vec_id, label, part, list_slice(v, part * w + 1, part * w + w) AS x
  FROM (SELECT *, len(v) // 16 AS w, unnest(range(16)) AS part FROM kept)
),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
b0 AS (SELECT part, e, x FROM parts JOIN first USING (vec_id)),
{_NEAREST.format(name="a0", books="b0")},
{_MEANS.format(name="b1", books="b0", near="a0")},
{_NEAREST.format(name="a1", books="b1")},
{_MEANS.format(name="b2", books="b1", near="a1")},
{_NEAREST.format(name="a2", books="b2")},
coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(m % 64)), 2, '0'), '' ORDER BY part) AS code,
    sum(m // 64)::BIGINT AS error
  FROM a2 GROUP BY vec_id, label
),
flat AS (SELECT part, e, j, x[j] AS v FROM (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM b2)),
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, e, j)) AS codebooks_sha256 FROM flat)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, books
"""

ORACLE = {
    "op1_chat_formatting": OP1,
    "op2_warc": OP2,
    "op5_quality_rules": OP5,
    "op6_benchmark_decontamination": OP6,
    "op11_vector_codes": OP11,
}
