"""DuckDB SQL of the operators that SQL can express; '...' words as in the Spark side."""

from __future__ import annotations

_OP1 = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
lines AS (
  SELECT doc_id, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines
  FROM (SELECT doc_id, list_filter(string_split(text, chr(10)),
                                   lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs)
),
positions AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM positions),
repeated AS (
  SELECT doc_id, i FROM
    (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS pos FROM repeated) GROUP BY doc_id
),
measured AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words,
         len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         n_dup_lines::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
),
judged AS (
  SELECT *,
    CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END AS bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, n_lines, bits::BIGINT AS fail_bits
FROM judged
"""

_OP6 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
    -- '<s>', the line end, '</s>', and one mark per doubled or inserted backslash
    8 + len(role) + len(text)
      + len(regexp_extract_all(role || chr(1) || text, '\\|</?s>|\[/?INST\]'))
      + 6 * len(regexp_extract_all(role, '\n')) AS chars
  FROM turns
),
numbered AS (
  SELECT *, row_number() OVER o AS seq, sum(tokens) OVER o - tokens AS start,
         sum(CASE WHEN tokens > 160 THEN 1 ELSE 0 END) OVER o AS long_no, tokens > 160 AS is_long
  FROM sized
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
),
marked AS (
  SELECT *, coalesce(max(CASE WHEN seq = 1 AND role = 'system' THEN tokens END) OVER c, 0) AS sys,
         coalesce(max(CASE WHEN seq = 1 AND role = 'system' THEN chars END) OVER c, 0) AS sys_chars
  FROM numbered WINDOW c AS (PARTITION BY conv_id)
),
celled AS (
  SELECT *, floor((start - min(start) OVER (PARTITION BY conv_id, long_no, is_long))
                  / greatest(1, 256 - sys)) AS cell
  FROM marked
),
opened AS (
  SELECT *, coalesce((long_no, is_long, cell) <>
    lag((long_no, is_long, cell)) OVER (PARTITION BY conv_id ORDER BY seq), true) AS opens
  FROM celled
),
repeated AS (
  SELECT o.conv_id, o.seq, sum(h.chars) AS chars
  FROM opened o JOIN opened h ON h.conv_id = o.conv_id AND h.seq < o.seq
    AND NOT (h.seq = 1 AND h.role = 'system')
    AND o.start - h.start <= least(96, 512 - o.sys - CASE WHEN o.is_long THEN o.tokens ELSE 0 END)
  WHERE o.opens GROUP BY o.conv_id, o.seq
)
SELECT o.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY o.seq)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY o.seq) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(o.chars + CASE WHEN opens AND o.seq > 1 THEN sys_chars ELSE 0 END
           + coalesce(r.chars, 0))::BIGINT AS formatted_chars,
       count(*) FILTER (opens) AS n_windows
FROM opened o LEFT JOIN repeated r ON r.conv_id = o.conv_id AND r.seq = o.seq
GROUP BY o.conv_id
"""

_OP9 = r"""
WITH named AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
sites AS (
  SELECT *, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*$', '') AS site FROM named
),
split AS (
  SELECT *, string_split(site, '.') AS l,
    array_to_string(list_slice(string_split(site, '.'), -2, -1), '.') AS last_two
  FROM sites
),
parts AS (
  SELECT *, CASE WHEN two THEN last_two ELSE l[-1] END AS suffix,
    CASE WHEN two THEN array_to_string(list_slice(l, -3, -1), '.') ELSE last_two END AS domain
  FROM (SELECT *, last_two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz')
        AS two FROM split)
),
hosts AS (
  SELECT site, any_value(domain) AS domain, any_value(suffix) AS suffix,
         count(quality) AS n, coalesce(sum(1 - quality), 0) AS k
  FROM parts LEFT JOIN labels ON doc_id = page_id GROUP BY site
),
share AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS m FROM hosts),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT m FROM share) AS mu
      FROM hosts WHERE n > 0 GROUP BY suffix),
sw AS (SELECT CASE WHEN c < 2 OR NOT p > 0 THEN 1 WHEN o <= 0 THEN 1000
            ELSE least(greatest(p / o - 1, 1), 1000) END AS w
       FROM (SELECT sum((k - n * mu) ** 2 - n * mu * (1 - mu)) AS o,
                    sum(n * (n - 1) * mu * (1 - mu)) AS p, count(*) AS c FROM s)),
sm AS (SELECT suffix, (k + w * mu) / (n + w) AS mean FROM s, sw),
d AS (SELECT domain, sum(n) AS n, sum(k) AS k, any_value(mean) AS mu
      FROM hosts JOIN sm USING (suffix) WHERE n > 0 GROUP BY domain),
dw AS (SELECT CASE WHEN c < 2 OR NOT p > 0 THEN 1 WHEN o <= 0 THEN 1000
            ELSE least(greatest(p / o - 1, 1), 1000) END AS w
       FROM (SELECT sum((k - n * mu) ** 2 - n * mu * (1 - mu)) AS o,
                    sum(n * (n - 1) * mu * (1 - mu)) AS p, count(*) AS c FROM d)),
dm AS (SELECT domain, (k + w * mu) / (n + w) AS mean FROM d, dw),
hw AS (SELECT CASE WHEN c < 2 OR NOT p > 0 THEN 1 WHEN o <= 0 THEN 1000
            ELSE least(greatest(p / o - 1, 1), 1000) END AS w
       FROM (SELECT sum((k - n * mean) ** 2 - n * mean * (1 - mean)) AS o,
                    sum(n * (n - 1) * mean * (1 - mean)) AS p, count(*) AS c
             FROM hosts JOIN dm USING (domain) WHERE n > 0)),
ab AS (
  SELECT site, n, k + w * mu AS a, n - k + w * (1 - mu) AS b
  FROM (SELECT site, n, k, coalesce(dm.mean, sm.mean, (SELECT m FROM share)) AS mu,
               CASE WHEN dm.mean IS NOT NULL THEN hw.w WHEN sm.mean IS NOT NULL THEN dw.w
                    ELSE sw.w END AS w
        FROM hosts LEFT JOIN dm USING (domain) LEFT JOIN sm USING (suffix), hw, dw, sw)
),
judged AS (
  SELECT site, n,
         round(a / (a + b) - 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))), 9) > 0.2 AS blocked
  FROM ab
),
rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
ruled AS (
  SELECT page_id, host, path, site, arg_max(rhost || rpath, len(rhost || rpath)) AS rule,
         arg_max(r.verdict, len(rhost || rpath)) AS verdict
  FROM sites LEFT JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost))
    AND starts_with(path, rpath)
  GROUP BY page_id, host, path, site
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict,
       n AS n_labelled
FROM ruled JOIN judged USING (site)
"""

# Dynamic programming, one step per bucket; of equal costs the last boundary, then fewer buckets.
_OP4_STEPS = ",\n".join(
    f"""dp{b} AS (
  SELECT j, m.cost AS cost, -m.minus_i AS i FROM (
    SELECT h.j, min({{'cost': p.cost + h.len * (h.c - p.c), 'minus_i': -p.j}}) AS m
    FROM hist h JOIN (SELECT d.j, d.cost, c FROM dp{b - 1} d JOIN sums USING (j)) p ON p.j < h.j
    GROUP BY h.j)
)"""
    for b in range(1, 13)
)

_OP4 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens
  FROM documents
),
pieces AS (
  SELECT doc_id, piece, piece * 8192 AS start, least(8192, tokens - piece * 8192) AS n_tokens
  FROM (SELECT doc_id, tokens, unnest(range(0, (tokens - 1) // 8192 + 1)) AS piece FROM sized)
),
hist AS (
  SELECT len, row_number() OVER (ORDER BY len) AS j, sum(n) OVER (ORDER BY len) AS c
  FROM (SELECT n_tokens AS len, count(*) AS n FROM pieces GROUP BY n_tokens)
),
sums AS (SELECT 0 AS j, 0 AS c UNION ALL SELECT j, c FROM hist),
dp0 AS (SELECT 0 AS j, 0 AS cost),
{_OP4_STEPS},
dp AS ({" UNION ALL ".join(f"SELECT {b} AS b, * FROM dp{b}" for b in range(1, 13))}),
best AS (
  SELECT b, j, i FROM dp WHERE j = (SELECT max(j) FROM hist) ORDER BY cost, b LIMIT 1
),
path AS (
  SELECT b, j, i FROM best
  UNION ALL
  SELECT dp.b, dp.j, dp.i FROM path JOIN dp ON dp.b = path.b - 1 AND dp.j = path.i
),
ends AS (
  SELECT (b - 1)::INTEGER AS bucket, len::BIGINT AS bucket_length,
         coalesce(lag(len) OVER (ORDER BY len), 0) AS below
  FROM path JOIN hist USING (j)
),
placed AS (
  SELECT doc_id, piece, start, n_tokens, bucket, bucket_length,
         row_number() OVER (PARTITION BY bucket ORDER BY doc_id, piece) - 1 AS place,
         greatest(1, 65536 // bucket_length) AS capacity
  FROM pieces JOIN ends ON n_tokens > below AND n_tokens <= bucket_length
)
SELECT doc_id, piece, start, n_tokens, bucket, bucket_length, place // capacity AS batch,
       place % capacity AS slot, bucket_length - n_tokens AS padding
FROM placed
"""

_OP12 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents
),
pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM pieces
),
words AS (SELECT lang, unnest(w) AS w1 FROM worded),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM words GROUP BY ALL),
places AS (SELECT lang, w, unnest(range(1, len(w))) AS i FROM worded WHERE len(w) > 1),
f2 AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM places GROUP BY ALL
  HAVING count(*) >= 10
),
f3 AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM places
  WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10
),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.w1, c.w2, NULL AS w3, c.f AS a, 1 AS k,
         x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.w1, c.w2, c.w3, c.f, 1, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.w1, c.w2, c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
  JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3
),
scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
),
lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3
  ) GROUP BY ALL
),
kept AS (
  SELECT s.* FROM lowest s
  LEFT JOIN inside i ON s.w3 IS NULL AND i.lang = s.lang AND i.w1 = s.w1 AND i.w2 = s.w2
  WHERE NOT coalesce(100 * i.f >= 50 * s.a, false)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

SQL = {
    "op1_quality_rules": _OP1,
    "op4_length_buckets": _OP4,
    "op6_chat_windows": _OP6,
    "op9_host_reputation": _OP9,
    "op12_phrase_index": _OP12,
}
