"""The same results in DuckDB SQL, for the operators that SQL can express."""

# CRC-32 by its byte table; features as words and pairs; doubles as stated.
RESAMPLE = """
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY c) AS t
  FROM (SELECT unnest(range(256)) AS c)),
rows AS MATERIALIZED (
  SELECT doc_id, true AS is_doc, row_number() OVER () AS r,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
  UNION ALL
  SELECT NULL, false, 0,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')
  FROM benchmark),
features AS MATERIALIZED (
  SELECT is_doc, r, f, count(*) AS n
  FROM (SELECT is_doc, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM rows)
  GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
bucketed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, tab),
counts AS (
  SELECT bucket, sum(n) FILTER (is_doc) AS s, sum(n) FILTER (NOT is_doc) AS t FROM features JOIN bucketed USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
  FROM counts, totals),
weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS g
  FROM features JOIN bucketed USING (f) JOIN gains USING (bucket) WHERE is_doc GROUP BY r),
scored AS (
  SELECT doc_id, r, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features IS NULL THEN 0 ELSE (g - ((g % n_features) + n_features) % n_features) // n_features END AS weight,
         (CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE + 0.5) / 4294967296.0 AS u
  FROM (SELECT doc_id, r FROM rows WHERE is_doc) LEFT JOIN weights USING (r)),
summed AS (
  SELECT doc_id, r, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) AS score, n_features >= 39 AS enough FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id ASC NULLS LAST, r) AS place,
         sum(CASE WHEN enough THEN 1 ELSE 0 END) OVER () AS n FROM summed)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN enough AND place <= 25 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM ranked
"""

# Every n-gram counted; scores in 128-bit integers.
COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
listed AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM listed
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM listed WHERE len(w) >= 2
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM listed WHERE len(w) >= 3
  UNION ALL
  SELECT lang, 4, unnest(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) FROM listed WHERE len(w) >= 4),
counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(w)) AS n FROM listed GROUP BY lang),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (
  SELECT lang, phrase, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) WHERE place = 1),
inside AS (
  SELECT lang, phrase, max(f) AS longer
  FROM (SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, f, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM (SELECT lang, f, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS m FROM counts WHERE size > 2)))
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM kept)
SELECT lang, CAST(place AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN totals USING (lang) WHERE place <= 2000
"""
