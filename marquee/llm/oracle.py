"""SQL twins of the operators that SQL can express."""

_MIX = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
measured AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^ \t-\r]+')) AS size,
         greatest(0.05, CASE WHEN t = '' THEN 0.0 ELSE
           length(regexp_replace(t, '[^\p{L} \t-\r]+', '', 'g')) / length(t) END) AS w,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || t), 1, 13) AS BIGINT) AS bits
  FROM base),
keyed AS (SELECT *, -ln((bits + 0.5) / 4503599627370496.0) / w AS key FROM measured),
weighed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (sum(source_size) OVER () * 1.5::DOUBLE
            - (sum(2.0::DOUBLE * source_size) OVER o - 2.0::DOUBLE * source_size))
         / (sum(w) OVER () - (sum(w) OVER o - w)) AS level
  FROM weighed
  WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
goals AS (
  SELECT source, source_size,
         CASE WHEN level > cap / w THEN cap
              ELSE max(CASE WHEN NOT level > cap / w THEN level END) OVER () * w END AS target
  FROM levels),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM goals),
sums AS (
  SELECT source, key, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS after
  FROM keyed GROUP BY source, key)
SELECT k.doc_id, CAST(k.size AS BIGINT) AS size, r.source_size, CAST(r.target AS DOUBLE) AS target,
       CAST(k.size * (r.epochs + CASE WHEN 2 * s.after - s.words <= 2 * (r.target - r.epochs * r.source_size)
         AND r.target - r.epochs * r.source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM keyed k
JOIN rests r ON k.source IS NOT DISTINCT FROM r.source
JOIN sums s ON k.source IS NOT DISTINCT FROM s.source AND k.key = s.key
"""

_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
found AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
own AS (
  SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(o.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN own o USING (lang, source) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.lang_total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 50
"""

SQL = {"op2_source_mix": _MIX, "op12_source_divergence": _DIVERGENCE}
