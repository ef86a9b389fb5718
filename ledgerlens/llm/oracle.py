"""DuckDB SQL for those queries of this package that SQL can express."""

from __future__ import annotations

from ledgerlens.llm import quality

ORACLE: dict[str, str] = {}

ORACLE["op10_mix_systematic"] = r"""
WITH sized AS (
  SELECT doc_id, source, source IS NULL AS no_source, coalesce(source, '') AS src,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size
  FROM documents
), sources AS (
  SELECT no_source, src, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY no_source, src) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY no_source, src
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5
      - coalesce(sum(source_size * 2.0) OVER (ORDER BY source_size * 2.0 / weight, no_source, src
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size * 2.0 / weight, no_source, src
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT no_source, src, source_size,
    CAST(least(source_size * 2.0, max(level) OVER () * weight) AS DOUBLE) AS target FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target,
    CAST(row_number() OVER (PARTITION BY no_source, src
      ORDER BY size, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3), doc_id NULLS FIRST) - 1 AS DOUBLE) AS place,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio,
    CAST(concat('0x', substr(md5('mix-1:' || src), 1, 8)) AS BIGINT) / 4294967296.0 AS start
  FROM sized JOIN targets USING (no_source, src)
), taken AS (
  SELECT *, CAST(floor((place + 1) * ratio + start) - floor(place * ratio + start) AS BIGINT) AS copies FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies * CAST(size AS BIGINT) AS taken, copies FROM taken
"""

ORACLE["op1_top_k_segments"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _quality_sql() -> str:
    languages = " UNION ALL ".join(
        f"SELECT '{name}' AS language, unnest(string_split('{words}', ' ')) AS word, "
        f"unnest(range(1, {len(words.split()) + 1})) AS bin"
        for name, words in quality.COMMON.items()
    )
    char_bins = ", ".join(
        f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))" for pattern in quality.CLASSES.values()
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), counted AS (
  SELECT r, doc_id, t, w, len(w) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines
  FROM docs
), windows AS (
  SELECT r, pos, array_to_string(w[pos:pos + 7], ' ') AS words
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS pos FROM counted WHERE len(w) >= 8)
), repeated AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM (
    SELECT r, least(8, coalesce(lead(pos) OVER (PARTITION BY r ORDER BY pos) - pos, 8)) AS n
    FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, words) AS places FROM windows) WHERE places > 1) GROUP BY r
), common AS ({languages}
), hits AS (
  SELECT r, language, bin, count(*) AS c
  FROM (SELECT r, unnest(w) AS word FROM counted) JOIN common USING (word) GROUP BY r, language, bin
), spoken AS (
  SELECT r, arg_max(language, (n, -place)) AS language FROM (
    SELECT r, language, sum(c) AS n, row_number() OVER (PARTITION BY r ORDER BY language) AS place
    FROM hits GROUP BY r, language) GROUP BY r
), word_bins AS (
  SELECT r, language, bin, coalesce(c, 0) AS c
  FROM spoken JOIN (SELECT DISTINCT language, bin FROM common) USING (language) LEFT JOIN hits USING (r, language, bin)
  UNION ALL
  SELECT r, language, 0, n_words - coalesce((SELECT sum(c) FROM hits h WHERE h.r = s.r AND h.language = s.language), 0)
  FROM spoken s JOIN counted USING (r)
), char_lists AS (
  SELECT r, [{char_bins}, length(t) - word_chars] AS bins, length(t) AS n FROM counted
), char_bins AS (
  SELECT r, unnest(list_append(bins, n - list_sum(bins))) AS c, unnest(range(1, {len(quality.CLASSES) + 3})) AS bin
  FROM char_lists
), all_bins AS (
  SELECT 'word' AS kind, r, language, bin, CAST(c AS DOUBLE) AS c FROM word_bins
  UNION ALL SELECT 'char', r, language, bin, CAST(c AS DOUBLE) FROM char_bins LEFT JOIN spoken USING (r)
), refs AS (
  SELECT kind, language, bin, sum(c) AS c FROM all_bins JOIN counted USING (r)
  WHERE n_words >= {quality.MIN_WORDS} AND language IS NOT NULL GROUP BY kind, language, bin
), rates AS (
  SELECT kind, language, bin, c / sum(c) OVER (PARTITION BY kind, language) AS q FROM refs
), compared AS (
  SELECT b.kind, b.r, rates.language, b.c / sum(b.c) OVER (PARTITION BY b.kind, b.r, rates.language) AS p, q
  FROM all_bins b JOIN rates ON rates.kind = b.kind AND rates.bin = b.bin
    AND (rates.language = b.language OR b.language IS NULL AND b.kind = 'char')
  QUALIFY sum(b.c) OVER (PARTITION BY b.kind, b.r, rates.language) > 0
), distances AS (
  SELECT kind, r, language, sqrt(greatest(0, sum(
    (CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
     + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2))) AS d
  FROM compared GROUP BY kind, r, language
), nearest AS (
  SELECT kind, r, min(d) AS d FROM distances GROUP BY kind, r
), measured AS (
  SELECT counted.*, coalesce(n_repeat_words, 0) AS n_repeat_words, spoken.language, round(cd.d, 6) AS char_distance,
    round(CASE WHEN spoken.language IS NULL AND 2 * length(regexp_replace(t, '[^A-Za-z]', '', 'g')) < word_chars THEN NULL
      WHEN spoken.language IS NULL AND n_words > 0 THEN 1 ELSE wd.d END, 6) AS word_distance
  FROM counted LEFT JOIN repeated USING (r) LEFT JOIN spoken USING (r)
    LEFT JOIN nearest cd ON cd.r = counted.r AND cd.kind = 'char'
    LEFT JOIN nearest wd ON wd.r = counted.r AND wd.kind = 'word'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
    OR n_words >= {quality.MIN_WORDS} AND (coalesce(char_distance, 0) > {quality.MAX_CHAR_DISTANCE}
      OR coalesce(word_distance, 0) > {quality.MAX_WORD_DISTANCE})) AS kept,
  language, char_distance, word_distance
FROM measured
"""


ORACLE["op9_quality_divergence"] = _quality_sql()

ORACLE["op2_minhash_forest"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM texts
), members AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have, any_value(a.n + b.n) AS n
  FROM members a JOIN members b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY x, y
), links AS (
  SELECT x, y FROM pairs WHERE 100 * both_have >= 80 * (n - both_have)
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reached.x, hop.y FROM reached JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) hop ON hop.x = reached.y
), least AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

ORACLE["op11_phrase_summaries"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM texts)
), grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1
), inner_phrases AS (
  SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM candidates))
), covered AS (
  SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN covered v ON v.lang = c.lang AND v.phrase = c.phrase
  WHERE v.longer IS NULL OR 100 * v.longer < 80 * c.a
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLE["op13_splitter_skeleton"] = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(string_split(CAST(conv_id AS VARCHAR), ''), lambda acc, c: list_reduce(range(8),
      lambda b, k: xor(b >> 1, 3988292384 * (b & 1)), xor(acc, CAST(ascii(c) AS BIGINT))), CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, t.i, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL SELECT c.conv_id, t.i, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h
), placed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d FROM rebuilt
), reached AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS d, '' AS node, CAST(NULL AS VARCHAR) AS parent, CAST(0 AS BIGINT) AS words FROM convs
  UNION ALL
  SELECT r.conv_id, p.d, sha256(r.node || length(p.role) || ':' || p.role || p.text), r.node,
    CAST(len(list_filter(string_split_regex(p.text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT)
  FROM reached r JOIN placed p ON p.conv_id = r.conv_id AND p.d = r.d + 1
), sizes AS (
  SELECT conv_id, max(d) AS n FROM reached GROUP BY conv_id
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(r.d) AS depth, any_value(words) AS words, min(r.conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(r.conv_id AS VARCHAR), ',' ORDER BY r.conv_id) FILTER (s.n = r.d), '')) AS ends_sha256
  FROM reached r JOIN sizes s USING (conv_id) GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), up AS (
  SELECT node, node AS above FROM nodes UNION ALL SELECT up.node, n.parent FROM up JOIN nodes n ON n.node = up.above WHERE n.parent IS NOT NULL
), sums AS (
  SELECT above AS node, CAST(count(*) FILTER (c.n IS NULL) AS BIGINT) AS n_leaves, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
  FROM up JOIN nodes n USING (node) LEFT JOIN children c USING (node) GROUP BY above
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node
"""
