"""DuckDB SQL for the queries that SQL can express; macros are not used, so each stands alone."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) >= 2
      THEN list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
    ELSE words END AS shingles FROM w
),
sets AS MATERIALIZED (SELECT list_sort(shingles) AS k, min(doc_id) AS doc, len(any_value(shingles)) AS n FROM s WHERE len(shingles) > 0 GROUP BY 1),
one AS MATERIALIZED (SELECT doc, n, unnest(k) AS g FROM sets),
common AS MATERIALIZED (
  SELECT x.doc AS a, y.doc AS b, count(*) AS c, any_value(x.n) AS n, any_value(y.n) AS m
  FROM one x JOIN one y ON x.g = y.g AND x.doc < y.doc AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY 1, 2
),
link AS MATERIALIZED (
  SELECT a, b FROM common WHERE 100 * c >= 80 * (n + m - c) UNION SELECT b, a FROM common WHERE 100 * c >= 80 * (n + m - c)
),
reach AS (SELECT doc AS a, doc AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS doc, min(b) AS component FROM reach GROUP BY 1)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(c.component, s.doc_id) AS component_id,
  s.doc_id = coalesce(c.component, s.doc_id) AS kept
FROM s LEFT JOIN sets ON list_sort(s.shingles) = sets.k LEFT JOIN comp c ON c.doc = sets.doc
"""

# Holds for the pages of these tables, which have one `article` each and no markup inside it but h1, p, b and br.
OP2 = r"""
WITH p AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '<[^>]*$', '') AS body FROM pages
),
b AS (SELECT page_id, url, regexp_split_to_array(body, '</?(h1|p|br)>') AS parts FROM p),
t AS (
  SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(
    regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM b
)
SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), ' ') AS text,
  length(array_to_string(list_filter(parts, lambda x: x <> ''), ' '))::BIGINT AS n_chars FROM t
"""

OP6 = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
b AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM b WHERE len(w) > 0)
),
place AS MATERIALIZED (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
hit AS MATERIALIZED (SELECT doc_id, s, n, item_id FROM place JOIN win USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
win AS MATERIALIZED (
  SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM w WHERE len(words) >= 50)
),
source AS (SELECT h, min(doc_id) AS smallest FROM win GROUP BY h),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN source USING (h) WHERE smallest < doc_id),
gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(
    list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: NOT list_contains(ps, x[2])), lambda x: x[1]), ' ') END) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

OP7 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 1 + 5 * (j // 4)::INT, 5))::INT >> (15 - 5 * (j % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

OP9 = r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

OP10 = r"""
WITH RECURSIVE m AS MATERIALIZED (
  SELECT row_number() OVER () AS r, conv_id, turn, role, text, regexp_split_to_array(coalesce(text, ''), '\r?\n') AS lines FROM conversations
),
line AS MATERIALIZED (
  SELECT r, conv_id, turn, i, len(regexp_replace(regexp_extract(lines[i], '^([ \t]*>)+'), '[^>]', '', 'g')) AS level,
    regexp_replace(lines[i], '^([ \t]*>)+ ?', '') AS says
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM m)
),
run AS MATERIALIZED (
  SELECT *, sum(CASE WHEN level IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT *, lag(level) OVER (PARTITION BY r ORDER BY i) AS before FROM line)
),
said AS (
  SELECT conv_id, turn, level, string_agg(says, ' ' ORDER BY i) AS t FROM run GROUP BY r, conv_id, turn, level, g
  UNION ALL SELECT conv_id, turn, 0, string_agg(says, ' ' ORDER BY i) FROM run WHERE level = 0 GROUP BY r, conv_id, turn
  UNION ALL SELECT conv_id, turn, level, says FROM run
),
k AS MATERIALIZED (
  SELECT DISTINCT conv_id, turn, level, trim(regexp_replace(lower(t), '[^\p{L}\p{N}]+', ' ', 'g')) AS k FROM said WHERE turn IS NOT NULL
),
origin AS (
  SELECT q.conv_id, q.turn, q.level, q.k, max(o.turn) AS origin FROM k q JOIN k o
    ON q.level > 0 AND o.level = 0 AND q.k = o.k AND q.k <> '' AND q.conv_id IS NOT DISTINCT FROM o.conv_id AND o.turn < q.turn GROUP BY 1, 2, 3, 4
),
weight AS (SELECT conv_id, turn, level, origin, sum(length(k)) AS w FROM origin GROUP BY 1, 2, 3, 4),
link AS (SELECT conv_id, turn, origin AS reply_to FROM weight QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, w DESC, origin DESC) = 1),
t AS MATERIALIZED (
  SELECT d.conv_id, d.turn, reply_to FROM (SELECT DISTINCT conv_id, turn FROM m WHERE turn IS NOT NULL) d
  LEFT JOIN link l ON d.conv_id IS NOT DISTINCT FROM l.conv_id AND d.turn = l.turn
),
path AS (
  SELECT conv_id, turn, reply_to, [turn] AS path FROM t WHERE reply_to IS NULL
  UNION ALL SELECT t.conv_id, t.turn, t.reply_to, list_append(p.path, t.turn) FROM t JOIN path p
    ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.reply_to = p.turn
),
own AS (
  SELECT r, trim(coalesce(string_agg(CASE WHEN level = 0 THEN says END, chr(10) ORDER BY i), ''), ' ') AS own_text,
    count(DISTINCT CASE WHEN level > 0 THEN g END) AS n_quotes FROM run GROUP BY r
)
SELECT m.conv_id, m.turn, m.role, own_text, n_quotes, reply_to, coalesce(len(path) - 1, 0)::BIGINT AS depth,
  row_number() OVER (PARTITION BY m.conv_id ORDER BY coalesce(path, []), m.role NULLS FIRST, m.text NULLS FIRST) AS position,
  '<|' || coalesce(m.role, 'unknown') || '|>' || chr(10) || own_text AS formatted
FROM m JOIN own USING (r) LEFT JOIN path p ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.turn = p.turn
"""


OP11 = r"""
WITH p AS MATERIALIZED (
  SELECT doc_id, lang, j, regexp_extract_all(pieces[j], '[^\x20\x09]+') AS w FROM (
    SELECT doc_id, lang, pieces, unnest(range(1, len(pieces) + 1)) AS j FROM (
      SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents))
),
f AS MATERIALIZED (
  SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM p, (SELECT unnest(range(1, 5)) AS n) WHERE len(w) >= n) GROUP BY 1, 2, 3
),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE n = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, n, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE n >= 2 AND f >= 30),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, n)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.n = k AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.n = c.n - k AND y.phrase = array_to_string(w[k + 1:], ' ')
),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, n - m + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS m FROM c WHERE n > 2)) GROUP BY 1, 2
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, total.n, score::BIGINT AS score
FROM best LEFT JOIN inner_ USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR 100 * longer < 80 * a QUALIFY rank <= 2000
"""


def merkle_sql(group_levels: int = 6, top_levels: int = 4) -> str:
    """Both trees level by level; 16 to the power of the levels is more than any of these tables holds."""
    parts = [r"""
t AS MATERIALIZED (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
    lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) AS flipped FROM documents
),
f AS MATERIALIZED (
  SELECT doc_id, source, xor(flipped, 4294967295) % 5 = 0 AS tamper, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM t
),
l AS MATERIALIZED (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tamper THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered FROM f
),
a0 AS MATERIALIZED (
  SELECT *, leaf AS d, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l
)"""]

    def tree(name: str, key: str, levels: int) -> None:
        for k in range(levels):
            beside = "string_agg(d, '') OVER (PARTITION BY {key}, i // 16 ORDER BY i {order} ROWS BETWEEN {a} AND {b})"
            left = beside.format(key=key, order="", a="UNBOUNDED PRECEDING", b="1 PRECEDING")
            right = beside.format(key=key, order="", a="1 FOLLOWING", b="UNBOUNDED FOLLOWING")
            parts.append(f"{name}s{k} AS MATERIALIZED (SELECT {key}, i, coalesce({left}, '') AS l, coalesce({right}, '') AS r FROM {name}{k})")
            parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT {key}, i // 16 AS i, any_value(n) AS n, CASE WHEN any_value(n) > {16 ** k} "
                         f"THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d FROM {name}{k} GROUP BY {key}, i // 16)")

    tree("a", "source", group_levels)
    parts.append(f"b0 AS MATERIALIZED (SELECT 0 AS g, source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n "
                 f"FROM a{group_levels})")
    tree("b", "g", top_levels)
    step = "SELECT x.* REPLACE (CASE WHEN {n} > {size} THEN sha256(s.l || x.f || s.r) ELSE x.f END AS f, " \
           "CASE WHEN {n} > {size} THEN x.p || s.l || s.r ELSE x.p END AS p) FROM {last} x JOIN {sides} s ON {on}"
    parts.append("w0 AS (SELECT *, coalesce(tampered, leaf) AS f, '' AS p FROM a0)")
    for k in range(group_levels):
        on = f"x.source IS NOT DISTINCT FROM s.source AND x.i // {16 ** k} = s.i"
        parts.append(f"w{k + 1} AS (" + step.format(n="x.n", size=16 ** k, last=f"w{k}", sides=f"as{k}", on=on) + ")")
    parts.append(f"z0 AS (SELECT w.*, b0.d AS subroot, b0.i AS j, b0.n AS m FROM w{group_levels} w JOIN b0 ON w.source IS NOT DISTINCT FROM b0.source)")
    for k in range(top_levels):
        parts.append(f"z{k + 1} AS (" + step.format(n="x.m", size=16 ** k, last=f"z{k}", sides=f"bs{k}", on=f"x.j // {16 ** k} = s.i") + ")")
    return "WITH " + ",\n".join(parts) + (
        f"\nSELECT doc_id, leaf, subroot, r.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.d AS verified FROM z{top_levels}, b{top_levels} r")


OP12 = merkle_sql()


def oracle() -> dict[str, str]:
    return {"op1_minhash_near_dedup": OP1, "op2_html_main_text": OP2, "op6_decontamination": OP6, "op7_warc": OP7,
            "op8_substring_dedup": OP8, "op9_bit_sliced_top_k": OP9, "op10_quotation_linking": OP10,
            "op11_collocations": OP11, "op12_merkle_manifest": OP12}
