"""The queries that SQL can express, as SQL for DuckDB."""

from __future__ import annotations

from functools import reduce

from entigrid.llm.secret_scan import BASE, RULES

ORACLE: dict[str, str] = {}

# SHA-1 as bare base32: each five hexadecimal digits are four letters.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_LETTERS}', 1 + ((('0x' || substr(sha, {5 * i + 1}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)

ORACLE["op1_warc"] = f"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS sha FROM pages
), ranked AS (
  SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, max(page_id) OVER (PARTITION BY sha) AS first FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM ranked
"""


def _secrets() -> str:
    cuts, lists = [], []
    for rank, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        cuts.append(
            f"string_split_regex(t, '{pattern}') AS b{rank}, regexp_extract_all(t, '{pattern}', 0) AS m{rank}, "
            f"regexp_extract_all(t, '{pattern}', {rule.group}) AS g{rank}"
        )
        lists.append(
            f"""list_transform(list_filter(range(1, len(m{rank}) + 1), lambda i: length(g{rank}[i]) >= {rule.least}),
              lambda i: {{'start': coalesce(list_sum(list_transform(b{rank}[1:i], lambda x: length(x))), 0)::BIGINT
                       + coalesce(list_sum(list_transform(m{rank}[1:i - 1], lambda x: length(x))), 0)::BIGINT,
                    'rank': {rank}, 'size': length(m{rank}[i]), 'kind': '{rule.kind}'}})"""
        )
    written = "x.kind || ':' || x.start || ':' || (x.start + x.size)"
    base = ", ".join(f"'{k}'" for k in BASE)
    counts = ", ".join(f"len(list_filter(s, lambda x: x.kind = '{k}'))::BIGINT AS n_{k}" for k in BASE)
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT doc_id, {", ".join(cuts)} FROM texts),
    found AS (SELECT doc_id, list_sort({" || ".join(lists)}) AS s FROM cut)
    SELECT doc_id, {counts},
      sha256(coalesce(array_to_string(list_transform(list_filter(s, lambda x: x.kind IN ({base})), lambda x: {written}), ','), '')) AS base_sha256,
      coalesce(array_to_string(list_transform(s, lambda x: {written}), ','), '') AS spans
    FROM found
    """


ORACLE["op3_secrets"] = _secrets()


def _jaccard(k: int, more: str = "") -> str:
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k} + 2), lambda i: hash(array_to_string(w[i:i + {k} - 1], ' ')))
    WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b WHERE 100 * o.n >= 80 * (x.n + y.n - o.n)
), linked AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id{more}
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""


ORACLE["op7_ngram_jaccard"] = _jaccard(5)
ORACLE["op12_circulant"] = _jaccard(2, ", r.component_id = d.doc_id AS kept")

ORACLE["op10_decontaminate"] = r"""
WITH item_words AS (
  SELECT item_id::VARCHAR AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS size FROM item_words WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s FROM sized
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), runs AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s
  FROM doc_words CROSS JOIN (SELECT DISTINCT size FROM sized)
), hits AS (
  SELECT r.doc_id, r.i, r.size, x.item_id FROM runs r JOIN windows x ON x.s = r.s AND x.size = r.size
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes: one step of the reflected polynomial's table for each byte."""
    entries = [reduce(lambda c, _: c >> 1 ^ 0xEDB88320 * (c & 1), range(8), i) for i in range(256)]
    step = f"xor(c >> 8, ([{', '.join(map(str, entries))}]::BIGINT[])[(xor(c, b) & 255) + 1])"
    hexed = f"hex(encode({text}))"
    octets = f"list_transform(range(0, len({hexed}) // 2), lambda i: ('0x' || substr({hexed}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op11_spelling"] = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM counted
), typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), shorter AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word
), ranked AS (
  SELECT a AS word, b AS best, w.n AS best_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS rank
  FROM near JOIN words w ON w.word = b
), forms AS (
  SELECT w.word, CASE WHEN best_n >= 2 * w.n THEN best END AS form, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN (FROM ranked WHERE rank = 1) r ON r.word = w.word
), led AS (
  SELECT word, word AS root, 0 AS steps FROM words UNION ALL SELECT l.word, f.form, l.steps + 1 FROM led l JOIN forms f ON f.word = l.root AND f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM led GROUP BY word) USING (word)
"""

ORACLE["op13_prefix_trie"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS v FROM turns GROUP BY conv_id
), sized AS (
  SELECT *, ({_crc32("conv_id::VARCHAR")} % 4)::BIGINT AS h FROM own
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.v, [])[1:a.h], a.v[a.h + 1:]) AS s FROM sized a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
), members AS (
  SELECT conv_id, len(s) AS size, d AS depth, array_to_string(list_transform(s[1:d], lambda x: x.k), '') AS p, CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM members GROUP BY p, depth
), children AS (
  SELECT left(p, length(p) - 64) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), subtrees AS (
  SELECT a.p, sum((b.n_convs - 1) * b.w) AS saved, count(*) FILTER (c.p IS NULL) AS leaves
  FROM nodes a JOIN nodes b ON starts_with(b.p, a.p) LEFT JOIN children c ON c.p = b.p GROUP BY a.p
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
  s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.p = n.p LEFT JOIN children c ON c.p = n.p LEFT JOIN nodes u ON n.depth > 0 AND u.p = left(n.p, length(n.p) - 64)
"""
