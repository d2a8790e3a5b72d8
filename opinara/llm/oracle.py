"""SQL twins of the queries, for DuckDB over the same tables."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH t AS (SELECT doc_id, {LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""

OP3 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('0:' || doc_id), 1, 13) AS BIGINT) AS draw
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source),
everything AS (SELECT CAST(sum(s) AS BIGINT) AS total FROM totals),
-- Sources by how soon they reach three times their size; the first of them are cut there.
ordered AS (
  SELECT *, coalesce(sum(3 * s) OVER before, 0) AS cut, sum(w) OVER rest AS left_w
  FROM totals
  WINDOW before AS (ORDER BY 3.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY 3.0 * s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT (total - cut) AS words, left_w FROM ordered, everything
  WHERE w * (total - cut) <= 3 * s * left_w ORDER BY cut LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN w * words > 3 * s * left_w THEN CAST(3 * s AS DOUBLE)
    ELSE CAST(w * words AS DOUBLE) / CAST(left_w AS DOUBLE) END AS target
  FROM totals, level),
queued AS (
  SELECT doc_id, z.source, size, s, target, CAST(round(target) AS BIGINT) AS words,
    coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY draw, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, p.pass * s + before AS start, p.pass AS pass FROM queued, (VALUES (0), (1), (2)) p(pass)),
due AS (
  SELECT *, greatest(least(size, words - start), 0) AS due,
    (start + size) / greatest(target, 1) AS finish FROM copies),
line AS (
  SELECT *, coalesce(sum(due) OVER (ORDER BY finish, source, doc_id, pass
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past FROM due)
SELECT doc_id, size, s AS source_size, target,
  CAST(sum(greatest(least(due, total - past), 0)) AS BIGINT) AS taken
FROM line, everything GROUP BY doc_id, size, s, target
"""


# Table of the CRC's eight steps for every byte, and the CRC of a text's UTF-8 bytes.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1
      THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))))"""


def _crc32(text: str) -> str:
    code = f"hex({text})"
    bytes_ = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr({code}, i * 2 + 1, 2) AS BIGINT))"
    step = "lambda c, x: xor(c >> 8, crcs[1 + (xor(c, x) & 255)])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), {step}), 4294967295)"


OP11 = f"""
WITH {CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
drawn AS (
  SELECT run, length(run) AS size, {_crc32("doc || ':' || run")} AS h FROM runs, crc_table WHERE length(run) >= 7),
damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % size) || substr(run, 2 + h % size) ELSE run END AS word FROM drawn),
words AS (
  SELECT word, count(*) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
places AS (
  SELECT word, n, unnest(range(length(word))) AS i FROM words),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS short FROM places),
near AS (
  SELECT x.word AS a, y.word AS b, y.n AS bn FROM cut x JOIN cut y ON x.short = y.short AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.short = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.short = y.word),
best AS (
  SELECT a, count(*) AS n_near, max(bn) AS most FROM near GROUP BY a),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN most END AS form_n,
    CASE WHEN most >= 10 * w.n THEN (SELECT min(b) FROM near WHERE near.a = w.word AND bn = most) END AS form
  FROM words w LEFT JOIN best ON best.a = w.word),
chain AS (
  SELECT word, word AS reached, form AS next FROM formed
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT word, n, n_near, form, form_n, reached AS root
FROM formed JOIN (SELECT word, reached FROM chain WHERE next IS NULL) r USING (word)
""".replace("WITH ", "WITH RECURSIVE ", 1)

OP13 = f"""
WITH {CRC_TABLE},
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
drawn AS (
  SELECT DISTINCT c, c - c % 5 AS base, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM turns, crc_table),
heads AS (
  SELECT d.c, t.pos, role, text FROM drawn d JOIN turns t ON t.c = d.base AND t.pos <= d.h),
rebuilt AS (
  SELECT c, pos, role, text FROM heads
  UNION ALL SELECT c, t.pos + 100, role, text FROM drawn JOIN turns t USING (c) WHERE t.pos > h),
placed AS (
  SELECT c, row_number() OVER w AS depth, strlen(text) AS size,
    list(md5(strlen(role) || ':' || role || text)) OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY pos)),
members AS (
  SELECT c, depth, size, md5(array_to_string(path, '')) AS node,
    coalesce(lag(md5(array_to_string(path, ''))) OVER (PARTITION BY c ORDER BY depth), '') AS up,
    depth = max(depth) OVER (PARTITION BY c) AS is_end FROM placed
  UNION ALL SELECT c, 0, 0, '', NULL, c NOT IN (SELECT c FROM placed) FROM drawn),
nodes AS (
  SELECT node, depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
degrees AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.up = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.node = n.up),
below AS (
  SELECT m.node, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM members m JOIN degrees d ON d.conv_id = m.c AND d.depth >= m.depth GROUP BY m.node)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM degrees JOIN below USING (node)
"""

STATEMENTS: dict[str, str] = {
    "op1_exact_dedup": OP1,
    "op3_mix_sources": OP3,
    "op11_spelling": OP11,
    "op13_prefix_trie": OP13,
}
