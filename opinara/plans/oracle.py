"""DuckDB twins of the catalogue's queries, written independently of the Spark plans."""

from __future__ import annotations

from opinara.functions.words import CLOSED_CLASS, PUNCTUATION, STOP_WORDS
from opinara.operators.recommend import RANKS, REG_PARAMS, TUNING_ITERATIONS
from opinara.plans import tables as t


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


STOPS = _quoted(STOP_WORDS)
MARKS = _quoted([*PUNCTUATION, "br"])
_W = r"[\p{L}\p{M}\p{N}_]"
_NOT_W = r"[^\p{L}\p{M}\p{N}_]"
# The split-off contractions and fused words, as rewrites (this engine's regexes look nowhere).
_REWRITES = [
    (r'(^|[\s\p{Z}(\[{<])"', r"\1 `` "),
    ('"', " '' "),
    (rf"(?i)({_W})(n't)({_NOT_W}|$)", r"\1 \2\3"),
    (rf"(?i)({_W})('(?:s|m|d|ll|re|ve))({_NOT_W}|$)", r"\1 \2\3"),
    (rf"(?i)(^|[\s\p{{Z}}])(can)(not)({_NOT_W}|$)", r"\1\2 \3\4"),
    (rf"(?i)(^|[\s\p{{Z}}])(gim|lem)(me)({_NOT_W}|$)", r"\1\2 \3\4"),
    (rf"(?i)(^|[\s\p{{Z}}])(gon|wan)(na)({_NOT_W}|$)", r"\1\2 \3\4"),
    (rf"(?i)(^|[\s\p{{Z}}])(got)(ta)({_NOT_W}|$)", r"\1\2 \3\4"),
]
_TOKEN = (
    r"\.\.\.|``|''|--|n't\b|'(?:s|m|d|ll|re|ve)\b"
    rf"|{_W}+(?:[-./]{_W}+|[,:]\p{{N}}+|'{_W}+)*|[^\s\p{{Z}}]"
)


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tokens(text: str) -> str:
    for pattern, replacement in _REWRITES:
        text = f"regexp_replace({text}, {_lit(pattern)}, {_lit(replacement)}, 'g')"
    return f"regexp_extract_all({text}, {_lit(_TOKEN)})"


def fingerprint(tokens_: str) -> str:
    return f"len({tokens_}) AS n, md5(array_to_string({tokens_}, ' ')) AS digest"


def no_stops(tokens_: str) -> str:
    return f"list_filter({tokens_}, lambda w: w NOT IN ({STOPS}))"


def no_marks(tokens_: str) -> str:
    return f"list_filter({tokens_}, lambda w: w NOT IN ({MARKS}))"


def tag(w: str) -> str:
    classes = " ".join(
        f"WHEN lower({w}) IN ({_quoted(ws)}) THEN '{name}'" for name, ws in CLOSED_CLASS.items()
    )
    return rf"""CASE WHEN regexp_matches({w}, '^[-+]?\p{{N}}+([.,:/]\p{{N}}+)*$') THEN 'CD' {classes}
      WHEN NOT regexp_matches({w}, '[\p{{L}}\p{{N}}]') THEN 'SYM'
      WHEN regexp_matches({w}, '^\p{{Lu}}')
        THEN CASE WHEN regexp_matches(lower({w}), '[^su]s$') THEN 'NNPS' ELSE 'NNP' END
      WHEN regexp_matches(lower({w}), '[a-z][a-z]ing$') THEN 'VBG'
      WHEN regexp_matches(lower({w}), '[a-z][a-z]ed$') THEN 'VBD'
      WHEN regexp_matches(lower({w}), '[a-z][a-z]ly$') THEN 'RB'
      WHEN regexp_matches(lower({w}), '[a-z][a-z](ous|ful|ive|able|ible|ish|less)$') THEN 'JJ'
      WHEN regexp_matches(lower({w}), '[^su]s$') THEN 'NNS' ELSE 'NN' END"""


NOUNS = "('NN', 'NNS', 'NNP', 'NNPS')"
PREPROCESS = (
    r"list_filter(regexp_extract_all(lower(text), '[\p{L}_]+'),"
    r" lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))"
)
WORDS = f"""word_counts AS (SELECT word, count(*) AS n FROM
    (SELECT unnest({PREPROCESS}) AS word FROM documents) GROUP BY 1 HAVING count(*) >= 2)"""
# Words that stand near each other, by their places among the counted words of a text.
PAIRS = f"""placed AS (
  SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM
    (SELECT doc_id, unnest(list) AS word, unnest(range(len(list))) AS i FROM (SELECT doc_id, {PREPROCESS} AS list FROM documents))
  JOIN word_counts USING (word)),
counted AS (
  SELECT least(x.word, y.word) AS a, greatest(x.word, y.word) AS b, count(*) AS times FROM
    (SELECT doc_id, word, place + unnest(range(1, 11)) AS near FROM placed) x
  JOIN placed y ON x.doc_id = y.doc_id AND x.near = y.place WHERE x.word <> y.word GROUP BY 1, 2),
pairs AS (SELECT a AS word, b AS other, times FROM counted UNION ALL SELECT b, a, times FROM counted)"""
WEIGHTS = """sums AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM pairs GROUP BY 1),
weights AS (
  SELECT word, other, ln(ratio) - ln(5.0::DOUBLE) AS weight FROM (
    SELECT p.word, p.other, times / (CAST(x.n AS DOUBLE) * y.n / (SELECT CAST(sum(times) AS BIGINT) FROM pairs)) AS ratio
    FROM pairs p JOIN sums x ON x.word = p.word JOIN sums y ON y.word = p.other) WHERE ratio > 5.0)"""
CLEAN = r"trim(regexp_replace({0}, '[\s\p{{Z}}]+', ' ', 'g'))"

ASPECTS = f"""
words AS (SELECT source AS product_id, unnest({no_marks(no_stops(tokens("text")))}) AS term
          FROM documents),
counts AS (SELECT product_id, term, count(*) AS n FROM words GROUP BY 1, 2),
ranked AS (SELECT product_id, term, n,
             row_number() OVER (PARTITION BY product_id ORDER BY n DESC, term) AS rank
           FROM counts WHERE {tag("term")} IN {NOUNS}),
top AS (SELECT * FROM ranked WHERE rank <= 5)"""

ASPECTS_LEARNED = ASPECTS.replace(
    f"FROM counts WHERE {tag('term')} IN {NOUNS}",
    f"FROM counts LEFT JOIN learned ON term = word WHERE coalesce(learned.tag, {tag('term')}) IN {NOUNS}",
)

RATINGS = """ratings AS (
  SELECT CAST(user_id AS INTEGER) AS "user", CAST(json_extract(props, '$.k') AS INTEGER) AS item,
         round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / count(*), 6) AS rating
  FROM events GROUP BY 1, 2)"""

RECS = """sums AS (
  SELECT CAST(user_id AS INTEGER) AS user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS item,
         sum(CAST(value AS DECIMAL(18,6))) AS rating FROM events GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item) AS rank
        FROM sums QUALIFY rank <= 10),
recs AS (SELECT user_id, '[' || string_agg(item, ', ' ORDER BY rank) || ']' AS rec_prods
         FROM top GROUP BY 1)"""

LEX = """lex AS (
  SELECT p_partkey + 1 AS line_no, p_name AS token,
         CAST(CAST(p_size / 10.0 AS DECIMAL(5,2)) AS DOUBLE) AS valence,
         p_size / 50.0 AS sd, p_brand AS raw,
         concat_ws(chr(9), p_name, CAST(CAST(p_size / 10.0 AS DECIMAL(5,2)) AS VARCHAR),
                   CAST(CAST(p_size / 50.0 AS DOUBLE) AS VARCHAR), p_brand) AS line
  FROM part)"""
NEAREST = """nearest AS (SELECT valence, sd, raw FROM lex WHERE line_no > 440
  ORDER BY abs(0.44957 - sd), line_no LIMIT 1)"""

SIMILAR = """seed AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 7),
sims AS (SELECT 'w' || vec_id AS word,
    list_dot_product(CAST(embedding AS DOUBLE[]), v)
    / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
       * sqrt(list_dot_product(v, v))) AS similarity
  FROM embeddings, seed WHERE vec_id <> 7),
near AS (SELECT row_number() OVER (ORDER BY similarity DESC, word) AS rank, * FROM sims
         QUALIFY rank <= {k})"""

FLAT = r"""flat AS (SELECT page_id,
    {name} AS name,
    CASE WHEN len(regexp_extract_all(html, '(?s)<p><b>(.*?)<br>', 1)) > 0
         THEN regexp_extract_all(html, '(?s)<p><b>(.*?)<br>', 1)
         ELSE regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) END AS raw
  FROM pages),
clean AS (SELECT page_id, name, list_transform(raw, lambda b: {block}) AS blocks FROM flat)""".format(
    name=CLEAN.format(
        "regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<.*?>', '', 'g')"
    ),
    block=CLEAN.format("regexp_replace(b, '<.*?>', '', 'g')"),
)

LINES = """lines AS (
  SELECT doc_id, 'product/productId: ' || source AS line FROM documents
  UNION ALL SELECT doc_id, 'review/text: ' || text FROM documents)"""

URL = "http://www.amazon.com/dp/"


# Documents with null sources and orders, every seventh row twice.
HOLED = """once AS (SELECT nullif(source, 'src3') AS source,
    CASE WHEN doc_id % 11 <> 5 THEN doc_id END AS doc_id,
    CASE WHEN doc_id % 11 <> 5 THEN lang END AS lang,
    CASE WHEN doc_id % 11 <> 5 THEN text END AS text FROM documents),
holed AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE doc_id % 7 = 0),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1) // 16 AS part
  FROM holed)"""

WORD_LEXICON = r"""SELECT DISTINCT w, (length(w) * 7 % 9 - 4) / 2.0::DOUBLE FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '[\s\p{Z}]+')) AS w FROM conversations) WHERE length(w) > 1"""


def _sentiment(context: bool, emphasis: bool, special: bool, lexicon: str | None = None) -> str:
    """CTEs ending in ``totals(key, id, total)`` over ``reviews(key, id, text)``."""
    r = t.RULES
    lex = ", ".join(f"('{w}', {v})" for w, v in t.LEXICON.items())
    idioms = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in r["idioms"].items()) + " END"
    pairs = _quoted(r["dampener_pairs"])
    modifiers = _quoted(r["boosters"] + r["dampeners"])
    caps = "({0} = upper({0}) AND {0} <> lower({0}))"
    ctes = [
        f"lexicon(token, valence) AS ({lexicon or f'SELECT * FROM (VALUES {lex})'})",
        rf"""split_ AS (SELECT key, id, text,
          list_filter(list_transform(list_filter(regexp_split_to_array(text, '[\s\p{{Z}}]+'), lambda x: x <> ''),
            lambda x: CASE WHEN length(trim(x, {_lit(PUNCTUATION)})) <= 2 THEN x
                      ELSE trim(x, {_lit(PUNCTUATION)}) END), lambda x: length(x) >= 2) AS ws FROM reviews)""",
        "words AS (SELECT key, id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM split_)",
        f"""shape AS (SELECT key, id, count(*) AS n, count(*) FILTER ({caps.format("w")}) AS n_caps,
          min(pos) FILTER (lower(w) = '{r["but"]}') AS but_at FROM words GROUP BY 1, 2)""",
        """near AS (SELECT *, lag(w, 1) OVER o AS p1, lag(w, 2) OVER o AS p2, lag(w, 3) OVER o AS p3,
          lead(w, 1) OVER o AS n1, lead(w, 2) OVER o AS n2 FROM words
          WINDOW o AS (PARTITION BY key, id ORDER BY pos))""",
        """hit AS (SELECT near.*, CAST(valence AS DOUBLE) AS v0, but_at,
            n_caps > 0 AND n_caps < n AS mixed,
            p1 IS NOT NULL AND lower(p1) NOT IN (SELECT token FROM lexicon) AS o1,
            p2 IS NOT NULL AND lower(p2) NOT IN (SELECT token FROM lexicon) AS o2,
            p3 IS NOT NULL AND lower(p3) NOT IN (SELECT token FROM lexicon) AS o3
          FROM near JOIN lexicon ON lower(w) = token JOIN shape USING (key, id))""",
    ]
    last = "hit"
    value = "v0"

    def step(expr: str) -> None:
        nonlocal last, value
        number = len(ctes)
        ctes.append(f"s{number} AS (SELECT *, {expr} AS x{number} FROM {last})")
        last, value = f"s{number}", f"x{number}"

    if emphasis:
        step(
            f"CASE WHEN mixed AND {caps.format('w')} THEN"
            f" {value} + CASE WHEN {value} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE {value} END"
        )
    if context:
        for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            p = f"p{d}"
            sign = f"CASE WHEN {value} < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"
            loud = "0.0::DOUBLE"
            if emphasis:
                loud = (
                    f"CASE WHEN mixed AND {caps.format(p)} THEN CASE WHEN {value} > 0"
                    " THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0.0::DOUBLE END"
                )
            scalar = (
                f"CASE WHEN lower({p}) IN ({_quoted(r['boosters'])}) THEN {sign} * 0.293::DOUBLE + {loud}"
                f" WHEN lower({p}) IN ({_quoted(r['dampeners'])}) THEN {sign} * -0.293::DOUBLE + {loud}"
                " ELSE 0.0::DOUBLE END"
            )
            step(f"CASE WHEN o{d} THEN {value} + ({scalar}) * {damp}::DOUBLE ELSE {value} END")
            negated = (
                f"CASE WHEN lower({p}) IN ({_quoted(r['negations'])}) OR contains(lower({p}), 'n''t')"
                f" THEN {value} * -0.74::DOUBLE ELSE {value} END"
            )
            intensive = _quoted(r["intensive"])
            if special and d == 2:
                negated = (
                    f"CASE WHEN p2 = '{r['never']}' AND p1 IN ({intensive})"
                    f" THEN {value} * 1.5::DOUBLE ELSE {negated} END"
                )
            if special and d == 3:
                negated = (
                    f"CASE WHEN (p3 = '{r['never']}' AND p2 IN ({intensive})) OR p1 IN ({intensive})"
                    f" THEN {value} * 1.25::DOUBLE ELSE {negated} END"
                )
            step(f"CASE WHEN o{d} THEN {negated} ELSE {value} END")
        if special:
            phrases = [
                "w || ' ' || n1 || ' ' || n2",
                "w || ' ' || n1",
                "p1 || ' ' || w",
                "p2 || ' ' || p1 || ' ' || w",
                "p2 || ' ' || p1",
                "p3 || ' ' || p2 || ' ' || p1",
                "p3 || ' ' || p2",
            ]
            found = ", ".join(idioms.format(f"({p})") for p in phrases)
            step(f"CASE WHEN o3 THEN coalesce({found}, {value})::DOUBLE ELSE {value} END")
            step(
                f"CASE WHEN o3 AND (p3 || ' ' || p2 IN ({pairs}) OR p2 || ' ' || p1 IN ({pairs}))"
                f" THEN {value} - 0.293::DOUBLE ELSE {value} END"
            )
            step(
                f"CASE WHEN o1 AND lower(p1) = '{r['least']}'"
                f" AND coalesce(lower(p2) NOT IN ({_quoted(r['least_exempt'])}), true)"
                f" THEN {value} * -0.74::DOUBLE ELSE {value} END"
            )
        step(
            f"CASE WHEN lower(w) IN ({modifiers}) OR (lower(w) = 'kind' AND lower(n1) = 'of')"
            f" THEN 0.0::DOUBLE ELSE {value} END"
        )
    marks = "0"
    if emphasis:
        step(
            f"{value} * CASE WHEN but_at IS NULL OR pos = but_at THEN 1.0::DOUBLE"
            " WHEN pos < but_at THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END"
        )
        q = "(length(text) - length(replace(text, '?', '')))"
        marks = f"""CAST(round(least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
          + CASE WHEN {q} <= 1 THEN 0.0::DOUBLE WHEN {q} <= 3 THEN {q} * 0.18::DOUBLE
                 ELSE 0.96::DOUBLE END, 6) AS DECIMAL(18,6))"""
    ctes.append(
        f"sums AS (SELECT key, id, sum(CAST(round({value}, 6) AS DECIMAL(18,6))) AS s"
        f" FROM {last} GROUP BY 1, 2)"
    )
    ctes.append(
        f"""totals AS (SELECT key, id, coalesce(s, 0) + CASE WHEN s > 0 THEN {marks}
          WHEN s < 0 THEN -{marks} ELSE 0 END AS total FROM reviews LEFT JOIN sums USING (key, id))"""
    )
    return ",\n".join(ctes)


def _review_scores(context: bool, emphasis: bool, special: bool, lexicon: str | None = None) -> str:
    return f"""WITH reviews AS (SELECT source AS key, doc_id AS id, text FROM documents),
{_sentiment(context, emphasis, special, lexicon)}
SELECT id AS review_id, round(total::DOUBLE / sqrt(total::DOUBLE * total::DOUBLE + 15.0), 4) AS compound
FROM totals"""


def _product_scores(source: str) -> str:
    return f"""WITH reviews AS ({source}),
{_sentiment(True, True, True)},
pooled AS (SELECT key, CAST(sum(total) AS DOUBLE) AS total FROM totals GROUP BY 1)
SELECT key AS product_id, round(total / sqrt(total * total + 15.0), 4) AS compound FROM pooled"""


def _tagged(name: str) -> str:
    return f"""SELECT lower(w) AS word, {tag("w")} AS tag
      FROM (SELECT unnest({tokens("text")}) AS w FROM {name})"""


def _tag_lexicon(name: str) -> str:
    return f"""SELECT word, tag FROM (
      SELECT word, tag, row_number() OVER (PARTITION BY word ORDER BY count(*) DESC, tag) AS rn
      FROM ({_tagged(name)}) GROUP BY word, tag) WHERE rn = 1"""


def _per_day(name: str, column: str, count: str) -> str:
    return f"SELECT strftime({column}, '%Y-%m-%d') AS day, count(*) AS {count} FROM {name} GROUP BY 1"


_PLAIN_RULE = CLEAN.format("text")

MESSAGES = f"""msgs AS (SELECT event_id, '{URL}' || user_id AS url,
    CASE WHEN event_type <> 'error' THEN event_type END AS name,
    CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS price,
    CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k,
    CASE WHEN event_type = 'error' THEN 'page not found' END AS error,
    props, event_type, user_id FROM events)"""

SHOP = r"""shop AS (SELECT doc_id, source, lang, n_chars, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)"""


def statements() -> dict[str, str]:
    return {
        "pages_scan": "SELECT page_id, url, length(html) AS n_chars FROM pages",
        "ratings_scan": f"WITH {RATINGS} SELECT * FROM ratings",
        "lexicon_scan": f"WITH {LEX} SELECT line_no, token, valence, CAST(sd AS DOUBLE) AS sd, raw FROM lex",
        "review_records": """SELECT doc_id AS review_id, source AS product_id, length(text) AS n_chars,
            md5(replace(text, chr(10), ' ')) AS digest FROM documents""",
        "filter_contains": f"""WITH {LINES} SELECT doc_id, md5(line) AS digest FROM lines
            WHERE line LIKE '%review/text: %'""",
        "strip_prefix": f"""WITH {LINES} SELECT doc_id,
            md5(replace(replace(line, 'review/text: ', ''), 'product/productId: ', '')) AS digest
            FROM lines""",
        "clean_ratings": """SELECT CAST(user_id AS INTEGER) AS "user",
            CAST(json_extract(props, '$.k') AS INTEGER) AS item, value AS rating FROM events
            WHERE user_id <> 3 AND CAST(json_extract(props, '$.k') AS INTEGER) <> 7
              AND value IS NOT NULL""",
        "array_to_text": """SELECT l_orderkey, l_linenumber,
            concat('[', l_orderkey, ', ', l_partkey, ', ', l_suppkey, ']') AS keys FROM lineitem""",
        "map_ids": """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER)
            AS "user" FROM customer""",
        "full_outer_join": f"""SELECT coalesce(a.day, b.day) AS day, n_ordered, n_shipped
            FROM ({_per_day("orders", "o_orderdate", "n_ordered")}) a FULL OUTER JOIN
                 ({_per_day("lineitem", "l_shipdate", "n_shipped")}) b ON a.day = b.day""",
        "recs_join_users": f"""WITH {RECS} SELECT user_id, c_name AS "user", rec_prods
            FROM recs JOIN customer ON user_id = c_custkey""",
        "recs_for_user": f"""WITH {RECS} SELECT user_id, c_name AS "user", rec_prods
            FROM recs JOIN customer ON user_id = c_custkey WHERE user_id = 7""",
        "recommended_products": f"""WITH {RECS} SELECT user_id, CAST(rank AS INTEGER) AS rank,
            'P' || p_partkey AS product FROM top JOIN part ON item = p_partkey""",
        "recommended_products_text": f"""WITH {RECS} SELECT user_id, CAST(rank AS INTEGER) AS rank,
            'P' || p_partkey AS product FROM top JOIN part ON item = p_partkey""",
        "keyed_ratings": f"""WITH {RATINGS} SELECT
            CAST(dense_rank() OVER (ORDER BY 'u' || "user") - 1 AS INTEGER) AS "user",
            CAST(dense_rank() OVER (ORDER BY 'i' || item) - 1 AS INTEGER) AS item, rating FROM ratings""",
        "titles_with_default": """SELECT 'P' || p_partkey AS product, CAST(p_partkey AS INTEGER) AS pro_id,
            coalesce(n_name, 'TITLE NOT AVAILABLE') AS title
            FROM part LEFT JOIN nation ON p_partkey = n_nationkey""",
        "recommendation_report": f"""WITH {RECS} SELECT user_id, c_name AS "user",
            CAST(rank AS INTEGER) AS rank, 'P' || p_partkey AS product,
            coalesce(n_name, 'TITLE NOT AVAILABLE') AS title
            FROM top JOIN part ON item = p_partkey JOIN customer ON user_id = c_custkey
            LEFT JOIN nation ON n_nationkey = p_partkey""",
        "title_dedup": """SELECT p_name AS movie, p_brand || ' ' || p_type AS title FROM part
            QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1""",
        "group_collect": f"""WITH {HOLED} SELECT source, part,
            coalesce(string_agg(lang, ',' ORDER BY doc_id), '') AS langs FROM numbered GROUP BY 1, 2""",
        "concat_reviews": f"""WITH {HOLED} SELECT source AS product_id, part,
            md5(coalesce(string_agg(text, '.' ORDER BY doc_id), '')) AS digest FROM numbered GROUP BY 1, 2""",
        "term_counts": f"""SELECT product_id, term, count(*) AS n FROM (SELECT source AS product_id,
            unnest({tokens("text")}) AS term FROM documents) GROUP BY 1, 2""",
        "flatten_lists": """WITH f AS (SELECT doc_id, flatten(list_transform(
            string_split(text, chr(10)), lambda x: string_split(x, ' '))) AS ws FROM documents)
            SELECT doc_id, len(ws) AS n, md5(array_to_string(ws, ' ')) AS digest FROM f""",
        "distinct_products": "SELECT DISTINCT source AS product_id FROM documents",
        "rmse": """SELECT event_type, round(sqrt(avg((50.0::DOUBLE - value) * (50.0::DOUBLE - value))), 6)
            AS rmse FROM events GROUP BY 1""",
        "best_params": """SELECT event_type, round(rmse, 6) AS rmse FROM (SELECT event_type,
            sqrt(avg((50.0::DOUBLE - value) * (50.0::DOUBLE - value))) AS rmse FROM events GROUP BY 1)
            ORDER BY 2, 1 LIMIT 1""",
        "rating_histogram": """WITH c AS (SELECT c_mktsegment AS url, o_orderpriority AS rating,
              count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
            SELECT url, rating, CAST(n * 100 // sum(n) OVER (PARTITION BY url) AS BIGINT) || '%' AS share
            FROM c""",
        "vocabulary": f"WITH {WORDS} SELECT * FROM word_counts",
        "word_cooccurrences": f"""WITH {WORDS}, {PAIRS} SELECT word, count(*) AS n_others, CAST(sum(times) AS BIGINT) AS times,
            arg_min(other, (-times, other)) AS nearest FROM pairs GROUP BY 1""",
        "word_information": f"""WITH {WORDS}, {PAIRS}, {WEIGHTS} SELECT word, count(*) AS n_weights,
            round(sum(weight), 4) AS total, round(max(weight), 6) AS largest FROM weights GROUP BY 1""",
        "word_vectors": f"""WITH {WORDS}, {PAIRS}, {WEIGHTS}
            SELECT DISTINCT word, 150 AS dim, true AS is_vector FROM weights""",
        "top_aspects": f"WITH {ASPECTS} SELECT product_id, CAST(rank AS INTEGER) AS rank, term, n FROM top",
        "top_aspects_learned": f"""WITH learned AS ({_tag_lexicon("conversations")}), {ASPECTS_LEARNED}
            SELECT product_id, CAST(rank AS INTEGER) AS rank, term, n FROM top""",
        "aspect_lists": f"""WITH {ASPECTS} SELECT p.product_id,
            '[' || coalesce(string_agg(term, ', ' ORDER BY rank), '') || ']' AS noun
            FROM (SELECT DISTINCT source AS product_id FROM documents) p
            LEFT JOIN top USING (product_id) GROUP BY 1""",
        "tokenize": f"SELECT doc_id, {fingerprint(tokens('text'))} FROM documents",
        "remove_stopwords": f"SELECT doc_id, {fingerprint(no_stops(tokens('text')))} FROM documents",
        "remove_punctuation": f"SELECT doc_id, {fingerprint(no_marks(tokens('text')))} FROM documents",
        "tag_lexicon": _tag_lexicon("documents"),
        "tag_tokens": f"""WITH learned AS ({_tag_lexicon("conversations")}),
            split_ AS (SELECT doc_id, {no_marks(no_stops(tokens("text")))} AS ws FROM documents),
            words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM split_),
            tagged AS (SELECT doc_id, words.word, pos,
              coalesce(learned.tag, {tag("words.word")}) AS tag FROM words LEFT JOIN learned USING (word))
            SELECT doc_id, tag, count(*) AS n, CAST(sum(length(word)) AS BIGINT) AS char_sum,
              CAST(sum(pos) AS BIGINT) AS pos_sum, CAST(sum(pos * length(word)) AS BIGINT) AS mixed_sum
            FROM tagged GROUP BY 1, 2""",
        "extract_nouns": f"""WITH f AS (SELECT doc_id, list_filter({no_marks(no_stops(tokens("text")))},
            lambda w: {tag("w")} IN {NOUNS}) AS ws FROM documents)
            SELECT doc_id, {fingerprint("ws")} FROM f""",
        "simple_preprocess": f"SELECT doc_id, {fingerprint(PREPROCESS)} FROM documents",
        "sentiment_basic": _review_scores(False, False, False),
        "sentiment_context": _review_scores(True, False, False),
        "sentiment_emphasis": _review_scores(True, True, False),
        "sentiment_full": _review_scores(True, True, True),
        "sentiment_table_lexicon": _review_scores(False, False, False, WORD_LEXICON),
        "sentiment_table_full": _review_scores(True, True, True, WORD_LEXICON),
        "product_sentiment": _product_scores(
            "SELECT source AS key, doc_id AS id, text FROM documents"
        ),
        "conversation_sentiment": _product_scores(
            "SELECT CAST(conv_id AS VARCHAR) AS key, turn AS id, text FROM conversations"
        ),
        "nearest_vectors": f"""WITH {SIMILAR.format(k=10)}
            SELECT CAST(rank AS INTEGER) AS rank, word, round(similarity, 6) AS similarity FROM near""",
        "nearest_lexicon_row": f"""WITH {LEX} SELECT line_no, token, valence, CAST(sd AS DOUBLE) AS sd, raw
            FROM lex WHERE line_no > 440 ORDER BY abs(0.44957 - sd), line_no LIMIT 1""",
        "lexicon_latest": f"""WITH {LEX} SELECT line_no, token, valence, CAST(sd AS DOUBLE) AS sd, raw
            FROM lex QUALIFY row_number() OVER (PARTITION BY token ORDER BY line_no DESC) = 1""",
        "lexicon_missing_words": f"""WITH {LEX}, {WORDS}
            SELECT word, 'token' AS mode FROM word_counts WHERE word NOT IN (SELECT token FROM lex)
            UNION ALL
            SELECT word, 'substring' AS mode FROM word_counts WHERE NOT EXISTS
              (SELECT 1 FROM (SELECT DISTINCT line FROM lex) l WHERE contains(l.line, word))""",
        "lexicon_proposals": f"""WITH {LEX}, {WORDS}, {NEAREST}
            SELECT word AS token, valence, CAST(sd AS DOUBLE) AS sd, raw FROM word_counts, nearest
            WHERE word NOT IN (SELECT token FROM lex)""",
        "lexicon_append": f"""WITH {LEX}, {WORDS}, {NEAREST}
            SELECT token, valence, CAST(sd AS DOUBLE) AS sd, raw FROM lex UNION ALL
            SELECT word, valence, CAST(sd AS DOUBLE), raw FROM word_counts, nearest
            WHERE word NOT IN (SELECT token FROM lex)""",
        "grow_lexicon": f"""WITH {LEX}, {NEAREST}, {SIMILAR.format(k=5)},
            fresh AS (SELECT word, row_number() OVER (ORDER BY rank) AS nth FROM near n WHERE
              NOT EXISTS (SELECT 1 FROM lex WHERE contains(line, word)) AND
              NOT EXISTS (SELECT 1 FROM near e WHERE e.rank < n.rank AND contains(e.word, n.word)))
            SELECT line_no, token, valence, CAST(sd AS DOUBLE) AS sd, raw FROM lex UNION ALL
            SELECT (SELECT max(line_no) FROM lex) + nth, word, valence, CAST(sd AS DOUBLE), raw
            FROM fresh, nearest""",
        "page_products": f"WITH {FLAT} SELECT page_id, name, {fingerprint('blocks')} FROM clean",
        "page_reviews": f"""WITH {FLAT} SELECT page_id, unnest(range(len(blocks))) AS pos,
            unnest(blocks) AS review_text FROM clean""",
        "page_records": f"""WITH {SHOP} SELECT '{URL}' || doc_id AS url, i AS pos,
            CAST(i AS VARCHAR) AS review_comment_count,
            md5({CLEAN.format("line")} || CASE WHEN i % 3 = 0 THEN '+' || lang ELSE '' END) AS review_text,
            lpad(CAST(i % 28 + 1 AS VARCHAR), 2, '0') || ' Jan 2018' AS review_posted_date,
            'line ' || i AS review_header, CAST(i % 5 + 1 AS VARCHAR) || ' ' AS review_rating,
            'by ' || source AS review_author FROM shop""",
        "page_record_heads": f"""SELECT '{URL}' || doc_id AS url, source AS name, '$' || n_chars || '.00' AS price,
            '1 star=7%,5 star=' || (n_chars % 100) || '%' AS ratings,
            len(string_split(text, chr(10))) AS n_reviews, CAST(NULL AS VARCHAR) AS error FROM documents""",
        "review_text_rule": rf"""SELECT doc_id, md5(CASE WHEN doc_id % 5 = 0 THEN {_PLAIN_RULE}
            ELSE {_PLAIN_RULE} || CASE WHEN doc_id % 3 = 0 THEN source || ' more' ELSE '' END END)
            AS digest FROM documents""",
        "clean_text": f"SELECT page_id, md5({CLEAN.format('html')}) AS digest FROM pages",
        "page_errors": """SELECT url, CASE WHEN page_id % 10 = 0 THEN 'page not found'
            ELSE 'failed to process the page' END AS error FROM pages WHERE page_id % 10 < 2""",
        "product_url": f"SELECT p_partkey, '{URL}' || p_partkey AS url FROM part",
        "parse_price": """SELECT o_orderkey, '$' || replace(format('{:,.2f}', o_totalprice), ',', '') AS price
            FROM orders""",
        "parse_stars": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) || ' ' AS stars,
            l_quantity AS stars_value FROM lineitem""",
        "als_factors": f"""WITH {RATINGS} SELECT 'user' AS kind, "user" AS id, count(*) AS n_ratings, true AS is_solution
            FROM ratings GROUP BY 2 UNION ALL SELECT 'item', item, count(*), true FROM ratings GROUP BY 2""",
        "als_predict": f"""WITH {RATINGS} SELECT "user", item, rating, true AS is_product FROM ratings""",
        "als_tuning": f"""SELECT CAST(i * {len(REG_PARAMS)} + j AS INTEGER) AS trial, rank, reg,
            {TUNING_ITERATIONS} AS iters, (SELECT count(*) > 0 FROM events) AS is_finite
            FROM (VALUES {", ".join(f"({i}, {r})" for i, r in enumerate(RANKS))}) r(i, rank),
              (VALUES {", ".join(f"({j}, {g}::DOUBLE)" for j, g in enumerate(REG_PARAMS))}) g(j, reg)""",
        "recommend_all": f"""WITH {RATINGS}, best AS (SELECT least(count(DISTINCT item), 10) AS k FROM ratings)
            SELECT "user", CAST(unnest(range(k)) AS INTEGER) AS pos, true AS is_best
            FROM (SELECT DISTINCT "user" FROM ratings), best""",
        "normalize_date": """SELECT o_orderkey, CASE WHEN o_orderkey % 14 < 12
            THEN strftime(o_orderdate, '%d %b %Y') END AS posted FROM orders""",
        "comment_count": "SELECT event_id, CAST(user_id AS VARCHAR) AS comments FROM events",
        "publish_payload": """SELECT CAST(to_json({'doc_id': doc_id, 'source': source, 'text': text})
            AS VARCHAR) AS value FROM documents""",
        "stream_decode": f"""WITH {MESSAGES} SELECT event_id, url, name, price, k,
            CASE WHEN error IS NULL THEN 1 END AS n_reviews, error FROM msgs""",
        "stream_dedup": f"""WITH {MESSAGES} SELECT event_id, url, name, price, error FROM msgs
            QUALIFY row_number() OVER (PARTITION BY url ORDER BY event_id DESC) = 1""",
        "stream_reviews": f"""WITH {MESSAGES} SELECT url, name, CASE WHEN error IS NULL THEN 0 END AS pos,
            CASE WHEN error IS NULL THEN props END AS review_text, name AS review_header,
            price AS review_rating, CASE WHEN error IS NULL THEN CAST(user_id AS VARCHAR) END
            AS review_author FROM msgs""",
        "split_ratings": f"""WITH {RATINGS} SELECT *, CASE WHEN
            CAST('0x' || substr(md5('1:' || "user" || ':' || item), 1, 8) AS BIGINT) % 100 < 80
            THEN 'train' ELSE 'valid' END AS part FROM ratings""",
        "recommended_items": f"""WITH {RECS} SELECT user_id AS "user", rec_prods AS recommended FROM recs""",
    }
