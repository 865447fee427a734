"""DuckDB SQL for every registered query: the independent correctness oracle.

The SQL restates each rule in DuckDB's dialect (RE2 regular expressions,
list lambdas, ``string_agg``) and computes scores by unnesting tokens and
joining the weight table, a different route from the Spark plans. Bands,
weights, list sizes and headings are written out here, so a wrong constant in
the library shows; only the stop list, checked against Spark's own, is
shared. Names and types of the output columns equal the Spark queries'.
"""

from __future__ import annotations

from marquee.functions.stopwords import ENGLISH_STOP_WORDS

# Python's whitespace class and the title filter, in RE2 syntax.
WS = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
TITLE_NON_LETTERS = r"[^a-zA-Z \t\n\x0B\f\r]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOPS = "[" + ", ".join(_q(w) for w in ENGLISH_STOP_WORDS) + "]"

CATALOG = """
genre_lists AS (
  SELECT l.l_orderkey AS k,
         string_agg(p.p_name, ', ' ORDER BY l.l_linenumber, p.p_name) AS listed_in
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey),
catalog AS (
  SELECT d.doc_id AS title_id, d.lang AS platform,
         CASE WHEN d.doc_id % 40 = 39 THEN 'Special'
              WHEN d.doc_id % 3 = 0 THEN 'TV Show' ELSE 'Movie' END AS type,
         split_part(d.text, '.', 1) AS title, g.listed_in,
         CASE WHEN d.doc_id % 50 = 49 THEN 'n/a'
              ELSE CAST(1998 + (d.doc_id * 7) % 25 AS VARCHAR) END AS release_year,
         d.source AS rating, d.text AS description
  FROM documents d LEFT JOIN genre_lists g ON g.k = d.doc_id)"""

CANDIDATES = """
candidates AS (
  SELECT item_id AS cand_id,
         CASE item_id % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'en' WHEN 2 THEN 'es' ELSE 'fr' END AS platform,
         CASE WHEN item_id % 8 < 4 THEN 'Movie' ELSE 'TV Show' END AS type,
         split_part(text, '.', 1) AS title,
         CASE WHEN item_id % 3 = 0 THEN 'red rod, small anvil'
              WHEN item_id % 3 = 1 THEN 'Red Rod' END AS listed_in,
         CAST(2014 + item_id % 12 AS VARCHAR) AS release_year,
         'src0' AS rating, text AS description
  FROM benchmark)"""


def desc_tokens(col: str) -> str:
    return (f"coalesce(list_filter(string_split_regex(lower({col}), '{WS}+'), "
            f"lambda w: length(w) > 2 AND NOT list_contains({STOPS}, w) "
            f"AND regexp_full_match(w, '\\p{{L}}+')), [])")


def title_vocab(col: str) -> str:
    return (f"list_filter(string_split(lower(regexp_replace({col}, '{TITLE_NON_LETTERS}', '', 'g')), ' '), "
            f"lambda w: w <> '' AND NOT list_contains({STOPS}, w))")


def title_terms(col: str) -> str:
    return (f"coalesce(list_filter(string_split_regex(lower({col}), '{WS}+'), "
            f"lambda w: NOT list_contains({STOPS}, w) AND regexp_full_match(w, '\\p{{L}}+')), [])")


def genre_terms(col: str) -> str:
    return (f"list_filter(list_transform(string_split({col}, ','), lambda x: trim(x)), "
            f"lambda x: x <> '')")


def genre_score_terms(col: str) -> str:
    return (f"coalesce(list_transform(string_split({col}, ','), "
            f"lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), [])")


def year_points(col: str) -> str:
    value = (f"TRY_CAST(NULLIF(replace(regexp_extract({col}, "
             f"'^{WS}*([+-]?[0-9](?:_?[0-9])*){WS}*$', 1), '_', ''), '') AS BIGINT)")
    return (f"CAST(CASE WHEN {value} BETWEEN 2000 AND 2005 THEN 5 WHEN {value} BETWEEN 2006 AND 2010 THEN 10 "
            f"WHEN {value} BETWEEN 2011 AND 2015 THEN 15 WHEN {value} BETWEEN 2016 AND 2021 THEN 20 "
            f"ELSE 0 END AS INTEGER)")


def success(total: str, lo: str, hi: str) -> str:
    raw = f"(60.0 + ({total} - {lo})::DOUBLE / ({hi} - {lo}) * 35.0)"
    # Spark rounds half-up on the shortest decimal text of the double.
    rounded = f"CAST(round(CAST(CAST({raw} AS VARCHAR) AS DECIMAL(22,18)), 2) AS DOUBLE)"
    return f"CASE WHEN {hi} = {lo} THEN CAST(77.5 AS DOUBLE) ELSE {rounded} END"


def _top(counts: str, term: str, n: int) -> str:
    return f"""(SELECT platform, type, rank, {term}, "count" FROM (
      SELECT platform, type,
             CAST(row_number() OVER (PARTITION BY platform, type ORDER BY "count" DESC, {term}) AS INTEGER) AS rank,
             {term}, "count" FROM {counts}) WHERE rank <= {n})"""


def base(whole: bool = False) -> str:
    """Prepared catalogue, term lists and weights, shared by most queries; ``whole`` makes it one segment."""
    one = " REPLACE ('all' AS platform, 'all' AS type)" if whole else ""
    return f"""WITH {CATALOG},
seg AS (SELECT *{one} FROM catalog WHERE type IN ('TV Show', 'Movie')),
prep AS (SELECT *, {desc_tokens('description')} AS desc_tokens FROM seg),
desc_counts AS (
  SELECT platform, type, word, CAST(count(*) AS BIGINT) AS "count"
  FROM (SELECT platform, type, unnest(desc_tokens) AS word FROM prep) GROUP BY platform, type, word),
desc_top AS {_top('desc_counts', 'word', 10)},
genre_counts AS (
  SELECT platform, type, genre, CAST(count(*) AS BIGINT) AS "count"
  FROM (SELECT platform, type, unnest({genre_terms('listed_in')}) AS genre FROM prep)
  GROUP BY platform, type, genre),
genre_top AS {_top('genre_counts', 'genre', 5)},
title_counts AS (
  SELECT platform, type, word, CAST(count(*) AS BIGINT) AS "count"
  FROM (SELECT platform, type, unnest({title_vocab('title')}) AS word FROM prep)
  GROUP BY platform, type, word),
title_top AS {_top('title_counts', 'word', 10)},
weights AS (
  SELECT platform, type, 'description' AS list, word AS term, CAST(11 - rank AS INTEGER) AS weight FROM desc_top
  UNION ALL
  SELECT platform, type, 'genre', genre, CAST((6 - rank) * 5 AS INTEGER) FROM genre_top
  UNION ALL
  SELECT platform, type, 'title', word, CAST(11 - rank AS INTEGER) FROM title_top)"""


# The stop list of the queries with a table of stop words.
STOP_TABLE = """stops AS (
  SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM benchmark)
  WHERE word <> '')"""


def base_with_stop_table() -> str:
    """:func:`base` with the words of a table instead of the list."""
    none = "['']"
    prep = f"prep AS (SELECT *, {desc_tokens('description')} AS desc_tokens FROM seg)"
    vocab = f"(SELECT platform, type, unnest({title_vocab('title')}) AS word FROM prep)"
    sql = base()
    assert prep in sql and vocab in sql
    sql = sql.replace(prep, f"""{STOP_TABLE},
raw AS (SELECT *, {desc_tokens('description')} AS all_words FROM seg),
words AS (SELECT title_id, unnest(all_words) AS w, generate_subscripts(all_words, 1) AS place FROM raw),
kept AS (SELECT title_id, list(w ORDER BY place) AS ws FROM words WHERE w NOT IN (SELECT word FROM stops)
         GROUP BY title_id),
prep AS (SELECT raw.*, coalesce(kept.ws, []) AS desc_tokens FROM raw LEFT JOIN kept ON kept.title_id = raw.title_id)""")
    return sql.replace(vocab, f"(SELECT * FROM {vocab} WHERE word NOT IN (SELECT word FROM stops))").replace(STOPS, none)


def inferred(source: str, columns: list[str], key: str = "") -> str:
    """Column types of a relation, its values as text, by the narrowest type that fits every value."""
    keyed = f"{key}, " if key else ""
    parts = []
    for at, name in enumerate(columns):
        parts.append(f"SELECT {keyed}CAST({at} AS INTEGER) AS position, '{name}' AS column_name, "
                     f"NULLIF(CAST({name} AS VARCHAR), '') AS v FROM {source}")
    whole, real = "[+-]?[0-9]+", r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
    day, time = "[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"

    def all_fit(pattern, kind):
        return f"bool_and(regexp_full_match(v, '{pattern}') AND TRY_CAST(v AS {kind}) IS NOT NULL)"
    return f"""SELECT {keyed}position, column_name,
  CASE WHEN count(v) = 0 THEN 'string' WHEN {all_fit(whole, 'INTEGER')} THEN 'int' WHEN {all_fit(whole, 'BIGINT')} THEN 'bigint'
       WHEN {all_fit(real, 'DOUBLE')} THEN 'double' WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'boolean'
       WHEN {all_fit(day, 'DATE')} THEN 'date' WHEN {all_fit(f'{day}({time})?', 'TIMESTAMP')} THEN 'timestamp'
       ELSE 'string' END AS column_type,
  count(v) AS n_values, count(*) - count(v) AS n_nulls
FROM ({" UNION ALL ".join(parts)}) GROUP BY {keyed}position, column_name"""


def scored_ctes(src: str, name: str) -> str:
    """CTEs scoring relation ``src`` (``rid, platform, type, title, listed_in,
    release_year, desc_tokens``) into ``name`` with the four criteria and the total."""

    def part(list_name: str, tokens: str, alias: str) -> str:
        return f"""{name}_{alias} AS (
  SELECT x.rid, sum(w.weight) AS s
  FROM (SELECT rid, platform, type, unnest({tokens}) AS t FROM {src}) x
  JOIN weights w ON w.list = '{list_name}' AND w.term = x.t
   AND w.platform IS NOT DISTINCT FROM x.platform AND w.type IS NOT DISTINCT FROM x.type
  GROUP BY x.rid)"""

    return f""",
{part('description', 'desc_tokens', 'd')},
{part('genre', genre_score_terms('listed_in'), 'g')},
{part('title', title_terms('title'), 't')},
{name}_p AS (
  SELECT s.*,
         CAST(coalesce(d.s, 0) AS INTEGER) AS points_criterion_1,
         CAST(coalesce(g.s, 0) AS INTEGER) AS points_criterion_2,
         {year_points('s.release_year')} AS points_criterion_3,
         CAST(coalesce(t.s, 0) AS INTEGER) AS points_criterion_4
  FROM {src} s
  LEFT JOIN {name}_d d ON d.rid = s.rid
  LEFT JOIN {name}_g g ON g.rid = s.rid
  LEFT JOIN {name}_t t ON t.rid = s.rid),
{name} AS (
  SELECT *, CAST(points_criterion_1 + points_criterion_2 + points_criterion_3
                 + points_criterion_4 AS INTEGER) AS total_points FROM {name}_p)"""


def scored(whole: bool = False) -> str:
    return base(whole) + ",\nrows AS (SELECT title_id AS rid, * FROM prep)" + scored_ctes("rows", "scored") + """,
stats AS (SELECT platform, type, min(total_points) AS min_points, max(total_points) AS max_points
          FROM scored GROUP BY platform, type)"""


def scaled(whole: bool = False) -> str:
    return scored(whole) + f""",
scaled AS (
  SELECT s.*, {success('s.total_points', 'st.min_points', 'st.max_points')} AS sucesso
  FROM scored s JOIN stats st
    ON st.platform IS NOT DISTINCT FROM s.platform AND st.type IS NOT DISTINCT FROM s.type)"""


def top15(whole: bool = False) -> str:
    columns = ("title_id, title, listed_in, release_year, rating, description, points_criterion_1, "
               "points_criterion_2, points_criterion_3, points_criterion_4, total_points, sucesso")
    return scaled(whole) + f"""
SELECT {'' if whole else 'platform, type, '}{columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY platform, type
                               ORDER BY total_points DESC, title, title_id) AS rn FROM scaled)
WHERE rn <= 15"""


CAND_PREP = f""",
{CANDIDATES.strip()},
cand_prep AS (SELECT *, {desc_tokens('description')} AS desc_tokens FROM candidates)"""


def _report_sql_whole() -> str:
    """The reports of the ungrouped job: one heading a list, no segment."""
    sql = _report_sql().replace(base(), base(whole=True))
    kind = "platform || ' ' || (CASE type WHEN 'TV Show' THEN 'Séries' WHEN 'Movie' THEN 'Filmes' ELSE type END) || "
    assert kind in sql
    return f"SELECT report, line_no, line FROM ({sql.replace(kind, "'Catálogo' || ")})"


def _report_sql() -> str:
    kind = "(CASE type WHEN 'TV Show' THEN 'Séries' WHEN 'Movie' THEN 'Filmes' ELSE type END)"
    heads = []
    for report, title in (("top_desc_words", " - Top 10 Palavras das Descrições"),
                          ("top_genres", " - Top 5 Gêneros"),
                          ("top_title_words", " - Top 10 Palavras dos Títulos")):
        heads.append(f"SELECT platform, type, '{report}' AS report, CAST(1 AS INTEGER) AS line_no, "
                     f"platform || ' ' || {kind} || '{title}' AS line FROM sizes")
        heads.append(f"SELECT platform, type, '{report}', CAST(2 AS INTEGER), repeat('=', 50) FROM sizes")

    def lines(top: str, term: str, report: str, unit: str) -> str:
        return (f"SELECT platform, type, '{report}', CAST(rank + 2 AS INTEGER), "
                f"CAST(rank AS VARCHAR) || '. ' || {term} || ': ' || CAST(\"count\" AS VARCHAR) "
                f"|| ' {unit}' FROM {top}")

    body = "\nUNION ALL ".join(heads + [
        lines("desc_top", "word", "top_desc_words", "ocorrências"),
        lines("genre_top", "genre", "top_genres", "títulos"),
        lines("title_top", "word", "top_title_words", "ocorrências"),
    ])
    return (base() + ",\nsizes AS (SELECT platform, type, count(*) AS n FROM seg GROUP BY platform, type)\n"
            + body)


# The columns of the orders table.
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def oracle_sql() -> dict[str, str]:
    BASE, SCORED, SCALED, TOP15 = base(), scored(), scaled(), top15()
    cand_success = SCORED + CAND_PREP + ",\ncrows AS (SELECT cand_id AS rid, * FROM cand_prep)" + scored_ctes(
        "crows", "cscored") + f"""
SELECT c.cand_id, c.title,
       {success('c.total_points', 'least(coalesce(st.min_points, c.total_points), c.total_points)',
                'greatest(coalesce(st.max_points, c.total_points), c.total_points)')} AS sucesso
FROM cscored c LEFT JOIN stats st
  ON st.platform IS NOT DISTINCT FROM c.platform AND st.type IS NOT DISTINCT FROM c.type"""

    # Every candidate in its own copy of its segment's range: titles and that candidate alone.
    union_form = BASE + CAND_PREP + """,
urows AS (
  SELECT 't' || CAST(title_id AS VARCHAR) AS rid, CAST(NULL AS BIGINT) AS cand_id, platform, type, title,
         listed_in, release_year, desc_tokens FROM prep
  UNION ALL
  SELECT 'c' || CAST(cand_id AS VARCHAR), cand_id, platform, type, title, listed_in, release_year,
         desc_tokens FROM cand_prep)""" + scored_ctes("urows", "uscored") + f""",
ustats AS (
  SELECT c.cand_id, min(u.total_points) AS mn, max(u.total_points) AS mx
  FROM uscored c JOIN uscored u
    ON u.platform IS NOT DISTINCT FROM c.platform AND u.type IS NOT DISTINCT FROM c.type
   AND (u.cand_id IS NULL OR u.cand_id = c.cand_id)
  WHERE c.cand_id IS NOT NULL GROUP BY c.cand_id)
SELECT u.cand_id, u.title, {success('u.total_points', 's.mn', 's.mx')} AS sucesso
FROM uscored u JOIN ustats s ON s.cand_id = u.cand_id"""

    return {
        "catalog": f"WITH {CATALOG}\nSELECT * FROM catalog",
        "segment_sizes": BASE + "\nSELECT platform, type, count(*) AS n FROM seg GROUP BY platform, type",
        "desc_clean": BASE + "\nSELECT title_id, array_to_string(desc_tokens, ' ') AS description_scraped FROM prep",
        "top_desc_words": BASE + "\nSELECT * FROM desc_top",
        "top_desc_words_global": BASE + """
SELECT word, CAST(count(*) AS BIGINT) AS "count"
FROM (SELECT unnest(desc_tokens) AS word FROM prep) GROUP BY word
ORDER BY "count" DESC, word LIMIT 10""",
        "top_genres": BASE + "\nSELECT * FROM genre_top",
        "top_title_words": BASE + "\nSELECT * FROM title_top",
        "rank_weights": BASE + "\nSELECT * FROM weights",
        "score_description": SCORED + "\nSELECT title_id, points_criterion_1 FROM scored",
        "score_genres": SCORED + "\nSELECT title_id, points_criterion_2 FROM scored",
        "score_year": SCORED + "\nSELECT title_id, points_criterion_3 FROM scored",
        "score_title": SCORED + "\nSELECT title_id, points_criterion_4 FROM scored",
        "total_points": SCORED + """
SELECT title_id, points_criterion_1, points_criterion_2, points_criterion_3, points_criterion_4,
       total_points FROM scored""",
        "segment_stats": SCORED + "\nSELECT * FROM stats",
        "success_scaled": SCALED + "\nSELECT title_id, total_points, sucesso FROM scaled",
        "top15_titles": TOP15,
        "candidates": f"WITH {CANDIDATES}\nSELECT * FROM candidates",
        "catalog_with_candidates": BASE + CAND_PREP + """
SELECT platform, type, false AS is_candidate, title_id AS row_id, title, listed_in, release_year,
       rating, description, array_to_string(desc_tokens, ' ') AS description_scraped FROM prep
UNION ALL
SELECT platform, type, true, cand_id, title, listed_in, release_year, rating, description,
       array_to_string(desc_tokens, ' ') FROM cand_prep""",
        "candidate_success": cand_success,
        "candidate_success_union": union_form,
        "report_lines": _report_sql(),
        "csv_round_trip": TOP15,
        "catalog_csv": f"WITH {CATALOG}\nSELECT * FROM catalog",
        "top15_from_csv": TOP15,
        "success_scaled_global": scaled(whole=True) + "\nSELECT title_id, total_points, sucesso FROM scaled",
        "top15_titles_global": top15(whole=True),
        "catalog_inferred": f"WITH {CATALOG}\n" + inferred("catalog", [
            "title_id", "type", "title", "listed_in", "release_year", "rating", "description"], "platform"),
        "orders_inferred": inferred("orders", ORDERS),
        "orders_typed": """
SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS last_key, CAST(min(o_orderdate) AS DATE) AS first_date,
       CAST(max(o_totalprice) AS DOUBLE) AS largest FROM orders GROUP BY o_orderpriority""",
        "top_desc_words_stop_table": base_with_stop_table() + "\nSELECT * FROM desc_top",
        "top_title_words_stop_table": base_with_stop_table() + "\nSELECT * FROM title_top",
        "desc_clean_stop_table": base_with_stop_table() + """
SELECT title_id, array_to_string(desc_tokens, ' ') AS description_scraped FROM prep""",
        "total_points_stop_table": (
            base_with_stop_table() + ",\nrows AS (SELECT title_id AS rid, * FROM prep)"
            + scored_ctes("rows", "scored").replace(STOPS, "['']") + """
SELECT title_id, points_criterion_1, points_criterion_2, points_criterion_3, points_criterion_4,
       total_points FROM scored"""),
        "top_desc_words_two_pass": BASE + "\nSELECT * FROM desc_top",
        "title_ranks": SCORED + """
SELECT platform, type, title_id, total_points,
       row_number() OVER (PARTITION BY platform, type ORDER BY total_points DESC, title, title_id) AS rank FROM scored""",
        "report_lines_global": _report_sql_whole(),
        "csv_round_trip_global": top15(whole=True),
        # Batches and publications change how the rows come about, not which they are.
        "csv_published": TOP15,
        "top15_incremental": TOP15,
        "segment_stats_incremental": SCORED + "\nSELECT * FROM stats",
    }
