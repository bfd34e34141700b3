"""The registered queries once more, in the SQL of an embedded engine, for cross-checking.

Written from the operators' definitions, step by step where the Spark side takes a
shortcut: clean-up in six passes, edges one by one, every pair of documents.
"""

from __future__ import annotations

from lectern.functions.tokens import BOILERPLATE, UNICODE_SPACES

# The English stop words of three or more plain letters.
STOP_WORDS = """
myself our ours ourselves you your yours yourself yourselves him his himself she her
hers herself its itself they them their theirs themselves what which who whom this that
these those are was were been being have has had having does did doing the and but
because until while for with about against between into through during before after
above below from down out off over under again further then once here there when where
why how all any both each few more most other some such nor not only own same than too
very can will just don should now cannot could ought would
""".split()

AUTHOR_CLASS = r"[\p{L}\p{N}_.\t-\r\x1c-\x1f\x{85}\p{Z}]"
SPACE_CLASS = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


STOP_LIST = ", ".join(quoted(word) for word in STOP_WORDS)
SPACES = quoted(UNICODE_SPACES)

# Views

def books(credit: str) -> str:
    return f"""books AS (SELECT concat('book', d.doc_id) AS file_name,
    concat('Title: ', p.p_name, chr(10),
      'Release Date: ', strftime(o.o_orderdate, '%B %-d, %Y'), chr(10),
      'Language: ', d.lang, chr(10), 'Character set encoding: UTF-8', chr(10),
      '{credit} Customer ', CAST(o.o_custkey AS VARCHAR), ';', chr(10),
      '*** START OF THIS BOOK ***', chr(10), d.text) AS text
  FROM documents d
  LEFT JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN part p ON p.p_partkey = d.doc_id)"""


BOOKS = books("Author:")
BOOKS_BY = books("by")

BOOKS_MARKED = """marked AS (SELECT doc_id, CASE CAST(doc_id % 3 AS INT)
    WHEN 0 THEN concat('Front matter', chr(10), '*** START OF THIS BOOK ***', chr(10), text, chr(10),
      '*** END OF THIS BOOK ***', chr(10), 'Back matter')
    WHEN 1 THEN concat('This eBook is for the use of anyone anywhere.', chr(10), chr(10), text, chr(10),
      'End of the Project Gutenberg book', chr(10), 'Back matter')
    ELSE concat('Project Gutenberg''s Book, produced by Volunteers', chr(10), chr(10), text, chr(10),
      'End of Project Gutenberg book', chr(10), 'Back matter') END AS text
  FROM documents)"""

TEXT_LINES = "lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"

DOCUMENT_LINES = r"""lines AS (SELECT unnest(string_split(regexp_replace(text, '\n\z', ''), chr(10))) AS value
  FROM documents WHERE text <> '')"""

# Word counts

BLANKS = "'[ \\t\\n\\r\\f]+'"
BLANK_TOKENS = f"""tokens AS (SELECT doc_id, word FROM (
  SELECT doc_id, unnest(string_split_regex(text, {BLANKS})) AS word FROM documents) WHERE word <> '')"""
BARE_TOKENS = rf"""tokens AS (SELECT word FROM (
  SELECT unnest(string_split_regex(regexp_replace(text, '\p{{P}}', '', 'g'), {BLANKS})) AS word
  FROM documents) WHERE word <> '')"""
CLEAN_TOKENS = r"""tokens AS (SELECT word FROM (
  SELECT unnest(string_split_regex(lower(text), '[\t\n\x0B\f\r ]+')) AS word FROM documents)
  WHERE regexp_matches(word, '^[a-z'']+$') AND NOT contains(word, ''''''))"""
COUNTS = 'SELECT word, count(*) AS "count" FROM tokens GROUP BY word'

WORD_COUNTS = {
    "word_count": with_ctes(BLANK_TOKENS, select=COUNTS),
    "word_frequency_split": with_ctes(
        DOCUMENT_LINES,
        r"""tokens AS (SELECT unnest(CASE
          WHEN value = '' THEN ['']
          WHEN regexp_full_match(value, '[\t\n\x0B\f\r ]+') THEN []
          ELSE string_split_regex(regexp_replace(value, '[\t\n\x0B\f\r ]+\z', ''), '[\t\n\x0B\f\r ]+')
          END) AS word FROM lines)""",
        select=COUNTS,
    ),
    "word_count_no_punct": with_ctes(BARE_TOKENS, select=COUNTS),
    "clean_word_count": with_ctes(CLEAN_TOKENS, select=COUNTS),
    "top_words": with_ctes(CLEAN_TOKENS, select=COUNTS + ' ORDER BY "count" DESC, word LIMIT 1000'),
    "unique_word_count": with_ctes(
        CLEAN_TOKENS, select="SELECT count(DISTINCT word) AS unique_words FROM tokens"
    ),
    "token_pairs": with_ctes(
        BLANK_TOKENS, select="SELECT doc_id, word, CAST(1 AS INTEGER) AS one FROM tokens"
    ),
    "word_count_by_split": with_ctes(
        BLANK_TOKENS,
        f"counts AS ({COUNTS})",
        select='SELECT CAST(s.split_mb AS INTEGER) AS split_mb, word, "count" '
        "FROM counts, (SELECT unnest([1, 2, 4, 8]) AS split_mb) s",
    ),
}

# Header metadata

METADATA_FIELDS = r"""
    regexp_extract(value, 'Title:[\t\n\x0B\f\r ]*([^\n]+)', 1) AS title,
    regexp_extract(value, 'Release Date:[\t\n\x0B\f\r ]*(\w+[\t\n\x0B\f\r ]+\d{1,2},[\t\n\x0B\f\r ]*\d{4})', 1)
      AS release_date,
    regexp_extract(value, 'Language:[\t\n\x0B\f\r ]*(\w+)', 1) AS language,
    regexp_extract(value, 'Character set encoding:[\t\n\x0B\f\r ]*(\w+[-\w]*)', 1) AS encoding"""


def metadata_ctes(rows: str) -> list[str]:
    return [
        BOOKS,
        f"lines AS ({rows})",
        f"fields AS (SELECT {METADATA_FIELDS} FROM lines)",
        """metadata AS (SELECT * FROM fields
          WHERE title <> '' OR release_date <> '' OR language <> '' OR encoding <> '')""",
    ]


BY_LINE = metadata_ctes(
    r"SELECT unnest(string_split(regexp_replace(text, '\n\z', ''), chr(10))) AS value FROM books"
)
BY_DOCUMENT = metadata_ctes("SELECT text AS value FROM books")
YEARS = r"""years AS (SELECT year, count(*) AS "count" FROM (
    SELECT regexp_extract(release_date, '\d{4}') AS year FROM metadata)
  WHERE regexp_matches(year, '^[12][0-9]{3}$') GROUP BY year)"""
LANGUAGES = """languages AS (SELECT language, count(*) AS "count" FROM metadata
  WHERE language <> '' GROUP BY language)"""
TITLES = "titles AS (SELECT length(title) AS title_length FROM metadata WHERE title <> '')"

METADATA = {
    "header_metadata": with_ctes(*BY_LINE, select="SELECT * FROM metadata"),
    "header_metadata_by_document": with_ctes(*BY_DOCUMENT, select="SELECT * FROM metadata"),
    "releases_per_year": with_ctes(*BY_LINE, YEARS, select="SELECT * FROM years"),
    "release_year_stats": with_ctes(
        *BY_LINE,
        YEARS,
        select="""SELECT CAST(sum("count") AS BIGINT) AS total_books, min(year) AS earliest_year,
          max(year) AS latest_year FROM years""",
    ),
    "top_release_years": with_ctes(
        *BY_LINE, YEARS, select='SELECT * FROM years ORDER BY "count" DESC, year LIMIT 20'
    ),
    "language_counts": with_ctes(*BY_LINE, LANGUAGES, select="SELECT * FROM languages"),
    "language_summary": with_ctes(
        *BY_LINE,
        LANGUAGES,
        select="""SELECT language AS top_language, "count" AS top_count,
          (SELECT CAST(sum("count") AS BIGINT) FROM languages) AS total_books
          FROM languages ORDER BY "count" DESC, language LIMIT 1""",
    ),
    "title_length_stats": with_ctes(
        *BY_LINE,
        TITLES,
        select="""SELECT round(avg(title_length), 6) AS avg_length,
          CAST(min(title_length) AS INTEGER) AS min_length,
          CAST(max(title_length) AS INTEGER) AS max_length, count(*) AS total_titles FROM titles""",
    ),
    "title_length_histogram": with_ctes(
        *BY_LINE,
        TITLES,
        select="""SELECT CAST(title_length // 10 * 10 AS INTEGER) AS length_range, count(*) AS "count"
          FROM titles GROUP BY 1""",
    ),
    "missing_field_report": with_ctes(
        *BY_LINE,
        select="SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE {f} IS NULL OR {f} = '') AS missing_{f}"
            for f in ["title", "release_date", "language", "encoding"]
        )
        + " FROM metadata",
    ),
    "metadata_row_counts": with_ctes(
        *BY_LINE,
        select="""SELECT (SELECT count(*) FROM lines) AS rows_read,
          (SELECT count(*) FROM metadata) AS rows_with_metadata""",
    ),
}

# Cleaning and tokens


def stripped(source: str, key: str) -> str:
    expression = "text"
    for pattern in BOILERPLATE:
        expression = f"regexp_replace({expression}, {quoted(pattern)}, '', 'gis')"
    return f"stripped AS (SELECT {key}, trim({expression}, {SPACES}) AS text FROM {source})"


def cleaned(source: str, key: str) -> str:
    expression = "lower(text)"
    for pattern, blank in [
        (r"\n+", " "),
        (r"[\t\n\x0B\f\r ]+", " "),
        (r"[^a-z ]", " "),
        (r"\b\w{1,2}\b", ""),
        (r" +", " "),
    ]:
        expression = f"regexp_replace({expression}, '{pattern}', '{blank}', 'g')"
    return f"cleaned AS (SELECT {key}, trim({expression}) AS cleaned_text FROM {source})"


def numbered_words(key: str) -> list[str]:
    return [
        f"arrays AS (SELECT {key}, string_split_regex(cleaned_text, ' +') AS words FROM cleaned)",
        f"""numbered AS (SELECT {key}, unnest(words) AS word, generate_subscripts(words, 1) AS place
          FROM arrays)""",
        "words AS (SELECT * FROM numbered WHERE length(word) >= 3)",
        f"filtered AS (SELECT * FROM words WHERE word NOT IN ({STOP_LIST}))",
    ]


MARKED_WORDS = [
    BOOKS_MARKED,
    stripped("marked", "doc_id"),
    cleaned("stripped", "doc_id"),
    *numbered_words("doc_id"),
]
DOCUMENT_WORDS = [
    stripped("documents", "doc_id"),
    cleaned("stripped", "doc_id"),
    *numbered_words("doc_id"),
]


def joined_words(table: str, name: str, documents: str) -> str:
    return f"""SELECT d.doc_id, coalesce(w.joined, '') AS {name} FROM {documents} d LEFT JOIN
      (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS joined FROM {table} GROUP BY doc_id) w
      ON w.doc_id = d.doc_id"""


CLEANING = {
    "strip_boilerplate": with_ctes(
        BOOKS_MARKED, stripped("marked", "doc_id"), select="SELECT doc_id, text FROM stripped"
    ),
    "normalize_text": with_ctes(
        cleaned("documents", "doc_id"), select="SELECT doc_id, cleaned_text FROM cleaned"
    ),
    "tokenize": with_ctes(*MARKED_WORDS, select=joined_words("words", "words", "marked")),
    "remove_stop_words": with_ctes(
        *MARKED_WORDS, select=joined_words("filtered", "filtered_words", "marked")
    ),
    "filter_effect_stats": with_ctes(
        *MARKED_WORDS,
        select="""SELECT
          round((SELECT count(*) FROM words) / (SELECT count(*) FROM marked), 6) AS avg_words_before,
          round((SELECT count(*) FROM filtered) / (SELECT count(*) FROM marked), 6) AS avg_words_after""",
    ),
}

# Term weights


def weight_ctes(key: str) -> list[str]:
    return [
        f"texts AS (SELECT {key}, doc_id, text FROM documents)",
        stripped("texts", key),
        cleaned("stripped", key),
        *numbered_words(key),
        f"counts AS (SELECT {key}, word, count(*) AS term_count FROM filtered GROUP BY ALL)",
        f"totals AS (SELECT {key}, count(*) AS total_terms FROM filtered GROUP BY ALL)",
        f"corpus AS (SELECT count(DISTINCT {key}) AS documents FROM documents)",
        f"""tf AS (SELECT {key}, word, term_count, total_terms, term_count / total_terms AS tf
          FROM counts JOIN totals USING ({key}))""",
        f"""idf AS (SELECT word, count(DISTINCT {key}) AS doc_freq, count(*) AS total_times_used,
          count(DISTINCT {key}) / any_value(documents) * 100 AS docs_containing_percent,
          ln(any_value(documents) / count(DISTINCT {key})) AS idf_score
          FROM filtered, corpus GROUP BY word)""",
        f"""weights AS (SELECT {key}, word, tf, idf_score AS idf, tf * idf_score AS tfidf
          FROM tf JOIN idf USING (word))""",
    ]


BY_DOC = weight_ctes("doc_id")
BY_SOURCE = weight_ctes("source")


def ranked(table: str, score: str) -> str:
    return f"""SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY {score} DESC, word) AS INTEGER)
      AS rank FROM {table} QUALIFY rank <= 10"""


IDF_COLUMNS = """word, doc_freq, total_times_used,
  round(docs_containing_percent, 6) AS docs_containing_percent, round(idf_score, 6) AS idf_score"""
WEIGHT_COLUMNS = "doc_id, word, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf"

TERMS = {
    "term_frequency": with_ctes(
        *BY_DOC, select="SELECT doc_id, word, term_count, total_terms, round(tf, 6) AS tf FROM tf"
    ),
    "top_terms_by_tf": with_ctes(
        *BY_DOC,
        select=f"""SELECT doc_id, rank, word, term_count, total_terms, round(tf, 6) AS tf
          FROM ({ranked("tf", "tf")})""",
    ),
    "idf_stats": with_ctes(*BY_DOC, select=f"SELECT {IDF_COLUMNS} FROM idf"),
    "most_common_words": with_ctes(
        *BY_DOC, select=f"SELECT {IDF_COLUMNS} FROM idf ORDER BY doc_freq DESC, word LIMIT 10"
    ),
    "rarest_shared_words": with_ctes(
        *BY_DOC,
        select=f"SELECT {IDF_COLUMNS} FROM idf WHERE doc_freq > 1 ORDER BY doc_freq, word LIMIT 10",
    ),
    "tf_idf": with_ctes(*BY_DOC, select=f"SELECT {WEIGHT_COLUMNS} FROM weights"),
    "top_tfidf_overall": with_ctes(
        *BY_DOC,
        select=f"""SELECT {WEIGHT_COLUMNS} FROM
          (SELECT * FROM weights ORDER BY tfidf DESC, doc_id, word LIMIT 10)""",
    ),
    "top_terms_by_tfidf": with_ctes(
        *BY_DOC,
        select=f"""SELECT doc_id, rank, word, round(tfidf, 6) AS tfidf
          FROM ({ranked("weights", "tfidf")})""",
    ),
}

# Vectors and similarity

VOCABULARY = """vocabulary AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS index
  FROM (SELECT DISTINCT word FROM weights))"""

PAIRS = [
    "names AS (SELECT DISTINCT source FROM weights)",
    "norms AS (SELECT source, sqrt(sum(tfidf * tfidf)) AS norm FROM weights GROUP BY source)",
    """dots AS (SELECT a.source AS book1, b.source AS book2, sum(a.tfidf * b.tfidf) AS dot
      FROM weights a JOIN weights b ON a.word = b.word AND a.source < b.source GROUP BY ALL)""",
    """pairs AS (SELECT a.source AS book1, b.source AS book2,
        coalesce(CASE WHEN na.norm = 0 OR nb.norm = 0 THEN 0 ELSE dot / (na.norm * nb.norm) END, 0)
          AS similarity
      FROM names a JOIN names b ON a.source < b.source
      JOIN norms na ON na.source = a.source JOIN norms nb ON nb.source = b.source
      LEFT JOIN dots ON book1 = a.source AND book2 = b.source)""",
    "published AS (SELECT book1, book2, round(similarity, 4) AS similarity FROM pairs)",
]

SIMILARITY = {
    "vocabulary": with_ctes(*BY_DOC, VOCABULARY, select="SELECT word, index FROM vocabulary"),
    "vocabulary_size": with_ctes(
        *BY_DOC, select="SELECT count(DISTINCT word) AS dimensions FROM weights"
    ),
    "tfidf_vectors": with_ctes(
        *BY_DOC,
        VOCABULARY,
        select="""SELECT doc_id, (SELECT CAST(count(*) AS INTEGER) FROM vocabulary) AS size,
          string_agg(CAST(index AS VARCHAR), ',' ORDER BY index) AS indices,
          string_agg(CAST(CAST(tfidf AS DECIMAL(18, 6)) AS VARCHAR), ',' ORDER BY index) AS "values"
          FROM weights JOIN vocabulary USING (word) GROUP BY doc_id""",
    ),
    "tfidf_vector_chunks": with_ctes(
        *BY_SOURCE,
        VOCABULARY,
        select="""SELECT source, CAST(index // 256 AS INTEGER) AS chunk,
          string_agg(CAST(index AS VARCHAR), ',' ORDER BY index) AS indices,
          string_agg(CAST(CAST(tfidf AS DECIMAL(18, 6)) AS VARCHAR), ',' ORDER BY index) AS "values"
          FROM weights JOIN vocabulary USING (word) GROUP BY source, index // 256""",
    ),
    "pairwise_cosine": with_ctes(
        *BY_SOURCE, *PAIRS, select="SELECT * FROM published WHERE similarity >= 0.05"
    ),
    "similar_documents": with_ctes(
        *BY_DOC,
        """vectors AS (SELECT doc_id, list((word, tfidf) ORDER BY word) FILTER (WHERE tfidf <> 0) AS vector
          FROM weights GROUP BY doc_id)""",
        """classes AS (SELECT doc_id,
          CASE WHEN vector IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY vector) END AS class_id
          FROM vectors)""",
        "norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM weights GROUP BY doc_id)",
        """units AS (SELECT doc_id, word, tfidf / norm AS unit FROM weights JOIN norms USING (doc_id)
          WHERE tfidf <> 0)""",
        """links AS (SELECT a.doc_id, b.doc_id AS other
          FROM units a JOIN units b ON a.word = b.word AND a.doc_id <> b.doc_id
          GROUP BY ALL HAVING round(sum(a.unit * b.unit), 4) >= 0.8)""",
        select="""SELECT doc_id, class_id, count(other) AS links
          FROM classes LEFT JOIN links USING (doc_id) GROUP BY ALL""",
    ),
    "most_similar_pairs": with_ctes(
        *BY_SOURCE,
        *PAIRS,
        select="SELECT * FROM published ORDER BY similarity DESC, book1, book2 LIMIT 10",
    ),
    "similarity_stats": with_ctes(
        *BY_SOURCE,
        *PAIRS,
        select="""SELECT round(avg(similarity), 4) AS average_similarity,
          round(min(similarity), 4) AS min_similarity, round(max(similarity), 4) AS max_similarity
          FROM pairs""",
    ),
    "least_similar_pairs": with_ctes(
        *BY_SOURCE,
        *PAIRS,
        select="SELECT * FROM published ORDER BY similarity, book1, book2 LIMIT 10",
    ),
    "vector_stats": with_ctes(
        *BY_DOC,
        select="""SELECT doc_id, count(*) FILTER (WHERE tfidf <> 0) AS unique_terms,
          round(coalesce(avg(tfidf) FILTER (WHERE tfidf <> 0), 0), 6) AS mean_tfidf,
          round(coalesce(max(tfidf) FILTER (WHERE tfidf <> 0), 0), 6) AS max_tfidf,
          round((1 - count(*) FILTER (WHERE tfidf <> 0)
            / (SELECT count(DISTINCT word) FROM weights)) * 100, 6) AS sparsity
          FROM weights GROUP BY doc_id""",
    ),
    "find_similar": with_ctes(
        *BY_DOC,
        "target AS (SELECT word, tfidf AS wanted FROM weights WHERE doc_id = 0)",
        "target_norm AS (SELECT sqrt(sum(wanted * wanted)) AS norm FROM target)",
        """scored AS (SELECT doc_id, coalesce(sum(tfidf * wanted), 0) AS dot,
            sqrt(sum(tfidf * tfidf)) * (SELECT norm FROM target_norm) AS norms
          FROM weights LEFT JOIN target USING (word) WHERE doc_id <> 0 GROUP BY doc_id)""",
        select="""SELECT doc_id, round(CASE WHEN norms = 0 THEN 0 ELSE dot / norms END, 4) AS similarity
          FROM scored ORDER BY similarity DESC, doc_id LIMIT 5""",
    ),
}

# Author network

RECORDS = rf"""cues AS (SELECT file_name, text,
    regexp_extract(text, '(?i)by{SPACE_CLASS}+({AUTHOR_CLASS}+)', 0) AS by_match,
    regexp_extract(text, '(?i)by{SPACE_CLASS}+({AUTHOR_CLASS}+)', 1) AS by_name,
    regexp_extract(text, '(?i)Author:{SPACE_CLASS}*({AUTHOR_CLASS}+)', 1) AS header_name,
    regexp_extract(text, '\p{{Nd}}{{4}}') AS date FROM books),
named AS (SELECT *, trim(CASE WHEN by_match <> '' THEN by_name ELSE header_name END, {SPACES}) AS name
  FROM cues),
records AS (SELECT file_name, CASE WHEN name = '' THEN 'Unknown' ELSE name END AS author,
  CASE WHEN date = '' THEN 'Unknown' ELSE date END AS release_date,
  round(octet_length(encode(text)) / 1048576, 2) AS size_mb FROM named)"""

DATES = """dates AS (SELECT DISTINCT author, coalesce(
    CASE WHEN regexp_full_match(release_date, '[0-9]{4}')
      THEN TRY_CAST(concat(release_date, '-01-01') AS DATE) END,
    CAST(try_strptime(release_date, ['%B %d, %Y', '%m/%d/%Y', '%Y-%m-%d']) AS DATE)) AS date
  FROM records WHERE author <> 'Unknown'),
known AS (SELECT author, date FROM dates WHERE date IS NOT NULL AND year(date) >= 1)"""

EDGES = """edges AS (SELECT a.author AS influencer, b.author AS influenced,
    CAST(year(b.date) AS INTEGER) AS later_year,
    CAST(year(b.date) - year(a.date) AS INTEGER) AS year_difference
  FROM known a JOIN known b ON a.author <> b.author
    AND year(b.date) - year(a.date) BETWEEN 1 AND 5)"""

ACTIVE = """active AS (SELECT author, CAST(year(date) AS INTEGER) AS year, count(*) AS dates FROM known GROUP BY ALL)"""

NETWORK_CTES = [BOOKS_BY, RECORDS, DATES, EDGES]

DEGREES = """degrees AS (SELECT author, CAST(sum(incoming) AS BIGINT) AS in_degree,
    CAST(sum(outgoing) AS BIGINT) AS out_degree, CAST(sum(incoming + outgoing) AS BIGINT) AS total_degree
  FROM (SELECT influenced AS author, 1 AS incoming, 0 AS outgoing FROM edges
    UNION ALL SELECT influencer, 0, 1 FROM edges) GROUP BY author)"""


def end_stats(name: str, count: str) -> str:
    return f"""SELECT {name}, count(*) AS {count}, round(avg(year_difference), 2) AS avg_years,
      min(year_difference) AS min_years, max(year_difference) AS max_years
      FROM edges GROUP BY {name} ORDER BY {count} DESC, {name} LIMIT 5"""


NETWORK = {
    "author_date": with_ctes(BOOKS, RECORDS, select="SELECT * FROM records"),
    "author_dates": with_ctes(BOOKS_BY, RECORDS, DATES, select="SELECT * FROM known"),
    "influence_edges": with_ctes(
        *NETWORK_CTES,
        select="""SELECT influencer, influenced, later_year, year_difference, count(*) AS edges
          FROM edges GROUP BY influencer, influenced, later_year, year_difference""",
    ),
    "influence_classes": with_ctes(
        *NETWORK_CTES,
        ACTIVE,
        select="""SELECT a.year AS earlier_year, a.dates AS earlier_dates, b.year AS later_year, b.dates AS later_dates,
            CAST(b.year - a.year AS INTEGER) AS year_difference, count(*) AS pairs,
            CAST(sum(a.dates * b.dates) AS BIGINT) AS edges
          FROM active a JOIN active b ON a.author <> b.author AND b.year - a.year BETWEEN 1 AND 5 GROUP BY ALL""",
    ),
    "influence_members": with_ctes(
        *NETWORK_CTES,
        ACTIVE,
        select="""SELECT a.author, a.year, a.dates, count(*) FILTER (WHERE b.year > a.year) AS out_links,
            count(*) FILTER (WHERE b.year < a.year) AS in_links
          FROM active a LEFT JOIN active b ON a.author <> b.author AND abs(b.year - a.year) BETWEEN 1 AND 5
          GROUP BY a.author, a.year, a.dates""",
    ),
    "influence_of_author": with_ctes(
        *NETWORK_CTES,
        select="""SELECT influencer, influenced, later_year, year_difference, count(*) AS edges
          FROM edges WHERE (SELECT min(author) FROM known) IN (influencer, influenced)
          GROUP BY influencer, influenced, later_year, year_difference""",
    ),
    "influencer_stats": with_ctes(*NETWORK_CTES, select=end_stats("influencer", "influence_count")),
    "influenced_stats": with_ctes(*NETWORK_CTES, select=end_stats("influenced", "times_influenced")),
    "year_gap_stats": with_ctes(
        *NETWORK_CTES,
        select="""SELECT round(avg(year_difference), 6) AS avg_years,
          min(year_difference) AS min_years, max(year_difference) AS max_years FROM edges""",
    ),
    "network_summary": with_ctes(
        *NETWORK_CTES,
        DEGREES,
        select="""SELECT (SELECT count(*) FROM degrees) AS unique_authors, count(*) AS "count",
          round(avg(year_difference), 6) AS mean, round(stddev_samp(year_difference), 6) AS std,
          min(year_difference) AS "min", quantile_cont(year_difference, 0.25) AS p25,
          quantile_cont(year_difference, 0.5) AS p50, quantile_cont(year_difference, 0.75) AS p75,
          max(year_difference) AS "max" FROM edges""",
    ),
    "degree_metrics": with_ctes(*NETWORK_CTES, DEGREES, select="SELECT * FROM degrees"),
    "degree_top_in": with_ctes(
        *NETWORK_CTES,
        DEGREES,
        select="SELECT author, in_degree FROM degrees ORDER BY in_degree DESC, author LIMIT 5",
    ),
    "degree_top_out": with_ctes(
        *NETWORK_CTES,
        DEGREES,
        select="SELECT author, out_degree FROM degrees ORDER BY out_degree DESC, author LIMIT 5",
    ),
    "degree_top_total": with_ctes(
        *NETWORK_CTES,
        DEGREES,
        select="SELECT * FROM degrees ORDER BY total_degree DESC, author LIMIT 10",
    ),
    "degree_stats": with_ctes(
        *NETWORK_CTES,
        DEGREES,
        select="""SELECT round(avg(in_degree), 6) AS avg_in_degree,
          round(avg(out_degree), 6) AS avg_out_degree,
          max(in_degree) AS max_in_degree, max(out_degree) AS max_out_degree FROM degrees""",
    ),
    "book_profile": with_ctes(
        BOOKS,
        RECORDS,
        select="\nUNION ALL ".join(
            f"""SELECT '{name}' AS column_name, '{kind}' AS data_type,
              count({name}) AS non_null_count, count(*) AS total_books FROM records"""
            for name, kind in [
                ("file_name", "string"),
                ("author", "string"),
                ("release_date", "string"),
                ("size_mb", "double"),
            ]
        ),
    ),
}

# Sources and sinks. A written text ends in one more line end than the table's.

VOLUMES = """volumes AS (SELECT *, octet_length(encode(text)) AS size_bytes FROM (
  SELECT CAST(doc_id // 100 AS VARCHAR) AS file_name,
    concat(string_agg(text, chr(10) ORDER BY doc_id), chr(10)) AS text
  FROM documents GROUP BY doc_id // 100))"""

SOURCES = {
    "scan_lines": with_ctes(TEXT_LINES, select="SELECT value FROM lines"),
    "scan_documents": with_ctes(VOLUMES, select="SELECT * FROM volumes"),
    "skipped_documents": """SELECT CAST(doc_id // 100 AS VARCHAR) AS file_name,
        CAST(sum(octet_length(encode(text)) + 3) AS BIGINT) AS size_bytes
      FROM documents WHERE (doc_id // 100) % 2 = 1 GROUP BY 1""",
    "with_file_name": with_ctes(
        VOLUMES,
        select="SELECT file_name, len(string_split(text, chr(10))) - 1 AS lines FROM volumes",
    ),
    "source_listing": with_ctes(
        VOLUMES, select="SELECT file_name, round(size_bytes / 1048576, 2) AS size_mb FROM volumes"
    ),
    "write_csv": METADATA["header_metadata"],
    "write_parquet": with_ctes(
        *DOCUMENT_WORDS, select=joined_words("filtered", "filtered_words", "documents")
    ),
    "write_tsv_sorted": with_ctes(
        BARE_TOKENS,
        f"counts AS ({COUNTS})",
        select="""SELECT concat(word, chr(9), "count") AS value FROM counts""",
    ),
    "scan_with_split_size": with_ctes(
        TEXT_LINES,
        select="""SELECT CAST(s.split_mb AS INTEGER) AS split_mb, count(*) AS lines,
          CAST(sum(length(value)) AS BIGINT) AS characters
          FROM lines, (SELECT unnest([1, 2, 4, 8]) AS split_mb) s GROUP BY 1""",
    ),
}

ORACLES: dict[str, str] = {
    **SOURCES, **WORD_COUNTS, **METADATA, **CLEANING, **TERMS, **SIMILARITY, **NETWORK
}
