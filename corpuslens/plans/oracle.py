"""The same results in plain DuckDB SQL, written independently of the Spark plans."""

from corpuslens.functions.patterns import END_MARKERS, START_MARKERS, STOP_WORDS

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# --- books with headers and footers -----------------------------------------
BOOKS = r"""books AS (
  SELECT d.doc_id,
    'The Project Gutenberg EBook of ' || p_name || ', by Writer ' || w || chr(10) || chr(10)
    || CASE WHEN d.doc_id % 11 = 0 THEN ''
            ELSE 'Title: ' || p_name || ' ' || d.doc_id || chr(10) END
    || CASE WHEN d.doc_id % 19 = 0 THEN ''
            WHEN d.doc_id % 17 = 0 THEN 'Author: Various' || chr(10)
            WHEN d.doc_id % 5 = 0 THEN 'Author: Writer ' || w || ' (1812-1870)' || chr(10)
            ELSE 'Author: Writer ' || w || chr(10) END
    || CASE WHEN d.doc_id % 13 = 0 THEN ''
            WHEN d.doc_id % 7 = 0 THEN 'Posting Date: ' || day || chr(10)
            ELSE 'Release Date: ' || day || ' [EBook #' || d.doc_id || ']' || chr(10) END
    || CASE WHEN d.doc_id % 23 = 0 THEN ''
            ELSE 'Language: ' || CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French'
                 WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END || chr(10) END
    || CASE WHEN d.doc_id % 29 = 0 THEN ''
            ELSE 'Character set encoding: '
                 || CASE WHEN d.doc_id % 2 = 0 THEN 'UTF-8' ELSE 'ASCII' END || chr(10) END
    || chr(10) || '*** START OF THIS PROJECT GUTENBERG EBOOK ***' || chr(10)
    || d.text || chr(10) || '*** END OF THIS PROJECT GUTENBERG EBOOK ***' || chr(10) AS text
  FROM documents d
  JOIN (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%B %-d, %Y') AS day FROM orders)
    ON o_orderkey = d.doc_id
  JOIN (SELECT c_custkey, translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij') AS w
        FROM customer) ON c_custkey = o_custkey
  JOIN part ON p_partkey = d.doc_id % (SELECT count(*) FROM part)
)"""


def _labelled(label: str, source: str = "text") -> str:
    pattern = rf"(?i){label}:\s*(.+)"
    value = STRIP.format(f"regexp_extract({source}, '{pattern}', 1)")
    return f"CASE WHEN regexp_matches({source}, '{pattern}') THEN {value} END"


def _dated(label: str) -> str:
    pattern = rf"(?m){label}:\s*(.+?)(?:\s*\[|$)"
    value = STRIP.format(f"regexp_extract(text, '{pattern}', 1)")
    return f"CASE WHEN regexp_matches(text, '{pattern}') THEN {value} END"


_HEADING = r"(?m)^[^\n]*Project Gutenberg E(?:Book|book|Text|text) of[ \t]+(.+?)(?:,[ \t]+by[ \t].*)?$"
FORMS = f"""forms AS (
  SELECT doc_id, coalesce(title, heading) AS title,
    CASE WHEN title IS NOT NULL THEN 'label' WHEN heading IS NOT NULL THEN 'heading' END AS title_form,
    coalesce(release, posting) AS release_date,
    CASE WHEN release IS NOT NULL THEN 'release' WHEN posting IS NOT NULL THEN 'posting' END AS release_date_form,
    language, CASE WHEN language IS NOT NULL THEN 'label' END AS language_form,
    encoding, CASE WHEN encoding IS NOT NULL THEN 'label' END AS encoding_form
  FROM (SELECT doc_id, {_labelled("Title")} AS title,
    CASE WHEN regexp_matches(text, '{_HEADING}') THEN regexp_extract(text, '{_HEADING}', 1) END AS heading,
    {_dated("Release [Dd]ate")} AS release, {_dated("Posting Date")} AS posting,
    {_labelled("Language")} AS language, {_labelled("Character set encoding")} AS encoding
  FROM books)
)"""
META = f"""meta AS (
  SELECT doc_id, title, release_date, language, encoding,
    try_cast(regexp_extract(release_date, '([0-9]{{4}})', 1) AS INTEGER) AS release_year
  FROM (SELECT doc_id,
    {_labelled("Title")} AS title,
    coalesce({_dated("Release [Dd]ate")}, {_dated("Posting Date")}) AS release_date,
    {_labelled("Language")} AS language,
    {_labelled("Character set encoding")} AS encoding
  FROM books)
)"""

# --- authors -----------------------------------------------------------------
_YEAR = r"try_cast(regexp_extract(text, '{}:\s*.*?([0-9]{{4}})', 1) AS INTEGER)"
_BYLINE = (
    r"regexp_extract(substring(text, 1, 2000), "
    r"'(?:Project Gutenberg[^\n]*\n.*?)?by\s+([A-Z][a-zA-Z\s.,]+)', 1)"
)
AUTHORS = f"""authors AS (
  SELECT doc_id,
    CASE WHEN length(line) > 1 AND lower(line) <> 'various' THEN line
         WHEN length(byline) > 3 AND length(byline) < 100 THEN byline END AS author,
    release_year
  FROM (SELECT doc_id,
    {STRIP.format("regexp_replace(" + _labelled("Author") + r", '\s*\(.*?\)\s*', '', 'g')")} AS line,
    {STRIP.format("rtrim(" + STRIP.format(_BYLINE) + ", ',')")} AS byline,
    coalesce({_YEAR.format("Release [Dd]ate")}, {_YEAR.format("Posting Date")}) AS release_year
  FROM books)
)"""
AUTHOR_YEARS = """author_years AS (
  SELECT * FROM authors WHERE author IS NOT NULL AND release_year IS NOT NULL
)"""
EDGES = """edges AS (
  SELECT DISTINCT a.author AS author_a, b.author AS author_b
  FROM (SELECT DISTINCT author, release_year FROM author_years) a
  JOIN (SELECT DISTINCT author, release_year FROM author_years) b
    ON a.author <> b.author
   AND b.release_year - a.release_year > 0 AND b.release_year - a.release_year <= 5
)"""
WINDOWED = """years AS (SELECT DISTINCT author, release_year FROM author_years),
windows(x) AS (VALUES (1), (2), (5), (10)),
windowed AS (
  SELECT DISTINCT x, a.author AS author_a, b.author AS author_b
  FROM windows JOIN years a ON true
  JOIN years b ON a.author <> b.author AND b.release_year > a.release_year
   AND b.release_year <= a.release_year + x
)"""
DEGREES = """outs AS (SELECT author_a AS author, count(*) AS out_degree FROM edges GROUP BY 1),
ins AS (SELECT author_b AS author, count(*) AS in_degree FROM edges GROUP BY 1),
degrees AS (
  SELECT coalesce(outs.author, ins.author) AS author, coalesce(out_degree, 0) AS out_degree,
    coalesce(in_degree, 0) AS in_degree,
    coalesce(out_degree, 0) + coalesce(in_degree, 0) AS total_degree
  FROM outs FULL JOIN ins ON outs.author = ins.author
)"""
NETWORK = _with(BOOKS, AUTHORS, AUTHOR_YEARS, EDGES, DEGREES)


# --- boilerplate and tokens --------------------------------------------------
def _first_marker(markers: tuple[str, ...], text: str) -> str:
    found = [f"nullif(strpos(lower({text}), '{marker.lower()}'), 0)" for marker in markers]
    return "coalesce(" + ", ".join(found) + ")"


def _stripped(source: str) -> str:
    return f"""stripped AS (
  SELECT doc_id, CASE WHEN stop IS NULL THEN body ELSE substring(body, 1, stop - 1) END AS text
  FROM (SELECT doc_id, body, {_first_marker(END_MARKERS, "body")} AS stop
    FROM (SELECT doc_id,
        CASE WHEN start IS NULL OR strpos(substring(text, start), chr(10)) = 0 THEN text
             ELSE substring(text, start + strpos(substring(text, start), chr(10))) END AS body
      FROM (SELECT doc_id, text, {_first_marker(START_MARKERS, "text")} AS start FROM {source})))
)"""


_STOP = ", ".join(f"'{word}'" for word in STOP_WORDS)
TOKENS = f"""tokens AS (
  SELECT doc_id, word
  FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM stripped)
  WHERE length(word) > 2 AND word NOT IN ({_STOP})
)"""
OF_DOCUMENTS = (_stripped("documents"), TOKENS)
COUNTS = """counts AS (SELECT doc_id, word, count(*) AS word_count FROM tokens GROUP BY ALL),
totals AS (SELECT doc_id, count(*) AS total_words FROM tokens GROUP BY ALL),
tf AS (
  SELECT doc_id, word, word_count, total_words, word_count / total_words AS tf
  FROM counts JOIN totals USING (doc_id)
)"""
VOCABULARY = """vocabulary AS (
  SELECT word, count(*) AS doc_freq,
    ln((SELECT count(*) FROM documents) / count(*)) AS idf
  FROM counts GROUP BY word
)"""
WEIGHTS = """weights AS (
  SELECT doc_id, word, tf, idf, tf * idf AS tfidf FROM tf JOIN vocabulary USING (word)
)"""
NORMS = "norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM weights GROUP BY doc_id)"
PAIRS = """pairs AS (
  SELECT book_a, book_b,
    CASE WHEN na.norm > 0 AND nb.norm > 0 THEN dot / (na.norm * nb.norm) ELSE 0.0 END
      AS cosine_similarity
  FROM (SELECT a.doc_id AS book_a, b.doc_id AS book_b, sum(a.tfidf * b.tfidf) AS dot
        FROM weights a JOIN weights b ON a.word = b.word AND a.doc_id < b.doc_id GROUP BY ALL)
  JOIN norms na ON na.doc_id = book_a JOIN norms nb ON nb.doc_id = book_b
)"""

_TF = _with(*OF_DOCUMENTS, COUNTS)
_IDF = _with(*OF_DOCUMENTS, COUNTS, VOCABULARY)
_TFIDF = _with(*OF_DOCUMENTS, COUNTS, VOCABULARY, WEIGHTS)
_PAIRS = _with(*OF_DOCUMENTS, COUNTS, VOCABULARY, WEIGHTS, NORMS, PAIRS)
_META = _with(BOOKS, META)

WORD_COUNT = r"""word_counts AS (
  SELECT word, count(*) AS n
  FROM (SELECT lower(trim(piece, '''')) AS word
        FROM (SELECT unnest(string_split_regex(
                regexp_replace(text, '[^a-zA-Z'' \t\n\x0B\f\r]', '', 'g'), '[ \t\n\r\f]+')) AS piece
              FROM documents))
  WHERE word <> '' GROUP BY word
)"""


def oracle_sql() -> dict[str, str]:
    coverage = ", ".join(
        f"count({column}) AS with_{name}, round(100.0 * count({column}) / count(*), 6) AS pct_{name}"
        for name, column in {
            "title": "title",
            "date": "release_date",
            "language": "language",
            "encoding": "encoding",
        }.items()
    )
    top_similar = (
        _PAIRS
        + """SELECT CASE WHEN book_a = 10 THEN book_b ELSE book_a END AS similar,
             round(cosine_similarity, 6) AS cosine
             FROM pairs WHERE book_a = 10 OR book_b = 10 ORDER BY 2 DESC, 1 LIMIT 5"""
    )
    return {
        "documents_as_books": r"""SELECT doc_id || '.txt' AS file_name,
            replace(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(65533), '') AS text
            FROM documents""",
        "wordcount_sink": _with(WORD_COUNT) + "SELECT word || chr(9) || n AS value FROM word_counts",
        "book_folder": r"""SELECT sum(length(replace(regexp_replace(coalesce(text, '') || chr(10),
            '\r\n?', chr(10), 'g'), chr(65533), '')))::BIGINT AS characters, true AS all_read, 0 AS rejected
            FROM documents""",
        "word_count": _with(WORD_COUNT) + "SELECT * FROM word_counts",
        "meta_extract": _META + "SELECT * FROM meta",
        "books_per_year": _META
        + """SELECT release_year, count(*) AS num_books FROM meta
             WHERE release_year IS NOT NULL GROUP BY 1 ORDER BY 1""",
        "language_counts": _META
        + """SELECT language, count(*) AS num_books FROM meta
             WHERE language IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1""",
        "top_language": _META
        + """SELECT language, count(*) AS num_books FROM meta
             WHERE language IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
        "avg_title_length": _META
        + "SELECT round(avg(length(title)), 6) AS avg_title_length FROM meta",
        "metadata_coverage": _META + f"SELECT count(*) AS total_books, {coverage} FROM meta",
        "metadata_by_form": _with(BOOKS, FORMS) + "SELECT * FROM forms",
        "metadata_forms": _with(BOOKS, FORMS)
        + """SELECT field, form, count(*) AS n FROM (
               SELECT 'title' AS field, title_form AS form FROM forms
               UNION ALL SELECT 'release_date', release_date_form FROM forms
               UNION ALL SELECT 'language', language_form FROM forms
               UNION ALL SELECT 'encoding', encoding_form FROM forms) GROUP BY ALL""",
        "metadata_quality": _META
        + """SELECT doc_id, title IS NULL AS no_title, release_date IS NULL AS no_release_date,
             language IS NULL AS no_language, encoding IS NULL AS no_encoding,
             (title IS NULL)::INT + (release_date IS NULL)::INT + (language IS NULL)::INT
               + (encoding IS NULL)::INT AS n_missing,
             try_strptime(release_date, ['%B %d, %Y', '%b %d, %Y'])::DATE AS release_day
             FROM meta""",
        "strip_boilerplate": _with(BOOKS, _stripped("books")) + "SELECT * FROM stripped",
        "tokenize": _with(*OF_DOCUMENTS) + "SELECT * FROM tokens",
        "tokenize_by_table": _with(*OF_DOCUMENTS) + "SELECT * FROM tokens",
        "tokenize_books": _with(BOOKS, _stripped("books"), TOKENS) + "SELECT * FROM tokens",
        "token_count": _with(*OF_DOCUMENTS) + "SELECT count(*) AS tokens FROM tokens",
        "tokens_per_doc": _with(*OF_DOCUMENTS)
        + "SELECT doc_id, count(*) AS tokens FROM tokens GROUP BY 1",
        "first_tokens_per_doc": _with(*OF_DOCUMENTS)
        + "SELECT doc_id, count(*) AS tokens FROM tokens GROUP BY 1 ORDER BY 1 LIMIT 10",
        "term_counts": _TF + "SELECT * FROM counts",
        "term_frequency": _TF + "SELECT * REPLACE (round(tf, 6) AS tf) FROM tf",
        "top_tf": _TF
        + "SELECT * REPLACE (round(tf, 6) AS tf) FROM tf ORDER BY round(tf.tf, 6) DESC, doc_id, word LIMIT 10",
        "doc_frequency": _IDF + "SELECT word, doc_freq FROM vocabulary",
        "idf": _IDF + "SELECT word, doc_freq, round(idf, 6) AS idf FROM vocabulary",
        "idf_extremes": _IDF
        + """(SELECT word, doc_freq, round(idf, 6) AS idf, 'highest' AS extreme FROM vocabulary
              ORDER BY 3 DESC, 1 LIMIT 10)
             UNION ALL
             (SELECT word, doc_freq, round(idf, 6) AS idf, 'lowest' AS extreme FROM vocabulary
              ORDER BY 3, 1 LIMIT 10)""",
        "tfidf": _TFIDF
        + """SELECT doc_id, word, round(tf, 6) AS tf, round(idf, 6) AS idf,
             round(tfidf, 6) AS tfidf FROM weights""",
        "top_tfidf": _TFIDF
        + """SELECT doc_id, word, round(tf, 6) AS tf, round(idf, 6) AS idf,
             round(tfidf, 6) AS tfidf FROM weights ORDER BY 5 DESC, 1, 2 LIMIT 20""",
        "doc_norms": _with(*OF_DOCUMENTS, COUNTS, VOCABULARY, WEIGHTS, NORMS)
        + "SELECT doc_id, round(norm, 6) AS norm FROM norms",
        "cosine_pairs": _PAIRS
        + """SELECT book_a, book_b, round(cosine_similarity, 6) AS cosine_similarity
             FROM pairs""",
        "similarity_pair_count": _PAIRS + "SELECT count(*) AS pairs FROM pairs",
        "top_pairs": _PAIRS
        + """SELECT book_a, book_b, round(cosine_similarity, 6) AS cosine_similarity
             FROM pairs ORDER BY 3 DESC, 1, 2 LIMIT 20""",
        "pairs_above": _PAIRS
        + """SELECT book_a, book_b, round(cosine_similarity, 6) AS cosine_similarity
             FROM pairs WHERE round(cosine_similarity, 6) >= 0.6""",
        "top_similar": top_similar,
        "indexed_similar": top_similar,
        "approximate_recall": _PAIRS
        + """SELECT count(*) AS near, true AS recall_reached FROM (
             SELECT row_number() OVER (PARTITION BY query ORDER BY round(cosine, 6) DESC, other) AS rank
             FROM (SELECT book_a AS query, book_b AS other, cosine_similarity AS cosine FROM pairs
                   UNION ALL SELECT book_b, book_a, cosine_similarity FROM pairs)
             WHERE query % 50 = 0 AND round(cosine, 6) >= 0.8) WHERE rank <= 10""",
        "author_extract": _with(BOOKS, AUTHORS) + "SELECT * FROM authors",
        "author_years": _with(BOOKS, AUTHORS, AUTHOR_YEARS) + "SELECT * FROM author_years",
        "first_author_years": _with(BOOKS, AUTHORS, AUTHOR_YEARS)
        + "SELECT * FROM author_years ORDER BY release_year, doc_id LIMIT 20",
        "influence_edges": NETWORK + "SELECT * FROM edges",
        "fed_network": NETWORK + "SELECT * FROM edges",
        "adjacency_edges": NETWORK + "SELECT * FROM edges",
        "out_degree": NETWORK + "SELECT * FROM outs",
        "in_degree": NETWORK + "SELECT * FROM ins",
        "degree_combined": NETWORK + "SELECT * FROM degrees",
        "top_out_degree": NETWORK + "SELECT * FROM outs ORDER BY out_degree DESC, author LIMIT 5",
        "top_in_degree": NETWORK + "SELECT * FROM ins ORDER BY in_degree DESC, author LIMIT 5",
        "top_total_degree": NETWORK
        + "SELECT * FROM degrees ORDER BY total_degree DESC, author LIMIT 20",
        "window_sensitivity": _with(BOOKS, AUTHORS, AUTHOR_YEARS, WINDOWED)
        + """SELECT x AS window_years, n AS authors, count(author_a) AS edges,
             round(CASE WHEN n > 1 THEN count(author_a) / (n * (n - 1)) ELSE 0 END, 6) AS density,
             coalesce(round(count(author_a) / nullif(count(DISTINCT author_b), 0), 6), 0) AS avg_in_degree,
             coalesce(round(count(author_a) / nullif(count(DISTINCT author_a), 0), 6), 0) AS avg_out_degree
             FROM windows LEFT JOIN windowed USING (x),
                  (SELECT count(DISTINCT author) AS n FROM author_years) GROUP BY x, n""",
        "edges_added": _with(BOOKS, AUTHORS, AUTHOR_YEARS, EDGES)
        + """SELECT * FROM edges EXCEPT
             SELECT DISTINCT a.author, b.author FROM author_years a JOIN author_years b
               ON a.author <> b.author AND b.release_year > a.release_year
              AND b.release_year <= a.release_year + 5
             WHERE a.doc_id % 10 <> 9 AND b.doc_id % 10 <> 9""",
        "network_stats": NETWORK
        + """SELECT 5 AS window_years, n AS authors, m AS edges,
             round(CASE WHEN n > 1 THEN m / (n * (n - 1)) ELSE 0 END, 6) AS density,
             coalesce(round((SELECT avg(in_degree) FROM ins), 6), 0) AS avg_in_degree,
             coalesce(round((SELECT avg(out_degree) FROM outs), 6), 0) AS avg_out_degree
             FROM (SELECT (SELECT count(DISTINCT author) FROM author_years) AS n,
                          (SELECT count(*) FROM edges) AS m)""",
    }
