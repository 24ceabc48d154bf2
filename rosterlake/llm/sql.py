"""DuckDB SQL that gives the rows of the registered queries which SQL can express."""

from .licenses import LOWER, STEMS, TEMPLATES, TERM, UPPER

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"


def _shingles(table: str, key: str) -> str:
    """Distinct shingles of five words per row, as the text of the words; short texts are one."""
    return f"""
        SELECT {key}, unnest(list_distinct(CASE
            WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
            ELSE [] END)) AS shingle
        FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL)"""


CONTAINMENT = f"""
    WITH item AS ({_shingles("benchmark", "item_id")}),
    doc AS ({_shingles("documents", "doc_id")}),
    size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
    shared AS (
        SELECT doc_id, item_id, count(*) AS n_shared
        FROM item JOIN doc USING (shingle) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_item, n_shared
    FROM shared JOIN size USING (item_id)
    WHERE 100 * n_shared >= 80 * n_item
"""


TOP_K = """
    WITH base AS (
        SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
               CAST(list_sum([x[1] * x[2] FOR x IN list_zip(q.v, c.v)]) AS BIGINT) AS score
        FROM base AS q JOIN base AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (
        SELECT query_id, vec_id, score,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _term_counts(table: str, key: str) -> str:
    """One row per term and row of a table: key, term, how often."""
    found = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
        SELECT {key}, term, count(*) AS times
        FROM (SELECT {key}, unnest({found}) AS term FROM {table} WHERE text IS NOT NULL)
        GROUP BY {key}, term"""


RANKED = f"""
    WITH doc AS ({_term_counts("documents", "doc_id")}),
    item AS ({_term_counts("benchmark", "item_id")}),
    size AS (SELECT doc_id, CAST(sum(times) AS BIGINT) AS n FROM doc GROUP BY doc_id),
    total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM size),
    weight AS (
        SELECT term,
               CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM doc, total GROUP BY term, documents),
    norm AS (SELECT doc_id, 25 + (75 * n * documents) // terms AS m FROM size, total),
    scored AS (
        SELECT item_id, doc_id,
               CAST(sum(item.times * w * ((1000000000 * doc.times) // (1000 * doc.times + 8 * m))) AS BIGINT) AS score
        FROM item JOIN doc USING (term) JOIN weight USING (term) JOIN norm USING (doc_id)
        GROUP BY item_id, doc_id),
    ranked AS (
        SELECT item_id, doc_id, score,
               row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
        FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


COLLOCATIONS = f"""
    WITH piece AS (
        SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
        FROM (SELECT lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
              FROM documents WHERE text IS NOT NULL)),
    grams AS (
        SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
        FROM piece, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
    f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
    total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
    candidate AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 30),
    cut AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
        FROM candidate, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
    scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
               CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.a + y.a) AS BIGINT) AS score
        FROM cut AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = c.head
        JOIN f AS y ON y.lang = c.lang AND y.phrase = c.rest),
    lowest AS (
        SELECT * FROM scored
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_phrase AS (
        SELECT lang, unnest([array_to_string(w[b:b + n - 1], ' ') FOR b IN range(1, size - n + 2)]) AS phrase, a
        FROM candidate, (SELECT unnest([2, 3]) AS n) WHERE n < size),
    around AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrase GROUP BY lang, phrase),
    ranked AS (
        SELECT lang, phrase, a, l, r, n, score,
               row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
        FROM lowest JOIN total USING (lang) LEFT JOIN around USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 80 * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


COMPONENTS = f"""
    WITH RECURSIVE shingle AS ({_shingles("documents", "doc_id")}),
    size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM shingle AS a JOIN shingle AS b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (
        SELECT shared.a, shared.b FROM shared
        JOIN size AS x ON x.doc_id = shared.a JOIN size AS y ON y.doc_id = shared.b
        WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents LEFT JOIN size USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


def _unit_licences(name: str, least: float) -> str:
    """CTEs that end in ``<name>_best``: text, license, score of the texts of ``<name>``."""
    return f"""
    {name}_unit AS (SELECT text, {_terms("text")} AS words FROM (SELECT DISTINCT text FROM {name})),
    {name}_total AS (SELECT count(*) AS n FROM {name}_unit),
    {name}_count AS (
        SELECT text, len(words) AS size, term, times
        FROM {name}_unit, LATERAL (SELECT w AS term, count(*) AS times FROM (SELECT unnest(words) AS w) GROUP BY w)
        WHERE term IN (SELECT term FROM template_term)),
    {name}_idf AS (
        SELECT t.term, ln((1.0 + n) / (1 + coalesce(df, 0))) + 1 AS idf
        FROM (SELECT DISTINCT term FROM template_term) AS t CROSS JOIN {name}_total
        LEFT JOIN (SELECT term, count(*) AS df FROM {name}_count GROUP BY term) USING (term)),
    {name}_template AS (
        SELECT template, license, term,
               times * idf / sqrt(sum(times * idf * times * idf) OVER (PARTITION BY template)) AS tw
        FROM template_term JOIN {name}_idf USING (term)),
    {name}_length AS (
        SELECT text, sqrt(sum(times * idf * times * idf)
               + (any_value(size) - sum(times)) * (ln(1.0 + any_value(n)) + 1) * (ln(1.0 + any_value(n)) + 1)) AS length
        FROM {name}_count JOIN {name}_idf USING (term) CROSS JOIN {name}_total GROUP BY text),
    {name}_score AS (
        SELECT text, license, round(sum(times * idf * tw) / any_value(length), 6) AS score
        FROM {name}_count JOIN {name}_idf USING (term) JOIN {name}_template USING (term) JOIN {name}_length USING (text)
        GROUP BY text, template, license),
    {name}_best AS (
        SELECT text, license, score FROM {name}_score WHERE score >= {least}
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, license) = 1)"""


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{TERM}')"


_STEMMED = f"regexp_matches(translate(text, '{UPPER}', '{LOWER}'), '{STEMS}')"
_VALUES = ", ".join(
    "({}, '{}', '{}')".format(n, name, text.replace("'", "''")) for n, (name, text) in enumerate(TEMPLATES)
)
LICENSES = f"""
    WITH template (template, license, text) AS (VALUES {_VALUES}),
    template_term AS (
        SELECT template, license, term, count(*) AS times
        FROM (SELECT template, license, unnest({_terms("text")}) AS term FROM template) GROUP BY ALL),
    file AS (
        SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '_') || '/' || coalesce(lang, '_') AS directory,
               coalesce(CAST(doc_id AS VARCHAR), '_') AS name
        FROM documents),
    line AS (
        SELECT doc_id, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM file) WHERE {_STEMMED}),
    whole AS (SELECT directory, name, text FROM file WHERE {_STEMMED}),
    {_unit_licences("line", 0.8)},
    {_unit_licences("whole", 0.5)},
    own AS (
        SELECT doc_id, license, score FROM line JOIN line_best USING (text)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
    holder AS (
        SELECT directory, license, score FROM whole JOIN whole_best USING (text)
        QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, license, name) = 1)
    SELECT f.doc_id, f.directory || '/' || f.name AS path, coalesce(own.license, holder.license) AS license,
           coalesce(own.score, holder.score) AS score,
           CASE WHEN own.license IS NOT NULL THEN 'header' WHEN holder.license IS NOT NULL THEN 'directory' ELSE 'none' END AS source
    FROM file AS f LEFT JOIN own ON own.doc_id = f.doc_id LEFT JOIN holder ON holder.directory = f.directory
"""
