"""DuckDB SQL for every registered query, over the same Parquet tables.

These strings are the correctness oracle: an independent, declarative
statement of each query. PageRank is unrolled into one materialized CTE per
round. Every double leaving a query is rounded to 9 decimals, and top-k
orders by the rounded value with a total tie-break, as the Spark side does.
"""

from __future__ import annotations

TERM = "the"
K = 100
ITERATIONS = 10
# Targets in a row of adjacency_lists; short, so that small tables have cut lists too.
LIST_LENGTH = 5

ARTICLES = (
    "SELECT page_id AS article_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, "
    "html AS body FROM pages"
)
# Fixed values, as in functions/text.py: the tag, non-letter and escaped line break patterns.
# Tags and literal backslash-n become spaces, non-letter runs one space, lower, trim.
CLEAN = (
    "trim(lower(regexp_replace(replace(regexp_replace(body, '<[^>]*>', ' ', 'g'), '\\n', ' '), "
    "'[^a-zA-Z]+', ' ', 'g')))"
)
CLEAN_GLUED = (
    "lower(regexp_replace(replace(regexp_replace(body, '<[^>]*>', '', 'g'), '\\n', ''), "
    "'[^a-zA-Z]+', ' ', 'g'))"
)

DOC_ARTICLES = (
    "SELECT doc_id AS article_id, 'doc' || CAST(doc_id AS VARCHAR) AS title, text AS body FROM documents"
)
SOURCE_ARTICLES = "SELECT doc_id AS article_id, source AS title, text AS body FROM documents"


def tfidf_ctes(articles: str) -> str:
    return f"""
articles AS ({articles}),
toks AS (SELECT title, unnest(string_split({CLEAN}, ' ')) AS word FROM articles),
tf AS (SELECT word, title, count(*) AS tf FROM toks GROUP BY word, title),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
n AS (SELECT count(DISTINCT title) AS n FROM articles),
scored AS (
  SELECT tf.word, tf.title, tf.tf, df.df, tf.tf * log10(n.n / df.df) AS w
  FROM tf JOIN df USING (word) CROSS JOIN n
)"""


TFIDF_CTES = tfidf_ctes(ARTICLES)

ARCS_RAW = """
SELECT a.l_partkey AS src, b.l_partkey AS dst
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
WHERE a.l_partkey <> b.l_partkey
  AND a.l_returnflag = 'R' AND a.l_linestatus = 'F' AND b.l_returnflag = 'R'"""

# Without the filters on returned lines.
ARCS_FULL = """
SELECT a.l_partkey AS src, b.l_partkey AS dst
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
WHERE a.l_partkey <> b.l_partkey"""

# Fields of an arc record are apart by 1 to 3 of these characters, from the data.
SEPARATORS = " \t  \t"
WS_LINE = (
    "repeat(' ', (src % 2)::BIGINT) || CAST(src AS VARCHAR) || "
    f"substr('{SEPARATORS}', (1 + src % 3)::BIGINT, (1 + dst % 3)::BIGINT) || CAST(dst AS VARCHAR) || repeat(chr(9), (dst % 2)::BIGINT)"
)

LABELS_TAB = "SELECT p_partkey AS id, p_name AS name FROM part"
# The whitespace reader splits the whole record on whitespace runs.
LABELS_WS = (
    "SELECT p_partkey AS id, "
    "string_split_regex(CAST(p_partkey AS VARCHAR) || chr(9) || p_name, '\\s+')[2] AS name FROM part"
)

def graph_ctes(arcs: str) -> str:
    return f"""
arcs AS (SELECT DISTINCT src, dst FROM ({arcs})),
deg AS (SELECT src, count(*) AS deg FROM arcs GROUP BY src),
links AS (SELECT a.src, a.dst, d.deg FROM arcs a JOIN deg d USING (src))"""


GRAPH_CTES = graph_ctes(ARCS_RAW)


def significant(c: str, digits: int = 12) -> str:
    """A positive number at so many significant digits."""
    scale = f"pow(10.0::DOUBLE, floor(log10({c})))"
    return f"(round({c} / {scale}, {digits - 1}) * {scale})"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def pagerank_ctes(variant: str, iterations: int = ITERATIONS, arcs: str = ARCS_RAW) -> str:
    """CTEs r0..rN (id, rank) for variant A, B or C, plus c_i and i_i."""
    labels = LABELS_WS if variant == "A" else LABELS_TAB
    ctes = [
        graph_ctes(arcs).strip(),
        f"labels AS ({labels})",
        "dangling AS (SELECT id FROM labels WHERE id NOT IN (SELECT src FROM deg))",
        "nlabels AS (SELECT count(*) AS n FROM (SELECT DISTINCT id, name FROM labels))",
        "r0 AS (SELECT src AS id, 1.0::DOUBLE AS rank FROM deg)",
    ]
    for i in range(1, iterations + 1):
        ctes.append(
            f"c{i} AS MATERIALIZED (SELECT l.dst, r.rank / l.deg AS contrib "
            f"FROM links l JOIN r{i - 1} r ON l.src = r.id)"
        )
        ctes.append(
            f"i{i} AS MATERIALIZED (SELECT dst AS id, 0.15::DOUBLE + 0.85::DOUBLE * sum(contrib) AS rank "
            f"FROM c{i} GROUP BY dst)"
        )
        if variant == "C":
            ctes.append(f"r{i} AS MATERIALIZED (SELECT id, rank FROM i{i})")
            continue
        ctes.append(
            f"m{i} AS (SELECT coalesce(sum(x.rank), 0.0::DOUBLE) AS mass "
            f"FROM dangling d JOIN i{i} x ON d.id = x.id)"
        )
        if variant == "A":
            ctes.append(
                f"n{i} AS (SELECT count(*)::DOUBLE AS n FROM (SELECT DISTINCT dst, {significant('contrib')} FROM c{i}))"
            )
        else:
            ctes.append(f"n{i} AS (SELECT n::DOUBLE AS n FROM nlabels)")
        ctes.append(
            f"s{i} AS (SELECT CASE WHEN n{i}.n = 0 THEN 0.0::DOUBLE ELSE m{i}.mass / n{i}.n END AS share "
            f"FROM m{i} CROSS JOIN n{i})"
        )
        ctes.append(f"r{i} AS MATERIALIZED (SELECT id, rank + s{i}.share AS rank FROM i{i} CROSS JOIN s{i})")
    return ",\n".join(ctes)


def pagerank_sql(variant: str, iterations: int = ITERATIONS, arcs: str = ARCS_RAW) -> str:
    return with_(pagerank_ctes(variant, iterations, arcs), f"SELECT id, round(rank, 9) AS rank FROM r{iterations}")


def pagerank_topk_sql(variant: str, k: int = K, bottom: bool = False, iterations: int = ITERATIONS) -> str:
    d = "ASC" if bottom else "DESC"
    return with_(
        pagerank_ctes(variant, iterations),
        f"SELECT r.id, l.name, round(r.rank, 9) AS rank FROM r{iterations} r JOIN labels l ON r.id = l.id "
        f"ORDER BY round(r.rank, 9) {d}, l.name {d}, r.id {d} LIMIT {k}",
    )


TITLE_SQL = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


def escaped(col: str) -> str:
    return f"replace({col}, chr(10), '\\n')"


def list_rows(ctes: str) -> str:
    return with_(
        f"{ctes},\nplaced AS (SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {LIST_LENGTH} AS part FROM arcs)",
        "SELECT src, part::BIGINT AS part, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS dsts FROM placed GROUP BY src, part",
    )


def utf16(c: str) -> str:
    """A text's UTF-16 code units as hex digits, which sort as the units do."""
    unit = (f"list_transform(list_filter(string_split({c}, ''), lambda x: x <> ''), lambda x: CASE WHEN unicode(x) > 65535 THEN "
            "printf('%04x%04x', 55296 + (unicode(x) - 65536) // 1024, 56320 + (unicode(x) - 65536) % 1024) ELSE printf('%04x', unicode(x)) END)")
    return f"array_to_string({unit}, '')"


def initial_java_sql(d: str) -> str:
    mark = "CASE id % 3 WHEN 0 THEN chr(65313) WHEN 1 THEN chr(128512) ELSE '' END"
    return with_(
        f"{graph_ctes(ARCS_FULL).strip()},\nlabels AS (SELECT id, {mark} || name AS name FROM ({LABELS_TAB}))",
        f"SELECT l.id, l.name, 1.0::DOUBLE AS rank FROM deg JOIN labels l ON deg.src = l.id ORDER BY {utf16('l.name')} {d}, l.id {d} LIMIT {K}",
    )


def cut_lines(by: str, width: int) -> str:
    """How many fields a line of the quarantine queries keeps."""
    return f"CASE WHEN {by} % 7 = 0 THEN {width - 1} WHEN {by} % 11 = 0 THEN 1 ELSE {width} END"


def article_halves(bad: bool) -> str:
    body = escaped("html")
    if bad:
        return (f"SELECT CASE WHEN n = 3 THEN concat_ws(chr(9), id, title, url) ELSE id END AS record FROM ("
                f"SELECT CAST(page_id AS VARCHAR) AS id, {TITLE_SQL} AS title, url, {cut_lines('page_id', 4)} AS n FROM pages) WHERE n < 4")
    return (f"SELECT CAST(page_id AS VARCHAR) AS article_id, {TITLE_SQL} AS title, url AS ts, {body} AS body, CAST(NULL AS VARCHAR) AS plain "
            f"FROM pages WHERE {cut_lines('page_id', 4)} = 4")


def arc_halves(bad: bool) -> str:
    n = cut_lines("(l_linenumber + l_orderkey)", 2)
    if bad:
        return f"SELECT CAST(l_partkey AS VARCHAR) AS record FROM lineitem WHERE {n} < 2"
    return f"SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem WHERE {n} = 2"


SQL: dict[str, str] = {
    # ---------------------------------------------------------------- sources
    "scan_articles": (
        "SELECT CAST(page_id AS VARCHAR) AS article_id, "
        f"{escaped(TITLE_SQL)} AS title, "
        f"{escaped('url')} AS ts, {escaped('html')} AS body, CAST(NULL AS VARCHAR) AS plain FROM pages"
    ),
    "scan_arcs_tab": f"SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM ({ARCS_RAW})",
    # A line that begins with white space has an empty first field.
    "scan_arcs_ws": (
        f"SELECT p[1] AS src, p[2] AS dst FROM (SELECT string_split_regex({WS_LINE}, '\\s+') AS p FROM ({ARCS_RAW}))"
    ),
    "scan_labels_tab": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part",
    "scan_labels_ws": (
        "SELECT CAST(p_partkey AS VARCHAR) AS id, "
        "string_split_regex(CAST(p_partkey AS VARCHAR) || chr(9) || p_name, '\\s+')[2] AS name FROM part"
    ),
    "quarantine_articles": article_halves(False),
    "quarantine_articles_bad": article_halves(True),
    "quarantine_arcs": arc_halves(False),
    "quarantine_arcs_bad": arc_halves(True),
    # ----------------------------------------------------------------- TF-IDF
    "doc_count": with_(f"articles AS ({ARTICLES})", "SELECT count(DISTINCT title) AS n FROM articles"),
    "tokens": with_(f"articles AS ({ARTICLES})", f"SELECT title, unnest(string_split({CLEAN}, ' ')) AS word FROM articles"),
    "tokens_glued": with_(
        f"articles AS ({ARTICLES}), g AS (SELECT title, {CLEAN_GLUED} AS c FROM articles)",
        "SELECT title, unnest(CASE WHEN c = '' THEN [''] WHEN rtrim(c) = '' THEN []::VARCHAR[] "
        "ELSE string_split(rtrim(c), ' ') END) AS word FROM g",
    ),
    "term_freq": with_(TFIDF_CTES, "SELECT word, title, tf FROM tf"),
    "doc_freq": with_(TFIDF_CTES, "SELECT word, df FROM df"),
    "idf": with_(TFIDF_CTES, "SELECT word, df, n, round(log10(n / df), 9) AS idf FROM df CROSS JOIN n"),
    "tfidf_all": with_(TFIDF_CTES, "SELECT word, title, tf, df, round(w, 9) AS w FROM scored"),
    # The streaming form must give exactly the batch result.
    "stream_tfidf_all": with_(TFIDF_CTES, "SELECT word, title, tf, df, round(w, 9) AS w FROM scored"),
    "tfidf_term": with_(
        TFIDF_CTES, f"SELECT word, title, tf, df, round(w, 9) AS w FROM scored WHERE word = '{TERM}'"
    ),
    "tfidf_all_salted": with_(TFIDF_CTES, "SELECT word, title, tf, df, round(w, 9) AS w FROM scored"),
    "tfidf_lookup": with_(
        TFIDF_CTES, f"SELECT word, title, tf, df, round(w, 9) AS w FROM scored WHERE word = '{TERM}'"
    ),
    "tfidf_lookup_many": with_(
        TFIDF_CTES,
        "SELECT word, title, tf, df, round(w, 9) AS w FROM scored WHERE word <> '' AND word IN "
        "(SELECT unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g')), ' ')) FROM benchmark)",
    ),
    "tfidf_topk": with_(
        TFIDF_CTES,
        f"SELECT title, round(w, 9) AS w FROM scored WHERE word = '{TERM}' "
        f"ORDER BY round(w, 9) DESC, title DESC LIMIT {K}",
    ),
    "tfidf_before_comma": with_(
        TFIDF_CTES
        + f""",
cut AS (SELECT split_part(title, ',', 1) AS title, max(w) AS w FROM scored WHERE word = '{TERM}' GROUP BY 1)""",
        f"SELECT title, round(w, 9) AS w FROM cut ORDER BY round(w, 9) DESC, title DESC LIMIT {K}",
    ),
    "docs_tfidf_topk": with_(
        tfidf_ctes(DOC_ARTICLES),
        f"SELECT title, round(w, 9) AS w FROM scored WHERE word = '{TERM}' "
        f"ORDER BY round(w, 9) DESC, title DESC LIMIT {K}",
    ),
    "source_tfidf_all": with_(tfidf_ctes(SOURCE_ARTICLES), "SELECT word, title, tf, df, round(w, 9) AS w FROM scored"),
    # ------------------------------------------------------------------ graph
    "distinct_arcs": with_(GRAPH_CTES, "SELECT src, dst FROM arcs"),
    "adjacency": with_(
        GRAPH_CTES,
        "SELECT src, substr(md5(CAST(dst AS VARCHAR)), 1, 2) AS chunk, "
        "string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS dsts FROM arcs GROUP BY src, chunk",
    ),
    "adjacency_lists": list_rows(GRAPH_CTES),
    "out_degree": with_(GRAPH_CTES, "SELECT src, deg FROM deg"),
    "initial_ranks": with_(GRAPH_CTES, "SELECT src AS id, 1.0::DOUBLE AS rank FROM deg"),
    "dangling_nodes": with_(
        GRAPH_CTES + f",\nlabels AS ({LABELS_TAB})",
        "SELECT id, name FROM labels WHERE id NOT IN (SELECT src FROM deg)",
    ),
    "label_count": f"SELECT count(*) AS n FROM (SELECT DISTINCT id, name FROM ({LABELS_TAB}))",
    # --------------------------------------------------------------- PageRank
    "contributions": with_(pagerank_ctes("C", 1), "SELECT dst, round(contrib, 9) AS contrib FROM c1"),
    "pagerank_step": with_(pagerank_ctes("C", 1), "SELECT id, round(rank, 9) AS rank FROM i1"),
    "pagerank_step_dangling": pagerank_sql("B", 1),
    "distinct_contribs": with_(
        pagerank_ctes("A", 1), f"SELECT count(*) AS n FROM (SELECT DISTINCT dst, {significant('contrib')} FROM c1)"
    ),
    "dangling_mass": with_(pagerank_ctes("B", 1), "SELECT round(mass, 9) AS mass FROM m1"),
    "rank_labels": with_(
        pagerank_ctes("C"),
        f"SELECT r.id, l.name, round(r.rank, 9) AS rank FROM r{ITERATIONS} r JOIN labels l ON r.id = l.id",
    ),
    "pagerank_a": pagerank_sql("A"),
    "pagerank_b": pagerank_sql("B"),
    "pagerank_c": pagerank_sql("C"),
    "pagerank_a_topk": pagerank_topk_sql("A"),
    "pagerank_b_topk": pagerank_topk_sql("B"),
    "pagerank_c_topk": pagerank_topk_sql("C"),
    "pagerank_bottomk": pagerank_topk_sql("C", bottom=True),
    "initial_topk_java": initial_java_sql("DESC"),
    "initial_bottomk_java": initial_java_sql("ASC"),
    "ranks_numbered": with_(
        pagerank_ctes("C", arcs=ARCS_FULL),
        f"SELECT id, name, rank, row_number() OVER (ORDER BY rank DESC, name DESC, id DESC) AS row FROM "
        f"(SELECT r.id, l.name, round(r.rank, 3) AS rank FROM r{ITERATIONS} r JOIN labels l ON r.id = l.id)",
    ),
}

# Each query over arcs in its form over all lines.
SQL |= {f"{name}_full": text.replace(ARCS_RAW, ARCS_FULL) for name, text in SQL.items() if ARCS_RAW in text}
