"""The queries of this subpackage in SQL for DuckDB, where SQL can express them."""

from clickflow.llm import chat, line_dedup, url_filters

BLANK = r"[^\x20\x09-\x0D]"

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

LINE_DEDUP = f"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, source, text,
           string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), pages AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
counted AS (
    SELECT source, line, count(DISTINCT row) AS n
    FROM (SELECT row, source, unnest(lines) AS line FROM d)
    WHERE regexp_matches(line, '{BLANK}') GROUP BY source, line
), gone AS (
    SELECT c.source, list(line) AS gone
    FROM counted c JOIN pages p ON c.source IS NOT DISTINCT FROM p.source
    WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.MAX_RATIO} * pages GROUP BY c.source
), cleaned AS (
    SELECT doc_id, d.source, text, lines,
           list_filter(lines, lambda x: NOT coalesce(list_contains(gone, x), FALSE)) AS kept
    FROM d LEFT JOIN gone g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source,
       CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(kept) END AS n_removed,
       CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text
FROM cleaned
"""


def _escapes(column: str) -> str:
    """How many characters escaping adds: one for each control string."""
    quoted = "|".join("".join("\\" + c if not c.isalnum() else c for c in control) for control in chat.CONTROL)
    return f"len(regexp_extract_all({column}, '{quoted}'))"


CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(chat.START) + len(chat.END) + 2} + length(role) + length(text) + {_escapes("text")}) AS BIGINT) AS formatted_chars,
       FALSE AS rewrites
FROM turns GROUP BY conv_id
"""


def _url_filter() -> str:
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in url_filters.RULES)
    start = "(?s)^.*?://"
    def quoted(pattern):
        return pattern.replace("'", "''")

    def attribute(name):
        return " || ".join(f"regexp_extract(tag, '{quoted(url_filters.attribute_pattern(name))}', {group})" for group in (1, 2, 3))

    def decoded(text):
        for written, character in url_filters.ENTITIES:
            text = f"regexp_replace({text}, '(?i){written}', '{quoted(character)}', 'g')"
        return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"

    def without_dots(path):
        """Dot segments, up to eight that lead upwards."""
        text = f"regexp_replace({path}, '/\\.(/|$)', '/', 'g')"
        text = f"regexp_replace({text}, '/\\.(/|$)', '/', 'g')"
        for _ in range(8):
            text = f"regexp_replace({text}, '^/\\.\\.(/|$)|/[^/]+/\\.\\.(/|$)', '/')"
        return text

    def host(url):
        return f"translate(regexp_extract({url}, '{start}([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def path(url):
        return f"regexp_extract({url}, '{start}[^/?#]*([^?#]*)', 1)"

    def form(url):
        query = f"regexp_extract({url}, '{start}[^?#]*\\?([^#]*)', 1)"
        kept = f"array_to_string(list_filter(string_split({query}, '&'), lambda q: q <> '' AND NOT regexp_matches(q, '^({url_filters.TRACKING})(=|$)')), '&')"
        page = f"regexp_replace({path(url)}, '(/|/index\\.html?|\\.html?)$', '')"
        site = f"regexp_replace({host(url)}, '^(www|m)\\.', '')"
        return f"CASE WHEN {host(url)} <> '' THEN {site} || {page} || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"

    return f"""
WITH RECURSIVE rules(host, path, verdict) AS (VALUES {rules}),
tags AS (
    SELECT url AS source, unnest(regexp_extract_all(html, '{url_filters.TAG}')) AS tag FROM pages WHERE url IS NOT NULL
), written AS (
    SELECT source, {decoded("written")} AS t FROM (
        SELECT source, CASE
            WHEN lower(tag[1:5]) = '<link' THEN CASE WHEN list_contains(regexp_split_to_array(lower({attribute("rel")}), '\\s+'), 'canonical') THEN {attribute("href")} ELSE '' END
            WHEN lower(trim({attribute("http-equiv")})) = 'refresh' THEN regexp_extract({attribute("content")}, '{quoted(url_filters.REFRESH)}', 1)
            ELSE '' END AS written
        FROM tags)
), parts AS (
    SELECT source, t, regexp_extract(source, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme, regexp_extract(source, '{start}([^/?#]*)', 1) AS authority,
           {path("source")} AS page, regexp_extract({path("source")}, '(?s)^(.*/)', 1) AS folder, regexp_extract(t, '(?s)^([^?#]*)', 1) AS p
    FROM written
), e AS (
    SELECT source, CASE
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR t = '' OR starts_with(t, '#') OR scheme = '' OR authority = '' THEN NULL
        WHEN starts_with(t, '//') THEN scheme || ':' || t
        ELSE scheme || '://' || authority || CASE WHEN p = '' THEN page
            ELSE {without_dots("CASE WHEN starts_with(p, '/') THEN p WHEN folder = '' THEN '/' || p ELSE folder || p END")} END || t[length(p) + 1:]
        END AS target
    FROM parts
), edges AS (SELECT * FROM e WHERE target IS NOT NULL),
forms AS (SELECT {form("source")} AS a, {form("target")} AS b FROM edges),
two_way AS (SELECT a, b FROM forms WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM forms WHERE a IS NOT NULL AND b IS NOT NULL),
reach(a, b) AS (SELECT a, a FROM two_way UNION SELECT r.a, x.b FROM reach r JOIN two_way x ON r.b = x.a),
component AS (SELECT a AS form, min(b) AS component FROM reach GROUP BY a),
urls AS (SELECT row_number() OVER () AS row, page_id, url FROM pages
         UNION ALL SELECT -row_number() OVER (), NULL, unnest([source, target]) FROM edges),
parsed AS (SELECT row, page_id, coalesce({host("url")}, '') AS host, coalesce({path("url")}, '') AS path, {form("url")} AS form FROM urls),
fits AS (
    SELECT p.row, arg_max(r.host || r.path, length(r.host) * 1000 + 1000000 * (length(r.host) + length(r.path))) AS rule,
           arg_max(r.verdict, length(r.host) * 1000 + 1000000 * (length(r.host) + length(r.path))) AS verdict
    FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.row
), judged AS (
    SELECT p.*, f.rule, f.verdict, coalesce(c.component, p.form) AS component
    FROM parsed p LEFT JOIN fits f USING (row) LEFT JOIN component c ON p.form = c.form
), marks AS (
    SELECT component FROM judged WHERE component IS NOT NULL GROUP BY component
    HAVING bool_or(verdict = 'block') AND NOT coalesce(bool_or(verdict = 'allow'), FALSE)
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN m.component IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN marks m ON j.component = m.component WHERE row > 0
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk_search": TOP_K,
        "op5_line_dedup": LINE_DEDUP,
        "op7_chat_format": CHAT,
        "op8_url_filter": _url_filter(),
    }
