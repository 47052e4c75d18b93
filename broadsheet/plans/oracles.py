"""ANSI-SQL statements (DuckDB) that must give the same rows as the registered queries.

Every value in them is written out here, not taken from the operators: a value that is wrong there shows.
"""

from __future__ import annotations

from typing import NamedTuple

# The Unicode white-space characters.
WHITE_SPACE = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Words never counted as keywords, the empty one among them.
STOP_WORDS = """
    the a an and or in on at to for of is was are be been with that this it by from as has have had but not its their
    le la les de du des un une et en au aux que qui sur par dans est ont son sa se si plus il elle nous vous ils elles
    article apercu preview content news hespress bbc
""".split() + [""]

# The articles that queries make of documents.
ARTICLES = """
SELECT CAST(doc_id AS varchar) AS id,
  CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN ''
       ELSE '<b>' || split_part(text, chr(10), 1) || '</b>' END AS title,
  source || ' Staff' AS author,
  CASE WHEN doc_id % 31 = 0 THEN NULL
       ELSE '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS varchar), 2, '0') || 'T10:00:00.000001' END AS published_date,
  CASE WHEN doc_id % 3 = 0 THEN 'News' WHEN doc_id % 3 = 1 THEN 'General' END AS category,
  text AS content, source,
  CASE doc_id % 6 WHEN 0 THEN 'Maroc' WHEN 1 THEN 'MA' WHEN 2 THEN 'morocco' WHEN 3 THEN 'International' WHEN 4 THEN ''
       END AS country,
  'https://example.org/' || CAST(doc_id AS varchar) AS url
FROM documents
"""


class Site(NamedTuple):
    """What the articles of a site carry, and whether its items are their own titles and absolute links count."""

    source: str
    base_url: str
    author: str
    category: str
    country: str
    before: str
    after: str
    own_title: bool
    absolute: bool


# The sites of the batch, and those of the live pages, in the order of their rules.
BATCH_SITES = (
    Site("Al Jazeera", "https://www.aljazeera.com", "Al Jazeera Staff", "News", "International", "Article preview: ", "...", False, False),
    Site("BBC News", "https://www.bbc.com", "BBC News Staff", "News", "International", "BBC News article: ", "...", True, True),
    Site("Hespress", "", "Hespress Writer", "General", "Maroc", "Hespress article: ", "...", False, True),
)
LIVE_SITES = (
    Site("Hespress", "", "Hespress Writer", "General", "Maroc", "Hespress streaming content for: ", "", False, True),
    Site("Akhbarona", "", "Akhbarona", "General", "Maroc", "Akhbarona article: ", "", True, True),
)

_SPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_SPACES = " || ".join(f"chr({code})" for code in WHITE_SPACE)
_STOPWORD_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)


def _strip(text: str) -> str:
    return f"trim({text}, {_SPACES})"


def _strip_html(text: str) -> str:
    return f"coalesce({_strip(rf"regexp_replace({text}, '<[^>\n]*>', '', 'g')")}, '')"


def _normalize(text: str) -> str:
    blanks = f"trim(regexp_replace(lower({text}), '{_SPACE_CLASS}+', ' ', 'g'))"
    return rf"regexp_replace({blanks}, '[^\p{{L}}\p{{N}}_ .,!?\-]', '', 'g')"


def _country(country: str) -> str:
    return (
        f"CASE WHEN {country} IS NULL THEN 'Unknown'"
        f" WHEN lower({country}) IN ('maroc', 'morocco', 'ma') THEN 'Maroc' ELSE {country} END"
    )


def _top_keywords(relation: str, text: str, deleted: str) -> str:
    return rf"""
    SELECT word, count(*) AS frequency FROM (
      SELECT unnest(regexp_split_to_array(lower(regexp_replace({text}, '{deleted}', '', 'g')),
                                          '[\t\n\x0b\f\r ]+')) AS word FROM {relation})
    WHERE length(word) >= 4 AND word NOT IN ({_STOPWORD_LIST})
    GROUP BY word ORDER BY frequency DESC, word LIMIT 200"""


_ASCII_DELETED = r"[^\w\t\n\x0b\f\r ]"
_UNICODE_DELETED = r"[^\p{L}\p{N}_\t\n\x0b\f\r ]"

_ARTICLES = ARTICLES
_ACCEPTED_TEST = (
    "title IS NOT NULL AND title <> '' AND published_date IS NOT NULL"
    " AND content IS NOT NULL AND length(content) >= 30"
)


def _gram_rows(key: str, text: str, relation: str, condition: str) -> str:
    """``(key, gram)``: all three-character windows of the letters of the texts."""
    letters = rf"(' ' || trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{M}}]+', ' ', 'g')) || ' ')"
    return f"""
    SELECT {key}, unnest(list_transform(range(1, len(ch) - 1), lambda i: ch[i] || ch[i + 1] || ch[i + 2])) AS gram
    FROM (SELECT {key}, string_split({letters}, '') AS ch FROM {relation} WHERE {condition})"""


_PROFILES = f"""
  gram_counts AS (
    SELECT lang, gram, count(*) AS gram_count
    FROM ({_gram_rows("lang", "text", "documents", "lang IS NOT NULL")}) GROUP BY lang, gram),
  gram_totals AS (SELECT lang, sum(gram_count) AS total FROM gram_counts GROUP BY lang),
  profiles AS (
    SELECT lang, gram, gram_count,
      CAST(round(ln(CAST(gram_count * 2 * (SELECT max(total) FROM gram_totals) AS double) / CAST(total AS double))
           * 1000000) AS bigint) AS weight
    FROM gram_counts JOIN gram_totals USING (lang))"""


def _languages(relation: str, key: str, text: str) -> str:
    """CTE ``languages(key, language)`` of a relation's texts."""
    return f"""{_PROFILES},
  text_grams AS ({_gram_rows(key, text, relation, f"length({_strip(text)}) >= 10")}),
  scores AS (
    SELECT {key}, lang, sum(weight) AS score FROM text_grams JOIN profiles USING (gram)
    GROUP BY {key}, lang),
  best AS (
    SELECT {key}, lang FROM scores
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY score DESC, lang) = 1),
  languages AS (
    SELECT r.{key}, coalesce(best.lang, 'unknown') AS language FROM {relation} r LEFT JOIN best USING ({key}))"""


def _silver_ctes(articles: str) -> str:
    return f"""
  articles AS ({articles}),
  cleaned AS (
    SELECT id, title, author, published_date, category, content, source,
      {_country("country")} AS country, url,
      {_strip_html("content")} AS content_clean, {_strip_html("title")} AS title_clean
    FROM articles WHERE {_ACCEPTED_TEST}),
  {_languages("cleaned", "id", "content_clean")},
  silver AS (
    SELECT c.*, {_normalize("content_clean")} AS content_normalized,
      {_normalize("title_clean")} AS title_normalized, language,
      TRY_CAST(substr(published_date, 1, 10) AS date) AS publish_day
    FROM cleaned c JOIN languages USING (id))"""


_SILVER = f"WITH {_silver_ctes(_ARTICLES)}"
# Counts that need no language.
_COUNTED = f"""WITH counted AS (
  SELECT TRY_CAST(substr(published_date, 1, 10) AS date) AS publish_day, source, category,
    {_country("country")} AS country, title
  FROM ({_ARTICLES}) WHERE {_ACCEPTED_TEST})"""


def _per(relation: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS article_count FROM {relation} GROUP BY {key}"


def _with_share(relation: str, key: str) -> str:
    return (
        f"SELECT {key}, count(*) AS article_count,"
        f" round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {relation} GROUP BY {key}"
    )


def _unescaped(text: str) -> str:
    for entity, raw in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("nbsp", " "), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{raw}', 'g')"
    return text


def _page_elements(pattern: str, groups: list[str], columns: str) -> str:
    """Elements found in pages by a pattern whose groups are the named parts."""
    lists = ", ".join(
        f"unnest(regexp_extract_all(html, '{pattern}', {i}, 's')) AS {name}" for i, name in enumerate(groups, 1)
    )
    first = f"regexp_extract_all(html, '{pattern}', 1, 's')"
    return f"""
    SELECT page_id, pos, {columns} FROM (
      SELECT page_id, unnest(range(len({first}))) AS pos, {lists} FROM pages)"""


def _site_articles(sites: tuple[Site, ...]) -> str:
    """The articles of the pages made of documents, taken from the documents themselves: a line is an item, every
    fourth lacks a title element, and links are site-relative, absolute and absent in turn."""
    parts = []
    for number, site in enumerate(sites):
        target = (
            f"CASE WHEN pos % 3 = 0 THEN '{site.base_url}/story/' || pos"
            + (" WHEN pos % 3 = 1 THEN 'https://example.org/story/' || pos" if site.absolute else "")
            + " ELSE '' END"
        )
        kept = "title <> ''" if site.own_title else "pos % 4 <> 3"
        parts.append(f"""
        SELECT doc_id || '-' || pos AS id, title, '{site.author}' AS author,
          '2024-01-01T08:30:00' AS published_date, '{site.category}' AS category,
          '{site.before}' || title || '{site.after}' AS content,
          '{site.source}' AS source, '{site.country}' AS country, {target} AS url
        FROM (SELECT doc_id, pos, {_strip("line")} AS title FROM lines
              WHERE doc_id % {len(sites)} = {number})
        WHERE {kept}""")
    return f"""
      SELECT * FROM (
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line FROM split)
        {" UNION ALL ".join(parts)})"""


def _gold_list(silver: str) -> str:
    others = " UNION ALL ".join(
        f"SELECT 'gold_articles_per_{key}' AS name, {key} AS key, count(*) AS value FROM {silver} GROUP BY {key}"
        for key in ("source", "category", "country", "language")
    )
    return f"""
    SELECT 'gold_articles_per_day' AS name, CAST(NULL AS varchar) AS key, count(*) AS value FROM {silver}
    UNION ALL {others}
    UNION ALL SELECT 'gold_top_keywords', word, frequency
      FROM ({_top_keywords(silver, "title_clean", _ASCII_DELETED)})"""


def all_oracles() -> dict[str, str]:
    silver_columns = (
        "id, title, author, published_date, category, content, source, country, url,"
        " content_clean, title_clean, content_normalized, title_normalized, language"
    )
    silver_rows = f"{_SILVER} SELECT {silver_columns} FROM silver"
    message_columns = "title, author, category, content, source, country, url"
    return {
        "top_keywords": _top_keywords("documents", "text", _ASCII_DELETED),
        "top_keywords_unicode": _top_keywords("documents", "text", _UNICODE_DELETED),
        "unbroken_keywords": f"""
            WITH unbroken AS (SELECT replace(text, ' ', '') AS text FROM documents)
            {_top_keywords("unbroken", "text", _ASCII_DELETED)}""",
        "title_keywords": f"""{_COUNTED}, titles AS (SELECT {_strip_html("title")} AS title_clean FROM counted)
            {_top_keywords("titles", "title_clean", _ASCII_DELETED)}""",
        "html_strip": f"SELECT page_id, {_strip_html('html')} AS text FROM pages",
        "text_normalize": f"SELECT page_id, {_normalize(_strip_html('html'))} AS text FROM pages",
        "country_canonical": f"SELECT id, {_country('country')} AS country FROM ({_ARTICLES})",
        "quality_accepted": f"SELECT * FROM ({_ARTICLES}) WHERE {_ACCEPTED_TEST}",
        "quality_report": f"""
            SELECT loaded, accepted, loaded - accepted AS rejected FROM (
              SELECT count(*) AS loaded, count(*) FILTER (WHERE {_ACCEPTED_TEST}) AS accepted
              FROM ({_ARTICLES}))""",
        "silver_articles": silver_rows,
        "articles_per_day": f"{_COUNTED} {_per('counted', 'publish_day')} ORDER BY publish_day DESC",
        "articles_per_source": f"{_COUNTED} {_per('counted', 'source')} ORDER BY article_count DESC, source",
        "articles_per_category": f"{_COUNTED} {_per('counted', 'category')} ORDER BY article_count DESC, category",
        "articles_per_country": f"{_COUNTED} {_per('counted', 'country')} ORDER BY article_count DESC, country",
        "articles_per_language": f"{_SILVER} {_per('silver', 'language')} ORDER BY article_count DESC, language",
        "articles_all_dimensions": f"""{_SILVER}
            SELECT CASE WHEN grouping(publish_day) = 0 THEN 'publish_day' WHEN grouping(source) = 0 THEN 'source'
                WHEN grouping(category) = 0 THEN 'category' WHEN grouping(country) = 0 THEN 'country'
                ELSE 'language' END AS dimension,
              publish_day, source, category, country, language, count(*) AS article_count
            FROM silver
            GROUP BY GROUPING SETS ((publish_day), (source), (category), (country), (language))""",
        "events_per_day": """
            SELECT CAST(ts AS date) AS publish_day, count(*) AS article_count
            FROM events GROUP BY 1 ORDER BY 1 DESC""",
        "page_hosts": """
            SELECT lower(nullif(regexp_extract(url, '://([^/?#:]+)', 1), '')) AS host, count(*) AS pages,
              coalesce(host IN ('www.ththon.example.org', 'www.aljazeera.com'), false) AS matched
            FROM pages GROUP BY 1""",
        "daily_trend": f"{_COUNTED} {_per('counted', 'publish_day')} ORDER BY publish_day",
        "country_share": f"{_COUNTED} {_with_share('counted', 'country')}",
        "language_share": f"{_SILVER} {_with_share('silver', 'language')}",
        "source_totals": f"""
            SELECT source, CAST(grouping(source) AS integer) AS is_total, count(*) AS article_count
            FROM ({_ARTICLES}) GROUP BY ROLLUP (source)""",
        "language_profiles": f"WITH {_PROFILES} SELECT lang, gram, gram_count, weight FROM profiles",
        "language_detect": f"WITH {_languages('documents', 'doc_id', 'text')} SELECT doc_id, language FROM languages",
        "language_detect_joined": f"WITH {_languages('documents', 'doc_id', 'text')} SELECT doc_id, language FROM languages",
        "extract_headings": _page_elements(
            "<h1[^>]*>(.*?)</h1>", ["body"], f"{_strip(_unescaped('body'))} AS title"
        ),
        "extract_links": _page_elements(
            '<li><a href="([^"]*)">(.*?)</a></li>',
            ["target", "body"],
            f"{_strip(_unescaped('body'))} AS title, {_unescaped('target')} AS url",
        ),
        "extract_cards": _page_elements(
            '<div class="ad">(.*?)</div>', ["body"], f"{_strip(_unescaped('body'))} AS title, '' AS url"
        ),
        "site_articles": _site_articles(BATCH_SITES),
        "live_site_articles": _site_articles(LIVE_SITES),
        "article_messages": _ARTICLES,
        "bronze_roundtrip": _ARTICLES,
        "broken_lines": """
            SELECT '{"id": "' || doc_id || '", "content": ' || translate(text, chr(10) || chr(13), '  ') AS line,
              (SELECT count(*) FROM documents) AS loaded,
              (SELECT count(*) FROM documents WHERE doc_id % 7 <> 0) AS good
            FROM documents WHERE doc_id % 7 = 0""",
        "gold_roundtrip": f"""{_COUNTED}
            SELECT source, count(*) AS article_count, count(*) OVER () AS stored_rows FROM counted GROUP BY source""",
        "stream_silver": silver_rows,
        "stream_site_messages": f"SELECT {message_columns} FROM ({_site_articles(LIVE_SITES)})",
        "stream_bounded_cycles": f"""
            SELECT 5 AS cycles, (SELECT count(*) FROM documents) AS pages, count(*) AS sent, 0 AS failed_pages,
              (SELECT count(*) FROM documents WHERE doc_id % 7 = 0) AS unmatched_pages
            FROM ({_site_articles(LIVE_SITES)}) WHERE CAST(split_part(id, '-', 1) AS bigint) % 7 <> 0""",
        "stream_letters": f"""
            SELECT 'site' || (doc_id % 11) || '.example' AS host, count(*) AS pages,
              (SELECT count(*) FROM ({_site_articles(LIVE_SITES)})
               WHERE CAST(split_part(id, '-', 1) AS bigint) % 3 <> 0) AS sent, 0 AS failed
            FROM documents WHERE doc_id % 3 = 0 GROUP BY 1""",
        "stream_daily_counts": f"""
            SELECT TRY_CAST(substr(published_date, 1, 10) AS date) AS publish_day, count(*) AS article_count
            FROM ({_ARTICLES}) GROUP BY 1""",
        "news_run_gold": f"WITH {_silver_ctes(_site_articles(BATCH_SITES))} {_gold_list('silver')}",
        "dashboard_views": f"""{_SILVER}
            SELECT 'daily_trend' AS chart, CAST(publish_day AS varchar) AS label, CAST(count(*) AS double) AS value
            FROM silver GROUP BY publish_day
            UNION ALL SELECT 'sources', source, count(*) FROM silver GROUP BY source
            UNION ALL SELECT 'country_share', country, round(count(*) / sum(count(*)) OVER (), 6)
              FROM silver GROUP BY country
            UNION ALL SELECT 'language_share', language, round(count(*) / sum(count(*)) OVER (), 6)
              FROM silver GROUP BY language
            UNION ALL SELECT 'keywords', word, frequency
              FROM ({_top_keywords("silver", "title_clean", _ASCII_DELETED)})""",
    }
