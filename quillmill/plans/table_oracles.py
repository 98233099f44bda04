"""The table queries as plain SQL for DuckDB, by query name."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LINE = "replace(replace(replace(replace({0}, chr(13), ''), chr(10), ' <p> '), '<p>  <p>', '<p>'), '  ', ' ')"
_ASCII = (
    "regexp_replace(replace(translate({0}, 'ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü', 'ACEEEINOOUaceeeinoou'), 'ß', 'ss'), "
    "'[^\\x00-\\x7F]', '', 'g')"
)


def _line(c: str) -> str:
    return _LINE.format(c)


def _ascii(c: str) -> str:
    return _ASCII.format(c)


ORACLES["linebreaks"] = f"SELECT doc_id, {_line('text')} AS line FROM documents"
ORACLES["transliterate"] = f"SELECT doc_id, {_ascii('text')} AS ascii FROM documents"
ORACLES["transliterate_scripts"] = (
    f"SELECT doc_id, replace({_ascii('text')}, chr(10), chr(10) || 'hangugeo kana gatsukou Moskva logos ') AS ascii FROM documents"
)
_WORDS = "'SHlvm slm nmste baaNlaa aithy t`bilisi Hay Han Zi  Rs5  '"
ORACLES["transliterate_all_scripts"] = f"""
SELECT doc_id, {_WORDS} || replace({_ascii('text')}, chr(10), chr(10) || {_WORDS}) AS ascii,
       CAST(2 * (1 + len(text) - len(replace(text, chr(10), ''))) + len(regexp_replace(
         replace(translate(text, 'ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü', ''), 'ß', ''), '[\\x00-\\x7F]', '', 'g')) AS INTEGER) AS lost
FROM documents"""
ORACLES["transliterate_record"] = f"SELECT conv_id, turn, {_ascii('role')} AS role, {_ascii('text')} AS text FROM conversations"
ORACLES["token_lengths"] = (
    "SELECT doc_id AS tweet_id, CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS tweet_length FROM documents"
)
ORACLES["words_no_punct"] = r"""
SELECT conv_id, turn,
       array_to_string([regexp_replace(w, '[!-/:-@\[-`{-~]', '', 'g') FOR w IN regexp_extract_all(text, '\S+')], ' ') AS words
FROM conversations"""
ORACLES["drop_lines"] = """
SELECT doc_id, array_to_string(
         [trim(l, ' ' || chr(9) || chr(13)) FOR l IN string_split(text, chr(10))
          IF trim(l, ' ' || chr(9) || chr(13)) <> '' AND NOT contains(l, 'MIT License')], chr(10)) AS body
FROM documents"""
ORACLES["doc_ids"] = """
SELECT doc_id, printf('%05d_%s', doc_id, source) AS id, printf('%05d_%s_%s', doc_id, source, lang) AS user_id,
       printf('%05d_%s.json', doc_id, source) AS file_name
FROM documents"""
ORACLES["batch_names"] = """
WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d') || '_' AS name, printf('%02d', event_id // 1000) AS b FROM events)
SELECT event_id, name || '_' || b || '.txt' AS corpus_file, name || '_' || b || '.json' AS metadata_file,
       name || '_' || b || '.csv' AS lengths_file
FROM e"""
ORACLES["split_tags"] = """
SELECT doc_id, CAST(len(string_split(text, ', ')) AS INTEGER) AS n, replace(text, ', ', '|') AS tags FROM documents"""
ORACLES["distinct_words"] = """
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
     f AS (SELECT doc_id, w, min(i) AS i FROM w WHERE w <> '' GROUP BY ALL)
SELECT doc_id, string_agg(w, ',' ORDER BY i) AS words FROM f GROUP BY doc_id"""

ORACLES["week_end"] = """
WITH e AS (SELECT event_id, CAST(user_id % 60 - 8 AS INTEGER) AS week FROM events)
SELECT event_id, week,
       CASE WHEN week BETWEEN -4 AND 49 THEN strftime(DATE '2020-02-09' + 7 * (week - 1), '%Y-%m-%d') END AS publication_date
FROM e"""
ORACLES["tweet_dates"] = "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events"
ORACLES["article_dates"] = """
SELECT event_id, CASE WHEN event_type <> 'purchase' THEN strftime(ts, '%Y-%m-%d') END AS date FROM events"""

# Documents as papers: (doc_id, position from 1, line), title at 1, abstract at 2, body after.
_LINES = """
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
s AS (SELECT *, least(i, 3) AS part, string_split(line, ' ')[1] AS section FROM l),
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, part, section ORDER BY i) AS k FROM s)"""
ORACLES["paper_corpus"] = f"""
WITH {_LINES},
t AS (SELECT doc_id, string_agg(CASE WHEN i > 1 AND k = 1 THEN section || chr(10) || line ELSE line END, chr(10) ORDER BY i) AS text
      FROM p GROUP BY doc_id)
SELECT printf('%06d', doc_id) AS id, {_line('text')} AS text FROM t"""
ORACLES["paper_records"] = """
WITH d AS (SELECT doc_id, string_split(text, chr(10))[1] AS title FROM documents),
w AS (SELECT doc_id, unnest(string_split(title, ' ')) AS w, generate_subscripts(string_split(title, ' '), 1) AS i FROM d),
n AS (SELECT doc_id, trim(w[1] || ' ' || w[2]) AS name, CASE WHEN len(w) > 2 THEN w[1:2] END AS country, i FROM w WHERE w <> ''),
names AS (SELECT doc_id, name, min(i) AS i FROM n GROUP BY ALL),
countries AS (SELECT doc_id, country, min(i) AS i FROM n WHERE country <> '' GROUP BY ALL),
a AS (SELECT doc_id, string_agg(name, ',' ORDER BY i) AS author FROM names GROUP BY doc_id),
c AS (SELECT doc_id, string_agg(country, ',' ORDER BY i) AS location FROM countries GROUP BY doc_id),
m AS (SELECT d.doc_id, min(l.doc_id) AS hit FROM d JOIN labels l ON d.doc_id IN (l.doc_id, l.doc_id + 1) GROUP BY d.doc_id)
SELECT printf('%06d', d.doc_id) AS id, d.title, coalesce(a.author, '') AS author, coalesce(c.location, '') AS location,
       'journal ' || l.quality AS journal, '10.1/' || l.doc_id AS doi, 'https://doi.example.org/' || l.doc_id AS url,
       CASE WHEN l.doc_id IS NOT NULL THEN '2020-03-01' END AS publication_date
FROM d LEFT JOIN a USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN labels l ON l.doc_id = m.hit"""
ORACLES["paper_metadata_join"] = """
WITH m AS (SELECT printf('Supplier#%09d; Supplier#%09d', l_suppkey, l_partkey) AS sha, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
j AS (SELECT s_name AS paper_id, m.*,
             row_number() OVER (PARTITION BY s_name ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k
      FROM supplier LEFT JOIN m ON contains(sha, s_name))
SELECT paper_id, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM j WHERE k = 1"""
ORACLES["contained_names"] = """
WITH m AS (SELECT n_name || '/' || c_name AS sha, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name AS paper_id, min(c_custkey) AS c_custkey FROM nation LEFT JOIN m ON contains(sha, n_name) GROUP BY n_name"""
ORACLES["headings_once"] = """
WITH k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations)
SELECT conv_id, turn, 0 AS part, CASE WHEN k = 1 THEN role ELSE text END AS line FROM k
UNION ALL SELECT conv_id, turn, 1, text FROM k WHERE k = 1"""

_NOTICE = "(contains(text, 'License') OR contains(text, 'license') OR contains(text, '#DEBUG (start_removal)'))"
ORACLES["removed_posts"] = f"SELECT doc_id, source FROM documents WHERE NOT {_NOTICE}"
ORACLES["sequence_ids"] = f"""
WITH a AS (SELECT 'document' AS kind, 0 AS o, doc_id AS row_id, text FROM documents
           UNION ALL SELECT 'benchmark', 1, item_id, text FROM benchmark)
SELECT printf('reddit_%06d', row_number() OVER (ORDER BY o, row_id)) AS id, kind, row_id FROM a WHERE NOT {_NOTICE}"""
ORACLES["labelled_posts"] = f"""
WITH a AS (SELECT *, CASE WHEN lang = 'en' THEN 'female' ELSE 'male' END AS gender, CAST(n_chars % 50 AS INTEGER) AS week
           FROM documents WHERE source <> 'src3' AND NOT contains(text, '(#start_removal)'))
SELECT printf('reddit_%06d', row_number() OVER (ORDER BY gender, doc_id)) AS id,
       CASE WHEN week <= 49 THEN strftime(DATE '2020-02-09' + 7 * (week - 1), '%Y-%m-%d') END AS publication_date,
       {_line('text')} AS line, n_chars / 8 AS valance, n_chars / 16 AS std_valance, doc_id, gender
FROM a"""

_CUSTOMERS = """
c AS (SELECT *, chr(65 + c_nationkey) AS code,
        CASE c_mktsegment
          WHEN 'BUILDING' THEN 'near ' || n_name || ' town'
          WHEN 'MACHINERY' THEN 'Austin, TX.'
          WHEN 'HOUSEHOLD' THEN 'London, UK Q' || chr(65 + c_nationkey)
          WHEN 'FURNITURE' THEN 'xx (QZ' || chr(65 + c_nationkey) || ') uk'
          ELSE CASE WHEN c_acctbal < 0 THEN '' ELSE 'the Q' || chr(65 + c_nationkey) || '.' END END AS loc
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
named AS (SELECT c_custkey, arg_max(n.n_name, n.n_nationkey) AS by_name FROM c JOIN nation n ON contains(c.loc, n.n_name) GROUP BY 1),
located AS (SELECT c.*, coalesce(by_name,
        CASE c_mktsegment WHEN 'MACHINERY' THEN 'United States'
                          WHEN 'HOUSEHOLD' THEN CASE WHEN c_nationkey = 0 THEN n_name ELSE 'United Kingdom' END
                          WHEN 'FURNITURE' THEN n_name
                          WHEN 'BUILDING' THEN NULL
                          ELSE CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name END END) AS location
      FROM c LEFT JOIN named USING (c_custkey))"""
_TWEETS = f"""
{_CUSTOMERS},
t AS (SELECT *, json_extract_string(props, '$.k') AS k, event_type NOT IN ('error', 'signup') AS kept,
             {_line("event_type || chr(10) || props || '  end'")} AS content
      FROM events JOIN located ON user_id = c_custkey)"""
ORACLES["tweet_locations"] = f"WITH {_CUSTOMERS} SELECT c_custkey, location FROM located"
ORACLES["retweet_split"] = """
SELECT CAST(event_id AS VARCHAR) AS id_str, CASE WHEN event_type IN ('error', 'signup') THEN 'skipped' ELSE 'kept' END AS part
FROM events JOIN customer ON user_id = c_custkey"""
ORACLES["tweet_records"] = f"""
WITH {_TWEETS}
SELECT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_type = 'view' THEN n_name ELSE location END AS location,
       event_type || '|' || k AS hashtags, 'https://www.example.org/' || k AS urls, CAST(user_id AS VARCHAR) AS user_mentions,
       event_id AS id, 'en' AS language, user_id AS favourite_count, CAST(k AS BIGINT) AS retweet_count,
       CASE WHEN event_type = 'click' THEN event_id - 1 END AS in_reply_to_status_id,
       CASE WHEN event_type = 'click' THEN user_id END AS in_reply_to_user_id,
       c_custkey AS author, c_name AS author_name, user_id * 3 AS author_followers_count, user_id AS author_statuses_count,
       user_id > 75 AS author_verified, content
FROM t"""
ORACLES["hydrate"] = "SELECT o_custkey AS id, o_orderkey, s_name FROM orders JOIN supplier ON o_custkey = s_suppkey"
ORACLES["hydrate_distinct"] = "SELECT DISTINCT o_custkey AS id, s_name FROM orders JOIN supplier ON o_custkey = s_suppkey"
ORACLES["daily_counts"] = "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events GROUP BY 1"

_IDS = """
i AS (SELECT event_type AS file_name, event_id AS id, value,
             row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS pos FROM events),
b AS (SELECT *, CAST(pos // 300 AS INTEGER) AS batch_id FROM i),
plan AS (SELECT DISTINCT file_name, batch_id FROM b)"""
ORACLES["positions"] = f"WITH {_IDS} SELECT file_name, id, pos, batch_id FROM b"
ORACLES["batch_plan"] = """
SELECT event_type AS file_name, count(*) AS n_rows, CAST(ceil(count(*) / 300) AS INTEGER) AS total_batches FROM events GROUP BY 1"""
ORACLES["pending_batches"] = f"""
WITH {_IDS}, done AS (SELECT DISTINCT CASE WHEN toxic = 1 THEN 'view' ELSE 'click' END AS file_name, quality AS batch_id FROM labels)
SELECT file_name, batch_id FROM plan ANTI JOIN done USING (file_name, batch_id)"""
ORACLES["batch_log"] = f"""
WITH {_IDS} SELECT file_name, batch_id, count(*) FILTER (value < 2) AS num_tweets_saved FROM b GROUP BY ALL"""
ORACLES["id_column"] = "SELECT o_custkey AS id FROM orders"
ORACLES["file_order"] = """
WITH f AS (SELECT DISTINCT 'ids/' || lang || '/' || source || '.csv' AS file_path FROM documents)
SELECT file_path, row_number() OVER (ORDER BY file_path) AS rank FROM f"""
ORACLES["file_union"] = """
SELECT doc_id AS row_id, text, 0 AS dir_ord FROM documents UNION ALL SELECT item_id, text, 1 FROM benchmark"""
ORACLES["processing_order"] = f"""
WITH {_IDS} SELECT file_name, batch_id, row_number() OVER (ORDER BY batch_id, file_name) AS step FROM plan"""
ORACLES["head_per_file"] = f"WITH {_IDS} SELECT file_name, id, CAST(pos AS INTEGER) AS pos FROM i WHERE pos < 100"
ORACLES["file_dates"] = f"""
WITH {_IDS},
h AS (SELECT file_name, arg_min(DATE '2024-01-01' + CAST(doc_id AS INTEGER), pos) AS d FROM i JOIN labels ON id = doc_id WHERE pos < 100 GROUP BY 1),
f AS (SELECT DISTINCT file_name FROM i)
SELECT 'corona_tweets_' || file_name || '.csv' AS file_name, strftime(d, '%Y-%m-%d') AS date,
       strftime(d, '%Y-%m-%d') || '_corona_tweets_' || file_name || '.csv' AS new_name
FROM f LEFT JOIN h USING (file_name)"""
ORACLES["hydrate_batches"] = f"""
WITH {_TWEETS}, o AS (SELECT *, strftime(ts, '%Y-%m-%d') || '_tweets_cov19.csv' AS file_name FROM t)
SELECT file_name, event_id || chr(9) || content AS line, 'corpus' AS output FROM o WHERE kept
UNION ALL SELECT file_name, event_id || chr(9) || len(regexp_extract_all(event_type || chr(10) || props || '  end', '\\S+')), 'lengths' FROM o WHERE kept
UNION ALL SELECT file_name, CAST(event_id AS VARCHAR), 'skipped' FROM o WHERE NOT kept
UNION ALL SELECT file_name, CAST(count(*) FILTER (kept) AS VARCHAR), 'ledger' FROM o GROUP BY file_name"""

ORACLES["first_n"] = "SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 50"
ORACLES["sample_n"] = "SELECT doc_id, source FROM documents ORDER BY md5('7' || doc_id), doc_id LIMIT 200"
ORACLES["summary"] = "SELECT source, count(*) AS n FROM documents GROUP BY source"
ORACLES["by_source"] = "SELECT doc_id, source, lang FROM documents WHERE source = 'src7'"
ORACLES["survey_pages"] = "SELECT doc_id FROM documents WHERE NOT contains(text, 'MIT License')"
ORACLES["url_prefix"] = "SELECT page_id, url FROM pages WHERE NOT starts_with(url, 'https://blog.')"
ORACLES["new_only"] = """
WITH k AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE source <> 'src0')
SELECT doc_id, source FROM k WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM documents s WHERE s.source = 'src0' AND s.text = k.text)"""
ORACLES["drop_empty_fields"] = """
SELECT d.doc_id AS id, CASE WHEN lang = 'de' THEN '' ELSE source END AS author,
       CASE WHEN lang <> 'de' THEN lang END AS description, CASE WHEN toxic = 1 THEN 'toxic' END AS tags, quality
FROM documents d LEFT JOIN labels l USING (doc_id)"""

_LINKS = """
a AS (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS hrefs FROM pages),
links AS (SELECT page_id AS page_num, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos, unnest(hrefs) AS href FROM a)"""
_SITE = "'https://www.example.org' || href"
ORACLES["page_links"] = f"WITH {_LINKS} SELECT 'site' AS source, page_num, pos, {_SITE} AS url FROM links"
ORACLES["class_links"] = f"""
WITH {_LINKS} SELECT 'sun' AS source, page_num, pos, 'https://www.thesun.co.uk' || href AS url FROM links"""
ORACLES["child_links"] = f"""
WITH {_LINKS} SELECT 'weforum' AS source, page_num, pos, 'https://www.weforum.org' || href AS url
FROM links JOIN pages ON page_id = page_num WHERE len(url) % 2 = 0"""
ORACLES["link_dedup"] = f"""
WITH {_LINKS} SELECT 'site' AS source, page_num, min(pos) AS pos, {_SITE} AS url FROM links GROUP BY ALL"""
ORACLES["frontier_limit"] = f"""
WITH {_LINKS} SELECT page_num, pos, {_SITE} AS url FROM links ORDER BY page_num, pos LIMIT 120"""
ORACLES["article_index"] = f"""
WITH {_LINKS} SELECT 'site' AS source, page_num, pos, {_SITE} AS url,
       row_number() OVER (ORDER BY page_num, pos) AS id_custom FROM links"""
ORACLES["index_frontier"] = f"""
WITH {_LINKS}, n AS (SELECT page_num AS page_id, CAST(ceil(count(*) * 37 / 20) AS INTEGER) AS n FROM links GROUP BY 1),
u AS (SELECT page_id, unnest(generate_series(1, n)) AS page_num FROM n)
SELECT page_id, CAST(page_num AS INTEGER) AS page_num,
       'https://www.theguardian.com/world/coronavirus-outbreak?page=' || page_num AS index_url FROM u"""


def _unescaped(c: str) -> str:
    for entity, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        c = f"replace({c}, '{entity}', '{char}')"
    return c


def _stripped_lines(c: str) -> str:
    blank = "' ' || chr(9) || chr(13)"
    return f"array_to_string([trim(l, {blank}) FOR l IN string_split({c}, chr(10)) IF trim(l, {blank}) <> ''], chr(10))"


def _main_text(c: str) -> str:
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', '', 'g')"
    for element in ("script", "style", "nav", "footer"):
        c = f"regexp_replace({c}, '(?is)<{element}\\b[^>]*>.*?</{element}\\s*>', '', 'g')"
    c = f"regexp_extract({c}, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
    blocks = "p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|blockquote|pre"
    c = f"regexp_replace({c}, '(?i)</?(?:{blocks})\\b[^>]*>', chr(10), 'g')"
    return _stripped_lines(_unescaped(f"regexp_replace({c}, '<[^>]*>', '', 'g')"))


_TITLE = f"trim({_unescaped('''regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)''')})"
ORACLES["page_title"] = f"SELECT page_id, {_TITLE} AS title FROM pages"
ORACLES["main_text"] = f"SELECT page_id, {_main_text('html')} AS text FROM pages"
ORACLES["container_text"] = f"""
SELECT page_id, {_stripped_lines(_unescaped('''regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1)'''))} AS text FROM pages"""
ORACLES["page_meta"] = """
SELECT page_id, 'T ' || url AS title, 'D ' || page_id || ' & more' AS description, 'news' AS format,
       CAST(NULL AS VARCHAR) AS taxon_slug, 'A' || page_id AS author, 'a,b c' AS tags, '2020-05-06' AS date
FROM pages"""
ORACLES["json_ld"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_type <> 'view' THEN event_type END AS author,
       event_type AS category, 'k|' || json_extract_string(props, '$.k') AS keywords
FROM events"""
ORACLES["article_records"] = f"""
SELECT 'guardian' AS source, url, CAST(page_id + 1 AS INTEGER) AS id_custom, {_TITLE} AS title, {_main_text('html')} AS content,
       CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS author
FROM pages"""
ORACLES["export_posts"] = f"""
SELECT printf('%05d_guardian', page_id + 1) AS id, {_line(_ascii(f"replace(replace({_main_text('html')}, '©', '(c)'), '·', '*')"))} AS text, {_TITLE} AS title, url FROM pages"""
ORACLES["ingest_pages_stream"] = f"""
SELECT 'sun' AS source, url, page_id AS id_custom, {_TITLE} AS title, {_main_text('html')} AS content FROM pages"""
ORACLES["ingest_rejects_stream"] = """
SELECT url, CASE WHEN page_id % 3 <> 0 THEN page_id ELSE -1 - page_id END AS id_custom, 'saved' AS state FROM pages WHERE page_id % 6 <> 0
UNION ALL SELECT url, unnest([page_id, -1 - page_id]), 'no content' FROM pages WHERE page_id % 6 = 0"""

ORACLES["written_corpus"] = f"SELECT doc_id || chr(9) || {_line('text')} AS line FROM documents"
ORACLES["written_metadata"] = """
SELECT doc_id, lang, n_chars, quality, source, toxic FROM documents LEFT JOIN labels USING (doc_id)"""
ORACLES["written_samples"] = "SELECT doc_id, text FROM documents ORDER BY md5('3' || doc_id), doc_id LIMIT 60"
ORACLES["written_days"] = """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, min(event_id) AS first_id FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' GROUP BY 1"""

ORACLES["written_all_days"] = """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1"""
ORACLES["shared_days"] = """
SELECT strftime(ts, '%Y-%m-%d') || '_tweets_cov19.csv' AS file_name, count(*) AS n, sum(event_id)::bigint AS ids FROM events
WHERE event_id % 2 = 0 OR CAST(ts AS DATE) < DATE '2024-01-20' GROUP BY 1"""
_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
ORACLES["first_n_many"] = f"SELECT {_LINES} FROM lineitem ORDER BY {_LINES} LIMIT 20000"
ORACLES["first_n_descending"] = f"SELECT {_LINES} FROM lineitem ORDER BY l_orderkey DESC, {_LINES} LIMIT 15000"
ORACLES["id_files"] = """
SELECT event_type AS dataset, event_id AS id, true AS valid FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'broken', doc_id, false FROM labels"""
ORACLES["resumed_batches"] = f"""
WITH {_TWEETS}, o AS (SELECT *, strftime(ts, '%Y-%m-%d') || '_tweets_cov19.csv' AS file_name FROM t)
SELECT file_name, count(*) AS ids, count(*) FILTER (kept) AS saved, count(*) FILTER (kept) AS lines, count(DISTINCT event_id) FILTER (kept) AS texts
FROM o GROUP BY file_name"""

ORACLES["page_counts"] = """
WITH n AS (SELECT page_id, CAST(page_id % 900 + 2 AS INTEGER) AS n FROM pages)
SELECT page_id, s.source, n AS num_pages FROM n, (SELECT unnest(['gov_uk_news', 'guardian', 'sun', 'weforum']) AS source) s
UNION ALL SELECT page_id // 10 * 10, 'telegraph', CAST(max(page_id) AS INTEGER) FROM pages
WHERE page_id % 3 <> 0 AND contains(html, '<li><a href') GROUP BY 1"""
ORACLES["pages_to_fetch"] = """
WITH stored AS (SELECT page_id, page_id % 3 <> 0 AND contains(html, '<li><a href') AS linked FROM pages WHERE page_id % 5 <> 2),
n AS (SELECT unnest(generate_series(1, (SELECT max(page_id) FILTER (linked) + 25 FROM stored))) AS page_num)
SELECT CAST(page_num AS INTEGER) AS page_num, 'https://www.telegraph.co.uk/coronavirus/page-' || page_num || '/' AS index_url
FROM n WHERE page_num NOT IN (SELECT page_id FROM stored)"""
ORACLES["scraped_articles"] = """
WITH l AS (SELECT page_id // 10 AS page_num, page_id AS place, url, true AS there FROM pages
           UNION ALL SELECT DISTINCT page_id // 10, 1000000000000, 'https://gone.example.org/' || (page_id // 10), false FROM pages)
SELECT url, row_number() OVER (ORDER BY page_num, place) AS id_custom, CASE WHEN there THEN 'saved' ELSE 'no page' END AS state FROM l"""
ORACLES["processed_papers"] = f"""
SELECT printf('%06d', d.doc_id) || chr(9) || {_line("source || chr(10) || lang || chr(10) || text")} AS line,
       source AS title, 'journal ' || quality AS journal, 'https://doi.example.org/' || l.doc_id AS url
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
_CONTAINER = _stripped_lines(_unescaped("regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', '', 'g')"))
for _source, _kind, _text in (("gov_uk_news", "'news'", _main_text("html")), ("telegraph", "NULL", _main_text("html")), ("weforum", "'health'", _CONTAINER)):
    ORACLES[f"{_source}_records"] = f"""
SELECT page_id + 1 AS id_custom, 'T' || page_id AS title, {_text} AS content, '2020-05-06' AS date, CAST({_kind} AS VARCHAR) AS kind
FROM pages WHERE page_id % 3 <> 0"""
