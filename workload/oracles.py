"""The registered queries as SQL over the same tables."""

_COMMITS = """
stats AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS added, sum(CAST(l_linenumber AS BIGINT)) AS deleted,
         list_sort(list('p/' || l_partkey)) AS files,
         list_sort(list(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || chr(9) || l_linenumber || chr(9) || 'p/' || l_partkey)) AS stat_lines
  FROM lineitem GROUP BY l_orderkey),
authors AS (
  SELECT c_custkey, n_name AS repo_owner, c_name AS own_name,
         'Crew  ' || n_name || ' / ' || CAST(floor(c_acctbal / 100) AS BIGINT) AS crew_name,
         CASE c_mktsegment WHEN 'BUILDING' THEN '[bot]@ci.example.org' WHEN 'HOUSEHOLD' THEN '@github.com'
              ELSE '@example.org' END AS domain
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
commits AS (
  SELECT o_orderpriority AS repo_name, repo_owner, CAST(o_orderkey AS VARCHAR) AS hash, o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' THEN crew_name ELSE own_name END AS author_name,
         'c' || c_custkey || '.' || lower(o_orderstatus) || domain AS author_email,
         o_orderdate AS date,
         'Order ' || o_orderkey || chr(10) || chr(10) || 'Status ' || o_orderstatus || ' of customer ' || o_custkey || chr(10) AS message,
         coalesce(files, []) AS files_changed, coalesce(stat_lines, []) AS stat_lines,
         CAST(coalesce(added, 0) AS BIGINT) AS lines_added, CAST(coalesce(deleted, 0) AS BIGINT) AS lines_deleted,
         CAST(coalesce(added, 0) + coalesce(deleted, 0) AS BIGINT) AS lines_modified
  FROM orders LEFT JOIN stats ON o_orderkey = l_orderkey JOIN authors ON o_custkey = c_custkey)
"""

_CONTRIBUTORS = _COMMITS + """,
contributors AS (
  SELECT repo_owner, repo_name, author_email, min(author_name) AS author_name, count(date) AS commit_count,
         CAST(sum(lines_added) AS BIGINT) AS lines_added, CAST(sum(lines_deleted) AS BIGINT) AS lines_deleted,
         CAST(sum(lines_modified) AS BIGINT) AS lines_modified, min(date) AS first_commit, max(date) AS last_commit
  FROM commits GROUP BY repo_owner, repo_name, author_email)
"""

# Components by reachability: from every address to all addresses that share a group, again and again.
_IDENTITIES = _CONTRIBUTORS + """,
named AS (
  SELECT *, trim(regexp_replace(lower(regexp_replace(author_name, '[[:punct:]]', '', 'g')), '\\s+', ' ', 'g')) AS name
  FROM contributors),
by_raw_name AS (SELECT DISTINCT repo_owner || chr(1) || repo_name || chr(1) || {group_name} AS g, author_email AS e FROM named),
linked AS (SELECT DISTINCT a.e AS x, b.e AS y FROM by_raw_name a JOIN by_raw_name b USING (g)),
reach AS (
  SELECT x, y FROM linked
  UNION
  SELECT reach.x, linked.y FROM reach JOIN linked ON reach.y = linked.x),
people AS (
  SELECT x AS email, min(y) AS first_key, count(DISTINCT y) AS key_count, string_agg(DISTINCT y, '|' ORDER BY y) AS identity
  FROM reach GROUP BY x)
"""

_RAW_IDENTITIES = _IDENTITIES.replace("{group_name}", "author_name")

_FINAL = _IDENTITIES.replace("{group_name}", "name") + """,
scored AS (
  SELECT *, CASE WHEN lines_modified % 13 <> 0 THEN 1 + commit_count % 10 END AS impact, 1 + lines_modified % 10 AS ability,
         repo_owner || '/' || repo_name || ': ' || 'did ' || commit_count AS why
  FROM named),
persons AS (
  SELECT repo_owner, repo_name, name AS author_name, identity AS author_email, CAST(key_count AS INTEGER) AS email_count,
         CAST(sum(commit_count) AS BIGINT) AS commit_count, CAST(sum(lines_added) AS BIGINT) AS lines_added,
         CAST(sum(lines_deleted) AS BIGINT) AS lines_deleted, CAST(sum(lines_modified) AS BIGINT) AS lines_modified,
         min(first_commit) AS first_commit, max(last_commit) AS last_commit,
         string_agg(why, chr(10) ORDER BY scored.author_email, why) AS reason,
         sum(impact * commit_count) / sum(commit_count) AS impact_to_project,
         sum(ability * commit_count) / sum(commit_count) AS technical_ability
  FROM scored JOIN people ON scored.author_email = people.email
  WHERE key_count <= 15
  GROUP BY repo_owner, repo_name, name, identity, key_count),
languages(i, language) AS (VALUES (0, 'rust'), (1, 'python'), (2, 'c++'), (3, 'type script'), (4, 'go')),
repos AS (
  SELECT DISTINCT repo_owner AS owner, repo_name AS name, CAST(split_part(repo_owner, '_', 2) AS INTEGER) AS number
  FROM commits WHERE repo_name <> '3-MEDIUM'),
tags AS (
  SELECT owner, name, 'language' AS kind, language AS tag FROM repos JOIN languages ON i = number % 5 OR i = (number + 2) % 5
  UNION ALL
  SELECT owner, name, 'keyword', lower('topic-' || substr(name, 3, 20)) FROM repos
  UNION ALL
  SELECT owner, name, 'keyword', 'nation-' || number FROM repos),
person_tags AS (
  SELECT author_email AS email,
         coalesce(string_agg(DISTINCT tag, '|' ORDER BY tag) FILTER (WHERE kind = 'language'), '') AS languages,
         coalesce(string_agg(DISTINCT tag, '|' ORDER BY tag) FILTER (WHERE kind = 'keyword'), '') AS keywords
  FROM persons JOIN tags ON repo_owner = owner AND repo_name = name GROUP BY author_email),
contributions AS (
  SELECT author_name, author_email, commit_count, lines_added, lines_deleted, lines_modified, first_commit, last_commit,
         reason, impact_to_project, technical_ability, email_count, languages, keywords, repo_owner || '/' || repo_name AS repo
  FROM persons LEFT JOIN person_tags ON author_email = email)
"""

_PACKAGED = """
packed AS (
  SELECT author_email, min(author_name) AS author_name, min(languages) AS languages, min(keywords) AS keywords,
         CAST(sum(commit_count) AS BIGINT) AS commit_count,
         avg(impact_to_project) AS impact_to_project, avg(technical_ability) AS technical_ability,
         coalesce(string_agg(reason, chr(10) ORDER BY repo, author_name, reason), '') AS reason,
         string_agg(repo || ' ' || commit_count || ' ' || lines_modified || ' ' || CAST(first_commit AS VARCHAR) || ' '
                    || CAST(last_commit AS VARCHAR), chr(10) ORDER BY repo, author_name, reason) AS repo_text,
         string_agg('https://github.com/' || repo || ' ' || strftime(first_commit, '%-m/%-d/%Y') || ' '
                    || strftime(last_commit, '%-m/%-d/%Y'), chr(10) ORDER BY repo, author_name, reason) AS links,
         string_agg(repo || ' ' || commit_count || ' ' || lines_modified, chr(10) ORDER BY repo, author_name, reason) AS short,
         CAST(round(CAST(sum(technical_ability) / count(*) AS DECIMAL(20,8)), 1) AS DOUBLE) AS mean_ability,
         CAST(round(CAST(sum(coalesce(impact_to_project, 0)) / count(*) AS DECIMAL(20,8)), 1) AS DOUBLE) AS mean_impact_shown
  FROM asked GROUP BY author_email),
answer AS (
  SELECT * FROM packed
  ORDER BY round(technical_ability, 9) DESC NULLS LAST, round(impact_to_project, 9) DESC NULLS LAST,
           commit_count DESC NULLS LAST, author_email
  LIMIT 100)
"""


def _markup(text: str) -> str:
    space = r"[\t\n\v\f\r ]"
    return f"""
    CAST(regexp_matches({text}, '\\[[^\\]]+\\]\\(http') AS INTEGER)
    + CAST(regexp_matches({text}, '(?m)^{space}*#{{1,6}}{space}+[^\\t\\n\\v\\f\\r ]') AS INTEGER)
    - CAST(regexp_matches({text}, '(?m)^\\.\\.{space}+[0-9A-Za-z_]+::') AS INTEGER)
    - CAST(regexp_matches({text}, '(?m)^[=\\-`:\\.''^~*+#]+(\\r?\\n)+') AS INTEGER)"""


_WORDS = r"string_split_regex(lower(concat_ws(' ', p_name, p_type)), '[^\p{L}\p{N}+#.-]+')"

_HITS = f"""
WITH catalogue AS (
  SELECT p_name AS name, p_brand AS owner, 'https://git.example.org/part/' || p_partkey AS url,
         CAST(floor(p_retailprice) AS BIGINT) AS stars,
         {_WORDS} || CASE WHEN p_partkey % 5 = 0 OR p_size % 5 = 0 THEN ['language:rust'] ELSE [] END AS words FROM part),
asked(query, a, b) AS (VALUES ('ring', 'ring', 'ring'), ('red,gear', 'red,gear', 'red,gear'),
  ('owner:Brand#7 widget', 'owner:brand#7', 'widget'), ('small', 'small', 'small'), ('nosuchword', 'nosuchword', 'nosuchword'),
  ('language:rust', 'language:rust', 'language:rust')),
hits AS (
  SELECT query, name, owner, url, stars FROM catalogue, asked
  WHERE (list_contains(words, a) OR a = 'owner:' || lower(owner)) AND (list_contains(words, b) OR b = 'owner:' || lower(owner)))
"""

_README = """
files AS (
  SELECT 'repo' || (doc_id // 3) AS url, lang, text,
         ['docs/README.md', 'README.rst', 'src/main.c', 'readme', 'README.md', 'LICENSE', 'README.txt'][doc_id % 7 + 1] AS path
  FROM documents),
places(path, place) AS (VALUES ('README.md', 1), ('README.txt', 6), ('readme', 8), ('docs/README.md', 10), ('README.rst', 12)),
best AS (
  SELECT url, text, lang, row_number() OVER (PARTITION BY url ORDER BY place) AS n FROM files JOIN places USING (path)),
numbers AS (SELECT DISTINCT (doc_id + 3) // 3 AS n FROM documents),
picked AS (
  SELECT 'repo' || numbers.n AS url, 'name' || numbers.n AS name, CASE WHEN lang <> 'es' THEN text END AS readme
  FROM numbers LEFT JOIN (SELECT * FROM best WHERE n = 1) b ON b.url = 'repo' || numbers.n
  WHERE numbers.n <> 5)
"""

_SCORES = f"""WITH {_CONTRIBUTORS},
            files AS (SELECT repo_owner, repo_name, author_email, unnest(files_changed) AS f FROM commits),
            counted AS (SELECT repo_owner, repo_name, author_email, least(count(DISTINCT f), 100) AS n FROM files GROUP BY ALL)
            SELECT c.repo_owner, c.repo_name, c.author_email,
                   CASE WHEN commit_count % 11 BETWEEN 1 AND 10 THEN commit_count % 11 END AS impact_to_project,
                   CASE WHEN commit_count % 11 BETWEEN 1 AND 10 THEN 1 + lines_modified % 10 END AS technical_ability,
                   CASE WHEN commit_count % 11 BETWEEN 1 AND 10 THEN coalesce(n, 0) || ' files' END AS reason
            FROM contributors c LEFT JOIN counted f ON c.repo_owner = f.repo_owner AND c.repo_name = f.repo_name AND c.author_email = f.author_email
            WHERE lines_modified > 100 AND commit_count >= 3"""

_PIECES = """
            WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS l FROM part),
            e AS (SELECT p_partkey, unnest(range(len(l))) AS position, unnest(l) AS word FROM w)
            SELECT p_partkey, CAST(position AS BIGINT) AS position, word FROM e WHERE length(word) >= 4"""

_PLAIN = r"regexp_replace(text, '[^\p{L}\p{N} \n]', '', 'g')"

_TRUNCATE = """array_to_string(list_slice(string_split_regex(
    regexp_replace(array_to_string(list_slice(string_split({text}, chr(10)), 1, {lines}), chr(10)), '^\\s+|\\s+$', '', 'g'),
    '\\s+'), 1, {words}), ' ')"""


def _truncated(text: str, lines: int = 500, words: int = 10_000) -> str:
    return _TRUNCATE.format(text=text, lines=lines, words=words)


def _asked(contributions: str = "contributions") -> str:
    from workload.queries import QUESTION

    return QUESTION.format(contributions=contributions)


def oracles() -> dict[str, str]:
    question = f"asked AS ({_asked()})"
    final = f"WITH RECURSIVE {_FINAL}, {question}, {_PACKAGED}"
    band = "CASE WHEN {0} >= 8 THEN 'green' WHEN {0} >= 6 THEN 'blue' WHEN {0} >= 4 THEN 'yellow' ELSE 'gray' END"
    return {
        "flagship": f"""WITH {_CONTRIBUTORS},
            asked AS (
              SELECT *, CAST(commit_count % 10 + 1 AS DOUBLE) AS impact_to_project,
                     CAST(lines_modified % 10 + 1 AS DOUBLE) AS technical_ability, '' AS languages, '' AS keywords,
                     repo_owner || '/' || repo_name AS repo, 'did ' || commit_count AS reason
              FROM contributors WHERE lines_modified > 100 AND commit_count >= 3), {_PACKAGED}
            SELECT author_email, author_name, commit_count, round(impact_to_project, 6) AS impact_to_project,
                   round(technical_ability, 6) AS technical_ability, reason, short AS repo FROM answer""",
        "contributors_rollup": f"WITH {_CONTRIBUTORS} SELECT * FROM contributors",
        "rollup_appends": f"WITH {_CONTRIBUTORS} SELECT * FROM contributors",
        "contributor_messages": f"""WITH {_COMMITS}
            SELECT repo_owner, repo_name, author_email, CAST(sum(length(message)) AS BIGINT) AS chars,
                   md5(string_agg(message, '' ORDER BY date, hash)) AS digest
            FROM commits GROUP BY repo_owner, repo_name, author_email""",
        "contributor_files": f"""WITH {_COMMITS}
            SELECT repo_owner, repo_name, author_email, CAST(sum(len(files_changed)) AS BIGINT) AS files,
                   md5(coalesce(string_agg(array_to_string(files_changed, '|'), '|' ORDER BY date, hash) FILTER (WHERE len(files_changed) > 0), '')) AS digest
            FROM commits GROUP BY repo_owner, repo_name, author_email""",
        "contributors_odd": f"""WITH {_COMMITS},
            odd AS (SELECT * REPLACE ('shared' || length(author_name) || '@x' AS author_email,
                                      CASE WHEN CAST(hash AS BIGINT) % 7 <> 0 THEN date END AS date) FROM commits),
            named AS (SELECT repo_owner, repo_name, author_email, author_name, min(date) AS f FROM odd GROUP BY ALL),
            first AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY repo_owner, repo_name, author_email ORDER BY f NULLS LAST, author_name) = 1)
            SELECT o.repo_owner, o.repo_name, o.author_email, any_value(first.author_name) AS author_name, count(date) AS commit_count,
                   CAST(sum(lines_added) AS BIGINT) AS lines_added, CAST(sum(lines_deleted) AS BIGINT) AS lines_deleted,
                   CAST(sum(lines_modified) AS BIGINT) AS lines_modified, min(date) AS first_commit, max(date) AS last_commit
            FROM odd o JOIN first USING (repo_owner, repo_name, author_email) GROUP BY o.repo_owner, o.repo_name, o.author_email""",
        "active_contributors": f"""WITH {_COMMITS}
            SELECT repo_owner, repo_name, author_email, count(date) AS commit_count, CAST(sum(lines_modified) AS BIGINT) AS lines_modified
            FROM commits GROUP BY ALL HAVING sum(commits.lines_modified) > 100 AND count(date) >= 3""".replace("GROUP BY ALL", "GROUP BY repo_owner, repo_name, author_email"),
        "weighted_mean": """
            WITH x AS (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS w, CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS x FROM lineitem)
            SELECT l_suppkey, CAST(sum(x * w) AS BIGINT) / CAST(sum(w) AS BIGINT) AS mean,
                   CAST(sum(x * w) AS BIGINT) / CAST(sum(w) FILTER (WHERE x IS NOT NULL) AS BIGINT) AS mean_of_known
            FROM x GROUP BY l_suppkey""",
        "history_digest": f"""
            WITH whole AS (SELECT source, string_agg(text || chr(10), '' ORDER BY doc_id) AS text FROM documents GROUP BY source),
            digest AS (SELECT source, {_truncated('text')} AS text FROM whole)
            SELECT source, CAST(len(string_split(text, ' ')) AS BIGINT) AS words, md5(text) AS digest FROM digest""",
        "history_words": f"""
            WITH flat AS (SELECT source, doc_id, replace(text, chr(10), ' ') AS f FROM documents),
            whole AS (SELECT source, string_agg(CASE WHEN doc_id % 5 = 0 THEN regexp_extract(f, '[^ ]+') ELSE f END, '' ORDER BY doc_id) AS text FROM flat GROUP BY source),
            digest AS (SELECT source, {_truncated('text')} AS text FROM whole)
            SELECT source, CAST(len(string_split(text, ' ')) AS BIGINT) AS words, md5(text) AS digest FROM digest""",
        "first_files": """
            WITH d AS (SELECT DISTINCT l_suppkey, 'p/' || l_partkey AS f FROM lineitem),
            r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY f) AS n FROM d)
            SELECT l_suppkey, count(*) AS n, string_agg(f, '|' ORDER BY f) AS files FROM r WHERE n <= 100 GROUP BY l_suppkey""",
        "deny_list": """SELECT p_name AS name, p_brand AS owner, 'https://git.example.org/part/' || p_partkey AS url
            FROM part WHERE p_name NOT IN ('red gear', 'old plate', 'cold ring')""",
        "bot_filter": f"""WITH {_COMMITS} SELECT author_email, count(*) AS commits FROM commits
            WHERE NOT contains(author_email, '[bot]') AND NOT contains(author_email, '@github.com') GROUP BY author_email""",
        "date_range": """SELECT o_orderkey, o_orderdate FROM orders
            WHERE o_orderdate BETWEEN CAST('1996-01-01' AS DATE) AND CAST('1996-12-31' AS DATE)""",
        "like_lower": """SELECT p_partkey, upper(p_brand) || '/' || p_name AS repo FROM part
            WHERE lower(p_brand || '/' || p_name) LIKE 'brand#1%/% gear'""",
        "pipe_member": """
            WITH t AS (SELECT p_partkey, p_type || '|' || replace(p_name, ' ', '-') || '|' || p_brand AS tags FROM part)
            SELECT * FROM t WHERE list_has_any(string_split(lower(tags), '|'), ['red-gear', 'promo'])""",
        "two_key_join": f"""WITH {_COMMITS},
            langs AS (SELECT ['Rust', 'Python', 'C++', 'Type  Script', 'Go'] AS l),
            repos AS (
              SELECT DISTINCT repo_owner AS owner, repo_name AS name, o_orderstatus, CAST(split_part(repo_owner, '_', 2) AS INTEGER) AS number
              FROM commits WHERE repo_name <> '3-MEDIUM')
            SELECT repo_owner, repo_name, l[number % 5 + 1] || '|' || l[(number + 2) % 5 + 1] AS languages, count(*) AS pairs
            FROM commits JOIN repos ON repo_owner = owner AND repo_name = name, langs
            GROUP BY repo_owner, repo_name, l[number % 5 + 1] || '|' || l[(number + 2) % 5 + 1]""",
        "skewed_lookup": """
            SELECT o_orderpriority, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
            FROM lineitem LEFT JOIN orders ON o_orderkey = CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_orderkey END
            GROUP BY o_orderpriority""",
        "agg_join_back": """
            WITH bought AS (
              SELECT o_custkey AS k, list_sort(list(DISTINCT p_brand)) AS brands
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey)
            SELECT o_orderkey, array_to_string(brands, '|') AS brands FROM orders LEFT JOIN bought ON o_custkey = k""",
        "keyword_topk": _HITS + """, ranked AS (
              SELECT *, row_number() OVER (PARTITION BY query ORDER BY stars DESC, owner, name, url) AS n FROM hits)
            SELECT query, CAST(n AS INTEGER) AS rank, name, owner, url, stars FROM asked LEFT JOIN (SELECT * FROM ranked WHERE n <= 10) r USING (query)""",
        "index_topk": _HITS + """, ranked AS (
              SELECT *, row_number() OVER (PARTITION BY query ORDER BY stars DESC, owner, name, url) AS n FROM hits)
            SELECT query, CAST(n AS INTEGER) AS rank, name, owner, url, stars FROM asked LEFT JOIN (SELECT * FROM ranked WHERE n <= 10) r USING (query)""",
        "index_all": _HITS + "SELECT query, name, owner, url, stars FROM asked LEFT JOIN hits USING (query)",
        "index_counts": _HITS + "SELECT query, count(hits.url) AS total FROM asked LEFT JOIN hits USING (query) GROUP BY query",
        "default_search": _HITS + """ SELECT name, owner, url, stars FROM hits WHERE query = 'language:rust'
            ORDER BY stars DESC, owner, name, url LIMIT 10""",
        "keyword_all": _HITS + "SELECT query, name, owner, url, stars FROM asked LEFT JOIN hits USING (query)",
        "keyword_counts": _HITS + "SELECT query, count(hits.url) AS total FROM asked LEFT JOIN hits USING (query) GROUP BY query",
        "first_n_children": """SELECT c_nationkey, c_custkey, c_name FROM customer
            QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) <= 10""",
        "ranked_customers": """
            SELECT CAST(floor(c_acctbal / 1000) AS BIGINT) AS technical_ability, c_nationkey AS impact_to_project,
                   CAST(length(c_mktsegment) AS BIGINT) AS commit_count, c_name
            FROM customer ORDER BY 1 DESC, 2 DESC, 3 DESC, 4 LIMIT 100""",
        "readme_pick": f"WITH {_README} SELECT url, name, readme FROM picked",
        "commit_log_roundtrip": f"""WITH {_COMMITS}
            SELECT repo_owner, repo_name, hash, author_name, author_email, date, message,
                   array_to_string(list_append([string_split(x, chr(9))[3] for x in stat_lines], 'img/logo.png'), '|') AS files_changed,
                   lines_added, lines_deleted, lines_modified FROM commits
            UNION ALL
            SELECT repo_owner, repo_name, 'm' || hash, author_name, author_email, date,
                   'Merge' || chr(10) || '---COMMIT START---' || chr(10) || 'quoted' || chr(10), '', 0, 0, 0 FROM commits""",
        "log_files": f"""WITH {_COMMITS}
            SELECT hash, author_name, author_email, date, message,
                   array_to_string(list_append([string_split(x, chr(9))[3] for x in stat_lines], 'img/logo.png'), '|') AS files_changed,
                   lines_added, lines_deleted, lines_modified FROM commits
            UNION ALL
            SELECT 'm' || hash, author_name, author_email, date,
                   'Merge' || chr(10) || '---COMMIT START---' || chr(10) || 'quoted' || chr(10), '', 0, 0, 0 FROM commits""",
        "remote_url_parts": """
            WITH urls AS (SELECT url FROM pages UNION ALL SELECT 'git@host:' || regexp_replace(url, '^https?://', '') || '.git' FROM pages),
            parts AS (
              SELECT url, CASE WHEN starts_with(url, 'https://') THEN string_split(url, '/')[-2] ELSE string_split(string_split(url, ':')[2], '/')[1] END AS o,
                     CASE WHEN starts_with(url, 'https://') THEN string_split(url, '/')[-1] ELSE string_split(string_split(url, ':')[2], '/')[2] END AS n FROM urls)
            SELECT url, CASE WHEN n IS NOT NULL THEN o END AS owner, regexp_replace(n, '\\.git$', '') AS name, replace(n, '.git', '') AS legacy_name FROM parts""",
        "write_modes": """SELECT p_brand, 2 * count(*) AS appended, count(*) AS overwritten, CAST(3 AS BIGINT) AS files_1,
            CAST(3 AS BIGINT) AS files_2, CAST(3 AS BIGINT) AS files_3 FROM part GROUP BY p_brand""",
        "sized_writes": """
            SELECT CASE WHEN l_linenumber = 7 THEN l_returnflag ELSE 'most' END AS status, count(*) AS rows, true AS bounded
            FROM lineitem WHERE l_quantity <= 25 GROUP BY 1""",
        "files_as_bytes": """SELECT c_nationkey AS nation, md5(string_agg(c_name || chr(10), '' ORDER BY c_name)) AS digest
            FROM customer GROUP BY c_nationkey""",
        "sanitized_text": "SELECT doc_id, md5(chr(65533) || text) AS digest FROM documents",
        "inline_lookup": """SELECT n_name, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS title,
            true AS now_is_shaped FROM nation""",
        "kept_table": f"""WITH RECURSIVE {_FINAL} SELECT repo, count(*) AS people FROM contributions
            WHERE NOT contains(author_email, '[bot]') AND NOT contains(author_email, '@github.com') GROUP BY repo""",
        "infer_top": _SCORES.replace("c.author_email,", "c.author_email, commit_count,", 1)
        + " ORDER BY commit_count DESC, lines_modified DESC, c.repo_owner, c.repo_name, c.author_email LIMIT 7",
        "identity_hops": f"""WITH {_CONTRIBUTORS},
            e AS MATERIALIZED (SELECT DISTINCT repo_owner || chr(1) || repo_name || chr(1) || author_name AS g, author_email AS k FROM contributors),
            one AS MATERIALIZED (SELECT DISTINCT a.k AS x, b.k AS y FROM e a JOIN e b USING (g)),
            two AS MATERIALIZED (SELECT DISTINCT a.x, b.y FROM one a JOIN one b ON a.y = b.x)
            SELECT x AS author_email, min(y) AS first_key, count(*) AS near,
                   CAST(max(CASE WHEN x = y THEN 0 WHEN EXISTS (SELECT 1 FROM one WHERE one.x = two.x AND one.y = two.y) THEN 1 ELSE 2 END) AS INTEGER) AS farthest
            FROM two GROUP BY x""",
        "shared_line_components": """
            WITH RECURSIVE edges AS MATERIALIZED (
              SELECT DISTINCT 'd' || doc_id AS doc, unnest(string_split(text, chr(10))) AS line FROM documents),
            kept AS MATERIALIZED (SELECT doc, line FROM edges WHERE line <> ''),
            found(doc, label) USING KEY (doc) AS (
              SELECT DISTINCT doc, doc FROM kept
              UNION
              SELECT e.doc, min(l.label) FROM (
                  SELECT line, min(label) AS label FROM found JOIN kept USING (doc) GROUP BY line) l
                JOIN kept e USING (line) JOIN recurring.found r ON r.doc = e.doc
              GROUP BY e.doc HAVING min(l.label) < min(r.label))
            SELECT label AS first_key, count(*) AS key_count FROM found GROUP BY label""",
        "arrow_round_trip": "SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name",
        "markup_format": f"""
            WITH forms AS (
              SELECT doc_id AS id, 'plain' AS form, text FROM documents
              UNION ALL SELECT doc_id, 'heading', '# ' || lang || chr(10) || text FROM documents
              UNION ALL SELECT doc_id, 'link', text || ' [x](http://h)' FROM documents
              UNION ALL SELECT doc_id, 'directive', '.. note::' || chr(10) || text FROM documents
              UNION ALL SELECT doc_id, 'tie', '# a' || chr(10) || '=====' || chr(10) || text FROM documents
              UNION ALL SELECT page_id, 'html', html FROM pages),
            judged AS (SELECT id, form, {_markup('text')} AS s FROM forms)
            SELECT id, form, CASE WHEN s > 0 THEN 'markdown' WHEN s < 0 THEN 'rst' ELSE 'unknown' END AS markup FROM judged""",
        "plain_text": f"""
            SELECT doc_id,
              md5('Title' || chr(10) || chr(10) || 'See the docs and bold code' || chr(10) || chr(10) || {_PLAIN} || chr(10)) AS markdown,
              md5('Title' || chr(10) || chr(10) || chr(10) || 'See the docs and bold code' || chr(10) || chr(10) || {_PLAIN} || chr(10)) AS rst
            FROM documents""",
        "normalize_names": """
            SELECT c_custkey, lower(replace(c_name, '#', '') || ' the ' || c_mktsegment) AS name,
                   lower(c_name || ' (the ' || c_mktsegment || ')') AS with_punct, CAST(NULL AS VARCHAR) AS nothing FROM customer""",
        "normalize_documents": """
            SELECT doc_id, md5(trim(regexp_replace(lower(regexp_replace(text, '[[:punct:]]', '', 'g')), '\\s+', ' ', 'g'))) AS digest FROM documents""",
        "normalize_lists": """
            WITH i AS (
              SELECT p_partkey, CASE WHEN p_size > 25 THEN lower(p_type) || '|' || lower(trim(' ' || p_name)) || '|a| b|' || lower(p_type)
                                     WHEN p_size > 10 THEN '' END AS joined FROM part),
            s AS (SELECT p_partkey, string_split(replace(joined, '| ' , '| '), '|') AS raw FROM i),
            l AS (SELECT p_partkey, raw, [x for x in (CASE WHEN len(raw) > 1 THEN [raw[1], ' ' || raw[2]] || raw[3:] ELSE raw END) if x <> ''] AS items FROM s)
            SELECT p_partkey, array_to_string(items, '|') AS items, array_to_string(list_sort(list_distinct(items)), '|') AS distinct_items,
                   CAST(len(items) AS BIGINT) AS n, CAST(len(raw) AS BIGINT) AS legacy_n FROM l""",
        "keyword_hyphenate": """
            SELECT p_partkey, array_to_string(list_sort([replace(x, ' ', '-') for x in [p_name, p_type || ' and more', p_brand]]), '|') AS keywords FROM part""",
        "truncate_text": f"""SELECT doc_id, {_truncated('text', 3, 20)} AS short, md5({_truncated('text')}) AS full_digest FROM documents""",
        "prompt_text": """
            SELECT o_orderkey, 'Order ' || o_orderkey || ' (' || CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE 'None' END
                   || ') of ' || o_custkey || '.' AS request FROM orders""",
        "data_uri": """
            WITH u AS (SELECT doc_id, 'data:image/png;base64,' || base64(encode(text)) AS uri FROM documents)
            SELECT doc_id, CAST(length(uri) AS BIGINT) AS chars, md5(uri) AS digest FROM u""",
        "json_struct": """
            WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
            SELECT event_id, CASE WHEN k BETWEEN 1 AND 90 THEN k END AS k FROM e""",
        "date_functions": """
            SELECT o_orderkey, o_orderdate - INTERVAL 330 MINUTE AS utc, CAST(o_orderdate AS VARCHAR) AS as_text,
                   strftime(o_orderdate, '%-m/%-d/%Y') AS shown, true AS bad_is_null FROM orders""",
        "identity_components": f"WITH RECURSIVE {_RAW_IDENTITIES} SELECT email AS author_email, first_key, key_count FROM people",
        "identity_bot_cut": f"""WITH RECURSIVE {_RAW_IDENTITIES} SELECT DISTINCT identity, key_count FROM people WHERE key_count <= 15""",
        "merge_people": f"""WITH RECURSIVE {_FINAL}
            SELECT * REPLACE (round(impact_to_project, 6) AS impact_to_project, round(technical_ability, 6) AS technical_ability) FROM contributions""",
        "packaged_top100": final + """
            SELECT author_email, author_name, languages, keywords, commit_count, round(impact_to_project, 6) AS impact_to_project,
                   round(technical_ability, 6) AS technical_ability, reason, repo_text AS repo FROM answer""",
        "present": final + f"""
            SELECT author_email, author_name, CAST(len(string_split(author_email, '|')) AS BIGINT) AS n_emails, commit_count AS total_commits,
                   mean_ability, mean_impact_shown AS mean_impact, {band.format('mean_ability')} AS ability_band,
                   {band.format('mean_impact_shown')} AS impact_band, round(mean_ability * 10, 6) AS ability_width,
                   round(mean_impact_shown * 10, 6) AS impact_width, languages,
                   array_to_string([CASE x WHEN 'rust' THEN 'bg-[#DEA584] text-black' WHEN 'python' THEN 'bg-[#3776AB] text-white'
                                   WHEN 'c++' THEN 'bg-[#00599C] text-white' WHEN 'go' THEN 'bg-[#00ADD8] text-white'
                                   ELSE 'bg-gray-100 text-gray-800' END for x in string_split(languages, '|')], '|') AS language_colors,
                   links AS repos FROM answer""",
        "first_nonempty": final + " SELECT author_email, commit_count, CAST(2 AS BIGINT) AS num_tries FROM answer",
        "guarded_question": final + " SELECT author_email, commit_count, CAST(3 AS BIGINT) AS num_tries FROM answer",
        "ledger_runs": """
            SELECT o_orderpriority || ' of ' || o_orderstatus || ' of ' || year(o_orderdate) AS request, count(*) AS orders,
                   CASE WHEN o_orderpriority LIKE '3-%' THEN 0 ELSE count(*) END AS answered_first, count(*) AS answered_second,
                   CAST(1 AS BIGINT) AS calls
            FROM orders GROUP BY o_orderpriority, o_orderstatus, year(o_orderdate)""",
        "mended_question": final + " SELECT author_email, commit_count, CAST(2 AS BIGINT) AS num_tries FROM answer",
        "blank_question": final + """
            SELECT '' AS question, CAST(0 AS BIGINT) AS people UNION ALL SELECT '  ' || chr(10), 0
            UNION ALL SELECT 'rust people', count(*) FROM answer""",
        "present_large": """
            WITH p AS (
              SELECT l_returnflag || '@x|' || l_returnflag || '@y' AS author_email, min(l_linestatus) AS author_name,
                     CAST(sum(l_linenumber) AS BIGINT) AS total_commits, CAST(sum(l_orderkey % 10 + 1) AS DECIMAL(20,8)) / count(*) AS ability,
                     CAST(sum(CASE WHEN l_linenumber <> 3 THEN l_quantity % 10 ELSE 0 END) AS DECIMAL(20,8)) / count(*) AS impact,
                     count(*) AS n_rows, count(*) AS shown, min('https://github.com/o/' || l_partkey) AS first_link, '2/3/2024' AS last_commit
              FROM lineitem GROUP BY l_returnflag),
            m AS (SELECT *, CAST(round(CAST(ability AS DECIMAL(20,8)), 1) AS DOUBLE) AS mean_ability,
                         CAST(round(CAST(impact AS DECIMAL(20,8)), 1) AS DOUBLE) AS mean_impact FROM p)
            SELECT author_email, author_name, total_commits, mean_ability, mean_impact, """ + band.format("mean_ability") + """ AS ability_band,
                   n_rows, shown, first_link, last_commit FROM m""",
        "query_contract": f"""WITH RECURSIVE {_FINAL} SELECT split_part(repo, '/', 1) AS owner, count(*) AS people FROM contributions GROUP BY 1""",
        "query_log": final + """
            SELECT 'rust people' AS query, 'Success' AS status, count(*) AS num_results, 'None' AS error, CAST(0 AS BIGINT) AS num_tries FROM answer
            UNION ALL SELECT 'nobody', 'Failed', 0, 'No results found', 0
            UNION ALL SELECT 'broken', 'Failed', 0, 'Error executing query', 0""",
        "infer_scores": _SCORES,
        "infer_projects": f"""WITH {_README}, judged AS (SELECT *, {_markup('readme')} AS s FROM picked)
            SELECT url, CASE WHEN readme IS NOT NULL THEN 'c|rust' END AS languages,
                   CASE WHEN readme IS NOT NULL THEN CAST(2 AS BIGINT) END AS n,
                   CASE WHEN readme IS NOT NULL THEN 'of-' || name END AS last_keyword FROM judged""",
        "infer_pictures": """
            SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN length(base64(encode(c_name))) / 8 END AS profile_pic_score,
                   CASE WHEN c_custkey % 5 <> 0 THEN substr(base64(encode(c_name)), 1, 4) END AS profile_pic_reason
            FROM customer""",
        "udtf_runs": r"""
            WITH w AS (SELECT doc_id, [x for x in string_split_regex(text, '\s+') if x <> ''] AS l FROM documents),
            e AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS word FROM w),
            s AS (SELECT doc_id, i, sum(CASE WHEN i = 0 OR word < before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
                  FROM (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM e)),
            n AS (SELECT doc_id, run, count(*) AS n FROM s GROUP BY doc_id, run)
            SELECT doc_id, count(*) AS runs, max(n) AS longest FROM n GROUP BY doc_id""",
        "udtf_groups": """
            WITH g AS (
              SELECT *, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) > 24 * 3600000000 THEN 1 ELSE 0 END AS new
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            v AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS visit FROM g)
            SELECT user_id, min(ts) AS start, count(*) AS events, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
            FROM v GROUP BY user_id, visit""",
        "checked_answers": """
            WITH a AS (
              SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS who, CAST(o_orderpriority[1] AS BIGINT) AS urgency,
                     lower(o_orderstatus) AS status, CAST(o_orderkey % 11 AS DOUBLE) AS share, CAST(year(o_orderdate) AS BIGINT) AS year
              FROM orders),
            f AS (SELECT *, urgency BETWEEN 1 AND 4 AND status IN ('f', 'o') AND share <= 9 AS fits FROM a)
            SELECT o_orderkey, fits, CASE WHEN fits THEN who END AS who, CASE WHEN fits THEN urgency END AS urgency,
                   CASE WHEN fits THEN status END AS status, CASE WHEN fits THEN share END AS share, CASE WHEN fits THEN year END AS year FROM f""",
        "picture_sizes": """
            SELECT p_partkey, CASE WHEN ok THEN (['png', 'gif', 'jpeg', 'bmp'])[p_partkey % 4 + 1] END AS format,
                   CASE WHEN ok THEN CAST(p_partkey + 1 AS INTEGER) END AS width, CASE WHEN ok THEN p_size END AS height,
                   CASE WHEN ok THEN CAST(([4, 3, 3, 3])[p_partkey % 4 + 1] AS INTEGER) END AS channels
            FROM (SELECT *, p_partkey % 7 <> 0 AS ok FROM part)""",
        "plain_constructs": """
            WITH c(construct, plain) AS (VALUES
              ('fence', E'a\n__{0}__ = *x*\n{0}'), ('ticks', 'call __{0}__ and {0}'),
              ('table', E'{0}  b\na__b__  {0}\nend'), ('reference', E'see {0}, {0} and [other][2]\n'),
              ('nested_list', E'- {0}\n    - b\n\n      *{0}*\n1. c'), ('picture_link', '{0}'), ('title', E'{0}\ntext'),
              ('rst_code', E'*{0}* = ``x``\n\n{0}'), ('rst_literal', E'run:\n\n*{0}*\n\n*{0}* of {0}'), ('rst_grid', E'{0}  b\n1  {0}'))
            SELECT p_partkey, construct, replace(plain, '{0}', p_name) AS plain FROM part, c""",
        "udtf_lateral": _PIECES,
        "udtf_expand": _PIECES,
    }
