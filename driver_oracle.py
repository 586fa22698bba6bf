"""SQL for DuckDB with the results the registered queries must have.

Written from the rules, on the supplied tables alone. The common part builds one raw record per
order (see ``papyra.fixtures`` for its description) and cleans it.
"""

from __future__ import annotations

# The white space the cleaning rule folds, and the layout of a version time.
BLANKS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
VERSION_TIME = "%a, %-d %b %Y %H:%M:%S GMT"
AS_OF = "DATE '2024-01-31'"
PROBE = "'0000001'"


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANKS}', ' ', 'g'))"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


COMMON = f"""
item AS (
  SELECT l_orderkey AS k, l_shipdate + to_hours(l_linenumber) AS shipped, s_name, p_brand,
         row_number() OVER (
           PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey
         ) AS rn
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
),
ver AS (
  SELECT k, rn, 'v' || rn AS version,
         CASE WHEN k % 90 = 0 AND rn = 1 THEN 'not a date'
              ELSE strftime(shipped, '{VERSION_TIME}') END AS created,
         CASE WHEN k % 90 = 0 AND rn = 1 THEN NULL ELSE shipped END AS ts
  FROM item
),
raw AS (
  SELECT o_orderkey AS k, lpad(o_orderkey::VARCHAR, 7, '0') AS id,
         CASE WHEN (o_orderkey // (SELECT count(*) FROM documents)) % 50 = 7 THEN ''
              ELSE split_part(text, chr(10), 1) || chr(10) || '  ' || source || '  ' || lang END AS title,
         CASE WHEN (o_orderkey // (SELECT count(*) FROM documents)) % 40 = 3 THEN '' ELSE text END AS abstract,
         CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/' || o_orderkey ELSE '' END AS doi,
         CASE WHEN o_orderkey % 60 = 0 THEN []
              ELSE [lower(c_mktsegment) || '.' || o_orderpriority[1], lower(n_name)] END AS categories,
         CASE WHEN o_orderstatus = 'F' THEN 'J. ' || split_part(o_orderpriority, '-', 2) || (o_orderkey % 90 + 1)
              || ':' || o_orderkey || ' (' || year(o_orderdate) || ')' ELSE '' END AS journal_ref,
         c_name || CASE o_orderkey % 5 WHEN 0 THEN ''
           WHEN 1 THEN ' u' || o_custkey || '@' || lower(n_name) || '.example.edu'
           ELSE ' <u' || o_custkey || '@' || lower(n_name) || '.example.edu>' END AS submitter,
         CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE split_part(lower(n_name), '.', 1) END AS institution,
         CASE WHEN o_orderkey % 5 <= 1 THEN '' ELSE split_part(lower(n_name), '.', 1) END AS bracketed,
         CASE WHEN o_orderkey % 80 <= 1 THEN NULL ELSE o_orderdate::DATE END AS updated,
         CASE o_orderkey % 80 WHEN 0 THEN '' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d or so')
           WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS updated_text,
         o_orderdate::DATE AS day, date_trunc('month', o_orderdate)::DATE AS stamp,
         o_orderpriority AS priority
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)
),
names AS (
  SELECT k, string_agg(s_name || '@' || p_brand, '|' ORDER BY rn) AS authors, count(*) AS n_authors
  FROM item WHERE k % 70 <> 0 GROUP BY k
),
span AS (
  SELECT k, count(*) AS n, count(ts) AS good, min(ts) AS lo, max(ts) AS hi,
         string_agg(version || '@' || created, '|' ORDER BY rn) AS versions
  FROM ver GROUP BY k
),
tidy AS (
  SELECT raw.*, {clean('title')} AS t, {clean('abstract')} AS a, coalesce(categories[1], '') AS primary_category,
         journal_ref <> '' AS is_published, n, good, lo, hi, versions, authors, n_authors,
         CASE WHEN n > 1 THEN (epoch(hi) - epoch(lo)) / 86400.0 / (n - 1) END AS gap
  FROM raw LEFT JOIN span USING (k) LEFT JOIN names USING (k)
),
paper AS (
  SELECT *, coalesce(lo::DATE, {AS_OF}) AS submitted,
         CASE WHEN is_published THEN hi::DATE END AS published,
         coalesce(updated, lo::DATE, {AS_OF}) AS update_date,
         greatest(coalesce(n, 0), 1) AS version_count,
         (CASE WHEN is_published THEN hi::DATE END - lo::DATE)::DOUBLE AS delay
  FROM tidy WHERE n IS NULL OR good = n
)
"""

# What the state holds before and what the update brings, then the merge of both.
MERGE = f"""
sver AS (SELECT * FROM ver WHERE rn <= 2),
uver AS (
  SELECT k, rn, version,
         CASE WHEN rn = 2 THEN strftime(ts + INTERVAL 1 DAY, '{VERSION_TIME}') ELSE created END AS created,
         CASE WHEN rn = 2 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts
  FROM ver WHERE rn >= 2
),
sspan AS (SELECT k, count(*) AS n, count(ts) AS good, min(ts) AS lo, max(ts) AS hi FROM sver GROUP BY k),
uspan AS (SELECT k, count(*) AS n, count(ts) AS good, min(ts) AS lo, max(ts) AS hi FROM uver GROUP BY k),
stored AS (
  SELECT raw.k, id, journal_ref <> '' AS pub, {clean('title')} AS t, {clean('abstract')} AS a,
         'old-' || raw.k AS doi, journal_ref, institution, categories[1:1] AS categories, updated,
         authors, n, lo, hi
  FROM raw JOIN sspan USING (k) LEFT JOIN names USING (k)
  WHERE priority <> '1-URGENT' AND good = n
),
upd AS (
  SELECT raw.k, id, journal_ref <> '' AS pub, {clean('title')} AS t, {clean('abstract')} AS a,
         doi, journal_ref, institution, categories, updated, authors, n, lo, hi
  FROM raw JOIN uspan USING (k) LEFT JOIN names USING (k)
  WHERE priority <> '5-LOW' AND good = n
),
mver AS (
  SELECT coalesce(s.k, u.k) AS k, coalesce(s.rn, u.rn) AS rn,
         coalesce(s.version, u.version) AS version, coalesce(u.created, s.created) AS created
  FROM (SELECT sver.* FROM sver JOIN stored USING (k)) s
  FULL JOIN (SELECT uver.* FROM uver JOIN upd USING (k)) u ON s.k = u.k AND s.rn = u.rn
),
mlist AS (SELECT k, string_agg(version || '@' || created, '|' ORDER BY rn) AS versions FROM mver GROUP BY k),
merged AS (
  SELECT coalesce(u.k, s.k) AS k, coalesce(u.id, s.id) AS paper_id,
         s.k IS NULL AS is_new, u.k IS NOT NULL AS touched,
         coalesce(u.pub, s.pub) AS is_published,
         CASE WHEN s.k IS NULL THEN u.t ELSE coalesce(nullif(u.t, ''), s.t) END AS title,
         CASE WHEN s.k IS NULL THEN u.a ELSE coalesce(nullif(u.a, ''), s.a) END AS abstract,
         CASE WHEN s.k IS NULL THEN u.doi ELSE coalesce(nullif(u.doi, ''), s.doi) END AS doi,
         coalesce(u.journal_ref, s.journal_ref) AS journal_ref,
         coalesce(u.institution, s.institution) AS institution,
         CASE WHEN s.k IS NULL OR u.k IS NULL THEN coalesce(u.categories, s.categories)
              ELSE list_sort(list_distinct(list_concat(s.categories, u.categories))) END AS categories,
         coalesce((coalesce(u.categories, s.categories))[1], '') AS primary_category,
         coalesce(u.lo, s.lo)::DATE AS submitted,
         CASE WHEN coalesce(u.pub, s.pub) THEN coalesce(u.hi, s.hi)::DATE END AS published,
         coalesce(u.updated, u.lo::DATE, s.updated, s.lo::DATE) AS update_date,
         coalesce(u.authors, s.authors) AS authors, versions, coalesce(u.n, s.n) AS version_count,
         coalesce(
           CASE WHEN u.n > 1 THEN (epoch(u.hi) - epoch(u.lo)) / 86400.0 / (u.n - 1) END,
           CASE WHEN s.n > 1 THEN (epoch(s.hi) - epoch(s.lo)) / 86400.0 / (s.n - 1) END
         ) AS gap,
         CASE WHEN coalesce(u.pub, s.pub) THEN coalesce(u.hi::DATE - u.lo::DATE, s.hi::DATE - s.lo::DATE) END::DOUBLE AS delay
  FROM stored s FULL JOIN upd u ON s.k = u.k JOIN mlist ON mlist.k = coalesce(u.k, s.k)
)
"""

# Deliveries: the first metadata record, its redelivery, and the version record.
DELIVERY = """
sent AS (
  SELECT k, 'arXiv' AS format, stamp AS ds, title FROM raw WHERE day(day) <> 31
  UNION ALL
  SELECT k, 'arXiv', stamp + 1, 'rev ' || title FROM raw WHERE day(day) <> 31 AND priority = '2-HIGH'
  UNION ALL
  SELECT k, 'arXivRaw', stamp, NULL FROM raw WHERE day(day) <> 30
)
"""

HISTORICAL_COLUMNS = f"""
  id AS paper_id, is_published, t AS title, md5(a) AS abstract_md5, doi, journal_ref, institution,
  array_to_string(categories, '|') AS categories, primary_category,
  {iso('submitted')} AS submitted_date, {iso('published')} AS published_date,
  {iso('update_date')} AS update_date, coalesce(authors, '') AS authors, versions, version_count,
  round(gap, 6) AS update_frequency, delay AS submission_to_publication,
  strftime(submitted, '%Y') AS year, strftime(submitted, '%m') AS month, strftime(submitted, '%d') AS day
"""

INCREMENTAL_FROM = f"""
  FROM (
    SELECT *, CASE WHEN priority = '2-HIGH' THEN {clean("'rev ' || title")} ELSE t END AS latest_title,
           coalesce(updated, CASE WHEN priority = '2-HIGH' THEN (stamp + 1)::DATE ELSE stamp END) AS latest_update
    FROM tidy WHERE day(day) NOT IN (30, 31) AND n IS NOT NULL AND good = n
  )
"""

CARD = f"id AS paper_id, t AS title, primary_category, {iso('update_date')} AS update_date"
MCARD = f"paper_id, title, primary_category, {iso('update_date')} AS update_date"
AUTHOR_ID = "sha1(lower(s_name) || '|' || lower(p_brand))"
CREDIT = f"""
credit AS (
  SELECT paper.k, id AS paper_id, rn, {AUTHOR_ID} AS author_id, p_brand || ' ' || s_name AS name,
         institution
  FROM paper JOIN item ON item.k = paper.k WHERE paper.k % 70 <> 0
)
"""
TAGGED = "tag AS (SELECT k, id AS paper_id, primary_category, unnest(categories) AS category_id FROM paper)"


def q(select: str, *parts: str) -> str:
    """A statement over the common tables; one that starts with a comma adds tables of its own."""
    return f"WITH {', '.join([COMMON, *parts])} {select}"


# Why an id of the deliveries is refused, null for a good one.
REFUSAL = """
  CASE WHEN day(day) IN (30, 31) THEN 'unpaired' WHEN n IS NULL THEN 'versions_absent'
       WHEN good < n THEN 'version_date' END"""


def _state_columns(null_if_empty: bool = True) -> str:
    return f"""
      paper_id, is_published, title, md5(abstract) AS abstract_md5, doi, journal_ref, institution,
      CASE WHEN len(categories) > 0 THEN array_to_string(categories, '|') END AS categories,
      primary_category, {iso('submitted')} AS submitted_date, {iso('published')} AS published_date,
      {iso('update_date')} AS update_date, authors, versions, version_count,
      round(gap, 6) AS update_frequency, delay AS submission_to_publication
    """


def _incremental(stored: bool, more: str = "") -> str:
    categories = "array_to_string(categories, '|')"
    if stored:
        categories = f"CASE WHEN len(categories) > 0 THEN {categories} END"
    return q(f"""
      SELECT id AS paper_id, is_published, latest_title AS title, md5(a) AS abstract_md5, doi,
             journal_ref, bracketed AS institution, {categories} AS categories, primary_category,
             {iso('lo')} AS submitted_date,
             CASE WHEN is_published THEN {iso('hi')} END AS published_date,
             {iso('latest_update')} AS update_date, authors, versions, n AS version_count,
             round(gap, 6) AS update_frequency,
             CASE WHEN is_published THEN (hi::DATE - lo::DATE)::DOUBLE END AS submission_to_publication {more}
      {INCREMENTAL_FROM}
    """)


SESSIONS = """
  WITH timed AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOUR AS opens FROM events),
  numbered AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM timed)
  SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
         strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS events,
         array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds
  FROM numbered GROUP BY user_id, session
"""


def _rank_rounds(rounds: int) -> str:
    """Each round of the co-authorship rank as a table of its own."""
    steps = """
      , node AS MATERIALIZED (SELECT DISTINCT k, author_id FROM credit),
      wide AS (SELECT k, count(*) - 1 AS others FROM node GROUP BY k),
      link AS MATERIALIZED (SELECT k, author_id, others FROM node JOIN wide USING (k)),
      r0 AS MATERIALIZED (SELECT author_id, count(*) AS papers, sum(others) AS weight, 1.0::DOUBLE AS rank FROM link GROUP BY 1)"""
    for i in range(rounds):
        steps += f""",
      s{i} AS (SELECT k, sum(rank / weight) AS total FROM link JOIN r{i} USING (author_id) WHERE others > 0 GROUP BY k),
      g{i} AS (SELECT author_id, sum(total - rank / weight) AS gets
               FROM link JOIN r{i} USING (author_id) JOIN s{i} USING (k) WHERE others > 0 GROUP BY 1),
      r{i + 1} AS MATERIALIZED (SELECT author_id, papers, weight, 0.15 + 0.85 * coalesce(gets, 0.0) AS rank
               FROM r{i} LEFT JOIN g{i} USING (author_id))"""
    return f"{steps} SELECT author_id, papers, round(rank, 6) AS rank FROM r{rounds}"


def statements() -> dict[str, str]:
    historical = q(f"SELECT {HISTORICAL_COLUMNS} FROM paper")
    s = {
        "normalize_historical": historical,
        "historical_load": historical,
        "stream_historical": historical,
        "normalize_incremental": _incremental(stored=False),
        "incremental_load": _incremental(stored=True),
        "stream_incremental": _incremental(stored=True),
        "clean_text": q("SELECT id AS paper_id, t AS title, md5(a) AS abstract_md5 FROM tidy"),
        "categories_split": q(
            "SELECT id AS paper_id, coalesce(categories[1], '') AS primary_category, "
            "array_to_string(categories, '|') AS categories FROM raw"
        ),
        "authors_parsed": q(
            "SELECT id AS paper_id, rn - 1 AS pos, s_name AS last_name, p_brand AS first_name "
            "FROM raw JOIN item USING (k) WHERE k % 70 <> 0"
        ),
        "institution_bracketed": q("SELECT id AS paper_id, bracketed AS institution FROM raw"),
        "institution_bare": q("SELECT id AS paper_id, institution FROM raw"),
        "version_dates": q(
            f"SELECT id AS paper_id, {iso('submitted')} AS submitted_date, {iso('published')} AS published_date FROM paper"
        ),
        "lenient_dates": q(
            f"SELECT id AS paper_id, version, {iso('ts')} AS created_date FROM raw JOIN ver USING (k)"
        ),
        "update_date_chain": q(f"SELECT id AS paper_id, {iso('update_date')} AS update_date FROM paper"),
        "update_frequency": q("SELECT id AS paper_id, round(gap, 6) AS update_frequency FROM paper"),
        "submission_to_publication": q("SELECT id AS paper_id, delay AS days FROM paper"),
        "dropped_records": q("SELECT id AS paper_id, 'version_date' AS reason FROM tidy WHERE good < n"),
        "quality_report": q("""
          SELECT metric, missing, total, round(100.0 * missing / total, 6) AS pct FROM (
            SELECT unnest(['missing_titles', 'missing_abstracts', 'missing_categories', 'missing_authors']) AS metric,
                   unnest([count(*) FILTER (t = ''), count(*) FILTER (a = ''),
                           count(*) FILTER (len(categories) = 0), count(*) FILTER (authors IS NULL)]) AS missing,
                   count(*) AS total
            FROM tidy)
        """),
        "run_stats": q("""
          SELECT unnest(['extract', 'transform']) AS stage,
                 unnest([count(*) + count(*) FILTER (k % 30 = 0), count(*)]) AS input,
                 unnest([count(*), count(*) FILTER (n IS NULL OR good = n)]) AS output,
                 unnest([count(*) FILTER (k % 30 = 0), count(*) FILTER (good < n)]) AS failed
          FROM tidy
        """),
        "historical_load_counts": q("""
          SELECT unnest(['extract', 'transform']) AS stage,
                 unnest([count(*) + count(*) FILTER (k % 30 = 0), count(*)]) AS input,
                 unnest([count(*), count(*) FILTER (n IS NULL OR good = n)]) AS output,
                 unnest([count(*) FILTER (k % 30 = 0), count(*) FILTER (good < n)]) AS failed,
                 unnest([count(*) FILTER (k % 30 = 0), count(*) FILTER (good < n)]) AS quarantined,
                 true AS timed
          FROM tidy
        """),
        "stream_then_batch_lake": historical,
        "stream_late_half": _incremental(stored=True, more=", true AS reoffer"),
        "incremental_load_counts": q(f"""
          , ids AS (SELECT {REFUSAL} AS reason FROM tidy)
          SELECT 'extract' AS stage, (SELECT count(*) FROM sent) + 4 * days AS input,
                 (SELECT count(*) FROM sent) AS output, 4 * days AS failed, true AS timed
          FROM (SELECT count(DISTINCT stamp) AS days FROM raw)
          UNION ALL SELECT 'transform', count(*), count(*) FILTER (reason IS NULL), count(reason), true FROM ids
        """, DELIVERY),
        "incremental_quarantine": q(f"""
          , refused AS (
            SELECT k, id AS paper_id, {REFUSAL} AS reason FROM tidy WHERE {REFUSAL} IS NOT NULL),
          latest AS (SELECT k, format, max(ds) AS ds FROM sent GROUP BY 1, 2)
          SELECT paper_id, reason, format, {iso('ds')} AS ds, NULL::VARCHAR AS line
          FROM refused JOIN latest USING (k)
          UNION ALL
          SELECT '', reason, format, {iso('stamp')}, line
          FROM (SELECT DISTINCT stamp FROM raw), (SELECT unnest(['arXiv', 'arXivRaw']) AS format),
               (SELECT unnest(['malformed', 'missing_id']) AS reason,
                       unnest(['{{"id": ', '{{"id": "", "title": "No id"}}']) AS line)
        """, DELIVERY),
        "incremental_replay": q(f"""
          , refused AS (
            SELECT CASE reason WHEN 'version_date' THEN 'accepted' ELSE reason END AS reason, lines
            FROM (SELECT {REFUSAL} AS reason, CASE WHEN day(day) IN (30, 31) THEN 1 ELSE 2 END AS lines FROM tidy)
            WHERE reason IS NOT NULL
            UNION ALL
            SELECT unnest(['malformed', 'malformed', 'missing_id', 'missing_id']), 1
            FROM (SELECT DISTINCT stamp FROM raw))
          SELECT reason, count(*) AS rows, sum(lines)::BIGINT AS lines FROM refused GROUP BY reason
        """),
        "window_counts": q("""
          SELECT format, count(*) FILTER (k % 97 <> 0 AND year(ds) = 1996) AS landed,
                 count(*) FILTER (k % 97 <> 0 AND year(ds) <> 1996) AS outside,
                 count(*) FILTER (k % 97 = 0) AS undated
          FROM sent GROUP BY format
        """, DELIVERY),
        "quality_alerts": q("""
          , yearly AS (
            SELECT strftime(submitted, '%Y') AS run, 100.0 * count(*) FILTER (t = '') / count(*) AS missing_titles,
                   100.0 * count(*) FILTER (a = '') / count(*) AS missing_abstracts,
                   100.0 * count(*) FILTER (authors IS NULL) / count(*) AS missing_authors
            FROM paper GROUP BY 1),
          long AS (UNPIVOT yearly ON missing_titles, missing_abstracts, missing_authors INTO NAME metric VALUE pct),
          capped AS (SELECT *, CASE metric WHEN 'missing_titles' THEN 2.0 WHEN 'missing_authors' THEN 1.4 END::DOUBLE AS most FROM long)
          SELECT run, metric, round(pct, 6) AS pct, most AS limit_pct, coalesce(pct > most, false) AS alert FROM capped
        """),
        "run_metrics": q("""
          SELECT 'r1' AS run, unnest(['extract', 'transform']) AS stage,
                 unnest([count(*), count(*)]) AS input,
                 unnest([count(*), count(*) FILTER (n IS NULL OR good = n)]) AS output,
                 unnest([0, count(*) FILTER (good < n)]) AS failed,
                 unnest([0.0, round(100.0 * count(*) FILTER (good < n) / count(*), 6)])::DOUBLE AS failed_pct,
                 NULL::DOUBLE AS rows_per_second
          FROM tidy
        """),
        "malformed_lines": """
          SELECT format, strftime(day, '%Y-%m-%d') AS ds, 1 AS bad_lines
          FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS day FROM orders),
               (SELECT unnest(['arXiv', 'arXivRaw']) AS format)
        """,
        "partition_fields": q("""
          SELECT strftime(submitted, '%Y') AS year, strftime(submitted, '%m') AS month,
                 strftime(submitted, '%d') AS day, count(*) AS papers
          FROM paper GROUP BY submitted
        """),
        "lake_roundtrip": q("""
          SELECT strftime(submitted, '%Y') AS year, strftime(submitted, '%m') AS month,
                 count(*) AS papers, sum(length(a)) AS characters
          FROM paper GROUP BY 1, 2
        """),
        "lake_date_range": q(
            f"SELECT id AS paper_id, {iso('submitted')} AS submitted_date FROM paper "
            "WHERE submitted BETWEEN DATE '1996-03-15' AND DATE '1997-02-10'"
        ),
        "landing_by_day": q(
            f"SELECT format, {iso('ds')} AS ds, count(*) AS records FROM sent GROUP BY 1, 2", DELIVERY
        ),
        "range_replace": q(f"""
          SELECT format, {iso('ds')} AS ds, count(*) AS records
          FROM sent LEFT JOIN span USING (k)
          WHERE year(ds) <> 1996 OR (format = 'arXivRaw' AND n IS NOT NULL) GROUP BY 1, 2
        """, DELIVERY),
        "last_wins": q(f"""
          SELECT id, format, md5(CASE WHEN format = 'arXivRaw' THEN '' ELSE sent.title END) AS title_md5,
                 {iso('ds')} AS datestamp
          FROM sent JOIN raw USING (k)
          QUALIFY row_number() OVER (PARTITION BY k, format ORDER BY ds DESC) = 1
        """, DELIVERY),
        "unpaired_records": q("""
          SELECT id, CASE day(day) WHEN 31 THEN 'arXiv' ELSE 'arXivRaw' END AS missing_format
          FROM raw WHERE day(day) IN (30, 31)
        """),
        "incremental_refusals": q("""
          SELECT reason, count(*) AS records FROM (
            SELECT CASE WHEN day(day) IN (30, 31) THEN 'unpaired' WHEN n IS NULL THEN 'versions_absent'
                        WHEN good < n THEN 'version_date' END AS reason FROM tidy)
          WHERE reason IS NOT NULL GROUP BY reason
        """),
        "paper_by_id": q(f"SELECT {HISTORICAL_COLUMNS} FROM paper WHERE id = {PROBE}"),
        "papers_by_category": q(
            f"SELECT {CARD} FROM paper WHERE primary_category = 'building.1' ORDER BY paper.update_date, id LIMIT 100"
        ),
        "papers_by_date_range": q(
            f"SELECT {CARD} FROM paper WHERE paper.update_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' "
            "ORDER BY paper.update_date, id LIMIT 100"
        ),
        "papers_by_date_range_category": q(
            f"SELECT {CARD}, {iso('submitted')} AS submitted_date FROM paper "
            "WHERE paper.update_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' "
            "AND primary_category = 'machinery.3' ORDER BY submitted, id LIMIT 50"
        ),
        "average_updates_by_category": q("""
          SELECT primary_category, round(avg(version_count), 6) AS average_updates, count(*) AS total_papers
          FROM paper WHERE primary_category <> '' GROUP BY 1
        """),
        "publication_delay": q("""
          SELECT primary_category, round(avg(delay), 6) AS average_days, count(*) AS sample_size
          FROM paper WHERE is_published AND delay IS NOT NULL AND primary_category <> '' GROUP BY 1
        """),
        "papers_by_author": q(
            f"SELECT {CARD} FROM paper WHERE k % 70 <> 0 AND EXISTS (FROM item "
            "WHERE item.k = paper.k AND (contains(lower(s_name), 'brand#13') OR contains(lower(p_brand), 'brand#13'))) "
            "ORDER BY id LIMIT 100"
        ),
        "papers_by_update_frequency": q(
            "SELECT id AS paper_id, round(gap, 6) AS update_frequency FROM paper "
            "WHERE gap BETWEEN 100 AND 300 ORDER BY id LIMIT 100"
        ),
        "paper_versions": q(
            f"SELECT id AS paper_id, version, created FROM paper JOIN ver USING (k) WHERE id = {PROBE}"
        ),
        "institution_counts": q(
            "SELECT institution, count(*) AS submissions FROM paper WHERE institution <> '' "
            "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
        ),
        "exported_json": q(
            "SELECT institution, count(*) AS submissions FROM paper WHERE institution <> '' "
            "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100"
        ),
        "merge_state": q(f"SELECT {_state_columns()} FROM merged", MERGE),
        "merge_stats": q(
            "SELECT count(*) FILTER (is_new) AS new_records, "
            "count(*) FILTER (touched AND NOT is_new) AS updated_records FROM merged", MERGE
        ),
        "state_point_read": q(
            f"SELECT paper_id, title, version_count FROM merged WHERE paper_id = {PROBE}", MERGE
        ),
        "state_category_read": q(
            f"SELECT {MCARD} FROM merged WHERE primary_category = 'building.1' "
            "ORDER BY merged.update_date, paper_id LIMIT 100", MERGE
        ),
        "merge_versions": q("SELECT id AS paper_id, version, created FROM mver JOIN raw USING (k)", MERGE),
        "merge_categories": q(
            "SELECT paper_id, CASE WHEN len(categories) > 0 THEN array_to_string(categories, '|') END AS categories FROM merged",
            MERGE,
        ),
        "storage_normal_form": q("""
          SELECT unnest(['categories', 'authors', 'versions', 'published_date', 'update_frequency']) AS column_name,
                 unnest([count(*) FILTER (len(categories) > 0), count(authors), count(versions),
                         count(published), count(gap)]) AS non_null
          FROM paper
        """),
        "wh_papers": q(f"""
          SELECT id AS paper_id, {iso('submitted')} AS submitted_date, {iso('published')} AS published_date,
                 journal_ref, version_count, delay::INT AS submission_to_publication_days, t AS title
          FROM paper
        """),
        "wh_authors": q("""
          , vote AS (SELECT author_id, institution, count(*) AS n FROM credit WHERE institution <> '' GROUP BY 1, 2),
          best AS (SELECT author_id, institution FROM vote
                   QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY n DESC, institution) = 1)
          SELECT author_id, min(name) AS author_name, any_value(best.institution) AS institution
          FROM credit LEFT JOIN best USING (author_id) GROUP BY author_id
        """, CREDIT),
        "wh_paper_authors": q(
            "SELECT paper_id, author_id, min(rn) AS author_position FROM credit GROUP BY 1, 2", CREDIT
        ),
        "wh_categories": q("""
          , used AS (SELECT DISTINCT category_id FROM tag),
          every AS (SELECT category_id FROM used UNION SELECT split_part(category_id, '.', 1) FROM used)
          SELECT category_id, category_id AS category_name,
                 CASE WHEN contains(category_id, '.') THEN split_part(category_id, '.', 1) END AS parent_category_id
          FROM every
        """, TAGGED),
        "wh_paper_categories": q(
            "SELECT DISTINCT paper_id, category_id, category_id = primary_category AS is_primary FROM tag", TAGGED
        ),
        "fk_check": q("""
          , pa AS (SELECT DISTINCT k, author_id FROM credit),
          pc AS (SELECT DISTINCT k, category_id FROM tag),
          used AS (SELECT DISTINCT category_id AS c FROM tag),
          every AS (SELECT c FROM used UNION SELECT split_part(c, '.', 1) FROM used)
          SELECT 'paper_authors' AS table_name, 'paper_id' AS column_name, count(*) AS orphans FROM pa WHERE k % 11 = 0
          UNION ALL SELECT 'paper_authors', 'author_id', count(*) FROM pa WHERE author_id LIKE 'a%'
          UNION ALL SELECT 'paper_categories', 'paper_id', count(*) FROM pc WHERE k % 11 = 0
          UNION ALL SELECT 'paper_categories', 'category_id', count(*) FROM pc WHERE category_id IN ('building', 'france')
          UNION ALL SELECT 'categories', 'parent_category_id', count(*) FROM every
            WHERE c LIKE 'building.%' OR c LIKE 'france.%'
        """, CREDIT, TAGGED),
        "oai_arxiv": q(f"""
          , listed AS (
            SELECT k, rn, s_name, p_brand,
                   row_number() OVER (PARTITION BY k ORDER BY rn) AS last_pos,
                   lag(p_brand) OVER (PARTITION BY k ORDER BY rn) AS before
            FROM item WHERE k % 70 <> 0),
          firsts AS (SELECT k, p_brand, row_number() OVER (PARTITION BY k ORDER BY rn) AS pos
                     FROM listed WHERE before IS NULL OR before <> p_brand),
          zipped AS (SELECT listed.k, string_agg(s_name || ';' || firsts.p_brand || ';', '|' ORDER BY pos) AS authors_parsed
                     FROM listed JOIN firsts ON listed.k = firsts.k AND last_pos = pos GROUP BY 1)
          SELECT id, {clean('sent.title')} AS title, md5(a) AS abstract_md5,
                 updated_text AS update_date, nullif(doi, '') AS doi,
                 journal_ref, authors_parsed,
                 'oai:' || id AS oai_identifier, {iso('ds')} AS datestamp,
                 array_to_string(categories, '|') AS "setSpecs", {iso('ds')} AS ds
          FROM sent JOIN tidy USING (k) LEFT JOIN zipped USING (k) WHERE format = 'arXiv'
        """, DELIVERY),
        "oai_arxiv_raw": q(f"""
          , sorted AS (SELECT k, string_agg(version || '@' || created, '|' ORDER BY version) AS by_label FROM ver GROUP BY k)
          SELECT id, submitter, by_label AS versions, 'oai:' || id AS oai_identifier,
                 {iso('ds')} AS datestamp, {iso('ds')} AS ds
          FROM sent JOIN raw USING (k) LEFT JOIN sorted USING (k) WHERE format = 'arXivRaw'
        """, DELIVERY),
        "oai_landing": q(f"""
          SELECT format, {iso('ds')} AS ds, count(*) AS records,
                 count(*) FILTER (format = 'arXiv' AND authors IS NOT NULL) AS with_authors,
                 count(*) FILTER (format = 'arXivRaw' AND n IS NOT NULL) AS with_versions
          FROM sent JOIN tidy USING (k) GROUP BY 1, 2
        """, DELIVERY),
        "oai_quarantine": """
          , bad AS (
            SELECT o_orderkey AS k, (o_orderkey // 30) % 5 AS kind, strftime(o_orderdate, '%Y-%m-%d') AS day
            FROM orders WHERE o_orderkey % 30 = 0),
          parts AS (
            SELECT kind, '<identifier>oai:bad-' || k || '</identifier>' AS own, 'oai:bad-' || k AS identifier,
                   CASE kind WHEN 3 THEN '' WHEN 4 THEN '<datestamp>soon</datestamp>'
                        ELSE '<datestamp>' || day || '</datestamp>' END AS stamp,
                   CASE kind WHEN 0 THEN '<metadata><arXiv><id>' || k
                        WHEN 1 THEN '<metadata><oai_dc><id>' || k || '</id></oai_dc></metadata>' WHEN 2 THEN ''
                        ELSE '<metadata><arXivRaw><id>' || k || '</id></arXivRaw></metadata>' END AS body
            FROM bad)
          SELECT CASE kind WHEN 0 THEN 'malformed' WHEN 3 THEN 'missing_datestamp' WHEN 4 THEN 'bad_datestamp'
                      ELSE 'unknown_format' END AS reason,
                 CASE WHEN kind <> 0 THEN identifier END AS identifier,
                 '<record><header>' || own || stamp || '</header>' || body || '</record>' AS text
          FROM parts
        """.replace(",", "WITH", 1),
        "oai_counts": q("""
          , bad AS (SELECT (k // 30) % 5 AS kind FROM raw WHERE k % 30 = 0)
          SELECT (SELECT count(*) FROM sent) + (SELECT count(*) FROM bad) AS responses,
                 (SELECT count(*) FROM sent) AS good, count(*) FILTER (kind = 0) AS malformed,
                 count(*) FILTER (kind IN (1, 2)) AS unknown_format, count(*) FILTER (kind = 3) AS missing_datestamp,
                 count(*) FILTER (kind = 4) AS bad_datestamp
          FROM bad
        """, DELIVERY),
        "stream_pairing": _incremental(stored=False),
        "landing_rejects": q("""
          SELECT 'unknown_format' AS reject, 'other' AS format, count(*) AS lines FROM sent WHERE format = 'arXiv'
          UNION ALL
          SELECT reason, format, count(DISTINCT stamp)
          FROM raw, (SELECT unnest(['malformed', 'missing_id']) AS reason), (SELECT unnest(['arXiv', 'arXivRaw']) AS format)
          GROUP BY 1, 2
        """, DELIVERY),
        "stream_pairing_quarantine": q(f"""
          , latest AS (SELECT k, format, max(ds) AS ds FROM sent JOIN raw USING (k)
                       WHERE day(day) IN (30, 31) GROUP BY 1, 2)
          SELECT 'unpaired' AS reason, format, {iso('ds')} AS ds, count(*) AS lines, count(*) AS papers FROM latest GROUP BY 2, 3
          UNION ALL
          SELECT reason, format, {iso('stamp')}, 1, 0
          FROM (SELECT DISTINCT stamp FROM raw), (SELECT unnest(['arXiv', 'arXivRaw']) AS format),
               (SELECT unnest(['malformed', 'missing_id']) AS reason)
          UNION ALL
          SELECT 'malformed', 'arXiv', {iso('max(day) + 92')}, 1, 0 FROM raw
        """, DELIVERY),
        "load_files": q("""
          SELECT name, (SELECT count(DISTINCT priority) FROM raw) + bad AS files, bad AS failed_files, true AS timed
          FROM (SELECT unnest(['historical', 'stream']) AS name, unnest([2, 1]) AS bad)
          UNION ALL
          SELECT 'incremental', (SELECT count(*) FROM (SELECT DISTINCT format, ds FROM sent)) + 4 * days, 4 * days, true
          FROM (SELECT count(DISTINCT stamp) AS days FROM raw)
        """, DELIVERY),
        "coauthor_components": q("""
          , RECURSIVE_MARK node AS MATERIALIZED (
            SELECT DISTINCT strftime(submitted, '%Y-%m') AS period, paper.k, author_id FROM credit JOIN paper USING (k)),
          near AS MATERIALIZED (
            SELECT DISTINCT a.period, a.author_id, b.author_id AS other FROM node a JOIN node b ON a.k = b.k AND a.period = b.period),
          label(period, author_id, component) USING KEY (period, author_id) AS (
            SELECT DISTINCT period, author_id, author_id FROM node
            UNION
            SELECT label.period, other, min(label.component)
            FROM label JOIN near ON near.period = label.period AND near.author_id = label.author_id
            JOIN recurring.label AS held ON held.period = label.period AND held.author_id = other
            WHERE label.component < held.component GROUP BY 1, 2)
          SELECT period, author_id, component, count(*) OVER (PARTITION BY period, component) AS authors FROM label
        """, CREDIT).replace("WITH", "WITH RECURSIVE", 1).replace("RECURSIVE_MARK ", ""),
        "coauthor_rank": q(_rank_rounds(10), CREDIT),
        "trend_by_month": q(f"""
          , monthly AS (SELECT primary_category, date_trunc('month', submitted)::DATE AS month, count(*) AS submissions
                        FROM paper WHERE primary_category <> '' GROUP BY 1, 2)
          SELECT primary_category, {iso('month')} AS month, submissions,
                 submissions - lag(submissions) OVER (PARTITION BY primary_category ORDER BY monthly.month) AS change
          FROM monthly
        """),
        "coauthor_strength": q("""
          , one AS (SELECT DISTINCT k, author_id FROM credit),
          wide AS (SELECT k, count(*) AS n FROM one GROUP BY k)
          SELECT author_id, count(*) AS papers, sum(n - 1)::BIGINT AS coauthor_links
          FROM one JOIN wide USING (k) GROUP BY 1
        """, CREDIT),
        "coauthors_of": q("""
          , one AS (SELECT DISTINCT k, author_id FROM credit)
          SELECT o.author_id, count(*) AS joint_papers
          FROM one p JOIN one o ON p.k = o.k AND p.author_id <> o.author_id
          WHERE p.author_id = sha1('supplier#000000001|brand#13') GROUP BY 1
        """, CREDIT),
        "institution_rank": q("""
          SELECT primary_category, institution, count(*) AS papers,
                 round(avg(is_published::INT), 6) AS published_share,
                 rank() OVER (PARTITION BY primary_category
                   ORDER BY count(*) DESC, count(*) FILTER (is_published) / count(*)::DOUBLE DESC) AS position
          FROM paper WHERE primary_category <> '' AND institution <> '' GROUP BY 1, 2
        """),
        "similar_papers": q(f"""
          , bag AS (
            SELECT id, list_distinct(list_filter(string_split({clean("lower(t || ' ' || a)")}, ' '), lambda w: w <> '')) AS w
            FROM paper),
          probe AS (SELECT w AS pw FROM bag WHERE id = {PROBE}),
          scored AS (
            SELECT id, len(list_intersect(w, pw)) / (len(w) + len(pw) - len(list_intersect(w, pw)))::DOUBLE AS score
            FROM bag, probe WHERE id <> {PROBE})
          SELECT id AS paper_id, round(score, 6) AS score FROM scored WHERE score > 0
          ORDER BY scored.score DESC, id LIMIT 10
        """),
        "unified_view": q("""
          SELECT id AS paper_id, n AS version_count, doi FROM upd
          UNION ALL SELECT id, n, doi FROM stored WHERE k NOT IN (SELECT k FROM upd)
        """, MERGE),
        "quality_drift": q("""
          , yearly AS (
            SELECT strftime(submitted, '%Y') AS run, 100.0 * count(*) FILTER (t = '') / count(*) AS missing_titles,
                   100.0 * count(*) FILTER (a = '') / count(*) AS missing_abstracts,
                   100.0 * count(*) FILTER (authors IS NULL) / count(*) AS missing_authors
            FROM paper GROUP BY 1),
          long AS (UNPIVOT yearly ON missing_titles, missing_abstracts, missing_authors INTO NAME metric VALUE pct),
          seen AS (SELECT *, avg(pct) OVER (PARTITION BY metric ORDER BY run ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS usual FROM long)
          SELECT run, metric, round(pct, 6) AS pct, round(usual, 6) AS usual_pct,
                 coalesce(pct - usual > 0.2, false) AS alert
          FROM seen
        """),
        "replay_quarantine": q(f"""
          SELECT id AS paper_id, {iso("least(lo, TIMESTAMP '2000-01-01 00:00:00')")} AS submitted_date, NULL::VARCHAR AS reason
          FROM tidy WHERE good < n
        """),
        "journal_enrich": q("""
          , journal AS (SELECT o_orderpriority AS name, round(avg(o_totalprice), 2) AS impact FROM orders GROUP BY 1)
          SELECT id AS paper_id, journal_ref, impact FROM paper LEFT JOIN journal ON is_published AND priority = name
        """),
        "journal_impact_asof": q(f"""
          , figure AS (SELECT o_orderpriority AS name, make_date(year(o_orderdate), 1, 1) AS day, round(avg(o_totalprice), 2) AS impact
                       FROM orders WHERE year(o_orderdate) NOT IN (1992, 1995, 1996) GROUP BY 1, 2),
          dated AS (SELECT * FROM paper WHERE is_published AND published IS NOT NULL),
          found AS (SELECT dated.k, figure.impact, figure.day AS impact_day
                    FROM dated ASOF JOIN figure ON priority = name AND published >= figure.day)
          SELECT id AS paper_id, journal_ref, {iso('published')} AS published_date, impact, {iso('impact_day')} AS impact_day
          FROM paper LEFT JOIN found USING (k)
        """),
        "behaviour_sessions": SESSIONS,
        "stream_sessions": SESSIONS,
        "distribution_drift": q("""
          , counts AS (SELECT strftime(submitted, '%Y') AS run, primary_category AS category, count(*) AS n
                       FROM paper WHERE primary_category <> '' GROUP BY 1, 2),
          shares AS (SELECT *, n / sum(n) OVER (PARTITION BY run) AS share FROM counts),
          runs AS (SELECT run, lag(run) OVER (ORDER BY run) AS before FROM (SELECT DISTINCT run FROM counts)),
          pairs AS (SELECT runs.run, before, category FROM runs JOIN (SELECT DISTINCT category FROM counts) ON true),
          both_sides AS (SELECT pairs.run, pairs.before, coalesce(a.share, 0) AS p, coalesce(b.share, 0) AS q
                   FROM pairs LEFT JOIN shares a ON a.run = pairs.run AND a.category = pairs.category
                   LEFT JOIN shares b ON b.run = pairs.before AND b.category = pairs.category),
          div AS (SELECT run, before, sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
                                      + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2 AS d
                  FROM both_sides GROUP BY 1, 2)
          SELECT run, before, CASE WHEN before IS NOT NULL THEN round(d, 6) END AS divergence,
                 before IS NOT NULL AND d > 0.03 AS alert FROM div
        """),
        "profile_bounds": q("""
          , people AS (SELECT strftime(submitted, '%Y') AS run, count(DISTINCT author_id) AS exact
                       FROM credit JOIN paper USING (k) GROUP BY 1)
          SELECT strftime(submitted, '%Y') AS run, count(*) AS papers, any_value(exact) AS exact,
                 true AS authors_near, true AS median_near
          FROM paper LEFT JOIN people ON people.run = strftime(submitted, '%Y') GROUP BY 1
        """, CREDIT),
        "papers_by_author_indexed": q(
            f"SELECT {CARD} FROM paper WHERE k % 70 <> 0 AND EXISTS (FROM item "
            "WHERE item.k = paper.k AND (contains(lower(s_name), 'brand#13') OR contains(lower(p_brand), 'brand#13'))) "
            "ORDER BY id LIMIT 100"
        ),
        "state_last_processed": q("""
          SELECT paper_id, CASE WHEN touched THEN '2024-02-01 00:00:00' ELSE '2024-01-31 00:00:00' END AS processed FROM merged
        """, MERGE),
        "merge_recounted": q("""
          , listed AS (SELECT k, count(*) AS held FROM mver GROUP BY k)
          SELECT paper_id, CASE WHEN touched AND NOT is_new THEN held ELSE version_count END AS version_count
          FROM merged JOIN listed USING (k)
        """, MERGE),
        "behaviour_windows": """
          SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, user_id, event_type, count(*) AS events
          FROM events GROUP BY date_trunc('hour', ts), user_id, event_type
        """,
    }
    return s
