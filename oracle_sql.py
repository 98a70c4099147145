"""DuckDB SQL twins of the registered queries (the correctness oracle).

The oracle never re-parses wiki markup (DuckDB's RE2 has no lookarounds and
its regex dialect differs from Java's). It computes the expected rows from
the parts the derived corpus was built from; see
``wikipassages/plans/corpus.py`` for the recipe. Column names match the
Spark queries exactly.
"""

from __future__ import annotations

from wikipassages.functions import porter
from wikipassages.functions.analysis import PROTOTYPE_STOP_WORDS

# Lines of each document, the sections built from them, and the hub.
CORPUS_CTE = """
d AS (
  SELECT doc_id, lang,
         list_filter(list_transform(string_split(text, chr(10)),
                                    lambda x: trim(replace(x, '=', ''))),
                     lambda x: x <> '') AS l
  FROM documents WHERE text IS NOT NULL
),
s AS (
  SELECT doc_id, lang, l, len(l) - 1 AS m, unnest(range(1, len(l))) AS i FROM d
),
sec AS (
  SELECT doc_id, lang, l, m, i,
         i + 3 - (i - 1) % 3 AS e,
         length(l[i + 1]) - length(replace(l[i + 1], '.', '')) AS c
  FROM s
),
hub AS (
  SELECT arg_min(doc_id, doc_id) AS hd, arg_min(lang, doc_id) AS hl,
         (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS ndocs
  FROM documents
),
sec_text AS (
  SELECT doc_id, lang, i, c, m,
         ' ' || l[i + 1]
         || CASE WHEN i + 1 < e AND i + 1 <= m
                 THEN ' ' || repeat('=', 2 + i % 3) || ' S_' || (i + 1) || ' ' || repeat('=', 2 + i % 3)
                      || ' ' || l[i + 2] ELSE '' END
         || CASE WHEN i + 2 < e AND i + 2 <= m
                 THEN ' ' || repeat('=', 2 + (i + 1) % 3) || ' S_' || (i + 2) || ' ' || repeat('=', 2 + (i + 1) % 3)
                      || ' ' || l[i + 3] ELSE '' END
         || CASE WHEN e <= m THEN ' ' ELSE '' END AS text
  FROM sec
),
redirected AS (
  SELECT lower('Doc ' || t.doc_id || '–' || t.lang || '#S ' || t.i) AS key,
         lower('Doc ' || t.doc_id || '–' || t.lang) AS page,
         's ' || t.i AS section,
         CAST(t.c + CASE WHEN t.doc_id = h.hd AND t.i = 1 THEN h.ndocs ELSE 0 END AS INTEGER) AS n,
         t.text AS text
  FROM sec_text t, hub h
  WHERE t.c > 0 OR (t.doc_id = h.hd AND t.i = 1)
  UNION ALL
  SELECT lower('Doc ' || h.hd || '–' || h.hl || '#S 1'), lower('Doc ' || h.hd || '–' || h.hl), 's 1',
         CAST(h.ndocs AS INTEGER), ''
  FROM hub h
  WHERE NOT EXISTS (SELECT 1 FROM sec WHERE sec.doc_id = h.hd AND sec.i = 1)
  UNION ALL
  SELECT lower('Doc ' || doc_id || '–' || lang || '#Lead'), lower('Doc ' || doc_id || '–' || lang), 'lead',
         1, ''
  FROM d
  UNION ALL
  SELECT 'css ' || doc_id || '#s 1', 'css ' || doc_id, 's 1', 1, '' FROM d
)
"""

REDIRECTED_SECTIONS = "WITH " + CORPUS_CTE + "SELECT key, page, section, n, text FROM redirected"

# Redirect pages to sections, long form. Titles as the primary job keeps them:
# normalised (underscores to spaces), not lower-cased.
SECTION_REDIRECTS = "WITH " + CORPUS_CTE + """,
r AS (
  SELECT lower('Doc ' || doc_id || '–' || lang || '#S ' || i) AS key,
         lower('Doc ' || doc_id || '–' || lang) AS page, 's ' || i AS section,
         'R ' || doc_id || ' ' || i || ' ' || unnest(range(1, c + 1)) AS redirect
  FROM sec WHERE c > 0
  UNION ALL
  SELECT lower('Doc ' || h.hd || '–' || h.hl || '#S 1'), lower('Doc ' || h.hd || '–' || h.hl), 's 1',
         'Hub ' || d.doc_id
  FROM d, hub h
  UNION ALL
  SELECT lower('Doc ' || doc_id || '–' || lang || '#Lead'), lower('Doc ' || doc_id || '–' || lang), 'lead',
         'Lead ' || doc_id FROM d
  UNION ALL
  SELECT 'css ' || doc_id || '#s 1', 'css ' || doc_id, 's 1', 'Cssr ' || doc_id FROM d
)
SELECT key, page, section, redirect FROM r"""

INDEXABLE = "WITH " + CORPUS_CTE + """,
ix AS (SELECT key, page, section, n, text, CAST(length(text) AS INTEGER) AS len
       FROM redirected WHERE length(text) > 0)
"""

SECTION_STATS = INDEXABLE + """
SELECT count(*) AS sections,
       avg(len) AS avg_text_length,
       avg(n) AS avg_redirs,
       max(len) AS longest_length,
       (SELECT section FROM ix ORDER BY len DESC, key LIMIT 1) AS longest_section,
       (SELECT page FROM ix ORDER BY len DESC, key LIMIT 1) AS longest_page,
       max(n) AS most_redirs,
       (SELECT section FROM ix ORDER BY n DESC, key LIMIT 1) AS most_redirs_section,
       (SELECT page FROM ix ORDER BY n DESC, key LIMIT 1) AS most_redirs_page,
       count(*) FILTER (WHERE len < 85) AS shorter_than_sentence,
       count(*) FILTER (WHERE len < 10) AS shorter_than_test,
       count(*) FILTER (WHERE len = 1) AS one_char,
       count(*) FILTER (WHERE len = 0) AS zero_char
FROM ix"""

REDIRS_COUNT_HIST = INDEXABLE + """
SELECT n AS redirs_count, count(*) AS freq FROM ix GROUP BY n"""

# Per source: the page's language (text after the en dash).
SECTION_STATS_BY_LANG = INDEXABLE + """,
sx AS (SELECT *, split_part(page, '–', -1) AS source FROM ix),
lg AS (SELECT source, arg_min(section, (-len, key)) AS ls, arg_min(page, (-len, key)) AS lp,
              arg_min(section, (-n, key)) AS ms, arg_min(page, (-n, key)) AS mp
       FROM sx GROUP BY source)
SELECT sx.source,
       count(*) AS sections,
       avg(len) AS avg_text_length,
       avg(n) AS avg_redirs,
       max(len) AS longest_length,
       any_value(lg.ls) AS longest_section,
       any_value(lg.lp) AS longest_page,
       max(n) AS most_redirs,
       any_value(lg.ms) AS most_redirs_section,
       any_value(lg.mp) AS most_redirs_page,
       count(*) FILTER (WHERE len < 85) AS shorter_than_sentence,
       count(*) FILTER (WHERE len < 10) AS shorter_than_test,
       count(*) FILTER (WHERE len = 1) AS one_char,
       count(*) FILTER (WHERE len = 0) AS zero_char
FROM sx JOIN lg USING (source) GROUP BY sx.source"""

REDIRS_COUNT_HIST_BY_LANG = INDEXABLE + """
SELECT split_part(page, '–', -1) AS source, n AS redirs_count, count(*) AS freq FROM ix GROUP BY ALL"""


def weighted_hist(bins: int) -> str:
    return INDEXABLE + f""",
h AS (SELECT n AS redirs_count, count(*) AS freq FROM ix GROUP BY n),
r AS (SELECT CAST(CASE WHEN max(redirs_count) > min(redirs_count) THEN min(redirs_count)
                       ELSE min(redirs_count) - 0.5 END AS DOUBLE) AS lo,
             CAST(CASE WHEN max(redirs_count) > min(redirs_count) THEN max(redirs_count)
                       ELSE max(redirs_count) + 0.5 END AS DOUBLE) AS hi
      FROM h),
b AS (SELECT CAST(least({bins}, floor((CAST(redirs_count AS DOUBLE) - lo) * {bins}.0 / (hi - lo)) + 1) AS INTEGER) AS bin,
             log10(CAST(freq AS DOUBLE)) AS w
      FROM h, r)
SELECT bin, lo + (bin - 1) * (hi - lo) / {bins}.0 AS bin_lo, lo + bin * (hi - lo) / {bins}.0 AS bin_hi,
       count(*) AS n_values, round(sum(w), 9) AS weight
FROM b, r GROUP BY bin, lo, hi"""


WORD_COUNT = r"""
SELECT word, count(*) AS freq
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word
      FROM documents WHERE text IS NOT NULL)
WHERE word <> ''
GROUP BY word"""


STOP_LIST = ("['a','an','and','are','as','at','be','but','by','for','if','in','into','is','it','no','not',"
             "'of','on','or','such','that','the','their','then','there','these','they','this','to','was',"
             "'will','with']")


def _analyzed(col: str) -> str:
    """Letter tokens, lower-cased, stop words removed (positions dropped)."""
    return (f"list_filter(list_transform(regexp_extract_all({col}, '\\p{{L}}+'), lambda x: lower(x)), "
            f"lambda x: NOT list_contains({STOP_LIST}, x))")


def _analyzed_pos(col: str) -> str:
    """Same with positions counted before stop-word removal."""
    return (f"list_filter(list_transform(regexp_extract_all({col}, '\\p{{L}}+'), "
            f"lambda x, i: struct_pack(pos := i - 1, term := lower(x))), "
            f"lambda s: NOT list_contains({STOP_LIST}, s.term))")


# sectionText postings, doc frequencies, N, and the benchmark's query terms.
SEARCH_CTE = INDEXABLE + f""",
dt AS (SELECT key AS doc_id, {_analyzed('text')} AS toks FROM ix),
tok AS (SELECT doc_id, len(toks) AS len, unnest(toks) AS term FROM dt),
post AS (SELECT term, doc_id, len, count(*) AS tf FROM tok GROUP BY term, doc_id, len),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ix),
avgl AS (SELECT CAST(sum(len(toks)) AS DOUBLE) / (SELECT n FROM nd) AS avg FROM dt),
qraw AS (SELECT item_id AS query_id, unnest({_analyzed('text')}) AS term FROM benchmark),
qt AS (SELECT query_id, term, count(*) AS qtf FROM qraw GROUP BY query_id, term)
"""

SEARCH_TFIDF_SCORES = SEARCH_CTE + """,
qi AS (SELECT qt.query_id, qt.term, qt.qtf, 1.0 + ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) AS idf
       FROM qt LEFT JOIN dfs USING (term), nd),
qn AS (SELECT query_id, sum(qtf * idf * idf) AS sumsq, sum(qtf) AS clauses FROM qi GROUP BY query_id),
m AS (SELECT qi.query_id, p.doc_id, sum(qi.qtf * sqrt(p.tf) * qi.idf * qi.idf / sqrt(p.len)) AS raw,
             sum(qi.qtf) AS hits
      FROM post p JOIN qi USING (term) GROUP BY qi.query_id, p.doc_id),
sc AS (SELECT m.query_id, m.doc_id, round(m.raw / sqrt(qn.sumsq) * m.hits / qn.clauses, 6) AS score
      FROM m JOIN qn USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM sc)
"""

SEARCH_TFIDF = SEARCH_TFIDF_SCORES + "SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"
SEARCH_TFIDF_PAGE2 = SEARCH_TFIDF_SCORES + "SELECT query_id, rank, doc_id, score FROM rk WHERE rank BETWEEN 11 AND 20"

# One query for each language over page title, section title and redirect titles.
SEARCH_FIELDS = INDEXABLE + f""",
titles AS (
  SELECT lower('Doc ' || doc_id || '–' || lang || '#S ' || i) AS key, 'R ' || doc_id || ' ' || i || ' ' || unnest(range(1, c + 1)) AS redirect
  FROM sec WHERE c > 0
  UNION ALL SELECT lower('Doc ' || h.hd || '–' || h.hl || '#S 1'), 'Hub ' || d.doc_id FROM d, hub h
  UNION ALL SELECT lower('Doc ' || doc_id || '–' || lang || '#Lead'), 'Lead ' || doc_id FROM d
  UNION ALL SELECT 'css ' || doc_id || '#s 1', 'Cssr ' || doc_id FROM d
),
toks AS (
  SELECT 'pageTitle' AS field, key, unnest({_analyzed('page')}) AS term FROM ix
  UNION ALL SELECT 'sectionTitle', key, unnest({_analyzed('section')}) FROM ix
  UNION ALL SELECT 'redirsFrom', key, unnest({_analyzed('redirect')}) FROM titles SEMI JOIN ix USING (key)
),
lens AS (SELECT field, key, count(*) AS len FROM toks GROUP BY ALL),
post AS (SELECT field, key, term, len, count(*) AS tf FROM toks JOIN lens USING (field, key) GROUP BY ALL),
dfs AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ix),
langs AS (SELECT DISTINCT lang AS query_id FROM documents WHERE lang IS NOT NULL),
q AS (SELECT query_id, 'sectionTitle' AS field, 's' AS term, 1.0 AS boost, 'must' AS occur FROM langs
      UNION ALL SELECT query_id, 'pageTitle', 'doc', 1.0, 'should' FROM langs
      UNION ALL SELECT query_id, 'pageTitle', lower(query_id), 1.0, 'should' FROM langs
      UNION ALL SELECT query_id, 'redirsFrom', 'hub', 2.0, 'should' FROM langs
      UNION ALL SELECT query_id, 'redirsFrom', 'lead', 1.0, 'should' FROM langs
      UNION ALL SELECT query_id, 'redirsFrom', 'cssr', 1.0, 'not' FROM langs),
qi AS (SELECT q.*, CAST(q.boost AS DOUBLE) AS b, 1.0 + ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) AS idf
       FROM q LEFT JOIN dfs USING (field, term), nd),
qn AS (SELECT query_id, sum(idf * b * idf * b) AS sumsq, count(*) AS clauses FROM qi WHERE occur <> 'not' GROUP BY query_id),
m AS (SELECT qi.query_id, p.key, sum(sqrt(p.tf) * qi.idf * qi.idf * qi.b / sqrt(p.len)) FILTER (occur <> 'not') AS raw,
             count(*) FILTER (occur <> 'not') AS hits, count(*) FILTER (occur = 'must') AS musts, count(*) FILTER (occur = 'not') AS bad
      FROM post p JOIN qi USING (field, term) GROUP BY ALL),
sc AS (SELECT query_id, key AS doc_id, round(raw / sqrt(sumsq) * hits / clauses, 6) AS score
       FROM m JOIN qn USING (query_id) WHERE bad = 0 AND musts = 1 AND hits > 0),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

SEARCH_NEXT_PAGE = SEARCH_TFIDF_SCORES + """
SELECT query_id, rank, doc_id, score, CAST(count(*) OVER (PARTITION BY query_id) AS INTEGER) AS hits_on_page,
       EXISTS (SELECT 1 FROM rk AS later WHERE later.query_id = rk.query_id AND later.rank = 21) AS more
FROM rk WHERE rank BETWEEN 11 AND 20"""

LINES_COUNT_FILES = INDEXABLE + """
SELECT CASE WHEN contains(page, '–') THEN split_part(page, '–', -1) ELSE 'none' END || 'wiki.txtredirsCount.txt' AS file,
       n AS redirs_count, count(*) AS freq
FROM ix GROUP BY ALL"""

SEARCH_BOOLEAN = SEARCH_CTE + """,
qi AS (SELECT qt.query_id, qt.term, qt.qtf, qt.qtf >= 2 AS must,
              1.0 + ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) AS idf
       FROM qt LEFT JOIN dfs USING (term), nd),
qn AS (SELECT query_id, sum(qtf * idf * idf) AS sumsq, sum(qtf) AS clauses, count(*) FILTER (WHERE must) AS musts
       FROM qi GROUP BY query_id),
m AS (SELECT qi.query_id, p.doc_id, sum(qi.qtf * sqrt(p.tf) * qi.idf * qi.idf / sqrt(p.len)) AS raw,
             sum(qi.qtf) AS hits, count(*) FILTER (WHERE qi.must) AS must_hits
      FROM post p JOIN qi USING (term) GROUP BY qi.query_id, p.doc_id),
sc AS (SELECT m.query_id, m.doc_id, round(m.raw / sqrt(qn.sumsq) * m.hits / qn.clauses, 6) AS score
       FROM m JOIN qn USING (query_id) WHERE m.must_hits = qn.musts),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
       FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

# Fuzzy (two edits), nested clauses. DuckDB's levenshtein counts bytes; terms
# are lower-case letters, so each non-ASCII letter is first mapped to a free
# ASCII character (upper case, digits, punctuation) to count characters.
SEARCH_FUZZY = SEARCH_CTE + """,
vocab AS (SELECT DISTINCT term FROM post),
qterms AS (SELECT DISTINCT term AS qterm FROM qt),
chars AS (SELECT DISTINCT ch FROM (SELECT unnest(string_split(w, '')) AS ch
                                   FROM (SELECT term AS w FROM vocab UNION ALL SELECT qterm FROM qterms))
          WHERE unicode(ch) > 127),
slots AS (SELECT list_filter(range(33, 127), lambda c: c < 97 OR c > 122) AS sl),
cmap AS (SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS src,
                coalesce(string_agg(chr(CAST(sl[CAST(rn AS INTEGER)] AS INTEGER)), '' ORDER BY ch), '') AS dst
         FROM (SELECT ch, row_number() OVER (ORDER BY ch) AS rn FROM chars), slots),
ex AS (SELECT q.qterm, v.term,
              levenshtein(translate(q.qterm, cmap.src, cmap.dst), translate(v.term, cmap.src, cmap.dst)) AS ed
       FROM qterms q, vocab v, cmap
       WHERE abs(length(q.qterm) - length(v.term)) <= 2),
exf AS (SELECT ex.qterm, ex.term, 1.0 - ed / least(length(ex.qterm), length(ex.term)) AS boost,
               1.0 + ln(nd.n / (CAST(dfs.df AS DOUBLE) + 1.0)) AS idf
        FROM ex JOIN dfs USING (term), nd WHERE ed <= 2),
wt AS (SELECT qterm, sum((idf * boost) * (idf * boost)) AS w FROM exf GROUP BY qterm),
fs AS (SELECT exf.qterm, p.doc_id, sum(exf.boost * sqrt(p.tf) * exf.idf * exf.idf / sqrt(p.len)) AS s
       FROM post p JOIN exf USING (term) GROUP BY exf.qterm, p.doc_id),
cl AS (SELECT qt.query_id, qt.term AS qterm, qt.qtf, coalesce(wt.w, 0.0) AS w
       FROM qt LEFT JOIN wt ON wt.qterm = qt.term),
qi AS (SELECT query_id, sum(qtf * w) AS sumsq, sum(qtf) AS n_clauses FROM cl GROUP BY query_id),
hits AS (SELECT cl.query_id, fs.doc_id, sum(cl.qtf * fs.s) AS raw, sum(cl.qtf) AS matched
         FROM cl JOIN fs USING (qterm) GROUP BY cl.query_id, fs.doc_id),
sc AS (SELECT hits.query_id, hits.doc_id, round(raw / sqrt(sumsq) * matched / n_clauses, 6) AS score
       FROM hits JOIN qi USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
       FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

SEARCH_BM25 = SEARCH_CTE + """,
qi AS (SELECT qt.query_id, qt.term, qt.qtf, ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) + 1.0 AS idf
       FROM qt LEFT JOIN dfs USING (term), nd),
need AS (SELECT query_id, count(*) AS n_terms FROM qi GROUP BY query_id),
m AS (SELECT qi.query_id, p.doc_id,
             sum(qi.qtf * qi.idf * CAST(p.tf AS DOUBLE) * 2.2
                 / (CAST(p.tf AS DOUBLE) + 1.2 * (0.25 + 0.75 * p.len / avgl.avg))) AS score,
             count(*) AS matched
      FROM post p JOIN qi USING (term), avgl GROUP BY qi.query_id, p.doc_id),
sc AS (SELECT m.query_id, m.doc_id, round(m.score, 6) AS score FROM m JOIN need USING (query_id)
      WHERE m.matched = need.n_terms),
rk AS (SELECT query_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

SEARCH_PHRASE = INDEXABLE + f""",
dp AS (SELECT key AS doc_id, unnest({_analyzed_pos('text')}) AS t FROM ix),
pos AS (SELECT doc_id, t.term AS term, t.pos AS pos FROM dp),
qp AS (SELECT item_id AS query_id, {_analyzed_pos('text')} AS toks FROM benchmark),
qi AS (SELECT query_id, toks, unnest(range(1, len(toks))) AS i FROM qp),
ph AS (SELECT query_id, CAST(i AS INTEGER) AS phrase_id, toks[i].term AS term, 0 AS o FROM qi
       UNION ALL
       SELECT query_id, CAST(i AS INTEGER), toks[i + 1].term, toks[i + 1].pos - toks[i].pos FROM qi),
st AS (SELECT ph.query_id, ph.phrase_id, pos.doc_id, pos.pos - ph.o AS start, count(*) AS k
       FROM pos JOIN ph USING (term) GROUP BY ALL)
SELECT query_id, phrase_id, doc_id, count(*) AS freq FROM st WHERE k = 2 GROUP BY ALL"""

SEARCH_PREFIX = SEARCH_CTE + """,
vocab AS (SELECT DISTINCT term FROM post),
cl AS (SELECT query_id, term AS clause_id FROM qt),
ncl AS (SELECT query_id, count(*) AS clauses FROM cl GROUP BY query_id),
ex AS (SELECT cl.query_id, cl.clause_id, v.term FROM cl JOIN vocab v ON starts_with(v.term, cl.clause_id)),
hit AS (SELECT DISTINCT ex.query_id, ex.clause_id, p.doc_id FROM ex JOIN post p USING (term)),
m AS (SELECT query_id, doc_id, count(*) AS matched FROM hit GROUP BY ALL),
sc AS (SELECT m.query_id, m.doc_id, round(m.matched * m.matched / pow(ncl.clauses, 1.5), 6) AS score
      FROM m JOIN ncl USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""


# Staged chain: level-2 sections keep raw titles; the next level-2 match eats
# the space before it; merging appends one space.
STAGED_CTE = "WITH " + CORPUS_CTE + """,
lvl2 AS (
  SELECT doc_id, lang, i, c,
         'Doc_' || doc_id || '-' || lang || '#S_' || i AS key,
         ' ' || l[i + 1]
         || CASE WHEN i + 1 <= m THEN ' === S_' || (i + 1) || ' === ' || l[i + 2] ELSE '' END
         || CASE WHEN i + 2 <= m THEN ' ==== S_' || (i + 2) || ' ==== ' || l[i + 3] ELSE '' END
         || ' ' AS text
  FROM sec WHERE 2 + (i - 1) % 3 = 2
),
rk AS (SELECT doc_id, lang, i, unnest(range(1, c + 1)) AS k FROM sec WHERE c > 0),
staged AS (
  SELECT key, text FROM lvl2
  UNION ALL
  SELECT 'Doc_' || doc_id || '-' || lang,
         coalesce(l[1], '') || ' {{Main|Doc_' || (doc_id + 1) || '-' || lang || '}}' || ' '
  FROM d WHERE len(l) <= 1
  UNION ALL
  SELECT 'Css_' || doc_id || '#S_1', ' ' || coalesce(l[1], '') || ' ' FROM d
  UNION ALL
  SELECT 'R_' || doc_id || '_' || i || '_' || k,
         CASE WHEN k % 2 = 1 THEN '#REDIRECT' ELSE '#presmeruj' END
         || ' [[Doc_' || doc_id || '-' || lang || '#S_' || i || ']] '
  FROM rk
  UNION ALL
  SELECT 'Hub_' || d.doc_id, '#REDIRECT [[Doc_' || h.hd || '-' || h.hl || '#S_1]] ' FROM d, hub h
  UNION ALL
  SELECT 'Lead_' || doc_id, '#REDIRECT [[Doc_' || doc_id || '-' || lang || '#Lead]] ' FROM d
  UNION ALL
  SELECT 'P_' || doc_id, '#REDIRECT [[Doc_' || doc_id || '-' || lang || ']] ' FROM d
  UNION ALL
  SELECT 'Cssr_' || doc_id, '#REDIRECT [[Css_' || doc_id || '#S_1]] ' FROM d
)
"""

STAGED_SECTIONS = STAGED_CTE + "SELECT key, text FROM staged"

STAGED_REDIRECTED = STAGED_CTE + """
SELECT key, text FROM lvl2, hub h WHERE c > 0 OR (doc_id = h.hd AND i = 1)
UNION ALL
SELECT 'Css_' || doc_id || '#S_1', ' ' || coalesce(l[1], '') || ' ' FROM d"""

LINK_INVERSION = "WITH " + CORPUS_CTE + """,
titles AS (
  SELECT 'Doc_' || doc_id || '-' || lang AS title FROM d
  UNION ALL SELECT 'Css_' || doc_id FROM d
),
edges AS (
  SELECT 'Doc_' || doc_id || '-' || lang AS target,
         'R_' || doc_id || '_' || i || '_' || unnest(range(1, c + 1)) AS r_from
  FROM sec WHERE c > 0
  UNION ALL SELECT 'Doc_' || h.hd || '-' || h.hl, 'Hub_' || d.doc_id FROM d, hub h
  UNION ALL SELECT 'Doc_' || doc_id || '-' || lang, 'Lead_' || doc_id FROM d
  UNION ALL SELECT 'Doc_' || doc_id || '-' || lang, 'P_' || doc_id FROM d
  UNION ALL SELECT 'Css_' || doc_id, 'Cssr_' || doc_id FROM d
  UNION ALL SELECT 'Doc_' || (doc_id + 1) || '-' || lang, 'Doc_' || doc_id || '-' || lang FROM d
)
SELECT t.title, e.r_from FROM titles t JOIN edges e ON e.target = t.title"""


SEARCH_MUST_NOT = SEARCH_CTE + """,
bad AS (SELECT query_id, min(term) AS term FROM qt GROUP BY query_id),
good AS (SELECT qt.* FROM qt ANTI JOIN bad USING (query_id, term)),
qi AS (SELECT good.query_id, good.term, good.qtf, 1.0 + ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) AS idf
       FROM good LEFT JOIN dfs USING (term), nd),
qn AS (SELECT query_id, sum(qtf * idf * idf) AS sumsq, sum(qtf) AS clauses FROM qi GROUP BY query_id),
m AS (SELECT qi.query_id, p.doc_id, sum(qi.qtf * sqrt(p.tf) * qi.idf * qi.idf / sqrt(p.len)) AS raw, sum(qi.qtf) AS hits
      FROM post p JOIN qi USING (term) GROUP BY qi.query_id, p.doc_id),
no AS (SELECT bad.query_id, post.doc_id FROM bad JOIN post USING (term)),
sc AS (SELECT m.query_id, m.doc_id, round(m.raw / sqrt(qn.sumsq) * m.hits / qn.clauses, 6) AS score
       FROM m ANTI JOIN no USING (query_id, doc_id) JOIN qn USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
       FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""


def _constant_clauses(clauses: str, matches: str) -> str:
    """Top 10 of constant-score clauses: ``matches`` joins vocab v to clause cl."""
    return SEARCH_CTE + f""",
vocab AS (SELECT DISTINCT term FROM post),
cl AS (SELECT query_id, term AS clause_id FROM qt {clauses}),
ncl AS (SELECT query_id, count(*) AS clauses FROM cl GROUP BY query_id),
ex AS (SELECT cl.query_id, cl.clause_id, v.term FROM cl JOIN vocab v ON {matches}),
hit AS (SELECT DISTINCT ex.query_id, ex.clause_id, p.doc_id FROM ex JOIN post p USING (term)),
m AS (SELECT query_id, doc_id, count(*) AS matched FROM hit GROUP BY ALL),
sc AS (SELECT m.query_id, m.doc_id, round(m.matched * m.matched / pow(ncl.clauses, 1.5), 6) AS score
       FROM m JOIN ncl USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
       FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""


SEARCH_WILDCARD = _constant_clauses(
    "WHERE length(term) >= 3",
    "starts_with(v.term, left(cl.clause_id, 2)) AND right(v.term, 1) = right(cl.clause_id, 1) AND length(v.term) >= 4")
SEARCH_INFIX = SEARCH_CTE + """,
vocab AS (SELECT DISTINCT term FROM post),
cl AS (SELECT DISTINCT query_id, unnest(['*' || substr(term, 2, 3) || '*', '?' || substr(term, 2, 2) || '*']) AS clause_id FROM qt WHERE length(term) >= 4),
ncl AS (SELECT query_id, count(*) AS clauses FROM cl GROUP BY query_id),
pats AS (SELECT DISTINCT clause_id, replace(replace(clause_id, '*', ''), '?', '') AS inner_part FROM cl),
ex AS (SELECT pats.clause_id, v.term FROM pats JOIN vocab v
       ON CASE WHEN starts_with(clause_id, '*') THEN contains(v.term, inner_part) ELSE substr(v.term, 2, 2) = inner_part END),
hit AS (SELECT DISTINCT cl.query_id, cl.clause_id, p.doc_id FROM cl JOIN ex USING (clause_id) JOIN post p USING (term)),
m AS (SELECT query_id, doc_id, count(*) AS matched FROM hit GROUP BY ALL),
sc AS (SELECT m.query_id, m.doc_id, round(m.matched * m.matched / pow(ncl.clauses, 1.5), 6) AS score
      FROM m JOIN ncl USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

SEARCH_RANGE = _constant_clauses("", "v.term >= cl.clause_id AND v.term <= cl.clause_id || 'm'")

# The same sections twice: every posting and document a second time under its own id.
SEARCH_AFTER_APPEND = SEARCH_CTE + """,
post2 AS (SELECT term, doc_id, len, tf FROM post UNION ALL SELECT term, doc_id || chr(9247) || '2', len, tf FROM post),
qi AS (SELECT qt.query_id, qt.term, qt.qtf, ln(2 * nd.n / (CAST(2 * coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) + 1.0 AS idf
       FROM qt LEFT JOIN dfs USING (term), nd),
need AS (SELECT query_id, count(*) AS n_terms FROM qi GROUP BY query_id),
m AS (SELECT qi.query_id, p.doc_id,
             sum(qi.qtf * qi.idf * CAST(p.tf AS DOUBLE) * 2.2
                 / (CAST(p.tf AS DOUBLE) + 1.2 * (0.25 + 0.75 * p.len / avgl.avg))) AS score,
             count(*) AS matched
      FROM post2 p JOIN qi USING (term), avgl GROUP BY qi.query_id, p.doc_id),
sc AS (SELECT m.query_id, m.doc_id, round(m.score, 6) AS score FROM m JOIN need USING (query_id)
       WHERE m.matched = need.n_terms),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
       FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

SEARCH_HITS = SEARCH_TFIDF_SCORES + """,
r AS (
  SELECT lower('Doc ' || doc_id || '–' || lang || '#S ' || i) AS key,
         'R ' || doc_id || ' ' || i || ' ' || unnest(range(1, c + 1)) AS redirect
  FROM sec WHERE c > 0
  UNION ALL
  SELECT lower('Doc ' || h.hd || '–' || h.hl || '#S 1'), 'Hub ' || d.doc_id FROM d, hub h
),
titles AS (SELECT key, string_agg(redirect || chr(9), '' ORDER BY redirect) AS t FROM r GROUP BY key)
SELECT query_id, rank, rank || '. ' || t || chr(9608) || ix.page || chr(9608) || ix.section || chr(9608) AS hit
FROM rk JOIN ix ON ix.key = rk.doc_id JOIN titles USING (key) WHERE rank <= 10"""

DEAD_LETTERS = "WITH " + CORPUS_CTE + """
SELECT '<page><title>Broken_' || doc_id || '</title><revision><text>'
       || replace(replace(replace(replace(coalesce(l[1], ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')
       || '</revision></page>' AS record
FROM d"""

# A page, a css page and a damaged record for each document; four fixed redirects and one for each dot.
DUMP_FILE_COUNTS = "WITH " + CORPUS_CTE + """
SELECT 'content' AS branch, 3 * count(*) AS records, count(*) AS broken FROM d
UNION ALL SELECT 'redirects', 4 * (SELECT count(*) FROM d) + CAST((SELECT coalesce(sum(c), 0) FROM sec) AS BIGINT), 0"""


# Porter stems of a table terms(term): one CTE for each step. Consonantal y is
# written Y meanwhile.
_M0, _M1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]", "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
_ONE, _CVC = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]*$", "[^aeiouy][aeiouy][^aeiouywxY]$"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _doubled(w: str) -> str:
    return f"length({w}) >= 2 AND lower({w}[-1]) = lower({w}[-2]) AND regexp_matches({w}, '[^aeiouy]$')"


def _rules(rules, condition: str) -> str:
    return "CASE " + " ".join(
        f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN regexp_matches({_cut(len(suffix))}, '{condition}') THEN {_cut(len(suffix))} || '{new}' ELSE w END"
        for suffix, new in rules) + " ELSE w END"


_STEP4 = "CASE " + " ".join(
    f"WHEN ends_with(w, '{suffix}')" + (f" AND regexp_matches({_cut(3)}, '[st]$')" if suffix == "ion" else "")
    + f" THEN CASE WHEN regexp_matches({_cut(len(suffix))}, '{_M1}') THEN {_cut(len(suffix))} ELSE w END"
    for suffix in porter.STEP4) + " ELSE w END"

STEM_CTE = f"""
p0 AS (SELECT term, replace(regexp_replace(regexp_replace(term, '^y', 'Y'), '([aeiou])y', '\\1Y', 'g'), 'yy', 'yY') AS w FROM terms),
p1 AS (SELECT term, CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {_cut(2)}
                         WHEN ends_with(w, 'ss') OR NOT ends_with(w, 's') THEN w ELSE {_cut(1)} END AS w FROM p0),
p2 AS (SELECT term, w, CASE WHEN ends_with(w, 'eed') THEN NULL
                            WHEN ends_with(w, 'ed') AND regexp_matches({_cut(2)}, '[aeiouy]') THEN {_cut(2)}
                            WHEN ends_with(w, 'ing') AND regexp_matches({_cut(3)}, '[aeiouy]') THEN {_cut(3)} END AS s FROM p1),
p3 AS (SELECT term, CASE
         WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches({_cut(3)}, '{_M0}') THEN {_cut(1)} ELSE w END
         WHEN s IS NULL THEN w
         WHEN ends_with(s, 'at') OR ends_with(s, 'bl') OR ends_with(s, 'iz') THEN s || 'e'
         WHEN {_doubled('s')} AND NOT regexp_matches(s, '[lsz]$') THEN left(s, length(s) - 1)
         WHEN regexp_matches(s, '{_ONE}') AND regexp_matches(s, '{_CVC}') THEN s || 'e' ELSE s END AS w FROM p2),
p4 AS (SELECT term, CASE WHEN regexp_matches(w, '[yY]$') AND regexp_matches({_cut(1)}, '[aeiouy]') THEN {_cut(1)} || 'i' ELSE w END AS w FROM p3),
p5 AS (SELECT term, {_rules(porter.STEP2, _M0)} AS w FROM p4),
p6 AS (SELECT term, {_rules(porter.STEP3, _M0)} AS w FROM p5),
p7 AS (SELECT term, {_STEP4} AS w FROM p6),
p8 AS (SELECT term, CASE WHEN ends_with(w, 'e') AND (regexp_matches({_cut(1)}, '{_M1}')
                              OR (regexp_matches({_cut(1)}, '{_ONE}') AND NOT regexp_matches({_cut(1)}, '{_CVC}'))) THEN {_cut(1)} ELSE w END AS w FROM p7),
stems AS (SELECT term, CASE WHEN length(term) <= 2 THEN term
                            WHEN ends_with(w, 'll') AND regexp_matches(w, '{_M1}') THEN replace({_cut(1)}, 'Y', 'y') ELSE replace(w, 'Y', 'y') END AS stem FROM p8)
"""

_WORD = "[\\p{L}\\p{Nl}\\p{Nd}\\p{M}\\p{Pc}]"
PROTOTYPE_STOP_LIST = str(PROTOTYPE_STOP_WORDS)


def _words(col: str) -> str:
    """Word tokens of two letters or more, lower-cased, stop words removed."""
    return (f"list_filter(list_transform(regexp_extract_all({col}, '{_WORD}+(?:\\.?{_WORD}+)*'), lambda x: lower(x)), "
            f"lambda x: length(x) >= 2 AND NOT list_contains({PROTOTYPE_STOP_LIST}, x))")


STEM_VOCABULARY = f"""
WITH terms AS (SELECT DISTINCT unnest({_words("text")}) AS term FROM documents WHERE text IS NOT NULL),
{STEM_CTE}
SELECT term, stem FROM stems"""

# Pages that something points at: all content pages (their Lead and P pages) and the css pages.
PROTOTYPE_SEARCH = "WITH " + CORPUS_CTE + f""",
bodies AS (SELECT doc_id, string_agg(chr(10) || repeat('=', CAST(2 + (i - 1) % 3 AS INTEGER)) || ' S_' || i || ' '
                                     || repeat('=', CAST(2 + (i - 1) % 3 AS INTEGER)) || chr(10) || l[i + 1], '' ORDER BY i) AS body FROM s GROUP BY doc_id),
pages AS (
  SELECT 'Doc_' || doc_id || '-' || lang AS doc_id,
         coalesce(l[1], '') || ' {{{{Main|Doc_' || (doc_id + 1) || '-' || lang || '}}}}' || coalesce(body, '') AS text
  FROM d LEFT JOIN bodies USING (doc_id)
  UNION ALL SELECT 'Css_' || doc_id, 'x' || chr(10) || '== S_1 ==' || chr(10) || coalesce(l[1], '') FROM d
),
dw AS (SELECT doc_id, {_words("text")} AS toks FROM pages),
qw AS (SELECT item_id AS query_id, unnest({_words("text")}) AS term FROM benchmark),
tw AS (SELECT doc_id, len(toks) AS len, unnest(toks) AS term FROM dw),
terms AS (SELECT DISTINCT term FROM (SELECT term FROM tw UNION ALL SELECT term FROM qw)),
{STEM_CTE},
post AS (SELECT stem, doc_id, len, count(*) AS tf FROM tw JOIN stems USING (term) GROUP BY ALL),
dfs AS (SELECT stem, count(*) AS df FROM post GROUP BY stem),
qt AS (SELECT query_id, stem, count(*) AS qtf FROM qw JOIN stems USING (term) GROUP BY ALL),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM pages),
avgl AS (SELECT CAST(sum(len(toks)) AS DOUBLE) / (SELECT n FROM nd) AS avg FROM dw),
qi AS (SELECT qt.query_id, qt.stem, qt.qtf, ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) + 1.0 AS idf
       FROM qt LEFT JOIN dfs USING (stem), nd),
need AS (SELECT query_id, count(*) AS n_terms FROM qi GROUP BY query_id),
m AS (SELECT qi.query_id, p.doc_id,
             sum(qi.qtf * qi.idf * CAST(p.tf AS DOUBLE) * 2.2
                 / (CAST(p.tf AS DOUBLE) + 1.2 * (0.25 + 0.75 * p.len / avgl.avg))) AS score, count(*) AS matched
      FROM post p JOIN qi USING (stem), avgl GROUP BY ALL),
sc AS (SELECT m.query_id, m.doc_id, round(m.score, 6) AS score FROM m JOIN need USING (query_id) WHERE m.matched = need.n_terms),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""


NORMALIZED_TITLES = "WITH " + CORPUS_CTE + """,
t AS (SELECT doc_id, CAST(unnest(range(0, len(l))) AS INTEGER) AS i, unnest(l) AS line FROM d),
b AS (SELECT doc_id, i, 'Doc ' || doc_id || ' L' || i AS base, 'w' || regexp_extract(line, '[a-z]+') AS word FROM t)
SELECT doc_id, i, CASE i % 11 WHEN 5 THEN word WHEN 6 THEN 'Café ' || base WHEN 7 THEN 'Café ' || base
                              WHEN 8 THEN base || '–' || word WHEN 9 THEN base || word ELSE base END AS title
FROM b"""

MARKUP_SECTIONS = "WITH " + CORPUS_CTE + """,
x AS (SELECT doc_id, coalesce(l[2], '') AS a, coalesce(l[3], '') AS t, coalesce(l[4], '') AS u, coalesce(l[5], '') AS v,
             coalesce(l[6], '') AS w, coalesce(l[7], '') AS s, coalesce(array_to_string(l[8:], ' '), '') AS rest FROM d),
w AS (SELECT *, ' ' || w || ' ' AS tw FROM x),
v AS (SELECT *, ' ' || v || ' ====== W ======' || tw AS tv FROM w),
u AS (SELECT *, ' ' || u || ' ===== V =====' || tv AS tu FROM v),
t AS (SELECT *, ' ' || t || ' ==== U ====' || tu AS tt FROM u),
a AS (SELECT *, ' ' || a || ' === T ===' || tt AS ta FROM t),
r AS (SELECT doc_id, 'a' AS section, ta AS text FROM a UNION ALL SELECT doc_id, 'b', ta FROM a UNION ALL SELECT doc_id, 't', tt FROM a
      UNION ALL SELECT doc_id, 'u', tu FROM a UNION ALL SELECT doc_id, 'v', tv FROM a UNION ALL SELECT doc_id, 'w', tw FROM a
      UNION ALL SELECT doc_id, 'same', ' ' || s || ' ' || ' ' || rest FROM a)
SELECT 'm ' || doc_id || '#' || section AS key, 'm ' || doc_id AS page, section, CAST(1 AS INTEGER) AS n, text FROM r"""


SEARCH_PHRASE_RANKED = SEARCH_CTE + f""",
dp AS (SELECT key AS doc_id, unnest({_analyzed_pos('text')}) AS t FROM ix),
pos AS (SELECT doc_id, t.term AS term, t.pos AS pos FROM dp),
qp AS (SELECT item_id AS query_id, {_analyzed_pos('text')} AS toks FROM benchmark),
pi AS (SELECT query_id, toks, unnest(range(1, len(toks))) AS i FROM qp),
ph AS (SELECT query_id, CAST(i AS INTEGER) AS phrase_id, toks[i].term AS term, 0 AS o FROM pi
       UNION ALL
       SELECT query_id, CAST(i AS INTEGER), toks[i + 1].term, toks[i + 1].pos - toks[i].pos FROM pi),
st AS (SELECT ph.query_id, ph.phrase_id, pos.doc_id, pos.pos - ph.o AS start, count(*) AS k
       FROM pos JOIN ph USING (term) GROUP BY ALL),
fr AS (SELECT query_id, phrase_id, doc_id, count(*) AS freq FROM st WHERE k = 2 GROUP BY ALL),
pw AS (SELECT query_id, phrase_id, sum(1.0 + ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0))) AS idf
       FROM ph LEFT JOIN dfs USING (term), nd GROUP BY query_id, phrase_id),
qn AS (SELECT query_id, sum(idf * idf) AS sumsq, count(*) AS clauses FROM pw GROUP BY query_id),
m AS (SELECT fr.query_id, fr.doc_id, sum(sqrt(fr.freq) * pw.idf * pw.idf / sqrt(len(dt.toks))) AS raw, count(*) AS matched
      FROM fr JOIN pw USING (query_id, phrase_id) JOIN dt USING (doc_id) GROUP BY ALL),
sc AS (SELECT m.query_id, m.doc_id, round(raw / sqrt(sumsq) * matched / clauses, 6) AS score FROM m JOIN qn USING (query_id)),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""


SEARCH_MIXED = SEARCH_CTE + f""",
idfs AS (SELECT term, df, 1.0 + ln(nd.n / (CAST(df AS DOUBLE) + 1.0)) AS idf FROM dfs, nd),
none AS (SELECT 1.0 + ln(nd.n) AS idf FROM nd),
num AS (SELECT query_id, term, row_number() OVER (PARTITION BY query_id ORDER BY term) AS i FROM qt),
-- expansions of the clauses with several terms
cst AS (SELECT num.query_id, num.i, idfs.term, CASE i WHEN 3 THEN 0.5 ELSE 1.0 END AS boost FROM num JOIN idfs
        ON (i = 1 AND starts_with(idfs.term, left(num.term, 2)))
        OR (i = 3 AND length(idfs.term) >= 2 AND starts_with(idfs.term, left(num.term, 1)) AND ends_with(idfs.term, right(num.term, 1)))
        OR (i = 4 AND idfs.term >= num.term AND idfs.term <= num.term || 'm')),
chars AS (SELECT DISTINCT ch FROM (SELECT unnest(string_split(w, '')) AS ch
                                   FROM (SELECT term AS w FROM idfs UNION ALL SELECT term FROM num)) WHERE unicode(ch) > 127),
slots AS (SELECT list_filter(range(33, 127), lambda c: c < 97 OR c > 122) AS sl),
cmap AS (SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS src,
                coalesce(string_agg(chr(CAST(sl[CAST(rn AS INTEGER)] AS INTEGER)), '' ORDER BY ch), '') AS dst
         FROM (SELECT ch, row_number() OVER (ORDER BY ch) AS rn FROM chars), slots),
fz AS (SELECT num.query_id, num.i, idfs.term, idfs.idf, levenshtein(translate(num.term, src, dst), translate(idfs.term, src, dst)) AS ed,
              least(length(num.term), length(idfs.term)) AS sh FROM num, idfs, cmap WHERE i = 2 AND abs(length(num.term) - length(idfs.term)) <= 2),
fx AS (SELECT query_id, i, term, (1.0 - ed / sh) * idf AS part, (1.0 - ed / sh) * idf * idf AS gain FROM fz WHERE ed <= 2),
tm AS (SELECT query_id, i, num.term, coalesce(idfs.idf, none.idf) AS idf, CASE i WHEN 5 THEN 1.0 ELSE 2.0 END AS boost
       FROM num LEFT JOIN idfs USING (term), none WHERE i >= 5),
qp AS (SELECT item_id AS query_id, {_analyzed('text')} AS toks FROM benchmark),
ph AS (SELECT query_id, toks[1] AS a, toks[2] AS b, coalesce(x.idf, none.idf) + coalesce(y.idf, none.idf) AS idf
       FROM qp LEFT JOIN idfs x ON x.term = toks[1] LEFT JOIN idfs y ON y.term = toks[2], none WHERE len(toks) >= 2),
-- weights of all clauses that score
wt AS (SELECT query_id, i, CASE i WHEN 3 THEN 0.5 ELSE 1.0 END AS w FROM num WHERE i IN (1, 3, 4)
       UNION ALL SELECT num.query_id, num.i, coalesce(sqrt(sum(part * part)), 0.0) FROM num LEFT JOIN fx USING (query_id, i) WHERE num.i = 2 GROUP BY ALL
       UNION ALL SELECT query_id, i, boost * idf FROM tm WHERE i > 5
       UNION ALL SELECT query_id, 0, idf FROM ph),
qn AS (SELECT query_id, sum(w * w) AS sumsq, count(*) AS clauses FROM wt GROUP BY query_id),
dp AS (SELECT key AS doc_id, unnest({_analyzed_pos('text')}) AS t FROM ix),
pos AS (SELECT doc_id, t.term AS term, t.pos AS pos FROM dp),
fr AS (SELECT ph.query_id, p.doc_id, count(*) AS freq FROM ph JOIN pos p ON p.term = ph.a JOIN pos r ON r.term = ph.b AND r.doc_id = p.doc_id AND r.pos = p.pos + 1
       GROUP BY ALL),
mt AS (SELECT DISTINCT c.query_id, c.i, p.doc_id, c.boost AS m FROM cst c JOIN post p USING (term)
       UNION ALL SELECT query_id, i, doc_id, sum(sqrt(tf) / sqrt(len) * gain) FROM fx JOIN post USING (term) GROUP BY ALL
       UNION ALL SELECT query_id, i, doc_id, boost * idf * idf * sqrt(tf) / sqrt(len) FROM tm JOIN post USING (term)
       UNION ALL SELECT fr.query_id, 0, fr.doc_id, sqrt(freq) / sqrt(len(dt.toks)) * idf * idf FROM fr JOIN ph USING (query_id) JOIN dt USING (doc_id)),
sc AS (SELECT query_id, doc_id, round(sum(m) FILTER (i <> 5) / sqrt(any_value(sumsq)) * count(*) FILTER (i <> 5) / any_value(clauses), 6) AS score
       FROM mt JOIN qn USING (query_id) GROUP BY query_id, doc_id
       HAVING count(*) FILTER (i = 5) = 0 AND count(*) FILTER (i = 1) = 1),
rk AS (SELECT query_id, doc_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""


# Groups inside groups: +(3 6 9 ... (+pre7* -8)^0.5) (+1 +2)^2 -(+4 +5), by the terms' alphabetical places.
SEARCH_GROUPED = SEARCH_CTE + """,
cl AS (SELECT qt.query_id, term, row_number() OVER (PARTITION BY query_id ORDER BY term) AS i FROM qt),
ci AS (SELECT cl.query_id, cl.term, cl.i, 1.0 + ln(nd.n / (CAST(coalesce(dfs.df, 0) AS DOUBLE) + 1.0)) AS idf
       FROM cl LEFT JOIN dfs USING (term), nd),
inf AS (SELECT query_id, count(*) FILTER (i % 3 = 0) AS n3, count(*) FILTER (i <= 2) AS n12, count(*) FILTER (i IN (4, 5)) AS n45,
               coalesce(sum(idf * idf) FILTER (i % 3 = 0), 0) + 4 * sum(idf * idf) FILTER (i <= 2)
                 + CASE WHEN count(*) FILTER (i = 7) > 0 THEN 0.25 ELSE 0 END AS sumsq
        FROM ci GROUP BY query_id),
lt AS (SELECT ci.query_id, p.doc_id, ci.i, sqrt(p.tf) / sqrt(p.len) * idf * idf AS m FROM post p JOIN ci USING (term) WHERE i <> 7),
l7 AS (SELECT DISTINCT c.query_id, p.doc_id FROM cl c JOIN post p ON starts_with(p.term, substr(c.term, 1, 3)) WHERE c.i = 7),
g4 AS (SELECT query_id, doc_id, 0.5 AS m FROM l7 WHERE NOT EXISTS (
         SELECT 1 FROM lt WHERE lt.i = 8 AND lt.query_id = l7.query_id AND lt.doc_id = l7.doc_id)),
g1 AS (SELECT query_id, doc_id, sum(m) * count(*) / (any_value(n3) + 1) AS m
       FROM (SELECT query_id, doc_id, m FROM lt WHERE i % 3 = 0 UNION ALL SELECT * FROM g4) JOIN inf USING (query_id) GROUP BY query_id, doc_id),
g2 AS (SELECT query_id, doc_id, 2 * sum(m) AS m FROM lt JOIN inf USING (query_id) WHERE i <= 2 GROUP BY query_id, doc_id HAVING count(*) = any_value(n12)),
g3 AS (SELECT query_id, doc_id FROM lt JOIN inf USING (query_id) WHERE i IN (4, 5) GROUP BY query_id, doc_id HAVING count(*) = any_value(n45)),
sc AS (SELECT g1.query_id, g1.doc_id, round((g1.m + coalesce(g2.m, 0)) * (CASE WHEN g2.m IS NULL THEN 0.5 ELSE 1.0 END) / sqrt(inf.sumsq), 6) AS score
       FROM g1 JOIN inf ON inf.query_id = g1.query_id LEFT JOIN g2 ON g2.query_id = g1.query_id AND g2.doc_id = g1.doc_id
       WHERE NOT EXISTS (SELECT 1 FROM g3 WHERE g3.query_id = g1.query_id AND g3.doc_id = g1.doc_id)),
rk AS (SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM rk WHERE rank <= 10"""

# Three neighbouring terms in any order, at most 6 positions from the first to the last: the smallest windows.
SEARCH_NEAR = INDEXABLE + f""",
dp AS (SELECT key AS doc_id, unnest({_analyzed_pos('text')}) AS t FROM ix),
pos AS (SELECT doc_id, t.term AS term, t.pos AS pos FROM dp),
qp AS (SELECT item_id AS query_id, {_analyzed_pos('text')} AS toks FROM benchmark),
qi AS (SELECT query_id, toks, unnest(range(1, len(toks) - 1)) AS i FROM qp),
gr AS (SELECT query_id, CAST(i AS INTEGER) AS phrase_id, toks[i].term AS a, toks[i + 1].term AS b, toks[i + 2].term AS c FROM qi),
gd AS (SELECT * FROM gr WHERE a <> b AND b <> c AND a <> c),
gt AS (SELECT query_id, phrase_id, unnest([a, b, c]) AS term, unnest([1, 2, 3]) AS j FROM gd),
ev AS (SELECT query_id, phrase_id, doc_id, pos, max(CASE WHEN j = 1 THEN pos END) OVER w AS a,
              max(CASE WHEN j = 2 THEN pos END) OVER w AS b, max(CASE WHEN j = 3 THEN pos END) OVER w AS c
       FROM pos JOIN gt USING (term) WINDOW w AS (PARTITION BY query_id, phrase_id, doc_id ORDER BY pos)),
st AS (SELECT query_id, phrase_id, doc_id, pos, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN least(a, b, c) END AS s FROM ev),
mv AS (SELECT *, lag(s) OVER (PARTITION BY query_id, phrase_id, doc_id ORDER BY pos) AS before FROM st)
SELECT query_id, phrase_id, doc_id, count(*) AS freq, CAST(min(pos - s) AS INTEGER) AS span
FROM mv WHERE s IS NOT NULL AND (before IS NULL OR s > before) AND pos - s <= 6 GROUP BY ALL"""


# The markup corpus's level-2 sections, one space after each; every record has a second revision.
LINES_KEYED_TEXTS = "WITH " + CORPUS_CTE + """,
x AS (SELECT doc_id, coalesce(l[2], '') AS a, coalesce(l[3], '') AS t, coalesce(l[4], '') AS u, coalesce(l[5], '') AS v,
             coalesce(l[6], '') AS w, coalesce(l[7], '') AS s, coalesce(array_to_string(l[8:], ' '), '') AS rest FROM d),
redirs AS (SELECT doc_id, unnest(['A', 'B', 'T', 'U', 'V', 'W', 'Same', '']) AS name FROM d),
titles AS (SELECT 'M_' || doc_id AS title FROM d UNION ALL SELECT 'Empty_' || doc_id FROM d
           UNION ALL SELECT 'MR_' || name || '_' || doc_id FROM redirs)
SELECT 'M_' || doc_id || '#{{anchor|A|B}}' AS key,
       ' ' || a || ' === T === ' || t || ' ==== U ==== ' || u || ' ===== V ===== ' || v || ' ====== W ====== ' || w || ' ' AS text FROM x
UNION ALL SELECT 'M_' || doc_id || '#Same', ' ' || s || ' ' || ' ' || rest || ' ' FROM x
UNION ALL SELECT 'Empty_' || doc_id, '  ' FROM d
UNION ALL SELECT 'MR_' || name || '_' || doc_id, '#REDIRECT [[M_' || doc_id || '#' || name || ']] ' FROM redirs
UNION ALL SELECT title || '#Later', ' later ' FROM titles"""

# A line without a text is no section line (its last field goes with the trailing separator).
LINES_SECTION_REDIRECTS = f"""SELECT r.key, r.page, r.section, r.redirect FROM ({SECTION_REDIRECTS}) r
JOIN ({REDIRECTED_SECTIONS}) s ON s.key = r.key WHERE s.text <> ''"""


def oracle_sql() -> dict[str, str]:
    return {
        "redirected_sections": REDIRECTED_SECTIONS,
        "section_redirects": SECTION_REDIRECTS,
        "section_stats": SECTION_STATS,
        "redirs_count_hist": REDIRS_COUNT_HIST,
        "redirs_hist_30": weighted_hist(30),
        "redirs_hist_100": weighted_hist(100),
        "section_stats_by_lang": SECTION_STATS_BY_LANG,
        "redirs_count_hist_by_lang": REDIRS_COUNT_HIST_BY_LANG,
        "word_count": WORD_COUNT,
        "search_tfidf": SEARCH_TFIDF,
        "search_tfidf_page2": SEARCH_TFIDF_PAGE2,
        "search_boolean": SEARCH_BOOLEAN,
        "search_bm25": SEARCH_BM25,
        "search_phrase": SEARCH_PHRASE,
        "search_prefix": SEARCH_PREFIX,
        "search_fuzzy": SEARCH_FUZZY,
        "staged_sections": STAGED_SECTIONS,
        "staged_redirected": STAGED_REDIRECTED,
        "link_inversion": LINK_INVERSION,
        "prototype_search": PROTOTYPE_SEARCH,
        "stem_vocabulary": STEM_VOCABULARY,
        "normalized_titles": NORMALIZED_TITLES,
        "markup_sections": MARKUP_SECTIONS,
        "search_phrase_ranked": SEARCH_PHRASE_RANKED,
        "search_mixed": SEARCH_MIXED,
        "search_must_not": SEARCH_MUST_NOT,
        "search_tfidf_bounded": SEARCH_TFIDF,
        "search_next_page": SEARCH_NEXT_PAGE,
        "lines_count_files": LINES_COUNT_FILES,
        "search_segments": SEARCH_BM25,
        "search_fields": SEARCH_FIELDS,
        "search_wildcard": SEARCH_WILDCARD,
        "search_infix": SEARCH_INFIX,
        "search_range": SEARCH_RANGE,
        "search_grouped": SEARCH_GROUPED,
        "search_near": SEARCH_NEAR,
        "search_hits": SEARCH_HITS,
        "search_after_append": SEARCH_AFTER_APPEND,
        "dead_letters": DEAD_LETTERS,
        "dump_file_sections": REDIRECTED_SECTIONS,
        "dump_file_counts": DUMP_FILE_COUNTS,
        "lines_section_stats": SECTION_STATS_BY_LANG,
        "lines_count_hist": REDIRS_COUNT_HIST,
        "lines_staged_sections": STAGED_SECTIONS,
        "lines_staged_redirected": STAGED_REDIRECTED,
        "lines_section_redirects": LINES_SECTION_REDIRECTS,
        "lines_keyed_texts": LINES_KEYED_TEXTS,
    }
