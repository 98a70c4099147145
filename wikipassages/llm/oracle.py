"""DuckDB twins of the operators' queries, where SQL can express them.

The others (byte-pair encoding, mined url rules, learned scores, packing and
file formats) are tested against brute force, round trips or held-out labels.
"""

from __future__ import annotations

from wikipassages.llm.quality import RULES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Smallest id reachable over the table links(a, b) from every row of nodes(id).
_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, origin) AS (SELECT id, id FROM nodes UNION SELECT l.b, r.origin FROM reach r JOIN both_ways l ON l.a = r.id),
components AS (SELECT id, min(origin) AS component_id FROM reach GROUP BY id)"""

OP3 = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
nodes AS (SELECT DISTINCT id FROM v),
links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id < y.id AND list_cosine_similarity(x.e, y.e) >= 0.9),
{_COMPONENTS},
degrees AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM v JOIN components USING (id) LEFT JOIN degrees USING (id)"""

OP6 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS i FROM windows JOIN firsts USING (k) WHERE f < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
         FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w) ANTI JOIN gone USING (doc_id, i)
         GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

OP7 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS k
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS i FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * c >= 80 * (s.n + t.n - c)),
nodes AS (SELECT DISTINCT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

_GRID = ", ".join(f"('{rule}', {j}, {cutoff!r})" for rule, (_, cutoffs) in RULES.items() for j, cutoff in enumerate(cutoffs, 1))
_VALUES = ", ".join(f"('{rule}', coalesce({' / '.join(f'nullif({x}, 0)::DOUBLE' if k else f'{x}::DOUBLE' for k, x in enumerate(expr.split(' / ')))}, 0))"
                    for rule, (expr, _) in RULES.items())

OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
trigrams AS (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS k
             FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
twice AS (SELECT DISTINCT doc_id, i + unnest(range(0, 3)) AS i
          FROM trigrams JOIN (SELECT doc_id, k FROM trigrams GROUP BY doc_id, k HAVING count(*) > 1) USING (doc_id, k)),
repeats AS (SELECT doc_id, count(*) AS n FROM twice GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, stratum, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_bangs, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
             coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
f AS (SELECT *, coalesce(chars, 0) AS word_chars FROM c),
grid(rule, j, cutoff) AS (VALUES {_GRID}),
vals AS (SELECT doc_id, stratum, v.rule, v.value FROM f, LATERAL (VALUES {_VALUES}) v(rule, value)),
good AS (SELECT doc_id FROM labels WHERE quality = 1),
n_good AS (SELECT stratum, count(*) AS n FROM f JOIN good USING (doc_id) GROUP BY stratum),
rejected AS (SELECT n_good.stratum, grid.rule, j, cutoff, n,
                    (SELECT count(*) FROM vals JOIN good USING (doc_id)
                     WHERE vals.stratum = n_good.stratum AND vals.rule = grid.rule AND value > cutoff) AS k
             FROM n_good, grid),
tails AS (SELECT stratum, rule, j, cutoff,
                 (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(0.01 / {len(RULES)}) + (n - i) * ln(1 - 0.01 / {len(RULES)})))
                  FROM (SELECT unnest(range(0, k + 1)) AS i)) AS tail,
                 0.05 / ({len(RULES)} * (SELECT count(*) FROM n_good)) AS level
          FROM rejected WHERE k < n
          UNION ALL SELECT stratum, rule, j, cutoff, 1.0, 0.0 FROM rejected WHERE k >= n),
failing AS (SELECT stratum, rule, coalesce(min(j) FILTER (tail > level), 1000) AS stop FROM tails GROUP BY ALL),
cutoffs AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM tails JOIN failing USING (stratum, rule) WHERE j < stop GROUP BY ALL),
broken AS (SELECT DISTINCT doc_id FROM vals JOIN cutoffs USING (stratum, rule) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM f"""

OP12 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS words FROM documents),
firsts AS (SELECT t, min(doc_id) AS f FROM d GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
    SELECT part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
                 + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
                 + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > f, false)::INT AS m,
           coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM d JOIN firsts USING (t) LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT [a, b, c, d, e] AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT array_to_string(list_transform(o, lambda x: x.l), '') AS filter_order, step, o[step].bit AS bit,
                 coalesce(list_sum(list_transform(o[1:step - 1], lambda x: x.bit)), 0)::INT AS before
          FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
counts AS (
    SELECT part, filter_order, step, bit, sum(n) FILTER (m & (before | bit) = 0) AS kept,
           sum(n) FILTER (m & bit > 0 AND m & before = 0) AS removed, sum(n) FILTER (m & bit > 0 AND m & before > 0) AS redundant,
           sum(n) FILTER (m = bit) AS unique_fails, sum(n) FILTER (m & bit > 0 AND m & before = 0 AND good) AS good_lost,
           sum(n) FILTER (m & bit > 0 AND m & before = 0 AND toxic) AS toxic_lost
    FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM counts"""

#: CRC-32 of each distinct feature, byte by byte with the table of the reflected polynomial.
OP13 = r"""
WITH crc_table AS (
    SELECT list(c ORDER BY i) AS tbl
    FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c
          FROM (SELECT unnest(range(256)) AS i))),
texts AS (SELECT 'raw' AS side, doc_id AS id, row_number() OVER () AS r, text FROM documents
          UNION ALL SELECT 'target', item_id, row_number() OVER (), text FROM benchmark),
w AS (SELECT side, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
features AS (SELECT side, r, unnest(words) AS f FROM w
             UNION ALL SELECT side, r, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM w),
counted AS (SELECT side, r, f, count(*) AS n FROM features GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
crcs AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h), 2), lambda i: ('0x' || h[i + 1:i + 2])::BIGINT)),
                                   lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
         FROM hexed, crc_table),
placed AS (SELECT side, r, bucket, sum(n) AS n FROM counted JOIN crcs USING (f) GROUP BY ALL),
b AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'raw'), 0) AS s, coalesce(sum(n) FILTER (side = 'target'), 0) AS t FROM placed GROUP BY bucket),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM b),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
          FROM b, sums),
totals AS (SELECT r, sum(n * gain) AS total, sum(n) AS n FROM placed JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY r),
scored AS (
    SELECT id AS doc_id, len(words) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
           ('0x' || sha256('7:' || coalesce(id::VARCHAR, ''))[1:8])::BIGINT AS h
    FROM w LEFT JOIN totals USING (r) WHERE side = 'raw'),
final AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM final)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= (SELECT 25 * count(*) // 100 FROM final WHERE n_words >= 20) THEN place END AS rank
FROM ranked"""

ORACLE: dict[str, str] = {
    "op3_embedding_copies": OP3,
    "op4_quality_rules": OP4,
    "op6_passages": OP6,
    "op7_near_copies": OP7,
    "op12_filter_audit": OP12,
    "op13_importance_resampling": OP13,
}
