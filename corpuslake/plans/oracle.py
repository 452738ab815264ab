"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

TAG = r"""CASE WHEN regexp_matches(word, '^\p{Lu}') THEN 'NNP'
  WHEN word LIKE '%,' OR word LIKE '%.' THEN 'NN'
  WHEN regexp_matches(word, '[0-9]') THEN 'CD'
  WHEN word LIKE '%tion' THEN 'NNS'
  WHEN word LIKE '%ing' THEN 'VBG' ELSE 'JJ' END"""

WORD_CLASS = """CASE tag WHEN 'NN' THEN 'N' WHEN 'NNS' THEN 'N' WHEN 'CD' THEN 'C' WHEN 'VBG' THEN 'V'
  WHEN 'JJ' THEN 'A' ELSE 'X' END"""

FEATS = r"""CASE WHEN length(word) = 1 THEN '_' ELSE
  'Len=' || CASE WHEN length(word) <= 3 THEN 'S' WHEN length(word) <= 7 THEN 'M' ELSE 'L' END
  || '|Cap=' || CASE WHEN regexp_matches(word, '^\p{Lu}') THEN 'Yes' ELSE 'No' END
  || CASE WHEN word LIKE '%tion' THEN '||Suf=tion|Cap='
       || CASE WHEN regexp_matches(word, '^\p{Lu}') THEN 'Yes' ELSE 'No' END ELSE '' END END"""

# One row per paragraph of a document, and one per token.
TOKENS = """paras AS (
  SELECT coalesce(lang, '') AS corpus_id, doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS num
  FROM documents),
pieces AS (
  SELECT corpus_id, doc_id, source, num, unnest(string_split(line, ' ')) AS word,
         generate_subscripts(string_split(line, ' '), 1) AS spot
  FROM paras),
toks AS (SELECT * FROM pieces WHERE word <> '')"""

TAGGED = TOKENS + f""",
tagged AS (SELECT *, lower(word) AS lemma, {TAG} AS tag, {FEATS} AS feats FROM toks)"""

CONV_TOKENS = """paras AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS num
  FROM conversations),
pieces AS (
  SELECT conv_id, turn, num, unnest(string_split(line, ' ')) AS word,
         generate_subscripts(string_split(line, ' '), 1) AS spot
  FROM paras),
toks AS (SELECT *, lower(word) AS lemma FROM pieces WHERE word <> '')"""

MULTI = TAGGED + f""",
classed AS (SELECT *, {WORD_CLASS} AS wclass FROM tagged),
grams AS (
  SELECT corpus_id,
         word || ' ' || lead(word) OVER w AS col0,
         lemma || ' ' || lead(lemma) OVER w AS col1,
         wclass || ' ' || lead(wclass) OVER w AS col2
  FROM classed WINDOW w AS (PARTITION BY doc_id, num ORDER BY spot)),
counts AS (SELECT corpus_id, col0, col1, col2, count(*) AS "count" FROM grams WHERE col0 IS NOT NULL
  GROUP BY corpus_id, col0, col1, col2)"""

DAY = "strftime(DATE '2020-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d')"

UNITS = TOKENS + f""",
sized AS (SELECT doc_id, num, count(*) AS n FROM toks GROUP BY doc_id, num),
units AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(corpus_id, '') AS doc_lang, nullif(source, '') AS doc_source, {DAY} AS doc_date,
         CAST(num AS VARCHAR) AS p_num, CAST(NULL AS VARCHAR) AS p_style, coalesce(n, 0) AS poscount,
         CAST(0 AS BIGINT) AS wordcount, corpus_id
  FROM paras LEFT JOIN sized USING (doc_id, num))"""

BLOCKS = """raws AS (SELECT feats AS raw, unnest(string_split(feats, '||')) AS body,
    generate_subscripts(string_split(feats, '||'), 1) - 1 AS block
  FROM (SELECT DISTINCT feats FROM tagged) WHERE feats <> '_'),
items AS (SELECT raw, block, unnest(string_split(body, '|')) AS item FROM raws),
sets AS (
  SELECT raw, block, string_agg(item, '|' ORDER BY split_part(item, '=', 1)) AS feats_key
  FROM items GROUP BY raw, block)"""

COMBOS = TAGGED + ", " + BLOCKS + """,
combos AS (
  SELECT lemma, tag, feats_key, count(*) AS cnt
  FROM tagged JOIN sets ON tagged.feats = sets.raw GROUP BY lemma, tag, feats_key)"""

VALID = r"""NOT regexp_matches(lemma, '^[a-zA-Z0-9]+=[a-zA-Z0-9]+(\|[a-zA-Z0-9]+=[a-zA-Z0-9]+)*$')
  AND NOT regexp_matches(lemma, '[0-9]')"""

VALID_STRICT = r"""NOT regexp_matches(lemma, '^[a-zA-Z0-9]+=[a-zA-Z0-9]+(\|[a-zA-Z0-9]+=[a-zA-Z0-9]+)*$')
  AND NOT regexp_matches(lemma, '^([-+])?[0-9]+(/[0-9]*)?$')"""

LIVE = COMBOS + f""",
live AS MATERIALIZED (
  SELECT *, sha256(length(lemma) || ':' || lemma || length(tag) || ':' || tag
    || length(feats_key) || ':' || feats_key) AS token_id
  FROM combos WHERE {VALID}),
udfeats AS MATERIALIZED (
  SELECT token_id, split_part(item, '=', 1) AS feat, split_part(item, '=', 2) AS value
  FROM (SELECT token_id, unnest(string_split(feats_key, '|')) AS item FROM live))"""

ITEM_TURNS = "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn_num"

ORACLE_SQL: dict[str, str] = {
    "unigram_counts": f"""WITH {TOKENS}
SELECT corpus_id, lower(word) AS col0, sha1(lower(word)) AS hash_id, count(*) AS "count"
FROM toks GROUP BY corpus_id, lower(word)""",
    "bigram_arf": f"""WITH {TOKENS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY corpus_id ORDER BY doc_id, num, spot) - 1 AS idx,
         lag(word) OVER (PARTITION BY doc_id, num ORDER BY spot) AS earlier
  FROM toks),
sizes AS (SELECT corpus_id, count(*) AS n FROM toks GROUP BY corpus_id),
grams AS (SELECT corpus_id, earlier || ' ' || word AS col0, idx FROM placed WHERE earlier IS NOT NULL),
gaps AS (
  SELECT corpus_id, col0, count(*) OVER g AS f, n,
         coalesce(idx - lag(idx) OVER o, min(idx) OVER g + n - max(idx) OVER g) AS d
  FROM grams JOIN sizes USING (corpus_id)
  WINDOW g AS (PARTITION BY corpus_id, col0), o AS (PARTITION BY corpus_id, col0 ORDER BY idx)),
sums AS (
  SELECT corpus_id, col0, count(*) AS f, any_value(n) AS n,
         CAST(coalesce(sum(d) FILTER (WHERE d * f < n), 0) AS DOUBLE) AS near,
         count(*) FILTER (WHERE d * f >= n) AS far
  FROM gaps GROUP BY corpus_id, col0)
SELECT CASE WHEN strlen(col0) <= 127 THEN col0 END AS col0, sha1(col0) AS hash_id, corpus_id, f AS "count",
       floor((far + near * f / n) * 1000 + 0.5) / 1000.0 AS arf,
       regexp_matches(col0, '^\\p{{Lu}}') AS initial_cap, CAST(2 AS INTEGER) AS ngram_size
FROM sums""",
    "trigram_counts": f"""WITH {CONV_TOKENS},
grams AS (
  SELECT lag(lemma, 2) OVER w || ' ' || lag(lemma) OVER w || ' ' || lemma AS col0
  FROM toks WINDOW w AS (PARTITION BY conv_id, turn, num ORDER BY spot))
SELECT 'conversations' AS corpus_id, col0, count(*) AS "count" FROM grams WHERE col0 IS NOT NULL GROUP BY col0""",
    "ngram_ipm": f"""WITH {TOKENS}, sizes AS (SELECT corpus_id, count(*) AS n FROM toks GROUP BY corpus_id)
SELECT corpus_id, lower(word) AS col0, count(*) AS "count", count(*) * 1e6::DOUBLE / any_value(n) AS ipm
FROM toks JOIN sizes USING (corpus_id) GROUP BY corpus_id, lower(word)""",
    "ngram_multi_column": f"""WITH {MULTI}
SELECT CASE WHEN strlen(col0) <= 127 THEN col0 END AS col0, CASE WHEN strlen(col1) <= 127 THEN col1 END AS col1,
       CASE WHEN strlen(col2) <= 127 THEN col2 END AS col2, sha1(col0 || col1 || col2) AS hash_id, corpus_id,
       "count", CAST(-1 AS DOUBLE) AS arf, regexp_matches(col1, '^\\p{{Lu}}') AS initial_cap,
       CAST(2 AS INTEGER) AS ngram_size
FROM counts""",
    "ngram_columns_fold": f"""WITH {MULTI}
SELECT corpus_id, '0:' || col0 || ';1:' || col1 || ';2:' || col2 || ';' AS texts,
       CAST((col1 <> col0)::INTEGER + (col2 <> col0)::INTEGER AS INTEGER) AS differing, "count" FROM counts""",
    "ngram_columns_long": f"""WITH {MULTI},
long AS (
  SELECT corpus_id, "count", CAST(0 AS INTEGER) AS col_idx, col0 AS text FROM counts
  UNION ALL SELECT corpus_id, "count", 1, col1 FROM counts
  UNION ALL SELECT corpus_id, "count", 2, col2 FROM counts)
SELECT corpus_id, col_idx, text, CAST(sum("count") AS BIGINT) AS "count" FROM long
GROUP BY corpus_id, col_idx, text""",
    "modifier_chain": f"""WITH {TOKENS}, words AS (SELECT DISTINCT word, {TAG} AS tag FROM toks)
SELECT word, lower(word) AS lowered, substr(word, 1, 1) AS first, substr(lower(word), 1, 1) AS first_lowered,
       substr(word, 1, 1) AS cs_2020, substr(word, 1, 1) AS cs_2000, substr(word, 1, 1) AS cs_spk, word AS same,
       {WORD_CLASS} AS word_class, lower({WORD_CLASS}) AS word_class_lowered
FROM words""",
    "long_ngram_null": f"""WITH {CONV_TOKENS},
grams AS (
  SELECT string_agg(lemma, ' ') OVER w AS col0, count(*) OVER w AS k
  FROM toks WINDOW w AS (PARTITION BY conv_id, turn, num ORDER BY spot ROWS BETWEEN 17 PRECEDING AND CURRENT ROW)),
counts AS (SELECT col0, count(*) AS n FROM grams WHERE k = 18 GROUP BY col0)
SELECT CASE WHEN strlen(col0) <= 127 THEN col0 END AS col0, sha1(col0) AS hash_id, 'conversations' AS corpus_id,
       n AS "count", CAST(-1 AS DOUBLE) AS arf, regexp_matches(col0, '^\\p{{Lu}}') AS initial_cap,
       CAST(18 AS INTEGER) AS ngram_size
FROM counts""",
    "distinct_values_sorted": f"WITH {TAGGED} SELECT DISTINCT tag FROM tagged ORDER BY tag",
    "corpus_stats": f"""WITH {TAGGED}
SELECT corpus_id, count(*) AS tokens, count(DISTINCT lemma) AS lemmas, count(DISTINCT tag) AS tags
FROM tagged GROUP BY corpus_id""",
    "vertical_lines_parse": f"""WITH {TAGGED}
SELECT corpus_id, word, lemma, tag, feats, count(*) AS n FROM tagged GROUP BY corpus_id, word, lemma, tag, feats""",
    "liveattrs_atoms": f"WITH {UNITS} SELECT * FROM units",
    "bibliography": f"WITH {UNITS} SELECT doc_id AS id, doc_source, doc_date FROM units",
    "liveattrs_parent_rows": f"""WITH {CONV_TOKENS},
sized AS (SELECT conv_id, turn, count(*) AS n FROM toks GROUP BY conv_id, turn),
turns AS (
  SELECT conv_id, turn, role, coalesce(n, 0) AS n,
         sum(coalesce(n, 0)) OVER (ORDER BY conv_id, turn) AS upto
  FROM conversations LEFT JOIN sized USING (conv_id, turn)),
opened AS (
  SELECT *, coalesce(max(CASE WHEN role <> 'system' THEN upto - n END) OVER (ORDER BY conv_id, turn), 0) AS since
  FROM turns)
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CASE WHEN role = 'system' THEN 'system' ELSE 'dialogue' END AS conv_kind,
       CASE WHEN role <> 'system' THEN CAST(turn AS VARCHAR) END AS turn_num,
       CASE WHEN role <> 'system' THEN role END AS turn_role,
       CAST(upto - since AS BIGINT) AS poscount, CAST(0 AS BIGINT) AS wordcount, 'conversations' AS corpus_id
FROM opened""",
    "liveattrs_nested": f"""WITH {UNITS}
SELECT doc_id, corpus_id AS div_kind, '1' AS div_part, p_num, poscount, wordcount, corpus_id FROM units""",
    "structure_errors": f"""WITH {TOKENS},
sized AS (SELECT doc_id, num, count(*) AS n FROM toks GROUP BY doc_id, num),
shaped AS (
  SELECT paras.*, coalesce(n, 0) AS n, CAST(regexp_matches(line, '[0-9]') AS INTEGER) AS digit,
         CAST(line LIKE '%.' AS INTEGER) AS stop
  FROM paras LEFT JOIN sized USING (doc_id, num)),
seqd AS (
  SELECT *, 1 + coalesce(sum(1 + n + digit + stop) OVER (PARTITION BY doc_id ORDER BY num
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opens,
         lag(stop) OVER (PARTITION BY corpus_id ORDER BY doc_id, num) AS earlier_stop
  FROM shaped),
wide AS (
  SELECT corpus_id, doc_id, num, row_number() OVER (PARTITION BY doc_id, num ORDER BY spot) AS k,
         CASE WHEN regexp_matches(word, '[0-9]') THEN 3 ELSE 2 END AS width,
         first_value(CASE WHEN regexp_matches(word, '[0-9]') THEN 3 ELSE 2 END)
           OVER (PARTITION BY corpus_id ORDER BY doc_id, num, spot) AS expected
  FROM toks)
SELECT corpus_id, doc_id, CAST(opens AS INTEGER) AS line, 'open of <p> while still open: <p>' AS message
FROM seqd WHERE earlier_stop = 0
UNION ALL
SELECT corpus_id, doc_id, CAST(opens + n + 1 AS INTEGER), 'close of q, which is not open'
FROM seqd WHERE digit = 1
UNION ALL
SELECT wide.corpus_id, wide.doc_id, CAST(opens + k AS INTEGER),
       'expected columns: ' || expected || ', found: ' || width
FROM wide JOIN seqd ON wide.doc_id = seqd.doc_id AND wide.num = seqd.num WHERE width <> expected""",
    "segment_ngrams": f"""WITH {TOKENS},
ended AS (
  SELECT doc_id, num, coalesce(sum(CAST(line LIKE '%.' AS INTEGER)) OVER (PARTITION BY corpus_id ORDER BY doc_id, num
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment
  FROM paras),
grams AS (
  SELECT corpus_id, lag(word) OVER (PARTITION BY corpus_id, segment ORDER BY doc_id, num, spot) || ' ' || word AS col0
  FROM toks JOIN ended USING (doc_id, num))
SELECT corpus_id, col0, count(*) AS "count" FROM grams WHERE col0 IS NOT NULL GROUP BY corpus_id, col0""",
    "subcorpus_filter": f"""WITH {TOKENS},
accepted AS (
  SELECT *, lower(word) AS lemma FROM toks WHERE source NOT IN ('src0', 'src1') AND NOT regexp_matches(word, '[0-9]')),
grams AS (
  SELECT corpus_id, lag(lemma, 2) OVER w || ' ' || lag(lemma) OVER w || ' ' || lemma AS col0
  FROM accepted WINDOW w AS (PARTITION BY doc_id, num ORDER BY spot))
SELECT corpus_id, col0, count(*) AS "count" FROM grams WHERE col0 IS NOT NULL GROUP BY corpus_id, col0""",
    "item_id_identity": f"""{ITEM_TURNS}, role,
  CASE WHEN role <> 'system' THEN conv_id || '_' || turn || '_' || role END AS item_id FROM conversations""",
    "item_id_intercorp": f"{ITEM_TURNS}, substr(role || conv_id, 3) AS item_id FROM conversations",
    "item_id_empty": f"{ITEM_TURNS}, CAST(NULL AS VARCHAR) AS item_id FROM conversations",
    "aligned_join": f"""WITH {CONV_TOKENS},
sized AS (SELECT conv_id, turn, count(*) AS n FROM toks GROUP BY conv_id, turn),
turns AS (
  SELECT conv_id, turn, role, CAST(coalesce(n, 0) AS INTEGER) AS n FROM conversations LEFT JOIN sized USING (conv_id, turn))
SELECT a.conv_id || '_' || (a.turn // 2) AS item_id, a.role AS corpus_id_a, a.turn AS turn_num_a, a.n AS poscount_a,
       b.role AS corpus_id_b, b.turn AS turn_num_b, b.n AS poscount_b
FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND a.turn // 2 = b.turn // 2 AND a.role < b.role""",
    "moving_window": f"""WITH dated AS (
  SELECT coalesce(lang, '') AS corpus_id, doc_id, CASE WHEN lang = 'fr' THEN source ELSE {DAY} END AS doc_date FROM documents)
SELECT * FROM dated WHERE coalesce(try_strptime(doc_date, '%Y-%m-%d') >= TIMESTAMP '2020-03-15', true)""",
    "ud_feats_parse": f"""WITH {TAGGED}, {BLOCKS}
SELECT feats AS raw, CAST(coalesce(block, -1) AS INTEGER) AS block, feats_key
FROM (SELECT DISTINCT feats FROM tagged) LEFT JOIN sets ON feats = raw""",
    "livetokens_counts": f"WITH {COMBOS} SELECT * FROM combos",
    "livetokens_valid": f"WITH {COMBOS} SELECT *, {VALID} AS valid, {VALID_STRICT} AS valid_strict FROM combos",
    "livetokens_feats": f"WITH {LIVE} SELECT * FROM udfeats",
    "search_tokens": f"""WITH {COMBOS}
SELECT lemma, tag, cnt, feats_key AS udfeats FROM combos
WHERE {VALID} AND tag = 'NNS' AND regexp_matches(feats_key, '(^|\\|)Cap=No(\\||$)')
  AND regexp_matches(feats_key, '(^|\\|)Len=[ML](\\||$)')""",
    "search_total": f"""WITH {LIVE}
SELECT count(*) AS total FROM live t
WHERE tag IN ('NNP', 'VBG')
  AND t.token_id IN (SELECT token_id FROM udfeats WHERE feat = 'Len' AND value = 'L')""",
    "facet_attr_values": f"""WITH {LIVE},
kept AS (
  SELECT * FROM live t WHERE tag IN ('NNS', 'VBG')
  AND t.token_id IN (SELECT token_id FROM udfeats WHERE feat = 'Len' AND value IN ('M', 'L'))
  AND t.token_id IN (SELECT token_id FROM udfeats WHERE feat = 'Cap' AND value = 'No'))
SELECT DISTINCT 'lemma' AS name, lemma AS value FROM kept
UNION ALL SELECT DISTINCT 'tag', tag FROM kept""",
    "facet_feat_values": f"""WITH {LIVE}
SELECT DISTINCT f.feat, f.value FROM live t JOIN udfeats f USING (token_id)
WHERE tag IN ('NNS', 'NNP')
  AND t.token_id IN (SELECT token_id FROM udfeats WHERE feat = 'Cap' AND value IN ('Yes', 'No'))""",
    "facet_counts": f"""WITH {LIVE},
kept AS (
  SELECT * FROM live t WHERE tag IN ('NNS', 'VBG')
  AND t.token_id IN (SELECT token_id FROM udfeats WHERE feat = 'Len' AND value IN ('M', 'L')))
SELECT 'attr' AS kind, 'lemma' AS name, lemma AS value, count(*) AS n FROM kept GROUP BY lemma
UNION ALL SELECT 'attr', 'tag', tag, count(*) FROM kept GROUP BY tag
UNION ALL SELECT 'feat', feat, value, count(DISTINCT token_id) FROM udfeats
  WHERE token_id IN (SELECT token_id FROM kept) GROUP BY feat, value""",
    "search_token_tables": f"""WITH {COMBOS}
SELECT lemma, tag, cnt, feats_key AS udfeats FROM combos
WHERE {VALID} AND tag IN ('NNP', 'VBG') AND regexp_matches(feats_key, '(^|\\|)Len=L(\\||$)')""",
    "token_ids": f"""WITH {COMBOS}
SELECT row_number() OVER (ORDER BY lemma, tag, feats_key) - 1 AS id, lemma, tag, feats_key, cnt FROM combos WHERE {VALID}""",
    "search_feats_map": f"""WITH {COMBOS}
SELECT lemma, cnt, feats_key AS feats, CASE WHEN regexp_matches(feats_key, '(^|\\|)Suf=') THEN 'tion' END AS suffix
FROM combos WHERE {VALID} AND regexp_matches(feats_key, '(^|\\|)Cap=Yes(\\||$)')""",
    "available_values": f"""WITH {LIVE},
kept AS (
  SELECT * FROM live t WHERE tag IN ('NNS', 'VBG')
  AND t.token_id IN (SELECT token_id FROM udfeats WHERE feat = 'Len' AND value IN ('M', 'L')))
SELECT DISTINCT 'attr' AS kind, 'lemma' AS name, lemma AS value FROM kept
UNION ALL SELECT DISTINCT 'attr', 'tag', tag FROM kept
UNION ALL SELECT DISTINCT 'feat', feat, value FROM udfeats WHERE token_id IN (SELECT token_id FROM kept)""",
    "liveattrs_selfclosing": f"""WITH {UNITS}
SELECT units.doc_id, CASE WHEN num % 2 = 0 THEN CAST(num - 1 AS VARCHAR) END AS q_part, p_num, poscount, wordcount, units.corpus_id
FROM units JOIN (SELECT CAST(doc_id AS VARCHAR) AS doc_id, num, line FROM paras) AS p
  ON units.doc_id = p.doc_id AND p_num = CAST(num AS VARCHAR) WHERE line LIKE '%.'""",
    "sink_units_all": f"""WITH {UNITS}, docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, {DAY} AS day FROM documents)
SELECT doc_id, doc_date, poscount, wordcount, corpus_id FROM (
  SELECT units.doc_id, day AS doc_date, CAST(sum(poscount) AS BIGINT) AS poscount, CAST(0 AS BIGINT) AS wordcount, corpus_id
  FROM units JOIN docs ON units.doc_id = docs.id GROUP BY units.doc_id, day, corpus_id)
WHERE corpus_id = (SELECT max(corpus_id) FROM units) OR doc_date >= '2020-06-01'""",
    "sink_frequencies_all": f"""WITH {TOKENS}
SELECT CASE WHEN strlen(word) <= 127 THEN word END AS col0, sha1(word) AS hash_id, count(*) AS "count",
       CAST(-1 AS DOUBLE) AS arf, false AS initial_cap, corpus_id, CAST('1' AS VARCHAR) AS ngram_size
FROM toks GROUP BY corpus_id, word""",
    "sink_livetokens": f"""WITH {LIVE} SELECT lemma, tag, cnt, feats_key AS udfeats FROM live""",
}
ORACLE_SQL["sink_search_index"] = ORACLE_SQL["sink_livetokens"]
ORACLE_SQL["liveattrs_nested_errors"] = ORACLE_SQL["liveattrs_nested"]
ORACLE_SQL["nested_structure_errors"] = f"""WITH {TOKENS},
sized AS (SELECT doc_id, num, count(*) AS n FROM toks GROUP BY doc_id, num),
shaped AS (
  SELECT paras.*, coalesce(n, 0) AS n, CAST(regexp_matches(line, '[0-9]') AS INTEGER) AS digit
  FROM paras LEFT JOIN sized USING (doc_id, num)),
seqd AS (
  SELECT *, 3 + coalesce(sum(2 + n + digit) OVER (PARTITION BY doc_id ORDER BY num
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opens FROM shaped)
SELECT corpus_id, doc_id, CAST(opens + n + 1 AS INTEGER) AS line,
       'close of div does not fit the innermost open element: <p>' AS message
FROM seqd WHERE digit = 1"""
ORACLE_SQL["nested_far_errors"] = """WITH walked AS (
  SELECT coalesce(lang, '') AS corpus_id, doc_id, sum(CASE WHEN doc_id % 2 <> 0 THEN 1 ELSE -1 END) OVER w AS depth
  FROM documents WINDOW w AS (PARTITION BY coalesce(lang, '') ORDER BY doc_id))
SELECT corpus_id, doc_id, 'close of doc does not fit the innermost open element: none' AS message
FROM (SELECT *, least(0, min(depth) OVER (PARTITION BY corpus_id ORDER BY doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS lowest FROM walked)
WHERE depth < coalesce(lowest, 0)"""
ORACLE_SQL["error_budgets"] = f"""WITH found AS (SELECT count(*) AS n FROM ({ORACLE_SQL["nested_structure_errors"]}))
SELECT n AS budget, n AS errors, false AS stopped FROM found
UNION ALL SELECT n - 1, n, true FROM found"""
ORACLE_SQL["sink_units"], ORACLE_SQL["sink_frequencies"] = ORACLE_SQL["sink_units_all"], ORACLE_SQL["sink_frequencies_all"]
ORACLE_SQL["vertical_files_scan"] = ORACLE_SQL["vertical_charsets_scan"] = ORACLE_SQL["vertical_lines_parse"]
ORACLE_SQL["bigram_arf_hot"] = ORACLE_SQL["bigram_arf_append"] = ORACLE_SQL["bigram_arf"]
ORACLE_SQL["ngram_ipm_many"] = ORACLE_SQL["ngram_ipm"]
