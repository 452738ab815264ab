"""DuckDB counterparts of the registered queries that SQL can express."""

from __future__ import annotations

from corpuslake.llm import secrets
from corpuslake.llm.quality import LineRules

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x20\x09-\x0D]+"


def line_dedup_sql(docs: str, min_chars: int = 20, min_docs: int = 3) -> str:
    """CTEs ending in ``kept`` (doc_id, n_lines, n_dropped, text); ``docs`` names a relation with doc_id and text."""
    return f"""
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM {docs}),
k AS (SELECT *, translate(trim(line, {_BLANKS}), {_AZ}) AS key FROM l),
shared AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {min_chars}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
kept AS (SELECT k.doc_id, count(*) AS n_lines, count(shared.key) FILTER (shared.keeper <> k.doc_id) AS n_dropped,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (shared.key IS NULL OR shared.keeper = k.doc_id), '') AS text
         FROM k LEFT JOIN shared ON k.key = shared.key GROUP BY k.doc_id)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: int, pattern: str) -> str:
    p = _quoted(pattern)
    return f"""SELECT doc_id, {kind} AS kind, unnest(regexp_extract_all(t, {p})) AS m,
       unnest(range(len(regexp_extract_all(t, {p})))) AS i, string_split_regex(t, {p}) AS gaps,
       regexp_extract_all(t, {p}) AS found FROM d WHERE regexp_matches(t, {p})"""


def secret_spans_sql(docs: str, rules: secrets.EntropyRules = secrets.EntropyRules()) -> str:
    """CTEs ending in ``spans`` (doc_id, start, kind, stop)."""
    f = "[" + ", ".join(map(str, secrets.weights(rules.window))) + "]"
    allow = _quoted("|".join(f"({x})" for x in rules.allow))
    kinds = " UNION ALL ".join(
        f"({_matches(k, p)})"
        for k, p in enumerate((secrets.ASSIGN, secrets.ACCESS, secrets.HEX, rules.candidates()))
    )
    return f"""
d AS (SELECT doc_id, coalesce(text, '') AS t FROM {docs}),
m AS ({kinds}),
placed AS (SELECT doc_id, kind, m,
    (list_sum(list_transform(gaps[:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(found[:i], lambda x: length(x))), 0))::BIGINT
    AS start FROM m),
windows AS (SELECT DISTINCT m, unnest(list_transform(range(1, length(m) - {rules.window} + 2), lambda i: substr(m, i, {rules.window}))) AS w
            FROM placed WHERE kind = 3 AND NOT regexp_full_match(m, {allow})),
chars AS (SELECT w, c, count(*) AS n FROM (SELECT w, unnest(string_split(w, '')) AS c FROM (SELECT DISTINCT w FROM windows)) GROUP BY w, c),
sums AS (SELECT w, sum({f}[n + 1]) AS s FROM chars GROUP BY w),
hits AS (SELECT DISTINCT m FROM windows JOIN sums USING (w)
         WHERE s <= CASE WHEN regexp_full_match(w, '[0-9a-fA-F]+') THEN {rules.least(rules.hex_bits)} ELSE {rules.least(rules.base64_bits)} END),
spans AS (SELECT doc_id, kind, start, start + length(m) AS stop FROM placed
          WHERE CASE kind WHEN 0 THEN length(regexp_extract(m, {_quoted(secrets.ASSIGN)}, 2)) >= 6
                          WHEN 3 THEN m IN (SELECT m FROM hits) ELSE true END)"""


def _spans_list(where: str) -> str:
    names = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    return (
        f"coalesce(string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
        f" FILTER ({where}), '')"
    )


def _quality() -> str:
    r = LineRules()
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
b AS (SELECT doc_id, line, trim(line, {_BLANKS}) AS s, len(regexp_extract_all(line, '{_WORD}')) AS n FROM l),
v AS (SELECT *, CASE WHEN s = '' THEN false
    WHEN length(s) - length(regexp_replace(s, {_quoted(r.separators)}, '', 'g')) >= {r.max_separators} THEN true
    WHEN regexp_matches(translate(s, {_AZ}), {_quoted(r.boilerplate)}) THEN true
    WHEN length(s) - length(translate(s, '#*$%&|<>', '')) > {r.max_symbols}::DOUBLE * n THEN true
    ELSE n >= {r.min_words} AND NOT regexp_matches(s, {_quoted(r.end)}) END AS bad FROM b),
lines AS (SELECT doc_id, count(*) FILTER (s <> '') - count(DISTINCT line) FILTER (s <> '') AS dup,
                 coalesce(sum(n) FILTER (bad), 0) AS lost FROM v GROUP BY doc_id),
r AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, dup AS n_dup_lines,
             coalesce(repeats.n, 0) AS n_repeat_words, lost::BIGINT AS lost_words
      FROM d JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_words <= {r.max_lost}::DOUBLE * n_words AS kept FROM r"""


def vector_codes_sql(vectors: str, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """CTEs ending in ``last`` (vec_id, label, part, j, error) and ``book{rounds}`` (part, j, v)."""
    out = f"""
x AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS v FROM {vectors}
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS v
      FROM x, (SELECT unnest(range({parts})) AS part)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM x ORDER BY vec_id LIMIT {entries}),
book0 AS (SELECT part, j, v FROM p JOIN first USING (vec_id))"""
    for r in range(rounds + 1):
        name = "last" if r == rounds else f"own{r}"
        out += f""",
far{r} AS (SELECT p.vec_id, p.label, part, j, p.v AS v, list_sum(list_transform(range(1, len(p.v) + 1),
             lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS error FROM p JOIN book{r} b USING (part)),
{name} AS (SELECT * FROM far{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY error, j) = 1)"""
        if r < rounds:
            out += f""",
sums{r} AS (SELECT part, j, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM own{r}, (SELECT unnest(range(1, 4097)) AS i)
           WHERE i <= len(v) GROUP BY part, j, i),
book{r + 1} AS (SELECT part, j, coalesce(new.v, old.v) AS v FROM book{r} old LEFT JOIN
           (SELECT part, j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums{r} GROUP BY part, j) new USING (part, j))"""
    return out


def divergence_sql(docs: str, least: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50) -> str:
    def share(n, total):
        return f"(1 + ({scale}::HUGEINT * ({n} + {smoothing})) // ({total} + {smoothing} * v.terms))::BIGINT"

    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM {docs}),
w AS (SELECT doc_id, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), {_AZ}) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= {least}),
v AS (SELECT lang, count(kept.term) AS terms FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT d.lang, d.source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) d
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) s ON d.lang = s.lang AND d.source = s.source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, {share("coalesce(n, 0)", "total")} AS p
      FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (SELECT lang, term, {share("n", "total")} AS q FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term)
      JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY lang) USING (lang) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term)
                     GROUP BY x.lang, x.source, y.source) s
          ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
marked AS (SELECT p.lang, p.source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marked))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}"""


ORACLE_SQL: dict[str, str] = {
    "op3_secrets": f"""WITH {secret_spans_sql("documents")}
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
       count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_entropy,
       sha256({_spans_list("kind < 3")}) AS base_sha256, {_spans_list("kind IS NOT NULL")} AS spans
FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id GROUP BY d.doc_id""",
    "op4_line_dedup": f"""WITH {line_dedup_sql("documents")}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept""",
    "op6_quality_rules": _quality(),
    "op12_source_divergence": divergence_sql("documents"),
    "op13_vector_codes": f"""WITH {vector_codes_sql("embeddings")},
codes AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', j), '' ORDER BY part) AS code, sum(error)::BIGINT AS error
          FROM last GROUP BY vec_id),
labels_sum AS (SELECT label, sum(error)::BIGINT AS label_error FROM codes GROUP BY label),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, j)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM codes JOIN labels_sum ON codes.label IS NOT DISTINCT FROM labels_sum.label, books""",
}
