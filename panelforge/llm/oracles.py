"""DuckDB SQL for the training-data queries that SQL can express.

Whole tables, written from the results' definitions and not from the operators'
methods: windows and shingles are compared as text, components by closure."""

from __future__ import annotations

from panelforge.llm.quality import FENCES, G, LEAST

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRINGS = f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d) x),
least AS (SELECT k, min(doc_id) AS lo FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, pos FROM (
  SELECT doc_id, unnest(range(i, i + 50)) AS pos FROM win JOIN least USING (k) WHERE lo < doc_id) x),
places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

def _fence(metric: str, below: float | None, above: float, least: float) -> str:
    spread = f"greatest(q3 - q1, {least})"
    low = f" AND v >= q2 - {below} * {spread}" if below else ""
    return f"WHEN long.metric = '{metric}' THEN v <= q2 + {above} * {spread}{low}"


_CASE = " ".join(_fence(m, *f) for m, f in FENCES.items())
_QUANTILES = ", ".join(f"min(CASE WHEN c >= {q} * t THEN v END) AS {n}" for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)))


def _level(name: str, keys: str) -> str:
    by = f"{keys}, " if keys else ""
    part = f"{by}metric"
    return f"""{name}_bins AS (SELECT {by}metric, bin, count(*) AS n FROM binned GROUP BY {by}metric, bin),
{name} AS (SELECT {by}metric, max(t) AS total, {_QUANTILES} FROM (
  SELECT *, CASE WHEN bin IS NULL THEN 0.0 ELSE pow({G}, bin - 0.5) END AS v,
         sum(n) OVER (PARTITION BY {part} ORDER BY bin NULLS FIRST) AS c, sum(n) OVER (PARTITION BY {part}) AS t
  FROM {name}_bins) x GROUP BY {by}metric)"""


_PICK = ", ".join(
    f"CASE WHEN f.total >= {LEAST} THEN f.{q} WHEN l.total >= {LEAST} THEN l.{q} ELSE a.{q} END AS {q}" for q in ("q1", "q2", "q3")
)

QUALITY = f"""WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
tri AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d) x),
twice AS (SELECT doc_id, k FROM tri GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (
  SELECT doc_id, unnest(range(i, i + 3)) AS pos FROM tri JOIN twice USING (doc_id, k)) x GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS k FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) x
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
b AS (SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
       CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
       coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.k, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_symbols / nullif(word_chars, 0) AS symbol_share, n_dup_lines / nullif(n_lines, 0) AS dup_line_share,
       n_repeat_words / nullif(n_words, 0) AS repeat_share, word_chars / nullif(n_words, 0) AS word_length FROM b),
long AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS metric, {m} AS v FROM g WHERE NOT base_failed" for m in FENCES)}),
binned AS (SELECT lang, source, metric, CASE WHEN v > 0 THEN CAST(ceil(ln(v) / ln({G})) AS INTEGER) END AS bin FROM long WHERE v IS NOT NULL),
{_level("fine", "lang, source")},
{_level("by_lang", "lang")},
{_level("corpus", "")},
fences AS (SELECT f.lang, f.source, f.metric, {_PICK} FROM fine f
  JOIN by_lang l ON f.metric = l.metric AND f.lang IS NOT DISTINCT FROM l.lang JOIN corpus a ON f.metric = a.metric),
ok AS (SELECT doc_id, bool_and(CASE {_CASE} END) AS kept FROM long JOIN fences
  ON long.metric = fences.metric AND long.lang IS NOT DISTINCT FROM fences.lang AND long.source IS NOT DISTINCT FROM fences.source
  GROUP BY doc_id)
SELECT g.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(kept, false) AS kept
FROM g LEFT JOIN ok USING (doc_id)"""
JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS lo FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(lo, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id"""

NEIGHBOURS = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
    AND len([c FOR c IN embedding IF c <> 0]) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS lo FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(lo, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(lo, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id"""

TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER + r"'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""WITH t AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
all_docs AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, unnest({TERMS}) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, all_docs),
m AS (SELECT doc_id, 25 + (75 * n * n_docs) // n_terms AS m FROM d, all_docs),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
