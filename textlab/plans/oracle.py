"""Independent DuckDB SQL for every exactly reproducible query.

The SQL is written against the raw tables (``documents``, ``embeddings``,
...) with plain window functions and joins: it is the textbook definition
of each operator, against which the scalable Spark plans are checked.
Fixed values (stop words, contraction splits, whitespace class) are
shared with the Spark side so both use the same constants.
"""

from __future__ import annotations

from ..functions.text import (CLS_TOKEN, CONTRACTION_SPLITS, MIN_TOKEN_LENGTH, NON_LETTER_PATTERN, PAD_TOKEN,
                              SEP_TOKEN, STOP_WORDS_EN, URL_PATTERN, WINDOW_LENGTH, WS_RUN_PATTERN)


def _str_list(items) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + "]"


def normalize_sql(text: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(coalesce({text}, '')), '{URL_PATTERN}', '', 'g'), "
            f"'{NON_LETTER_PATTERN}', '', 'g')")


def ws_tokens_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{WS_RUN_PATTERN}'), lambda w: w <> '')"


def clean_tokens_sql(text: str) -> str:
    whole = _str_list(c[0] for c in CONTRACTION_SPLITS)
    stops = _str_list(sorted(set(STOP_WORDS_EN)))
    split = (f"flatten(list_transform({ws_tokens_sql(normalize_sql(text))}, lambda w: "
             f"CASE WHEN list_contains({whole}, w) THEN [substr(w, 1, 3), substr(w, 4)] ELSE [w] END))")
    return f"list_filter({split}, lambda w: length(w) >= {MIN_TOKEN_LENGTH} AND NOT list_contains({stops}, w))"


def ngrams_sql(tokens: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{tokens}[i + {j}]" for j in range(n))
    return f"list_transform(range(1, len({tokens}) - {n - 2}), lambda i: {parts})"


def key_sql(id_col: str, seed: int = 42) -> str:
    return f"md5(concat_ws(':', '{seed}', CAST({id_col} AS VARCHAR)))"


# Cleaned corpus and the exact stratified split, as CTEs.
CORPUS_CTE = f"""corpus AS (
  SELECT doc_id, lang AS label, {clean_tokens_sql('text')} AS tokens FROM documents
)"""

SPLIT_CTE = f"""keyed AS (
  SELECT doc_id, label, tokens, {key_sql('doc_id')} AS k FROM corpus
), cnt AS (
  SELECT label, count(*) AS n FROM keyed GROUP BY label
), tot AS (
  SELECT CAST(sum(n) AS BIGINT) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS ntest FROM cnt
), q0 AS (
  SELECT label, (n * ntest) // total AS base, (n * ntest) % total AS rem, ntest FROM cnt, tot
), quota AS (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label ASC NULLS FIRST)
                                 <= ntest - sum(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM q0
), split_rank AS (
  SELECT keyed.*, row_number() OVER (PARTITION BY label ORDER BY k, doc_id) AS rn FROM keyed
), split AS (
  SELECT r.doc_id, r.label, r.tokens, CASE WHEN r.rn <= q.quota THEN 'test' ELSE 'train' END AS split
  FROM split_rank r JOIN quota q ON r.label IS NOT DISTINCT FROM q.label
)"""


def vocab_cte(name: str, n: int, cap: int = 20000) -> str:
    grams = "tokens" if n == 1 else ngrams_sql("tokens", n)
    return f"""{name}_ntrain AS (
  SELECT count(*) AS n FROM split WHERE split = 'train'
), {name}_dt AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({grams}) AS term FROM split WHERE split = 'train') GROUP BY doc_id, term
), {name}_st AS (
  SELECT term, sum(tf) AS tf, count(*) AS df FROM {name}_dt GROUP BY term
), {name}_top AS (
  SELECT s.term, s.tf, s.df, t.n FROM {name}_st s, {name}_ntrain t
  WHERE s.df >= 2 AND s.df <= 0.95 * t.n ORDER BY s.tf DESC, s.term ASC LIMIT {cap}
), {name} AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id,
         CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df, CAST(n AS BIGINT) AS n_docs,
         ln(CAST(1 + n AS DOUBLE) / CAST(1 + df AS DOUBLE)) + 1.0 AS idf
  FROM {name}_top
)"""


def tfidf_cte(name: str, vocab: str, n: int = 2, where: str = "TRUE") -> str:
    grams = "tokens" if n == 1 else ngrams_sql("tokens", n)
    return f"""{name}_c AS (
  SELECT g.doc_id, g.label, g.split, v.term_id, v.idf, count(*) AS tf
  FROM (SELECT doc_id, label, split, unnest({grams}) AS term FROM split WHERE {where}) g
  JOIN {vocab} v ON g.term = v.term
  GROUP BY g.doc_id, g.label, g.split, v.term_id, v.idf
), {name}_w AS (
  SELECT doc_id, label, split, term_id, (1.0 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM {name}_c
), {name} AS (
  SELECT doc_id, label, split, term_id, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM {name}_w
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TOP_TERMS_BY_CLASS = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 2),
                               tfidf_cte("tw", "voc", 2, "split = 'train'")) + """
, sums AS (
  SELECT label, term_id, sum(weight) AS s FROM tw GROUP BY label, term_id
), ranked AS (
  SELECT s.label, v.term, s.s,
         row_number() OVER (PARTITION BY s.label ORDER BY round(s.s, 9) DESC, v.term ASC) AS rn
  FROM sums s JOIN voc v USING (term_id)
)
SELECT label AS lang, CAST(rn AS INTEGER) AS rank, term, round(s, 6) AS weight FROM ranked WHERE rn <= 10
"""


LABEL_DIM = ("(VALUES (0, 'Society & Culture'), (1, 'Science & Mathematics'), (2, 'Health'), "
             "(3, 'Education & Reference'), (4, 'Computers & Internet'), (5, 'Sports'), (6, 'Business & Finance'), "
             "(7, 'Entertainment & Music'), (8, 'Family & Relationships'), (9, 'Politics & Government')) "
             "AS dim(label, label_name)")

SCAN_CORPUS = """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

INPUT_CHECKS = """
WITH e(c) AS (VALUES ('de'), ('en'), ('es'), ('fr')),
s AS (
  SELECT (SELECT count(*) FROM documents) AS n_rows,
         (SELECT count(DISTINCT lang) FROM documents) AS n_classes,
         (SELECT count(*) FROM e WHERE c NOT IN (SELECT lang FROM documents WHERE lang IS NOT NULL)) AS n_missing
)
SELECT TRUE AS has_label_column, n_rows, n_classes, CAST(4 AS BIGINT) AS n_expected, n_missing,
       (n_classes = 4 AND n_missing = 0) AS ok
FROM s
"""

COMBINE_TEXT = """
SELECT a.conv_id, a.turn, coalesce(a.text, '') || ' ' || coalesce(b.text, '') AS text
FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
"""

LABEL_NAMES = f"""
SELECT e.vec_id, e.label, dim.label_name FROM embeddings e LEFT JOIN {LABEL_DIM} ON e.label = dim.label
"""

CLEAN_TEXT = with_ctes(CORPUS_CTE) + """
SELECT doc_id, array_to_string(tokens, ' ') AS clean_text, CAST(len(tokens) AS BIGINT) AS n_tokens FROM corpus
"""

STRIP_URLS = f"""
SELECT page_id, {normalize_sql("'see ' || url || ' end'")} AS url_text, {normalize_sql('html')} AS html_text FROM pages
"""

BIGRAMS = with_ctes(CORPUS_CTE) + f"""
SELECT doc_id, CAST(len({ngrams_sql('tokens', 2)}) AS BIGINT) AS n_bigrams,
       array_to_string({ngrams_sql('tokens', 2)}, '|') AS bigrams
FROM corpus
"""

LENGTHS_CTE = f"""lengths AS (
  SELECT doc_id, CAST(len({ws_tokens_sql('text')}) AS BIGINT) AS raw_len,
         CAST(len({clean_tokens_sql('text')}) AS BIGINT) AS clean_len
  FROM documents
)"""

TEXT_LENGTHS = with_ctes(LENGTHS_CTE) + "SELECT doc_id, raw_len, clean_len FROM lengths"

_CONTENT = f"tokens[1:{WINDOW_LENGTH - 2}]"
TOKEN_WINDOW = with_ctes(CORPUS_CTE) + f"""
, w AS (
  SELECT doc_id, len({_CONTENT}) AS n,
         ['{CLS_TOKEN}'] || {_CONTENT} || ['{SEP_TOKEN}']
           || list_transform(range({WINDOW_LENGTH - 2} - len({_CONTENT})), lambda i: '{PAD_TOKEN}') AS win
  FROM corpus
)
SELECT doc_id, CAST(n + 2 AS BIGINT) AS mask_sum, array_to_string(win, ' ') AS window_text,
       repeat('1', n + 2) || repeat('0', {WINDOW_LENGTH - 2} - n) AS mask_text
FROM w
"""

CLASS_COUNTS = "SELECT lang, count(*) AS n FROM documents GROUP BY lang"

SAMPLE_PEEK = "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 3"

STRATIFIED_SAMPLE = f"""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {key_sql('doc_id')}, doc_id) AS rn
  FROM documents
) WHERE rn <= 50
"""

_SPLIT_ONLY = with_ctes("corpus AS (SELECT doc_id, lang AS label, [] AS tokens FROM documents)", SPLIT_CTE)
STRATIFIED_SPLIT = _SPLIT_ONLY + "SELECT doc_id, label AS lang, split FROM split"

TERM_STATS = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + """
SELECT s.term, CAST(s.tf AS BIGINT) AS tf, CAST(s.df AS BIGINT) AS df
FROM voc_st s, voc_ntrain t WHERE s.df >= 2 AND s.df <= 0.95 * t.n
"""

VOCABULARY_TOPK = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + "SELECT term, term_id, tf, df FROM voc"
INCREMENTAL_TERM_COUNTS = with_ctes(CORPUS_CTE, SPLIT_CTE) + """
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(tokens) AS term FROM split) GROUP BY term
"""
BIGRAM_VOCABULARY = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 2)) + "SELECT term, term_id, tf, df FROM voc"

BOW = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + """
SELECT g.doc_id, g.split, v.term_id, count(*) AS count
FROM (SELECT doc_id, split, unnest(tokens) AS term FROM split) g JOIN voc v ON g.term = v.term
GROUP BY g.doc_id, g.split, v.term_id
"""

TFIDF_BIGRAMS = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 2), tfidf_cte("tw", "voc", 2)) + """
SELECT doc_id, split, term_id, round(weight, 6) AS weight FROM tw
"""

UNIFORM_SAMPLE = f"""
SELECT doc_id, lang FROM documents ORDER BY {key_sql('doc_id')}, doc_id LIMIT 2000
"""

UNIFORM_SAMPLE_CUT = UNIFORM_SAMPLE.replace("LIMIT 2000", "LIMIT 150")

_LONG_LENGTHS = """long AS (
  SELECT 'raw_len' AS kind, CAST(raw_len AS DOUBLE) AS x FROM lengths
  UNION ALL SELECT 'clean_len', CAST(clean_len AS DOUBLE) FROM lengths
)"""

LENGTH_HISTOGRAM = with_ctes(LENGTHS_CTE, _LONG_LENGTHS) + """
, rng AS (
  SELECT kind, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
  FROM long GROUP BY kind
), binned AS (
  SELECT l.kind, least(CAST(floor((l.x - r.lo) * (50.0 / (r.hi - r.lo))) AS INTEGER), 49) AS bin, count(*) AS c
  FROM long l JOIN rng r USING (kind) GROUP BY ALL
), grid AS (
  SELECT kind, lo, hi, CAST(b.range AS INTEGER) AS bin FROM rng, range(50) b
)
SELECT g.kind, g.bin, round(g.lo + g.bin * ((g.hi - g.lo) / 50.0), 6) AS lo,
       round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / 50.0), 6) AS hi, CAST(coalesce(b.c, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN binned b ON g.kind = b.kind AND g.bin = b.bin
"""

LENGTH_MEDIAN = with_ctes(LENGTHS_CTE, _LONG_LENGTHS) + "SELECT kind, median(x) AS median FROM long GROUP BY kind"

TOP_WORDS_BY_CLASS = with_ctes(CORPUS_CTE) + """
, c AS (
  SELECT label, word, count(*) AS n FROM (SELECT label, unnest(tokens) AS word FROM corpus) GROUP BY label, word
)
SELECT label AS lang, CAST(rn AS INTEGER) AS rank, word, CAST(n AS BIGINT) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word ASC) AS rn FROM c
) WHERE rn <= 80
"""


WV_CTE = """wv_tf AS (
  SELECT word, count(*) AS tf FROM (SELECT unnest(tokens) AS word FROM corpus) GROUP BY word
), wv AS (
  SELECT r.word, e.embedding AS vec
  FROM (SELECT word, row_number() OVER (ORDER BY tf DESC, word ASC) - 1 AS rk FROM wv_tf) r
  JOIN embeddings e ON e.vec_id = r.rk
), dims AS (
  SELECT DISTINCT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim FROM embeddings
)"""

WORD_VECTOR_MEAN = with_ctes(CORPUS_CTE, WV_CTE) + """
, hv AS (SELECT o.doc_id, w.vec FROM (SELECT doc_id, unnest(tokens) AS word FROM corpus) o JOIN wv w ON o.word = w.word)
, el AS (SELECT doc_id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS dim, CAST(unnest(vec) AS DOUBLE) AS v FROM hv)
, m AS (SELECT doc_id, dim, avg(v) AS mv FROM el GROUP BY doc_id, dim)
SELECT c.doc_id, d.dim, round(coalesce(m.mv, 0.0), 6) + 0.0 AS value
FROM corpus c CROSS JOIN dims d LEFT JOIN m ON m.doc_id = c.doc_id AND m.dim = d.dim
"""

_POOL = with_ctes(CORPUS_CTE, WV_CTE) + f"""
, win AS (SELECT doc_id, tokens[1:{WINDOW_LENGTH - 2}] AS content FROM corpus)
, hv AS (SELECT o.doc_id, w.vec FROM (SELECT doc_id, unnest(content) AS word FROM win) o JOIN wv w ON o.word = w.word)
, el AS (SELECT doc_id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS dim, CAST(unnest(vec) AS DOUBLE) AS v FROM hv)
, sm AS (SELECT doc_id, dim, sum(v) AS sv FROM el GROUP BY doc_id, dim)
, pooled AS (
  SELECT w.doc_id, d.dim, round(coalesce(CAST(f.vec[d.dim + 1] AS DOUBLE), 0.0), 6) + 0.0 AS first_value,
         round((coalesce(sm.sv, 0.0) + coalesce(CAST(f.vec[d.dim + 1] AS DOUBLE), 0.0)) / (len(w.content) + 2), 6) + 0.0 AS mean_value
  FROM win w CROSS JOIN dims d LEFT JOIN sm ON sm.doc_id = w.doc_id AND sm.dim = d.dim LEFT JOIN wv f ON f.word = w.content[1]
)
"""

MASKED_MEAN_POOL = _POOL + "SELECT doc_id, dim, mean_value AS value FROM pooled"
FIRST_TOKEN_POOL = _POOL + "SELECT doc_id, dim, first_value AS value FROM pooled"
ENCODE_BATCHES = _POOL + "SELECT doc_id, dim, first_value, mean_value FROM pooled"

V_CTE = """v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM embeddings
), tr AS (SELECT * FROM v WHERE split = 'train'), te AS (SELECT * FROM v WHERE split = 'test')"""

KNN_CTE = """pairs AS (
  SELECT te.vec_id AS query_id, tr.vec_id AS train_id, tr.label AS train_label,
         CASE WHEN list_dot_product(te.e, te.e) = 0 OR list_dot_product(tr.e, tr.e) = 0 THEN 0.0
              ELSE list_dot_product(te.e, tr.e) / (sqrt(list_dot_product(te.e, te.e)) * sqrt(list_dot_product(tr.e, tr.e)))
         END AS sim
  FROM te, tr
), nn AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, train_id) AS rank FROM pairs
  ) WHERE rank <= 5
), votes AS (
  SELECT query_id, train_label, count(*) AS n FROM nn GROUP BY query_id, train_label
), pred AS (
  SELECT p.query_id, te.label AS true_label, p.train_label AS pred_label FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, train_label) AS r FROM votes
  ) p JOIN te ON te.vec_id = p.query_id WHERE p.r = 1
), per_class AS (
  SELECT label, CAST(sum(t) AS BIGINT) AS support, CAST(sum(p) AS BIGINT) AS predicted, CAST(sum(tp) AS BIGINT) AS tp
  FROM (SELECT true_label AS label, 1 AS t, 0 AS p, CAST(true_label = pred_label AS INTEGER) AS tp FROM pred
        UNION ALL SELECT pred_label, 0, 1, 0 FROM pred)
  GROUP BY label
), pcm AS (
  SELECT label, support, predicted, tp,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
         CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0.0 END AS f1
  FROM per_class
)"""

_KNN = with_ctes(V_CTE, KNN_CTE)

KNN_NEIGHBORS = _KNN + """
SELECT query_id, CAST(rank AS INTEGER) AS rank, train_id, train_label, round(sim, 6) + 0.0 AS sim FROM nn
"""

KNN_PREDICT = _KNN + "SELECT query_id, true_label, pred_label FROM pred"

CONFUSION_MATRIX = _KNN + """
, labels AS (SELECT DISTINCT label FROM per_class)
, cnt AS (SELECT true_label, pred_label, count(*) AS n FROM pred GROUP BY ALL)
SELECT a.label AS true_label, b.label AS pred_label, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM labels a CROSS JOIN labels b LEFT JOIN cnt ON cnt.true_label = a.label AND cnt.pred_label = b.label
"""

METRIC_BUNDLE = _KNN + """
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(support * precision) / sum(support), 6) AS precision,
       round(sum(support * recall) / sum(support), 6) AS recall,
       round(sum(support * f1) / sum(support), 6) AS f1,
       round(avg(f1), 6) AS f1_macro
FROM pcm
"""

CLASS_REPORT = _KNN + """
SELECT CAST(label AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM pcm
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcm
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT)
FROM pcm
UNION ALL
SELECT 'weighted avg', round(sum(support * precision) / sum(support), 6), round(sum(support * recall) / sum(support), 6),
       round(sum(support * f1) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcm
"""

CLUSTER_CTE = """cm AS (
  SELECT label, dim, avg(x) AS mu FROM (
    SELECT label, generate_subscripts(e, 1) - 1 AS dim, unnest(e) AS x FROM tr
  ) GROUP BY label, dim
), cl AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster, center FROM (
    SELECT label, list(mu ORDER BY dim) AS center FROM cm GROUP BY label
  )
), dist AS (
  SELECT v.vec_id, v.label, v.split, cl.cluster,
         round(list_sum(list_transform(list_zip(v.e, cl.center), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9) AS d
  FROM v, cl
), assigned AS (
  SELECT vec_id, label, split, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS r FROM dist
  ) WHERE r = 1
)"""

CLUSTER_ASSIGN = with_ctes(V_CTE, CLUSTER_CTE) + "SELECT vec_id, split, cluster FROM assigned"

CLUSTER_MAJORITY = with_ctes(V_CTE, CLUSTER_CTE) + """
, c AS (SELECT cluster, label, count(*) AS n FROM assigned WHERE split = 'train' GROUP BY cluster, label)
, top AS (SELECT cluster, label, n FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS r FROM c) WHERE r = 1)
SELECT cl.cluster, CAST(coalesce(top.label, 0) AS INTEGER) AS label, CAST(coalesce(top.n, 0) AS BIGINT) AS n
FROM cl LEFT JOIN top ON top.cluster = cl.cluster
"""

VARIANCE_RATIO_AXES = """
WITH el AS (
  SELECT generate_subscripts(embedding, 1) - 1 AS axis, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
), va AS (SELECT axis, var_samp(x) AS var FROM el GROUP BY axis
), r AS (SELECT axis, var / sum(var) OVER () AS ratio FROM va
), k AS (SELECT *, row_number() OVER (ORDER BY round(ratio, 9) DESC, axis) AS component FROM r
), c AS (SELECT *, sum(ratio) OVER (ORDER BY component ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative
         FROM k)
SELECT CAST(component AS INTEGER) AS component, CAST(axis AS INTEGER) AS axis, round(ratio, 6) AS ratio,
       round(cumulative, 6) AS cumulative,
       CAST(least(coalesce(min(CASE WHEN cumulative >= 0.95 THEN component END) OVER (), max(component) OVER () + 1),
                  max(component) OVER ()) AS INTEGER) AS k95
FROM c
"""


CSV_ROUNDTRIP = "SELECT doc_id, text, lang FROM documents"

WORD_VECTOR_FILE = with_ctes(CORPUS_CTE, WV_CTE) + """
SELECT word, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS dim, CAST(unnest(vec) AS DOUBLE) AS value FROM wv
"""

FEATURE_STORE_ROUNDTRIP = """
SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, label,
       CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings
"""

COMPONENT_QUANTILES = """
WITH c AS (SELECT generate_subscripts(embedding, 1)::INTEGER - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT dim, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75 FROM c GROUP BY dim
"""

VECTORIZER_ROUNDTRIP = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + """
SELECT term, term_id, tf, df, round(idf, 6) AS idf FROM voc
"""

_EXPORTED = with_ctes(V_CTE, KNN_CTE, CLUSTER_CTE) + """
, cmaj AS (
  SELECT cluster, label FROM (
    SELECT cluster, label, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS r FROM (
      SELECT cluster, label, count(*) AS n FROM assigned WHERE split = 'train' GROUP BY cluster, label)
  ) WHERE r = 1
), cmap AS (SELECT cl.cluster, coalesce(cmaj.label, 0) AS label FROM cl LEFT JOIN cmaj USING (cluster)
), allpred AS (
  SELECT 'KNN' AS model, true_label, pred_label FROM pred
  UNION ALL
  SELECT 'NearestCentroid', a.label, m.label FROM assigned a JOIN cmap m USING (cluster) WHERE a.split = 'test'
)"""

RESULTS_EXPORT = _EXPORTED + """, pc AS (
  SELECT model, label, sum(t) AS support, sum(p) AS predicted, sum(tp) AS tp FROM (
    SELECT model, true_label AS label, 1 AS t, 0 AS p, CAST(true_label = pred_label AS INTEGER) AS tp FROM allpred
    UNION ALL SELECT model, pred_label, 0, 1, 0 FROM allpred) GROUP BY model, label
), pcm2 AS (
  SELECT model, support, tp,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
         CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0.0 END AS f1
  FROM pc
), m AS (
  SELECT model, round(sum(tp) / sum(support), 6) AS accuracy,
         round(sum(support * precision) / sum(support), 6) AS precision,
         round(sum(support * recall) / sum(support), 6) AS recall,
         round(sum(support * f1) / sum(support), 6) AS f1, round(avg(f1), 6) AS f1_macro
  FROM pcm2 GROUP BY model
)
SELECT 'VECTORS' AS feature_set, model, metric, value FROM m
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1, f1_macro))
"""

RESULTS_EXPORT_CELLS = _EXPORTED + """, lab AS (
  SELECT model, label, dense_rank() OVER (PARTITION BY model ORDER BY label) - 1 AS i
  FROM (SELECT DISTINCT model, unnest([true_label, pred_label]) AS label FROM allpred)
), cnt AS (SELECT model, true_label, pred_label, count(*) AS n FROM allpred GROUP BY ALL)
SELECT 'VECTORS' AS feature_set, a.model, CAST(a.i AS INTEGER) AS row, CAST(b.i AS INTEGER) AS col, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM lab a JOIN lab b ON a.model = b.model
LEFT JOIN cnt ON cnt.model = a.model AND cnt.true_label = a.label AND cnt.pred_label = b.label
"""

PCA_NORMS = with_ctes(V_CTE) + """
, el AS (SELECT vec_id, split, generate_subscripts(e, 1) AS dim, unnest(e) AS x FROM v)
, mu AS (SELECT dim, avg(x) AS m FROM el WHERE split = 'train' GROUP BY dim)
SELECT vec_id, split, round(sum((x - m) * (x - m)), 4) AS squared_norm FROM el JOIN mu USING (dim) GROUP BY vec_id, split
"""

CENTRED_CTE = V_CTE.split(", tr AS")[0].replace("v AS", "v0 AS") + """, el AS (SELECT vec_id, generate_subscripts(e, 1) AS dim, unnest(e) AS x FROM v0)
, mu AS (SELECT dim, avg(x) AS m FROM el JOIN v0 USING (vec_id) WHERE split = 'train' GROUP BY dim)
, ce AS (SELECT vec_id, list(x - m ORDER BY dim) AS e FROM el JOIN mu USING (dim) GROUP BY vec_id)
, v AS (SELECT vec_id, v0.label, ce.e, v0.split FROM v0 JOIN ce USING (vec_id))
, tr AS (SELECT * FROM v WHERE split = 'train'), te AS (SELECT * FROM v WHERE split = 'test')"""

KNN_FULL_WIDTH = with_ctes(CENTRED_CTE, KNN_CTE) + "SELECT query_id AS vec_id, true_label, pred_label FROM pred"

TIME_RANKING_EXACT = """
WITH t AS (
  SELECT coalesce(source, '-') AS feature_set, coalesce(lang, '-') AS model,
         CAST(CAST(coalesce(sum(n_chars), 0) AS BIGINT) // (10 * count(*)) AS DOUBLE) AS train_time
  FROM documents GROUP BY ALL)
SELECT *, model || chr(10) || feature_set AS label,
       CAST(row_number() OVER (ORDER BY train_time DESC, model || chr(10) || feature_set DESC) AS INTEGER) AS position
FROM t
"""

PCA_MOMENTS = with_ctes(V_CTE) + """
, el AS (SELECT vec_id, generate_subscripts(e, 1) AS dim, unnest(e) AS x FROM tr)
, mu AS (SELECT dim, avg(x) AS m FROM el GROUP BY dim)
, ce AS (SELECT vec_id, dim, x - m AS x FROM el JOIN mu USING (dim))
, c AS (SELECT a.dim AS i, b.dim AS j, sum(a.x * b.x) / ((SELECT count(*) FROM tr) - 1) AS x FROM ce a JOIN ce b USING (vec_id) GROUP BY ALL)
, c2 AS (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM c a JOIN c b ON a.j = b.i GROUP BY ALL)
, t AS (SELECT (SELECT sum(x) FROM c WHERE i = j) AS a, (SELECT sum(x * x) FROM c) AS b, (SELECT sum(c.x * c2.x) FROM c JOIN c2 ON c.i = c2.j AND c.j = c2.i) AS d)
SELECT 'first' AS moment, round(a, 6) AS value FROM t UNION ALL SELECT 'second', round(b / (a * a), 9) FROM t UNION ALL SELECT 'third', round(d / (a * a * a), 9) FROM t
UNION ALL SELECT 'off_diagonal', 0.0::DOUBLE UNION ALL SELECT 'on_diagonal', 0.0::DOUBLE
"""

SVD_NORMS = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + """
, c AS (SELECT g.doc_id, v.term_id, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM split) g JOIN voc v ON g.term = v.term GROUP BY ALL)
SELECT doc_id, split, coalesce(CAST(q AS DOUBLE), 0.0) AS squared_norm
FROM split LEFT JOIN (SELECT doc_id, sum(n * n) AS q FROM c GROUP BY doc_id) USING (doc_id)
"""

SVD_MOMENTS = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + """
, c AS (SELECT coalesce(d.source, '') || ':' || g.label AS grp, v.term_id, CAST(count(*) AS DOUBLE) AS n
        FROM (SELECT doc_id, label, unnest(tokens) AS term FROM split WHERE split = 'train') g
        JOIN documents d USING (doc_id) JOIN voc v ON g.term = v.term GROUP BY ALL)
, g AS (SELECT a.grp AS i, b.grp AS j, sum(a.n * b.n) AS x FROM c a JOIN c b USING (term_id) GROUP BY ALL)
, g2 AS (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM g a JOIN g b ON a.j = b.i GROUP BY ALL)
, t AS (SELECT (SELECT sum(x) FROM g WHERE i = j) AS a, (SELECT sum(x * x) FROM g) AS b,
               (SELECT sum(g.x * g2.x) FROM g JOIN g2 ON g.i = g2.j AND g.j = g2.i) AS c, (SELECT CAST(count(DISTINCT i) AS DOUBLE) FROM g) AS k)
SELECT 'components' AS moment, k AS value FROM t UNION ALL SELECT 'converged', k FROM t UNION ALL SELECT 'first', round(a, 2) FROM t
UNION ALL SELECT 'second', round(b / (a * a), 9) FROM t UNION ALL SELECT 'third', round(c / (a * a * a), 9) FROM t
"""

SVD_RESIDUALS = with_ctes(CORPUS_CTE, SPLIT_CTE, vocab_cte("voc", 1)) + """
SELECT CAST(unnest(range(1, 1 + least(300, (SELECT count(*) FROM voc), (SELECT count(*) FROM split WHERE split = 'train')))) AS INTEGER) AS component,
       true AS converged
"""

LOGREG_EXPECTED_ROWS = with_ctes(V_CTE) + "SELECT label, count(*) AS expected_rows FROM tr GROUP BY label"


LOGREG_GRADIENT = with_ctes(V_CTE) + """
SELECT label, unnest(range(0, 1 + (SELECT max(len(e)) FROM tr)))::INTEGER AS dim, 0.0::DOUBLE AS gradient FROM (SELECT DISTINCT label FROM tr)
"""


KMEANS_FIXED_POINT = with_ctes(V_CTE) + """
SELECT CAST(unnest(range(-1, (SELECT count(DISTINCT label) FROM tr))) AS INTEGER) AS cluster, true AS holds
"""


def _exact_models_ctes(p: str) -> str:
    """k-NN and nearest-centroid predictions over ``{p}v(vec_id, label, split, e DOUBLE[])``."""
    return f"""{p}tr AS (SELECT * FROM {p}v WHERE split = 'train'
), {p}te AS (SELECT * FROM {p}v WHERE split = 'test'
), {p}pairs AS (
  SELECT te.vec_id AS query_id, tr.vec_id AS train_id, tr.label AS train_label,
         CASE WHEN list_dot_product(te.e, te.e) = 0 OR list_dot_product(tr.e, tr.e) = 0 THEN 0.0
              ELSE list_dot_product(te.e, tr.e) / (sqrt(list_dot_product(te.e, te.e)) * sqrt(list_dot_product(tr.e, tr.e)))
         END AS sim
  FROM {p}te te, {p}tr tr
), {p}nn AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, train_id) AS rank
                 FROM {p}pairs) WHERE rank <= 5
), {p}votes AS (SELECT query_id, train_label, count(*) AS n FROM {p}nn GROUP BY query_id, train_label
), {p}knn AS (
  SELECT p.query_id, te.label AS true_label, p.train_label AS pred_label FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, train_label) AS r FROM {p}votes
  ) p JOIN {p}te te ON te.vec_id = p.query_id WHERE p.r = 1
), {p}cm AS (
  SELECT label, dim, avg(x) AS mu FROM (
    SELECT label, generate_subscripts(e, 1) - 1 AS dim, unnest(e) AS x FROM {p}tr) GROUP BY label, dim
), {p}cl AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster, center FROM (
    SELECT label, list(mu ORDER BY dim) AS center FROM {p}cm GROUP BY label)
), {p}dist AS (
  SELECT v.vec_id, v.label, v.split, cl.cluster,
         round(list_sum(list_transform(list_zip(v.e, cl.center), lambda q: (q[1] - q[2]) * (q[1] - q[2]))), 9) AS d
  FROM {p}v v, {p}cl cl
), {p}asg AS (
  SELECT vec_id, label, split, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS r FROM {p}dist) WHERE r = 1
), {p}cmaj AS (
  SELECT cluster, label FROM (
    SELECT cluster, label, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS r FROM (
      SELECT cluster, label, count(*) AS n FROM {p}asg WHERE split = 'train' GROUP BY cluster, label)
  ) WHERE r = 1
), {p}cmap AS (SELECT c.cluster, coalesce(m.label, 0) AS label FROM {p}cl c LEFT JOIN {p}cmaj m USING (cluster)
), {p}cen AS (
  SELECT a.vec_id AS query_id, a.label AS true_label, m.label AS pred_label
  FROM {p}asg a JOIN {p}cmap m USING (cluster) WHERE a.split = 'test'
)"""


EXACT_SOURCES = """ve_v AS (
  SELECT vec_id, label, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings
), dw_hv AS (
  SELECT o.doc_id, w.vec FROM (SELECT doc_id, unnest(tokens) AS word FROM split) o JOIN wv w ON o.word = w.word
), dw_el AS (
  SELECT doc_id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS dim, CAST(unnest(vec) AS DOUBLE) AS x FROM dw_hv
), dw_m AS (SELECT doc_id, dim, avg(x) AS mv FROM dw_el GROUP BY doc_id, dim
), dw_cls AS (
  SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS y FROM (SELECT DISTINCT label FROM split)
), dw_v AS (
  SELECT s.doc_id AS vec_id, c.y AS label, s.split, list(coalesce(m.mv, 0.0) ORDER BY d.dim) AS e
  FROM split s JOIN dw_cls c ON s.label = c.label CROSS JOIN dims d
  LEFT JOIN dw_m m ON m.doc_id = s.doc_id AND m.dim = d.dim
  GROUP BY s.doc_id, c.y, s.split
)"""

EXACT_METRICS_CTE = """allpred AS (
  SELECT 'VECTORS' AS feature_set, 'KNN' AS model, 0 AS run_order, true_label, pred_label FROM ve_knn
  UNION ALL SELECT 'VECTORS', 'NearestCentroid', 1, true_label, pred_label FROM ve_cen
  UNION ALL SELECT 'WORDVEC', 'KNN', 2, true_label, pred_label FROM dw_knn
  UNION ALL SELECT 'WORDVEC', 'NearestCentroid', 3, true_label, pred_label FROM dw_cen
), pcx AS (
  SELECT feature_set, model, run_order, label, sum(t) AS support, sum(p) AS predicted, sum(tp) AS tp FROM (
    SELECT feature_set, model, run_order, true_label AS label, 1 AS t, 0 AS p,
           CAST(true_label = pred_label AS INTEGER) AS tp FROM allpred
    UNION ALL SELECT feature_set, model, run_order, pred_label, 0, 1, 0 FROM allpred)
  GROUP BY feature_set, model, run_order, label
), mx AS (
  SELECT feature_set, model, run_order, round(sum(tp) / sum(support), 6) AS accuracy,
         round(avg(CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0.0 END), 6) AS f1_macro
  FROM pcx GROUP BY feature_set, model, run_order
)"""

_EXACT = with_ctes(CORPUS_CTE, SPLIT_CTE, WV_CTE, EXACT_SOURCES, _exact_models_ctes("ve_"),
                   _exact_models_ctes("dw_"), EXACT_METRICS_CTE)

METRIC_MATRIX_EXACT = _EXACT + """
SELECT feature_set, metric,
       coalesce(max(CASE WHEN model = 'KNN' THEN value END), 0.0) AS KNN,
       coalesce(max(CASE WHEN model = 'NearestCentroid' THEN value END), 0.0) AS NearestCentroid
FROM (SELECT feature_set, model, 'accuracy' AS metric, accuracy AS value FROM mx
      UNION ALL SELECT feature_set, model, 'f1_macro', f1_macro FROM mx)
GROUP BY feature_set, metric
"""

BEST_COMBINATION_EXACT = _EXACT + """
SELECT feature_set, model, accuracy FROM mx ORDER BY accuracy DESC, run_order ASC LIMIT 1
"""


def oracle_sql() -> dict[str, str]:
    return {
        "top_terms_by_class": TOP_TERMS_BY_CLASS,
        "scan_corpus": SCAN_CORPUS,
        "input_checks": INPUT_CHECKS,
        "combine_text": COMBINE_TEXT,
        "label_names": LABEL_NAMES,
        "clean_text": CLEAN_TEXT,
        "stream_clean_text": CLEAN_TEXT,
        "strip_urls": STRIP_URLS,
        "bigrams": BIGRAMS,
        "text_lengths": TEXT_LENGTHS,
        "token_window": TOKEN_WINDOW,
        "class_counts": CLASS_COUNTS,
        "sample_peek": SAMPLE_PEEK,
        "stratified_sample": STRATIFIED_SAMPLE,
        "stratified_split": STRATIFIED_SPLIT,
        "term_stats": TERM_STATS,
        "vocabulary_topk": VOCABULARY_TOPK,
        "vocabulary_summaries": VOCABULARY_TOPK,
        "incremental_term_counts": INCREMENTAL_TERM_COUNTS,
        "bigram_vocabulary_summaries": BIGRAM_VOCABULARY,
        "bow": BOW,
        "tfidf_bigrams": TFIDF_BIGRAMS,
        "tfidf_vectorizer_roundtrip": TFIDF_BIGRAMS,
        "uniform_sample": UNIFORM_SAMPLE,
        "uniform_sample_cut": UNIFORM_SAMPLE_CUT,
        "length_histogram": LENGTH_HISTOGRAM,
        "length_median": LENGTH_MEDIAN,
        "top_words_by_class": TOP_WORDS_BY_CLASS,
        "word_vector_mean": WORD_VECTOR_MEAN,
        "word_vector_mean_blocks": WORD_VECTOR_MEAN,
        "masked_mean_pool": MASKED_MEAN_POOL,
        "first_token_pool": FIRST_TOKEN_POOL,
        "encode_batches": ENCODE_BATCHES,
        "knn_neighbors": KNN_NEIGHBORS,
        "knn_index_neighbors": KNN_NEIGHBORS,
        "knn_predict": KNN_PREDICT,
        "confusion_matrix": CONFUSION_MATRIX,
        "metric_bundle": METRIC_BUNDLE,
        "class_report": CLASS_REPORT,
        "cluster_assign": CLUSTER_ASSIGN,
        "cluster_majority": CLUSTER_MAJORITY,
        "variance_ratio_axes": VARIANCE_RATIO_AXES,
        "csv_roundtrip": CSV_ROUNDTRIP,
        "word_vector_file": WORD_VECTOR_FILE,
        "feature_store_roundtrip": FEATURE_STORE_ROUNDTRIP,
        "vectorizer_roundtrip": VECTORIZER_ROUNDTRIP,
        "component_quantiles": COMPONENT_QUANTILES,
        "results_export": RESULTS_EXPORT,
        "results_export_cells": RESULTS_EXPORT_CELLS,
        "pca_norms": PCA_NORMS,
        "pca_moments": PCA_MOMENTS,
        "svd_norms": SVD_NORMS,
        "svd_moments": SVD_MOMENTS,
        "svd_residuals": SVD_RESIDUALS,
        "logreg_expected_rows": LOGREG_EXPECTED_ROWS,
        "logreg_gradient": LOGREG_GRADIENT,
        "svm_gradient": LOGREG_GRADIENT,  # the same weights, all at the optimum
        "kmeans_fixed_point": KMEANS_FIXED_POINT,
        "metric_matrix_exact": METRIC_MATRIX_EXACT,
        "best_combination_exact": BEST_COMBINATION_EXACT,
        "knn_full_width": KNN_FULL_WIDTH,
        "time_ranking_exact": TIME_RANKING_EXACT,
    }
