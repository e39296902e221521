"""The operators bound to the test tables: name to query, and the SQL that states the result where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ship
from .exact import exact_dedup
from .forest import nearest
from .licenses import license_scan
from .packing import best_fit_packing
from .partenum import jaccard_join
from .phrases import collocations
from .pieces import piece_check
from .pii import personal_data
from .quality import quality_classifier
from .spelling import spelling_variants
from .topk import exact_top_k
from .toxicity import toxicity
from .urls import url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return build
    return register


@query()
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing(table(spark, folder, "documents"))


@query("""
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""")
def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k(table(spark, folder, "embeddings"))


@query()
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


@query()
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter(table(spark, folder, "pages"))


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                 ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.c + y.c - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.doc_id AND r.m < e.b)
SELECT r.doc_id, coalesce(any_value(c), 0)::BIGINT AS n_shingles, min(m) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY 1
""")
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query()
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_check(table(spark, folder, "documents"))


@query()
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as files <source>/<lang>/<doc_id>: their sources are the directories."""
    files = table(spark, folder, "documents").withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    return license_scan(files)


@query("""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
""")
def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


#: U+00C0 to U+00FF, and 64 other one-byte characters that words do not hold: DuckDB's edit distance counts bytes.
WIDE = "".join(chr(c) for c in range(0xC0, 0x100))
NARROW = "".join(chr(c) for c in range(33, 127) if chr(c) not in "abcdefghijklmnopqrstuvwxyz'\\")[:64]


@query(rf"""
WITH RECURSIVE bit AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x : CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(0, 256))::BIGINT AS i)),
o AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
d AS (SELECT doc_id, run, count(*) AS c FROM o GROUP BY ALL),
h AS (
  SELECT run, c, xor(list_reduce(
    flatten([[4294967295]] || [CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END
                               FOR x IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')]),
    lambda s, b : xor(tab[(xor(s, b) & 255) + 1], s >> 8)), 4294967295) AS h
  FROM d, bit),
v AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n, translate(word, '{WIDE}', '{NARROW}') AS code FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
x AS (
  SELECT word, n, code, code AS cut FROM w UNION
  SELECT word, n, code, left(code, i) || substr(code, i + 2) FROM (SELECT *, unnest(range(0, length(code))) AS i FROM w)),
p AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.cut = b.cut AND a.code <> b.code WHERE levenshtein(a.code, b.code) = 1),
g AS (SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM p GROUP BY word, n),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
      FROM w LEFT JOIN g ON g.word = w.word),
r AS (SELECT word, form AS last, 1 AS step FROM f WHERE form IS NOT NULL UNION ALL SELECT r.word, f.form, step + 1 FROM r JOIN f ON f.word = r.last WHERE f.form IS NOT NULL),
e AS (SELECT word, arg_max(last, step) AS root FROM r GROUP BY word)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN e ON e.word = f.word
""")
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


@query(r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, unnest(regexp_extract_all(x, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
tot AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
o AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS m FROM s),
f AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS c FROM o GROUP BY ALL HAVING count(*) >= 100),
x AS (SELECT lang, m, phrase, c, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
inner_ AS (
  SELECT lang, c, array_to_string(ws[1:m - 1], ' ') AS phrase FROM x WHERE m >= 3 UNION ALL
  SELECT lang, c, array_to_string(ws[2:m], ' ') FROM x WHERE m >= 3),
k AS (SELECT lang, phrase, c AS a, ws, m, unnest(range(1, m)) AS k FROM x
      WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = x.lang AND i.phrase = x.phrase AND 100 * i.c >= 100 * x.c)),
z AS (
  SELECT k.lang, k.phrase, a, k, l.c AS l, r.c AS r, n, (1000::HUGEINT * a * n) // (l.c::HUGEINT * r.c) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(ws[1:k], ' ')
         JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(ws[k + 1:k.m], ' ') JOIN tot ON tot.lang = k.lang),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM b QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""")
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
