"""Registered queries of the corpus operators, and their SQL twins for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm.compression import compression_quality
from secflow.llm.decontamination import find_contamination
from secflow.llm.importance import resample
from secflow.llm.jaccard_join import join_similar
from secflow.llm.language_id import fit_languages, id_remainder, identify
from secflow.llm.line_dedup import remove_repeated_lines
from secflow.llm.packing import pack_documents
from secflow.llm.secrets import find_secrets
from secflow.llm.spelling_groups import group_spellings
from secflow.llm.substring_dedup import remove_repeated_passages
from secflow.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity
from secflow.llm.url_filters import RULES, judge_urls
from secflow.llm.vector_dedup import dedup_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(l) - 1)) AS i, l FROM d),
v AS (SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS win FROM w),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM v
      WHERE regexp_matches(win, '[^ \t\n\x0B\f\r]')),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(range(0, 3)) AS k) WHERE nth > 1),
a AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM d),
k AS (SELECT a.doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
      FROM a ANTI JOIN gone USING (doc_id, i) GROUP BY a.doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text, CAST(len(l) AS BIGINT) AS n_lines,
       CAST(len(l) - coalesce(k.n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN k USING (doc_id)
"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_passages(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM p),
f AS (SELECT win, min(doc_id) AS least FROM v GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM v JOIN f USING (win), (SELECT unnest(range(0, 13)) AS k)
         WHERE least < doc_id),
a AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
k AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
      FROM a ANTI JOIN gone USING (doc_id, i) GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS root, doc_id AS id FROM n UNION SELECT r.root, f.b FROM r JOIN f ON f.a = r.id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT id, min(root) AS least FROM r GROUP BY id) c ON c.id = d.doc_id
"""


def op5_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(_table(spark, sf_dir, "documents"), links=True).select("doc_id", "n_shingles", "component_id", "n_links")


OP5_LINKS_SQL = OP5_SQL.replace("AS component_id\n", "AS component_id, CAST(coalesce(l.n_links, 0) AS BIGINT) AS n_links\n") + (
    "LEFT JOIN (SELECT a, count(*) AS n_links FROM f GROUP BY a) l ON l.a = d.doc_id\n")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


OP8_SQL = r"""
WITH t AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents, t),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, coalesce(regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
      FROM benchmark, t WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
v AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM p, (SELECT DISTINCT n FROM bw) WHERE i + n - 1 <= len(w)),
m AS (SELECT v.doc_id, v.i, v.n, bw.item_id FROM v JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS i FROM m) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def _rule_values(named: bool) -> str:
    quoted = [(r.name, r.regex(), r.action) for r in RULES if r.named == named]
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in quoted)


OP9_SQL = rf"""
WITH r AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT page_id, coalesce(rest, '') AS rest FROM r)),
n (rule, regex, action) AS (VALUES {_rule_values(True)}),
o (rule, regex, action) AS (VALUES {_rule_values(False)})
SELECT page_id, host, path,
       (SELECT max_by(rule, (length(rule), rule)) FROM n WHERE regexp_matches(host || path, regex)) AS rule,
       coalesce((SELECT max_by(action, (length(rule), rule)) FROM n WHERE regexp_matches(host || path, regex)),
                CASE WHEN EXISTS (SELECT 1 FROM o WHERE action = 'block' AND regexp_matches(host || path, regex)) THEN 'block' ELSE 'allow' END) AS verdict
FROM u
"""

def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    model = fit_toxicity(docs, labels.where(~held_out))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    languages = fit_languages(docs.where(~held_out))
    return identify(docs, languages).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: DuckDB expression for the unsigned crc32 of the UTF-8 bytes of ``{s}``, a bit at a time.
def _crc32(s: str) -> str:
    point = "unicode(substr({s}, i, 1))".format(s=s)
    utf8 = (f"CASE WHEN {point} < 128 THEN [{point}] WHEN {point} < 2048 THEN [192 + ({point} >> 6), 128 + ({point} & 63)] "
            f"WHEN {point} < 65536 THEN [224 + ({point} >> 12), 128 + (({point} >> 6) & 63), 128 + ({point} & 63)] "
            f"ELSE [240 + ({point} >> 18), 128 + (({point} >> 12) & 63), 128 + (({point} >> 6) & 63), 128 + ({point} & 63)] END")
    octets = f"flatten(list_transform(range(1, length({s}) + 1), lambda i: {utf8}))"
    bits = f"flatten(list_transform({octets}, lambda b: [CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, b: {step}), 4294967295)"


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_vectors(_table(spark, sf_dir, "embeddings"))


OP11_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
f AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT DISTINCT a AS root, a AS id FROM f UNION SELECT r.root, f.b FROM r JOIN f ON f.a = r.id)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.least, v.vec_id) AS component_id,
       coalesce(c.least, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM f GROUP BY a) n ON n.a = v.vec_id
LEFT JOIN (SELECT id, min(root) AS least FROM r GROUP BY id) c ON c.id = v.vec_id
"""


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(_table(spark, sf_dir, "documents"))


# Two words are one edit apart when they are equal with one letter blanked out in each, or in the longer one only.
OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT run, n, concat(doc_id, ':', run) AS s FROM k),
h AS (SELECT run, n, {_crc32("s")} AS h FROM s),
t AS (SELECT CASE WHEN h % 97 = 0 THEN concat(left(run, CAST(h % length(run) AS BIGINT)), substr(run, CAST(h % length(run) AS BIGINT) + 2)) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM t WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
y AS (SELECT word, n, i, concat(left(word, i - 1), substr(word, i + 1)) AS rest FROM x),
e AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM y a JOIN y b USING (i, rest) WHERE a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM y a JOIN w b ON b.word = a.rest
      UNION SELECT b.word, b.n, a.word, a.n FROM y a JOIN w b ON b.word = a.rest),
b AS (SELECT word, n, count(*) AS n_near, min(struct_pack(less := -other_n, form := other)) AS best FROM e GROUP BY word, n),
g AS (SELECT word, n_near, CASE WHEN -best.less >= 2 * n THEN best.form END AS form, CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n FROM b),
r AS (SELECT word, form AS root, 1 AS depth FROM g WHERE form IS NOT NULL UNION ALL
      SELECT r.word, g.form, depth + 1 FROM r JOIN g ON g.word = r.root WHERE g.form IS NOT NULL)
SELECT w.word, g.form, coalesce(z.root, w.word) AS root, w.n, CAST(coalesce(g.n_near, 0) AS BIGINT) AS n_near, CAST(g.form_n AS BIGINT) AS form_n
FROM w LEFT JOIN g USING (word) LEFT JOIN (SELECT word, max_by(root, depth) AS root FROM r GROUP BY word) z USING (word)
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = rf"""
WITH l AS (SELECT doc_id, FALSE AS target, text FROM documents UNION ALL SELECT NULL, TRUE, text FROM benchmark),
d AS (SELECT row_number() OVER () AS row_id, doc_id, target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM l),
o AS (SELECT row_id, target, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT row_id, target, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (VALUES (1), (2), (3)) t (n))),
k AS (SELECT row_id, target, gram, count(*) AS n FROM o GROUP BY ALL),
c AS (SELECT gram, {_crc32("gram")} % 10000 AS bucket FROM (SELECT DISTINCT gram FROM k)),
b AS (SELECT bucket, CAST(sum(CASE WHEN target THEN 0 ELSE n END) AS DOUBLE) AS s, CAST(sum(CASE WHEN target THEN n ELSE 0 END) AS DOUBLE) AS t
      FROM k JOIN c USING (gram) GROUP BY bucket),
a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM b),
g AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS gain FROM b, a),
f AS (SELECT row_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM k JOIN c USING (gram) JOIN g USING (bucket) GROUP BY row_id),
p AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             (CAST('0x' || substr(sha256(concat('42:', doc_id)), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE) AS u
      FROM d LEFT JOIN f USING (row_id) WHERE NOT target),
q AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) AS score FROM p),
z AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) OVER (PARTITION BY n_words >= 20) AS total FROM q)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= total * 5 // 100 THEN place END AS rank FROM z
"""


QUERIES = {f.__name__: f for f in (
    op1_compression_bands, op2_line_dedup, op3_substring_dedup, op4_toxicity, op5_jaccard_join, op5_jaccard_links, op6_secret_scan, op7_best_fit_packing,
    op8_decontamination, op9_url_filters, op10_language_id,
    op11_vector_dedup, op12_spelling_groups, op13_importance_resampling)}
ORACLES = {"op2_line_dedup": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op5_jaccard_join": OP5_SQL, "op5_jaccard_links": OP5_LINKS_SQL,
           "op8_decontamination": OP8_SQL, "op9_url_filters": OP9_SQL,
           "op11_vector_dedup": OP11_SQL, "op12_spelling_groups": OP12_SQL, "op13_importance_resampling": OP13_SQL}
