"""The registered queries of the corpus operators and their SQL.

Each reads a whole table of ``sf_dir`` with the production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickscope.llm import codes as op12
from clickscope.llm import embedding_dedup as op7
from clickscope.llm import html_text as op13
from clickscope.llm import langid as op5
from clickscope.llm import line_dedup as op6
from clickscope.llm import lm_scoring as op9
from clickscope.llm import mixing as op2
from clickscope.llm import packing as op10
from clickscope.llm import resampling as op11
from clickscope.llm import simhash as op4
from clickscope.llm import token_counts as op1
from clickscope.llm import topk as op8
from clickscope.llm import warc as op3
from clickscope.llm.common import table
from clickscope.session import scratch_path


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (op1.token_counts(docs, _tokenizer("byte_bpe_50k.json"))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return op2.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


OP2_SQL = r"""WITH d AS (SELECT doc_id, source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM d GROUP BY source),
w AS (SELECT *, CAST(r % 3 + 1 AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS cap FROM s),
b AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
  coalesce(sum(cap) OVER (ORDER BY source_size / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(w) OVER (ORDER BY source_size / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
f AS (SELECT *, cap * rest <= w * (total - before) AS is_full FROM b),
g AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER () AS held,
  sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS share FROM f),
t AS (SELECT *, CASE WHEN is_full THEN cap ELSE w * (total - held) / share END AS target FROM g),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
q AS (SELECT *, CAST(floor(target - passes * source_size + 0.5) AS BIGINT) AS part FROM p),
m AS (SELECT d.doc_id, d.size, q.*, CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
k AS (SELECT *, passes * size + least(greatest(part - start, 0), size) AS taken,
  w * (CAST(start AS DOUBLE) / CAST(passes * source_size + part AS DOUBLE)) AS x FROM m)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, CASE WHEN taken = 0 THEN NULL
  WHEN w = 1 THEN 2 * x / (0.5 + sqrt(0.25 + 2 * x)) WHEN w = 2 THEN x / 2
  WHEN x < 2 THEN 2 * x / (5 + sqrt(25 - 8 * x)) ELSE 0.5 + 2 * (x - 2) / (3 + sqrt(9 - 8 * (x - 2))) END AS position
FROM k"""


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    op3.write_warc(op3.page_records(table(spark, sf_dir, "pages"), min_revisit_bytes=0), path)
    return op3.read_pages(spark, path)


OP3_SQL = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(p.h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top > page_id THEN top END AS refers_to
FROM p JOIN g USING (h)"""


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (op4.simhash_components(table(spark, sf_dir, "documents"), words=4, radius=4)
            .select("doc_id", op4.hex16("fingerprint").alias("fingerprint"), "component_id"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return op5.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op6.dedup_lines(table(spark, sf_dir, "documents"), edits=2, min_chars=24)
    return found.select("doc_id", "n_lines", "n_exact", "n_near", F.array_join("dropped", ",").alias("dropped"))


OP6_SQL = """WITH l AS (SELECT doc_id, unnest(range(0, len(a))) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
x AS (SELECT *, {'d': doc_id, 'p': pos} AS place FROM l WHERE trim(line, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) <> ''),
f AS (SELECT line, min(place) AS first, length(line) AS n, length(replace(line, 'e', '')) AS e,
  length(replace(line, 'a', '')) AS a, length(replace(line, 'n', '')) AS m, length(replace(line, 't', '')) AS t
  FROM x GROUP BY line),
near AS (SELECT DISTINCT a.line FROM (SELECT *, unnest([-2, -1, 0, 1, 2]) AS more FROM f WHERE n >= 24) a
  JOIN f b ON b.n = a.n + a.more AND b.first < a.first AND b.line <> a.line
  WHERE b.n >= 24 AND abs(b.e - a.e) <= 2 AND abs(b.a - a.a) <= 2 AND abs(b.m - a.m) <= 2 AND abs(b.t - a.t) <= 2
  AND levenshtein(a.line, b.line) <= 2),
g AS (SELECT x.doc_id, x.pos, x.place = f.first AS is_first FROM x JOIN f USING (line)
  WHERE x.place <> f.first OR x.line IN (SELECT line FROM near)),
h AS (SELECT doc_id, count(*) FILTER (NOT is_first) AS n_exact, count(*) FILTER (is_first) AS n_near,
  string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS dropped FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n_exact, 0) AS BIGINT) AS n_exact, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
  coalesce(dropped, '') AS dropped FROM documents d LEFT JOIN h USING (doc_id)"""


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)[0]


OP7_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n ON n.a = e.vec_id"""


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256, every=50)


OP8_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, x FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.score_documents(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=2, capacity=4096)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = op11.resample(docs, table(spark, sf_dir, "benchmark"), order=2, buckets=10000, min_words=20, share=25, seed=7, keep=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# The list holds the CRC-32 remainders of the 16 half-bytes.
OP11_SQL = r"""WITH x AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
d AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM x),
u AS (SELECT side, id, unnest(w || list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2])) AS f FROM d),
k AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, 2 * strlen(f)),
    lambda i: CAST(instr('0123456789ABCDEF', substr(hex(f), 2 * (i // 2) + 2 - i % 2, 1)) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384,
      4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + (xor(c, b) & 15)])),
  4294967295) % 10000 AS bucket FROM (SELECT DISTINCT f FROM u)),
n AS (SELECT bucket, CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t
  FROM u JOIN k USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
  FROM n),
m AS (SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM u JOIN k USING (f) JOIN g USING (bucket)
  WHERE side = 0 GROUP BY id),
v AS (SELECT d.id AS doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features,
  CASE WHEN total IS NULL THEN 0 ELSE total // n_features - CASE WHEN total % n_features < 0 THEN 1 ELSE 0 END END AS weight,
  CAST('0x' || substr(sha256('7:' || CAST(d.id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN m USING (id) WHERE side = 0),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM v),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS fit FROM z WHERE words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN rank <= 25 * fit // 100 THEN CAST(rank AS BIGINT) END AS rank FROM z LEFT JOIN r USING (doc_id)"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op12.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op12_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Each round is a pair of CTEs: ``a`` assigns every part, ``c`` averages the codebook's entries."""
    assign = """a{0} AS (SELECT part, vec_id, min({{'d': CAST(n - 2 * list_inner_product(p.y, c.y) + m AS BIGINT), 'e': e}}) AS best
  FROM p JOIN (SELECT *, list_inner_product(y, y) AS m FROM c{0}) c USING (part) GROUP BY part, vec_id)"""
    average = """c{1} AS (SELECT c.part, c.e, coalesce(t.y, c.y) AS y FROM c{0} c LEFT JOIN (SELECT part, e, list(v ORDER BY j) AS y FROM
  (SELECT part, best.e AS e, j, floor(sum(y[j]) / count(*)) AS v FROM a{0} JOIN p USING (part, vec_id), s, range(1, s.w + 1) r(j)
   GROUP BY part, best.e, j) GROUP BY part, e) t USING (part, e))"""
    steps = ",\n".join(assign.format(k) + ",\n" + average.format(k, k + 1) for k in range(rounds))
    return f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT CAST(min(len(x)) // {parts} AS BIGINT) AS w FROM v),
p AS (SELECT *, list_inner_product(y, y) AS n FROM (SELECT vec_id, label, part, x[part * w + 1:part * w + w] AS y
  FROM v, s, range({parts}) r(part))),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, y FROM p QUALIFY e < {entries}),
{steps},
{assign.format(rounds)},
h AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, j)) AS digest
  FROM (SELECT part, e, j, y[j] AS v FROM c{rounds}, s, range(1, s.w + 1) r(j))),
k AS (SELECT vec_id, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM k JOIN v USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error, digest AS codebooks_sha256 FROM k JOIN v USING (vec_id)
  JOIN l ON v.label IS NOT DISTINCT FROM l.label, h"""


OP12_SQL = _op12_sql(parts=4, entries=256, rounds=4, scale=1024)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


# The article's blocks; for pages whose main text is one article of headings and paragraphs.
OP13_SQL = r"""WITH b AS (SELECT page_id, url, list_filter(list_transform(
    regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '</?(p|h1)>'),
    lambda x: replace(replace(trim(regexp_replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')),
      '&quot;', '"'), '&amp;', '&')), lambda x: x <> '') AS a FROM pages),
c AS (SELECT page_id, url, regexp_replace(coalesce(array_to_string(a, chr(10) || chr(10)), ''), '&amp(\n)', '&\1') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_mixing": op2_mixing,
        "op3_warc_round_trip": op3_warc_round_trip,
        "op4_simhash_near_dedup": op4_simhash_near_dedup,
        "op5_language_id": op5_language_id,
        "op6_line_dedup": op6_line_dedup,
        "op7_embedding_near_dedup": op7_embedding_near_dedup,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_packing": op10_packing,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_vector_codes": op12_vector_codes,
        "op13_html_extraction": op13_html_extraction,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": OP2_SQL, "op3_warc_round_trip": OP3_SQL, "op6_line_dedup": OP6_SQL,
            "op7_embedding_near_dedup": OP7_SQL, "op8_exact_top_k": OP8_SQL,
            "op11_importance_resampling": OP11_SQL, "op12_vector_codes": OP12_SQL,
            "op13_html_extraction": OP13_SQL}
