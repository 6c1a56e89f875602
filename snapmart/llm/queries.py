"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import (
    divergence,
    language_id,
    mixing,
    near_duplicates,
    packing,
    pivot_clustering,
    repetition,
    rotated_codes,
    sentencepiece_bpe,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)
from snapmart.llm.common import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

END_ID = 2


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model).drop("probability")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model")
    held_out = F.coalesce(language_id.bucket(F.col("doc_id"), 3) == 1, F.lit(True))
    model = language_id.learn(docs.filter(~held_out), vocabulary)
    found = language_id.identify(docs, model, vocabulary)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(language_id.bucket(F.col("doc_id"), 5) == 0, F.lit(True))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = model.score(docs)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    written = token_files.write_files(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), folder, END_ID)
    read = token_files.read_files(spark, folder, written)
    return read.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition.measure(table(spark, sf_dir, "documents"))
    failed = repetition.base_failed()
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measured.select(*base, failed.alias("base_failed"), (~failed & ~repetition.repetitive()).alias("kept"))


def op9_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, means = rotated_codes.build_index(table(spark, sf_dir, "embeddings"))
    return rotated_codes.search(index, means, F.col("vec_id") % 20 == 0, k=20)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)


def op12_pivot_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_near_duplicates,
        op3_url_filter,
        op4_language_id,
        op5_toxicity,
        op6_token_files,
        op7_mixing,
        op8_repetition,
        op9_rotated_codes,
        op10_suffix_dedup,
        op11_packing,
        op12_pivot_clustering,
        op13_divergence,
    )
}

_OP7 = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(doc_id::VARCHAR || '|' || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [1.0::DOUBLE, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM d GROUP BY source),
c AS (SELECT *, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS words, sum(w) OVER () AS all_w FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER p, 0) AS cap_before, coalesce(sum(w) OVER p, 0) AS w_before FROM c
      WINDOW p AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((words - cap_before) / (all_w - w_before), cap / w) FILTER (cap / w >= (words - cap_before) / (all_w - w_before)) AS level FROM o),
t AS (SELECT source, source_size, least(cap, w * (SELECT level FROM l)) AS target FROM c),
r AS (SELECT doc_id, d.source, size, source_size, target, u,
             CASE WHEN size > 0 AND source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0.0 END AS ratio
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, floor(ratio)::BIGINT AS whole, ratio - floor(ratio) AS p FROM r),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds,
             target - sum(whole * size) OVER (PARTITION BY source) AS need FROM k),
m AS (SELECT *, coalesce(sum(CASE WHEN p > 0 THEN size END) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN p > 0 AND before + size / 2.0::DOUBLE <= need THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM m
"""

_OP8 = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
n AS (SELECT k, len(w) AS n_words, unnest(range(1, len(w) + 1)) AS p, w FROM w),
g AS (SELECT k, p, n_words, [w[p], w[p + 1], w[p + 2], w[p + 3], w[p + 4]] AS five, list_slice(w, p, p + 9) AS ten,
             CASE WHEN p + 50 <= n_words THEN md5(array_to_string(list_slice(w, p, p + 50), ' ')) END AS beyond FROM n),
c AS (SELECT k, p, n_words, p + 4 <= n_words AND count(*) OVER (PARTITION BY k, five) > 1 AS five,
             p + 9 <= n_words AND count(*) OVER (PARTITION BY k, ten) > 1 AS ten,
             beyond IS NOT NULL AND count(*) OVER (PARTITION BY k, beyond) > 1 AS beyond FROM g),
m AS (SELECT k, p, bool_or(five) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS in_five,
             bool_or(ten) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS in_ten, beyond FROM c),
r AS (SELECT k, count(*) FILTER (in_five) AS n5, count(*) FILTER (in_ten) AS n10, bool_or(beyond) AS beyond FROM m GROUP BY k),
l AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d),
u AS (SELECT k, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
x AS (SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
             coalesce(n5, 0)::BIGINT AS n_repeat_words, coalesce(n10, 0) AS n10, coalesce(beyond, false) AS beyond
      FROM w LEFT JOIN r USING (k) LEFT JOIN u USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (100 * n10 > 10 * n_words OR beyond) AS kept
FROM x
"""

_OP9 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.r, q.vec_id AS query_id, v.r AS other, v.vec_id,
             list_reduce(list_transform(range(1, len(v.e) + 1), lambda i: q.e[i] * v.e[i]), lambda x, y: x + y) AS score
      FROM v q JOIN v ON q.r <> v.r AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM n WHERE rank <= 20
"""

_OP10 = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
s AS (SELECT k, unnest(range(1, (len(t) // 2 - 198)::BIGINT)) AS p, t FROM d WHERE len(t) >= 400),
g AS (SELECT k, p, md5(substr(t, 2 * p - 1, 400)) AS x FROM s),
r AS (SELECT k, p FROM (SELECT *, count(*) OVER (PARTITION BY x) AS n FROM g) WHERE n > 1),
b AS (SELECT *, coalesce(p > max(p) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200, true) AS new FROM r),
i AS (SELECT *, sum(new::INT) OVER (PARTITION BY k ORDER BY p) AS i FROM b),
o AS (SELECT k, i, min(p) AS lo, max(p) + 199 AS hi FROM i GROUP BY k, i),
e AS (SELECT k, lo, hi, coalesce(lag(hi) OVER (PARTITION BY k ORDER BY lo), 0) AS before, row_number() OVER (PARTITION BY k ORDER BY lo DESC) = 1 AS last FROM o),
q AS (SELECT k, count(*) AS n_spans, sum(hi - lo + 1) AS n_removed,
             string_agg(substr(t, 2 * before + 1, 2 * (lo - before - 1)), '' ORDER BY lo) || max(CASE WHEN last THEN substr(t, 2 * hi + 1) ELSE '' END) AS kept
      FROM e JOIN d USING (k) GROUP BY k)
SELECT doc_id, (len(t) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, t))) AS kept_sha256
FROM d LEFT JOIN q USING (k)
"""



def _op12() -> str:
    """The rounds one after the other: a_k assigns with the centroids c_k."""
    start = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(embedding) = 64
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(x, lambda y: floor(256 * y)::BIGINT) AS v FROM e),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1)::INT AS k, v FROM v
       QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) <= 40)"""
    turn = """
a{i} AS (SELECT r, vec_id, v.v AS v, k, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))::BIGINT AS distance
      FROM v CROSS JOIN c{i} c QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, k) = 1)"""
    step = """
u{i} AS (SELECT k, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{i}, range(1, 65) t(i) GROUP BY k, i),
c{j} AS (SELECT k, coalesce(m, c{i}.v) AS v FROM c{i} LEFT JOIN (
         SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM u{i} GROUP BY k) USING (k))"""
    parts = [part.format(i=i, j=i + 1) for i in range(5) for part in (turn, step)]
    end = """
SELECT vec_id, k AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 JOIN c5 USING (k)"""
    return ",".join([start, *parts, turn.format(i=5)]) + end


_OP13 = """
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
o AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
f AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p FROM f JOIN v USING (lang)),
l AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM f GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q FROM l JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""

ORACLE: dict[str, str] = {
    "op7_mixing": _OP7,
    "op8_repetition": _OP8,
    "op9_rotated_codes": _OP9,
    "op10_suffix_dedup": _OP10,
    "op12_pivot_clustering": _op12(),
    "op13_divergence": _OP13,
}
