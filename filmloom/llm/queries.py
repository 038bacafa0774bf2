"""Registered queries of the corpus operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm import (
    bpe,
    collocations,
    lexical_search,
    license_scan,
    mixing,
    quality,
    secrets,
    sentence_dedup,
    shingle_join,
    simhash,
    suffix_dedup,
    topk,
    training_order,
)
from filmloom.llm.common import WORD, Scratch, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, vocabulary()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "ids",
        "offsets",
    )
    decoded = bpe.decode(encoded, vocabulary(), keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    counted = Scratch(spark).save(quality.with_counts(docs).drop("text"), "counts")
    cutoffs = quality.calibrate(counted, read(spark, sf_dir, "labels"))
    return quality.apply_cutoffs(counted, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':17') AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, (3 * source_size) / weight::DOUBLE AS filled FROM w),
l AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY filled, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (ORDER BY filled, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM f),
t AS (SELECT source, source_size, CASE WHEN filled <= lev THEN (3 * source_size)::DOUBLE
             ELSE weight * max(lev) FILTER (filled > lev) OVER () END AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((budget // greatest(source_size, 1)) * size
        + greatest(0, least(size, budget - (budget // greatest(source_size, 1)) * source_size - before)))::BIGINT AS taken
FROM p
"""


@query("op6_mix_sources", MIX_SQL)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = Scratch(spark).save(mixing.sized(docs).drop("text"), "sizes")
    return mixing.mix(rows, rows).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_ngram_jaccard")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = shingle_join.similar_classes(docs, Scratch(spark))
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op2_sentence_dedup")
def op2_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_dedup.without_repeats(docs).select("doc_id", "n_sentences", "n_removed", "n_spans", "text")


@query("op3_training_order")
def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    places = training_order.materialise(docs, vocabulary())
    return places.select("doc_id", "slot", "shard", "first_token", "n_tokens")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM p) WHERE rank <= 5
"""


@query("op7_exact_top_k", TOP_K_SQL)
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    whole = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    docs = docs.withColumn("_whole", whole)  # beside the scan, so that no text needs to move for it
    found = suffix_dedup.without_repeats(docs, Scratch(spark)).drop("text")
    kept = F.coalesce(F.sha2("kept", 256), F.col("_whole")).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)


LEXICAL_SQL = """
WITH t AS (SELECT row_number() OVER () AS d, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
           FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark),
c AS (SELECT count(*)::BIGINT AS nn, sum(len(ts))::BIGINT AS ll FROM t WHERE len(ts) > 0),
tf AS (SELECT d, doc_id, n, term, count(*)::BIGINT AS tf
       FROM (SELECT d, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM t) JOIN (SELECT DISTINCT term FROM q) USING (term) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, c),
s AS (SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), c GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


@query("op11_lexical_search", LEXICAL_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Scratch(spark))


@query("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), Scratch(spark))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select(F.col("id").alias("doc_id"), digits, "component_id")


PHRASES_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE m > 1 AND f >= 30),
cut AS (SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
        FROM c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
s AS (SELECT cut.*, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x AND x.m = k JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y AND y.m = cut.m - k),
one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, m, a, unnest(list_transform(flatten(list_transform([2, 3], lambda len_: list_transform(range(1, m - len_ + 2), lambda i: [i, len_]))),
             lambda z: CASE WHEN z[2] < m THEN array_to_string(ws[z[1]:z[1] + z[2] - 1], ' ') END)) AS phrase FROM c WHERE m > 2),
most AS (SELECT lang, phrase, max(a) AS longer FROM inside WHERE phrase IS NOT NULL GROUP BY ALL),
kept AS (SELECT one.* FROM one LEFT JOIN most USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
               FROM kept JOIN n USING (lang)) WHERE rank <= 2000
"""


@query("op13_phrase_collocations", PHRASES_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"), Scratch(spark))
