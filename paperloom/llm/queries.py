"""Queries over the given tables, one per operator, and their SQL where SQL can say them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import (
    decontamination, edit_counts, host_quality, language, minhash, mixing, packing, records, sharding, site_lines,
    spelling, vectors, whitening,
)
from paperloom.llm.shared import stored
from paperloom.llm.tokens import tokenizer_path
from paperloom.runtime import fresh_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "records")
    records.write_records(documents(spark, sf_dir), path, tokenizer_path(), end_id=2)
    found = records.read_records(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def edited(docs: DataFrame, *more: str) -> DataFrame:
    """Three edits per document, from its end to its start, so that places hold in the given text:
    a note behind it, its second line deleted, its first word replaced; (doc_id, text, `more`, edits)."""
    edits = F.expr("""
        array(named_struct('start', size, 'end', size, 'new', ' [end of document]'),
              named_struct('start', first, 'end', first + char_length(split_part(substring(t, first + 1), '\n', 1)), 'new', ''),
              named_struct('start', 0, 'end', char_length(split_part(split_part(t, '\n', 1), ' ', 1)), 'new', '[title]'))
    """)
    measured = docs.select("doc_id", "text", *more, F.coalesce("text", F.lit("")).alias("t")).select(
        "*", F.char_length("t").alias("size"), F.expr("char_length(split_part(t, '\n', 1)) + 1").alias("first"))
    return measured.select("doc_id", "text", *more, edits.alias("edits"))


def edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, repeated ones and those without text included: trees are written once, the edits
    take that table."""
    trees = stored(edit_counts.build_trees(documents(spark, sf_dir), tokenizer_path()), "trees")
    text = F.array_join("parts", "").alias("text")
    asked = edited(trees.select("doc_id", text, "parts", "tokens"), "parts", "tokens")
    return edit_counts.apply_edits(asked, tokenizer_path(), with_trees=False)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = site_lines.drop_boilerplate(documents(spark, sf_dir))
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


def harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), tokenizer_path(), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir), "doc_id", "text", width=3, percent=85)
    rows = minhash.with_first(found)
    return rows.select(F.col("key").alias("doc_id"), "n_shingles", "component_id",
                       F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    taken = F.col("size") * F.col("copies")
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    measured = host_quality.measure(docs, F.col("text"), F.col("source")).drop("text", "source")
    judged = host_quality.judge(stored(measured, "measured"))
    return judged.select("doc_id", *host_quality.MEASURES, "base_failed", "host_rate", "kept")


def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component; no rows where vectors have no spread. Vectors without
    finite entries are left out, repeated rows come each time."""
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = whitening.fit(given)
    whitened = whitening.whiten(given, model)
    error = whitening.identity_error(whitened, model.n, len(model.variances))
    rows = whitened.select(F.col("key").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "value"))
    explained = F.array(*map(F.lit, model.explained.tolist())) if len(model.explained) else F.lit(None).cast("array<double>")
    return rows.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, repeated ones and those without text included."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    scanned = decontamination.scan(documents(spark, sf_dir).select("doc_id", "text"), tests)
    hit = decontamination.n_hit(F.col("spans"))
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per word of the vocabulary."""
    return spelling.spelling_variants(documents(spark, sf_dir))


# Lines by page and place; a line of a host is judged by its text without blanks around it.
LINE_DEDUP = """
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, text, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT r, source, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM pages),
keyed AS (SELECT r, i, source, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS key
          FROM each WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
counted AS (SELECT source, key, count(DISTINCT r) AS n FROM keyed GROUP BY source, key),
frequent AS (SELECT c.source, key FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= 5 AND n > 0.1 * total),
bad AS (SELECT k.r, k.i FROM keyed k JOIN frequent f ON k.key = f.key AND k.source IS NOT DISTINCT FROM f.source),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM each ANTI JOIN bad USING (r, i) GROUP BY r)
SELECT doc_id, CASE WHEN p.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       CASE WHEN p.text IS NULL THEN 0 ELSE len(lines) END AS n_lines, len(lines) - coalesce(k.n, 0) AS n_dropped
FROM pages p LEFT JOIN kept k USING (r)
"""

# Measures by lists, windows by place; the prior of hosts from the moments of the beta-binomial distribution.
HOST_QUALITY = """
WITH split AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
starts AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + 2]) AS n FROM starts),
again AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE n > 1) GROUP BY r),
measured AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM split LEFT JOIN again USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS f FROM judged GROUP BY source),
sums AS (SELECT count(*) AS k, sum(n) AS pages, sum(f) / sum(n) AS mean, sum(n * n) AS squares, sum(f * f / n) AS rates FROM hosts),
shares AS (SELECT mean, CASE WHEN mean * (1 - mean) * (pages - squares / pages - (k - 1)) > 0
    THEN (rates - pages * mean * mean - mean * (1 - mean) * (k - 1)) / (mean * (1 - mean) * (pages - squares / pages - (k - 1))) ELSE 0 END AS share FROM sums),
prior AS (SELECT mean, CASE WHEN share > 0 THEN 1 / least(share, 0.999) - 1 END AS weight, 4.0 * mean / (1 - mean + 4.0 * mean) AS most FROM shares),
verdicts AS (SELECT source, CASE WHEN weight IS NULL THEN mean ELSE (f + mean * weight) / (n + weight) END AS host_rate, n + weight AS total, most FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate,
       NOT base_failed AND (total IS NULL OR host_rate - 1.645 * sqrt(host_rate * (1 - host_rate) / (total + 1)) <= most) AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""

# Test items and texts as word lists; a window of the test set is hit wherever it stands.
BENCHMARK_HITS = """
WITH letters AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), big, small), word) AS w FROM documents, letters),
tests AS (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), big, small), word) AS w FROM benchmark, letters),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM tests WHERE len(w) > 0),
starts AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS run FROM starts),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size),
runs AS (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS run FROM places),
hits AS (SELECT r, size, i, item_id FROM runs JOIN windows USING (size, run)),
marked AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

REGISTRY = {
    "op1_near_vectors": near_vectors,
    "op2_binary_records": binary_records,
    "op3_edit_counts": edit_token_counts,
    "op4_line_dedup": line_dedup,
    "op5_harmonic_packing": harmonic_packing,
    "op6_language_id": language_id,
    "op7_near_duplicates": near_duplicate_documents,
    "op8_balanced_shards": balanced_shards,
    "op9_source_mix": source_mix,
    "op10_host_quality": host_quality_rules,
    "op11_whitened_vectors": whitened_vectors,
    "op12_benchmark_hits": benchmark_hits,
    "op13_spelling_variants": spelling_variants,
}
ORACLES: dict[str, str] = {
    "op4_line_dedup": LINE_DEDUP,
    "op10_host_quality": HOST_QUALITY,
    "op12_benchmark_hits": BENCHMARK_HITS,
}
