"""One query per operator over the given tables, and the SQL some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosswind.llm import dedup, forest, mixing, packing, phrases, pii, quality, records, runs, secrets, sharding, warc, wrappers
from crosswind.session import scratch_path, settle

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, "base_sha256", "spans")


def op2_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wrappers.main_texts(table(spark, sf_dir, "pages"))
    return texts.select(F.col("id").alias("page_id"), "url", "text", "n_chars")


def op3_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size")


def op4_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "_doc.doc_id",
        *[f"_m.{name}" for name in counts],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def op5_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = settle(mixing.measured(table(spark, sf_dir, "documents")), "sizes")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.mix_plan(sized).select("doc_id", "size", "source_size", "target", taken)


def op6_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return forest.search(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op8_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in secrets.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, "base_sha256", "spans")


def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), path)
    index = records.write_index(spark, path, f"{path}-index")
    back = records.with_starts(records.scan_records(spark, path), index)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_packed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packages")
    warc.write_packages(table(spark, sf_dir, "pages"), path)
    return warc.scan_packages(spark, path).select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, told by their id, go on in a period from some word on."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rest = F.floor(number / 10)
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    worded = docs.select(
        "doc_id", "text", rest.alias("g"), F.when(number % 10 == 0, found).alias("words")
    ).withColumn("n", F.greatest(F.size("words"), F.lit(1)))
    a = (F.col("g") % F.col("n")).cast("int")
    p = (1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))).cast("int")
    placed = worded.withColumns({"a": a, "p": p})
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), F.col("n") - F.col("a"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(F.size("words") > 0, changed).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # The greatest run; of equal ones that which starts first, then that of the smallest period.
    ranked = F.transform(
        "runs", lambda r: F.struct(r["length"], (-r["start"]).alias("early"), (-r["period"]).alias("short"))
    )
    return found.withColumn("best", F.array_max(ranked)).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.early")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"),
        F.expr("(1000 * best.length) div (-best.short)").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    name: function for name, function in list(globals().items()) if name.startswith("op")
}
ORACLES: dict[str, str] = {
    "op11_packed_archives": """
        WITH paged AS (
            SELECT page_id, coalesce(html, '') AS html,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages
        )
        SELECT page_id, strlen(html) AS payload_bytes,
               array_to_string([substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + (((('0x' || substr(sha1(html), 1 + 5 * (i // 4), 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT,
                   1) FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM paged
    """,
    "op13_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), places AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
        ), counts AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
            FROM places, range(1, 5) AS t(k)
            WHERE i + k - 1 <= len(w)
            GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30
        ), inner_parts AS (
            SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS i
            FROM candidates, range(2, 4) AS t(m) WHERE m < k
        ), covered AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longest
            FROM inner_parts GROUP BY ALL
        ), kept AS (
            SELECT c.* FROM candidates c LEFT JOIN covered v ON c.lang = v.lang AND c.phrase = v.phrase
            WHERE v.longest IS NULL OR 100 * v.longest < 80 * c.a
        ), cuts AS (
            SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS c FROM kept
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, (2000000 * a) // (x.f + y.f) AS score,
                   row_number() OVER (PARTITION BY cuts.lang, cuts.phrase
                                      ORDER BY (2000000 * a) // (x.f + y.f), c) AS place
            FROM cuts
            JOIN counts x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:c], ' ')
            JOIN counts y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[c + 1:], ' ')
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM scored WHERE place = 1
        )
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
               n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
