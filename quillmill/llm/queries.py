"""The contract queries ``opN_<name>`` over whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from quillmill.durable import durable, scratch_path
from quillmill.operators.filters import extracted
from quillmill.llm import exact_dedup, filter_audit, imatch, jaccard_join, language_id, lexical_search, license_scan, lm_scoring, mixing, packing, sharding, token_files, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language_id.fit(docs)
    found = language_id.predict(docs.select("doc_id", "text"), model).select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_packing(spark, sf):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer, keep_ids=False)


@query
def op3_jaccard_join(spark, sf):
    found = jaccard_join.similar_documents(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op4_imatch(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = imatch.known_words(docs)
    hashes = lambda text: imatch.subset_hashes(text, words)
    near = imatch.with_next_text(docs, carried=hashes)
    rows = extracted(
        near,
        {
            "id": F.col("id"),
            "n_chars": F.col("n_chars"),
            "edited_sha256": F.sha2("edited", 256),
            "own": hashes(F.col("text")),
            "changed": hashes(F.col("edited")),
            "next": F.col("next"),
        },
    )
    text = lambda c: F.concat_ws("", c)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "edited_sha256",
        text("own").alias("fingerprint"),
        text("changed").alias("edited_fingerprint"),
        imatch.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        imatch.likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


@query
def op5_exact_dedup(spark, sf):
    found = exact_dedup.exact_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op5_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""


@query
def op6_license_scan(spark, sf):
    return license_scan.license_notices(table(spark, sf, "documents"))


@query
def op7_token_files(spark, sf):
    path = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(manifest, path)


@query
def op8_sharding(spark, sf):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf, "documents").select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.with_shards(rows, ["doc_id", "text_crc32", "size"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_warc(spark, sf):
    path = scratch_path(spark, "archives")
    written = warc.write_archives(table(spark, sf, "pages"), f"{path}/whole")
    return warc.read_archives(warc.normalise_archives(written, f"{path}/members"), f"{path}/members")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM d"""


@query
def op10_mixing(spark, sf):
    plan = durable(mixing.plan_mix(table(spark, sf, "documents")), "mix-plan")
    drawn = mixing.draw_mix(plan).groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("times"), F.sort_array(F.collect_list("shard")).alias("shards"))
    keys = ["source", "id", "size"]
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"d.{k}"))
    rows = plan.alias("p").join(drawn.alias("d"), same, "left").withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    taken = F.coalesce(F.col("times"), F.lit(0)) * F.col("p.size")
    return rows.select(F.col("p.id").alias("doc_id"), F.col("p.size"), "source_size", "target", taken.alias("taken"), "shards")


@query
def op11_lm_scoring(spark, sf):
    return lm_scoring.scores(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query
def op12_filter_audit(spark, sf):
    return filter_audit.every_order(filter_audit.failures(table(spark, sf, "documents"), table(spark, sf, "labels")))


ORACLES["op12_filter_audit"] = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT doc_id, part,
             (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t))::int
             + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * (doc_id > first)::int AS mask
      FROM w),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
p AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, bit)),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT o AS filter_order, k AS step, bit AS own,
                 (SELECT coalesce(sum(x.bit), 0) FROM letters x WHERE position(x.f IN o) < k) AS before
          FROM orders, range(1, 6) AS r(k), letters WHERE substr(o, k, 1) = f),
j AS (SELECT s.*, p.*, mask & own > 0 AS fails, mask & before::int > 0 AS gone FROM p, steps s)
SELECT part, filter_order, step::int AS step,
       sum(n * (NOT fails AND NOT gone)::int)::bigint AS kept,
       sum(n * (fails AND NOT gone)::int)::bigint AS removed,
       sum(n * (fails AND gone)::int)::bigint AS redundant,
       sum(n * (mask = own)::int)::bigint AS unique_fails,
       sum(good * (fails AND NOT gone)::int)::bigint AS good_lost,
       sum(toxic * (fails AND NOT gone)::int)::bigint AS toxic_lost,
       sum(CASE WHEN fails THEN n * (120 // greatest(bit_count(mask), 1)) ELSE 0 END)::bigint AS shapley
FROM j GROUP BY part, filter_order, step"""


@query
def op13_lexical_search(spark, sf):
    return lexical_search.best_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLES["op13_lexical_search"] = """
WITH lowered AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
d AS (SELECT row_number() OVER () AS row, doc_id, terms, len(terms) AS n FROM lowered WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::bigint AS words FROM d),
m AS (SELECT row, doc_id, 100 - 50 + ((50 * n * docs) // words) AS m FROM d, total),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
asked AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM items),
scored AS (SELECT item_id, text, row, doc_id,
                  sum(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint AS score
           FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN m USING (row), total GROUP BY item_id, text, row, doc_id),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, row)::int AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50"""
