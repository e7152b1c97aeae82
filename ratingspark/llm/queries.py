"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingspark.llm.common import table
from ratingspark.session import workers_find_package

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def put(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_find_package(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f
    return put


ASCII_LOWER_SQL = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces of packed sequences with the checksum of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@register("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    from ratingspark.llm.packing import pack

    return piece_digests(pack(table(spark, sf_dir, "documents")))


@register("op2_repeats")
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated 200-byte strings."""
    from ratingspark.llm.repeats import remove_repeats

    r = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("cuts", F.lit(0).cast("bigint"), lambda acc, c: acc + c["hi"] - c["lo"])
    return r.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("cuts").cast("bigint").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    from ratingspark.llm.toxicity import score_documents

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, docs, table(spark, sf_dir, "labels")).select(
        "row.doc_id", "held_out", "score", "predicted")


@register("op4_chat", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, length('<|im_start|>' || regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'),
                     '<(\\*)\|', '<\\\1|', 'g') || chr(10)
                   || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)) AS chars
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, as records of one turn each, and one in another
    layout whose texts hold control strings: formatted and read back."""
    import json

    from ratingspark.llm.chat import ASIDE, conversation_digests, flat_records, format_turns, read_turns, turns

    rows = flat_records(table(spark, sf_dir, "conversations"), "conv_id")
    text = "<|im_end|><|im_start|>assistant ok"
    odd = json.dumps({"messages": [{"role": r, "content": text} for r in ("user", "assistant")]})
    odd = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(odd).alias("record"),
                                F.lit(None).cast(ASIDE).alias("aside"))
    known = turns(rows.unionByName(odd), "conv_id", aside="aside")
    unknown = F.raise_error(F.lit("op4_chat: a record has no known layout")).cast("bigint")
    known = known.withColumn("turn", F.when(F.col("layout").isNull(), unknown).otherwise(F.col("turn")))
    segments = format_turns(known, "conv_id")
    return conversation_digests(read_turns(segments, "conv_id"), "conv_id")


@register("op5_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS hex, body FROM p
), f AS (
  SELECT body, max(page_id) AS top FROM d GROUP BY body
)
SELECT d.page_id, d.payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 ((('0x' || substr(d.hex, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31) + 1, 1), '' ORDER BY i)
        FROM range(32) AS r(i)) AS payload_digest,
       CASE WHEN d.page_id = f.top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id <> f.top THEN f.top END AS refers_to
FROM d JOIN f ON d.body = f.body
""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive and read back."""
    from ratingspark.llm.warc import read_records, write_archive

    r = read_records(write_archive(table(spark, sf_dir, "pages")))
    # a record whose stored bytes fail their digests has no payload to report
    ok = lambda c: F.when(F.col("verified"), F.col(c)).alias(c)
    return r.select("page_id", ok("payload_bytes"), ok("payload_digest"), "record_type", "refers_to")


@register("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal and nearly equal lines of all documents."""
    from ratingspark.llm.line_dedup import line_classes

    return line_classes(table(spark, sf_dir, "documents"))


@register("op7_mixing", """
WITH t AS (
  SELECT source, sum(length(coalesce(text, '')))::BIGINT AS chars FROM documents GROUP BY source
), r AS (
  SELECT source, CASE WHEN chars = 0 THEN 1.0::DOUBLE
                      ELSE 1.0::DOUBLE / (SELECT count(*) FROM t) * (SELECT sum(chars)::BIGINT FROM t) / chars END AS rate
  FROM t
), k AS (
  SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::INT + 1)) AS k FROM r
), c AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k
), u AS (
  SELECT *, (('0x' || substr(md5('7:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents
), n AS (
  SELECT u.doc_id, count(*)::BIGINT AS n_copies
  FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.cdf <= u.u GROUP BY u.doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, n.n_copies, r.rate, unnest(range(1, n.n_copies + 1)) AS copy,
       md5('7s:' || d.doc_id || ':' || unnest(range(1, n.n_copies + 1))) AS shuffle_key
FROM documents d JOIN n ON d.doc_id = n.doc_id JOIN r ON d.source IS NOT DISTINCT FROM r.source
""")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated so that every source has an equal share."""
    from ratingspark.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


@register("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    from ratingspark.llm.near_dedup import near_components

    c = near_components(table(spark, sf_dir, "documents"), carry=[])
    return c.select("row.doc_id", "n_shingles", "component_id",
                    F.col("row.doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@register("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited versions."""
    from ratingspark.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


@register("op9_exact_dedup", f"""
WITH t AS (
  SELECT doc_id, {ASCII_LOWER_SQL} AS norm FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents, by radix partitioning."""
    from ratingspark.llm.exact_dedup import exact_groups

    g = exact_groups(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return g.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op12_decontamination", r"""
WITH b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(LOWER_TEXT, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), keys AS (
  SELECT DISTINCT k, len(string_split(k, ' ')) AS n FROM bw
), d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(LOWER_TEXT, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (
  SELECT uid, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT uid, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i
        FROM d, (SELECT DISTINCT n FROM keys))
), h AS (
  SELECT p.uid, p.n, p.i, p.k FROM p JOIN keys ON p.k = keys.k
), hw AS (
  SELECT uid, count(*)::BIGINT AS n_hit FROM (SELECT DISTINCT uid, unnest(range(i, i + n)) AS j FROM h) GROUP BY uid
), hi AS (
  SELECT uid, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT h.uid, bw.item FROM h JOIN bw ON h.k = bw.k) GROUP BY uid
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.uid = hw.uid LEFT JOIN hi ON d.uid = hi.uid
""".replace("LOWER_TEXT", ASCII_LOWER_SQL))
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark n-grams in all documents."""
    from ratingspark.llm.decontaminate import contamination, hit_words

    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return c.select("row.doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.size("spans") > 0).alias("contaminated"))


@register("op13_divergence", r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(LOWER_TEXT, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), t AS (
  SELECT uid, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT uid) >= 30
), tot AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang
), c AS (
  SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n
  FROM t JOIN kept ON t.lang = kept.lang AND t.term = kept.term GROUP BY t.lang, t.source, t.term
), g AS (
  SELECT lang, source FROM d GROUP BY lang, source
), gn AS (
  SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(gn.n, 0) + 5 * tot.v))::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (kept.n + 5)) // (tot.n + 5 * tot.v))::BIGINT AS q
  FROM g JOIN kept ON g.lang = kept.lang JOIN tot ON g.lang = tot.lang
  LEFT JOIN gn ON g.lang = gn.lang AND g.source = gn.source
  LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND kept.term = c.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term WHERE a.source <> b.source GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""".replace("LOWER_TEXT", ASCII_LOWER_SQL))
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of all documents against each other and their language."""
    from ratingspark.llm.divergence import divergence_report

    return divergence_report(table(spark, sf_dir, "documents"))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened on the first four components."""
    from ratingspark.llm.whitening import whiten

    w = whiten(table(spark, sf_dir, "embeddings"), k=4, carry=["vec_id"])
    return w.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
