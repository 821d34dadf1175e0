"""Registered queries of the training-data operators: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import common, hard_negatives, jaccard_join, length_packing, merkle, packing, page_diff, pii, quality, quotes, tiling, toxicity, transducer, warc

BPE_FILE, BPE_SIZE = "byte_bpe_50k.json", 50_257
PIECE_FILE = "piece_bpe_32k.model"
WORD_FILE = "word_bpe_49k.json"
TOXIC_SCORE = 0.7


def held_out() -> Column:
    """Whether a document's label is held out: crc32 of the id as text is 1 modulo 3."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return tiling.contamination(docs, common.table(spark, sf_dir, "benchmark"), common.run_folder(spark, "op1"))


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(common.table(spark, sf_dir, "conversations"), common.run_folder(spark, "op2"))


def op3_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = packing.write(docs, common.run_folder(spark, "op3"), public_tokenizers.path(BPE_FILE), BPE_SIZE)
    return packing.digests(spark, manifest)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Fitted on the labelled documents that are not held out."""
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    return toxicity.train(common.table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scores(docs, toxicity_model(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return transducer.encoded(docs, public_tokenizers.path(PIECE_FILE))


def op6_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.verdicts(docs, common.run_folder(spark, "op6"))


def op7_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.personal_data(docs, common.run_folder(spark, "op7"))


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = warc.write(pages, common.run_folder(spark, "op8"))
    return (warc.read(spark, archives, payload=False).where("kind = 'record'")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.component_table(docs, common.run_folder(spark, "op9"))


def op10_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_diff.main_texts(pages, common.run_folder(spark, "op10"))


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = common.table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), hard_negatives.integer_vector("embedding").alias("v"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, common.run_folder(spark, "op11"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of every row, folded from a copy of the table in which some rows' ``n_chars`` were raised by one."""
    docs = common.table(spark, sf_dir, "documents")
    leaf = lambda n_chars: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    raised = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    leaves = docs.select("doc_id", merkle.group_key(F.col("lang")).alias("g"), leaf(F.col("n_chars")).alias("digest"),
                         leaf(F.when(tampered, raised).otherwise(F.col("n_chars").cast("string"))).alias("check"))
    return merkle.manifest(leaves, common.run_folder(spark, "op12")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = length_packing.pieces(docs, public_tokenizers.path(WORD_FILE))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_benchmark_decontamination, op2_quotation_linking, op3_bit_packing, op4_toxicity, op5_sentencepiece, op6_distribution_divergence,
        op7_weak_supervision_pii, op8_warc_salvage, op9_ngram_jaccard_join, op10_page_differencing, op11_hard_negative_mining, op12_merkle_manifest,
        op13_hierarchical_packing)
}

# DuckDB SQL of the queries that SQL expresses at full scale.
ORACLE: dict[str, str] = {
    "op2_quotation_linking": r"""
        WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
        l AS (SELECT conv_id, turn, u.i AS i, u.line AS line,
                     length(regexp_replace(regexp_extract(u.line, '^[ \t]*((?:>[ \t]*)+)', 1), '[^>]', '', 'g')) AS level,
                     lower(trim(regexp_replace(regexp_replace(u.line, '^[ \t]*((?:>[ \t]*)+)', ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS normal
              FROM m, unnest(string_split_regex(text, '\r?\n')) WITH ORDINALITY AS u(line, i) WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
        q AS (SELECT DISTINCT conv_id, turn, level, normal FROM l WHERE level > 0 AND normal <> ''),
        own AS (SELECT DISTINCT conv_id, turn, normal FROM l WHERE level = 0 AND normal <> ''),
        fst AS (SELECT normal, conv_id AS c, turn AS t FROM own QUALIFY row_number() OVER (PARTITION BY normal ORDER BY conv_id, turn) = 1),
        here AS (SELECT q.conv_id, q.turn, q.level, q.normal, max(o.turn) AS ft
                 FROM q LEFT JOIN own o ON o.conv_id = q.conv_id AND o.normal = q.normal AND o.turn < q.turn GROUP BY ALL),
        k AS (SELECT h.conv_id, h.turn, h.level, h.normal,
                     CASE WHEN ft IS NOT NULL THEN h.conv_id WHEN f.c <> h.conv_id THEN f.c END AS fc,
                     CASE WHEN ft IS NOT NULL THEN ft WHEN f.c <> h.conv_id THEN f.t END AS ft
              FROM here h LEFT JOIN fst f USING (normal)),
        per AS (SELECT conv_id, turn, max(level) AS levels, count(DISTINCT normal) AS nq, count(DISTINCT CASE WHEN ft IS NOT NULL THEN normal END) AS nl FROM k GROUP BY 1, 2),
        v AS (SELECT conv_id, turn, fc, ft, count(*) AS n FROM k WHERE level = 1 AND ft IS NOT NULL GROUP BY 1, 2, 3, 4),
        par AS (SELECT conv_id, turn, ft AS parent FROM v WHERE fc = conv_id QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, ft DESC) = 1),
        oth AS (SELECT conv_id, turn, fc FROM v WHERE fc <> conv_id QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, fc DESC) = 1),
        up AS (SELECT conv_id, turn, parent AS root FROM par UNION ALL SELECT up.conv_id, up.turn, p.parent FROM up JOIN par p ON p.conv_id = up.conv_id AND p.turn = up.root),
        r AS (SELECT conv_id, turn, min(root) AS root FROM up GROUP BY 1, 2),
        x AS (SELECT m.*, trim(array_to_string(list_filter(string_split_regex(text, '\r?\n'), lambda y: NOT regexp_matches(y, '^[ \t]*>')), chr(10)), ' ' || chr(9) || chr(10) || chr(13)) AS body FROM m)
        SELECT x.conv_id::BIGINT AS conv_id, x.turn::BIGINT AS turn, x.role, x.body AS text, coalesce(per.levels, 0)::INTEGER AS levels, coalesce(per.nq, 0)::BIGINT AS n_quoted,
               coalesce(per.nl, 0)::BIGINT AS n_linked, par.parent::BIGINT AS parent_turn, coalesce(r.root, x.turn)::BIGINT AS root_turn,
               CASE WHEN par.parent IS NULL THEN oth.fc END::BIGINT AS from_conv,
               concat_ws('/', coalesce(r.root, x.turn)::VARCHAR, x.turn::VARCHAR) AS position
        FROM x LEFT JOIN per USING (conv_id, turn) LEFT JOIN par USING (conv_id, turn) LEFT JOIN oth USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn)
    """,
    "op8_warc_salvage": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(encode(html)) AS h FROM p),
             top AS (SELECT h, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY h HAVING count(*) > 1)
        SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
               CASE WHEN top.top IS NOT NULL AND top.top <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN top.top <> d.page_id THEN top.top END AS refers_to
        FROM d LEFT JOIN top USING (h)
    """,
    "op11_hard_negative_mining": """
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
                   FROM r a JOIN r ON r.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
               s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
        QUALIFY rank <= 3
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE c AS (SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) AS x(i)
                             UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM c WHERE k < 8),
        crc AS (SELECT list(v ORDER BY i) AS t FROM c WHERE k = 8),
        d AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                                    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) % 7 = 0 AS raised
              FROM documents, crc),
        e AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS g,
                     list_transform([doc_id::VARCHAR, source, lang], lambda x: coalesce(strlen(x) || ':' || x, '-')) AS a, n_chars::VARCHAR AS b,
                     CASE WHEN raised THEN (n_chars + 1)::VARCHAR ELSE n_chars::VARCHAR END AS b2, coalesce(strlen(text) || ':' || text, '-') AS z FROM d),
        l AS (SELECT doc_id, g, sha256(array_to_string(a, '') || coalesce(strlen(b) || ':' || b, '-') || z) AS leaf,
                     sha256(array_to_string(a, '') || coalesce(strlen(b2) || ':' || b2, '-') || z) AS bad FROM e),
        n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, bad) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM l),
        t AS (SELECT g, 0 AS lev, i, leaf AS h, n FROM n
              UNION ALL SELECT g, lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY g, lev, i // 2, n),
        s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
        u AS (SELECT 0 AS lev, i, subroot AS h, n FROM s
              UNION ALL SELECT lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lev, i // 2, n),
        w AS (SELECT doc_id, leaf, g, 0 AS lev, i, n, '' AS siblings, bad AS node FROM n
              UNION ALL SELECT w.doc_id, w.leaf, w.g, w.lev + 1, w.i // 2, (w.n + 1) // 2, w.siblings || coalesce(x.h, ''),
                               sha256(CASE WHEN w.i % 2 = 0 THEN w.node || coalesce(x.h, '') ELSE x.h || w.node END)
                        FROM w LEFT JOIN t x ON x.g = w.g AND x.lev = w.lev AND x.i = w.i + 1 - 2 * (w.i % 2) WHERE w.n > 1),
        v AS (SELECT w.doc_id, w.leaf, s.subroot, 0 AS lev, s.i, s.n, w.siblings, w.node FROM w JOIN s USING (g) WHERE w.n = 1
              UNION ALL SELECT v.doc_id, v.leaf, v.subroot, v.lev + 1, v.i // 2, (v.n + 1) // 2, v.siblings || coalesce(x.h, ''),
                               sha256(CASE WHEN v.i % 2 = 0 THEN v.node || coalesce(x.h, '') ELSE x.h || v.node END)
                        FROM v LEFT JOIN u x ON x.lev = v.lev AND x.i = v.i + 1 - 2 * (v.i % 2) WHERE v.n > 1)
        SELECT v.doc_id::BIGINT AS doc_id, v.leaf, v.subroot, u.h AS root, sha256(v.siblings) AS proof_sha256, v.node AS folded_root, v.node = u.h AS verified
        FROM v, u WHERE v.n = 1 AND u.n = 1
    """,
}
