"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, embeddings, importance, language_id, packing, quality_rules, secrets, simhash, suffix_dedup
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_large_item_packing(spark, sf_dir):
    pieces = packing.tokenize_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack_pieces(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op2_packed_matrices(spark, sf_dir):
    return packing.pack_matrices(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_decision_list(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_secret_entropy(spark, sf_dir):
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    every = F.array_sort(F.concat("base", "added"), secrets._by_place)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(every).alias("spans"))


def op4_suffix_arrays(spark, sf_dir):
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return done.select(F.col("row.doc_id").alias("doc_id"), (F.octet_length("kept") + gone).cast("long").alias("n_bytes"), gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_hyperdimensional_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    langs, prototypes = language_id.fit(docs.where(~held_out))
    got = language_id.predict(docs, langs, prototypes)
    return got.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_simhash_variants(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_projection_passes(spark, sf_dir):
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def op9_bpe_tree(spark, sf_dir):
    got = bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_large_item_packing, op2_packed_matrices, op3_decision_list, op4_suffix_arrays, op5_importance_resampling, op6_hyperdimensional_language, op7_simhash_variants, op8_projection_passes, op9_bpe_tree, op10_secret_entropy)}
#: The other operators have no SQL form; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {
    "op8_projection_passes": """
        WITH RECURSIVE able AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9
        ),
        reach(node, other) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
        ),
        least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
        counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
        FROM embeddings e JOIN least l ON l.node = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
    """,
}
