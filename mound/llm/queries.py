"""One thin query per operator: it applies the operator to its whole table and
derives the digest columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mound.llm import (bpe, bwt_dedup, chat, cross_polytope, hard_negatives, langid, license_scan, packing, prefix_trie, probminhash,
                       secret_scan, vptree, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.digest(_table(spark, sf_dir, "documents"))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "component_id", "kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "documents").select("doc_id", license_scan.scan_licenses(F.col("text")).alias("r"))
    return found.select("doc_id", "r.n_words", "r.n_base", "r.first_word", "r.last_word", "r.base_labels", "r.labels", "r.score")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(rows.unionByName(extra)))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), langid.predict(F.col("text"), model, spark).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = _tokenizer("byte_bpe_50k.json")
    coded = docs.select("doc_id", bpe.encode_decode(F.col("text"), path, bpe.publish_lexicon(docs, path)).alias("r"))
    return coded.select("doc_id", F.floor(F.octet_length("r.ids") / 4).alias("n_tokens"), F.sha2("r.ids", 256).alias("ids_sha256"),
                        F.sha2("r.decoded", 256).alias("decoded_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return warc.read_back(warc.write(pages), pages)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turn_paths(_table(spark, sf_dir, "conversations"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


QUERIES = {"op1_vptree": op1_vptree, "op2_suffix_array": op2_suffix_array, "op3_cross_polytope": op3_cross_polytope, "op5_probminhash": op5_probminhash,
           "op4_secrets": op4_secrets, "op6_licenses": op6_licenses, "op7_chat": op7_chat,
           "op8_langid": op8_langid, "op9_bpe": op9_bpe, "op10_packing": op10_packing, "op11_warc": op11_warc, "op12_prefix_trie": op12_prefix_trie,
           "op13_hard_negatives": op13_hard_negatives}
ORACLE_SQL = {"op4_secrets": secret_scan.oracle_sql(), "op7_chat": chat.oracle_sql(), "op11_warc": warc.oracle_sql(), "op12_prefix_trie": prefix_trie.oracle_sql(),
              "op13_hard_negatives": hard_negatives.oracle_sql()}
