"""Queries of the text operators: each applies its operator to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import alignment as AL
from shelfcast.llm import decontam as DEC
from shelfcast.llm import icws as ICWS
from shelfcast.llm import kneser_ney as KN
from shelfcast.llm import merkle as MK
from shelfcast.llm import pareto_mix as MIX
from shelfcast.llm import pii as PII
from shelfcast.llm import ppm_langid as PPM
from shelfcast.llm import prefix_free as PF
from shelfcast.llm import superkmer as SK
from shelfcast.llm import text_density as TD
from shelfcast.llm.common import crc_mod, read_table, written
from shelfcast.llm.compression_quality import compression_quality
from shelfcast.llm.token_fst import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_compression_bands")
def op1(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return compression_quality(docs).drop("text")


@register("op6_pii", PII.ORACLE_SQL)
def op6(spark, sf):
    return PII.digest(PII.find_pii(read_table(spark, sf, "documents").select("doc_id", "text")))


@register("op10_pareto_mix", MIX.ORACLE_SQL)
def op10(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "source", MIX.n_words(F.col("text")).alias("words"))
    docs = docs.withColumn("weight", MIX.length_weight(F.col("words")))
    mixed = MIX.pareto_mix(written(docs, "mix-sizes"), size_col="words", weight_col="weight")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op4_prefix_decontam", DEC.ORACLE_SQL)
def op4(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return DEC.digest(DEC.hits(docs, read_table(spark, sf, "benchmark")))


@register("op2_fst_tokens")
def op2(spark, sf):
    import public_tokenizers
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@register("op3_ppm_langid")
def op3(spark, sf):
    docs = read_table(spark, sf, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    trees = PPM.fit(docs.filter(~held).select("doc_id", "text", "lang"))
    return PPM.predict(docs.select("doc_id", held.alias("held_out"), "text"), trees).drop("text")


@register("op9_kneser_ney")
def op9(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    held = crc_mod(F.col("doc_id"), 7) == 2
    model = KN.train(docs.filter(~held))
    return KN.score(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


@register("op7_icws_neardup")
def op7(spark, sf):
    return ICWS.near_duplicates(read_table(spark, sf, "documents").select("doc_id", "text")).drop("digest")


@register("op5_superkmer_dedup", SK.ORACLE_SQL)
def op5(spark, sf):
    return SK.remove_repeats(read_table(spark, sf, "documents").select("doc_id", "text"))


@register("op8_text_density")
def op8(spark, sf):
    return TD.extract(read_table(spark, sf, "pages").select("page_id", "url", "html")).drop("html")


@register("op11_prefix_free_dedup", PF.ORACLE_SQL)
def op11(spark, sf):
    return PF.remove_repeats(read_table(spark, sf, "documents").select("doc_id", "text"))


@register("op12_token_alignment")
def op12(spark, sf):
    import public_tokenizers
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return AL.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]


@register("op13_merkle_manifest", MK.ORACLE_SQL)
def op13(spark, sf):
    return MK.manifest(read_table(spark, sf, "documents"))
