"""The registered queries of this package, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commitlens.llm import ann, bpe, byteconv, codes, fertility, fim, licenses, mixing, pages, pieces, pii, planes, simhash
from commitlens.llm.common import table
from commitlens.llm.oracles import ORACLES


def vocabulary(name: str) -> str:
    """Where a file of the installed public tokenizers lies, on the driver as on the executors."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, d, "documents"), shingle=3, radius=3)


def op2_ann(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(table(spark, d, "embeddings"), k=20, every=20)


def op3_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.license_labels(table(spark, d, "documents"))


def op4_fertility(spark: SparkSession, d: str) -> DataFrame:
    return fertility.quality_measures(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_byteconv(spark: SparkSession, d: str) -> DataFrame:
    return byteconv.classify(table(spark, d, "documents"), table(spark, d, "labels"), threshold=0.3)


def op6_planes(spark: SparkSession, d: str) -> DataFrame:
    return planes.ids_round_trip(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op7_mixing(spark: SparkSession, d: str) -> DataFrame:
    """As many tokens as there are, drawn anew by the mixture's weights."""
    docs = table(spark, d, "documents")
    goal = mixing.Mixture(entropy=0.92, repeats=2.0, budget=mixing.total_tokens(docs))
    drawn = mixing.mix(docs.select("doc_id", "source", "text"), goal)
    return drawn.select("doc.doc_id", "doc.source", "epoch", "turn", "n_tokens")


def op8_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.span_digests(pii.find_spans(table(spark, d, "documents")))


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return bpe.digests(bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"), decoded=True))


def op10_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_texts(table(spark, d, "pages"))


def op11_fim(spark: SparkSession, d: str) -> DataFrame:
    plan = fim.Plan(rate=50, spm_rate=80, unit="token", seed=42)
    return fim.digests(fim.transform(table(spark, d, "documents"), plan), plan)


def op12_pieces(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return pieces.digests(pieces.encode_documents(docs, vocabulary("piece_bpe_32k.model"), end=True, decoded=True))


def op13_codes(spark: SparkSession, d: str) -> DataFrame:
    return codes.code_digests(codes.code_vectors(table(spark, d, "embeddings"), parts=16, size=64, rounds=2, scale=256))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_ann": op2_ann,
    "op3_licenses": op3_licenses,
    "op4_fertility": op4_fertility,
    "op5_byteconv": op5_byteconv,
    "op6_planes": op6_planes,
    "op7_mixing": op7_mixing,
    "op8_pii": op8_pii,
    "op9_bpe": op9_bpe,
    "op10_pages": op10_pages,
    "op11_fim": op11_fim,
    "op12_pieces": op12_pieces,
    "op13_codes": op13_codes,
}
__all__ = ["ORACLES", "QUERIES"]
