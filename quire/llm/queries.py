"""Queries of the text-corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, lookalike, packing, pii, quality, scannoise, surrogates
from quire.session import cut
from quire.sources.tables import table


ELEMENTS = "elements_core_content_types_rubric_v1"


def _text_types(spark: SparkSession, d: str) -> DataFrame:
    common = quality.common_words(spark, d)
    elements = quality.vote_rows(table(spark, d, ELEMENTS), "element", "element_key", "text", common, html=False)
    pages = quality.vote_rows(table(spark, d, "pages_html"), "page", "page_key", "html", common, html=True)
    return quality.text_types(elements.unionByName(pages))


def p1_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Text statistics of every element and of the readable text of every page."""
    common = quality.common_words(spark, d)
    elements = quality.statistics(table(spark, d, ELEMENTS), "element_key", "text", common).withColumnRenamed("element_key", "rec_key")
    pages = quality.statistics(table(spark, d, "pages_html"), "page_key", "html", common, html=True).withColumnRenamed("page_key", "rec_key")
    out = elements.select(F.lit("element").alias("src_table"), "*").unionByName(pages.select(F.lit("page").alias("src_table"), "*"))
    return out.dropDuplicates(["src_table", "rec_key"])


def p1_types(spark: SparkSession, d: str) -> DataFrame:
    """Text type of every element and page with a posterior per type."""
    return _text_types(spark, d).dropDuplicates(["src_table", "rec_key"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Elements and pages of some length that are mainly list, table or junk."""
    found = _text_types(spark, d).where((F.col("chars") >= quality.MIN_CHARS) & (F.col("other_share") > 0.5))
    return found.select("src_table", "rec_key").distinct()


def p2_forms(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every element's text, with its class among the book's texts."""
    forms = lookalike.consistent_forms(table(spark, d, ELEMENTS), "element_key", "book_id", "text").dropDuplicates(["element_key"])
    return forms.select("element_key", "book_id", F.md5("form").alias("class_id"), "form")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of elements of a book that look the same but are stored differently."""
    forms = lookalike.consistent_forms(table(spark, d, ELEMENTS), "element_key", "book_id", "text")
    return lookalike.same_look_pairs(forms, "element_key", "book_id")


def _listed_words(spark: SparkSession, d: str) -> frozenset[str]:
    """The words of the fixed word list (some hundred rows whatever the corpus)."""
    return frozenset(r["w"] for r in table(spark, d, "word_list").select(F.lower("word").alias("w")).distinct().collect())


def _noise(spark: SparkSession, d: str) -> DataFrame:
    known = _listed_words(spark, d)
    elements, pages = table(spark, d, ELEMENTS), table(spark, d, "pages_html")
    rows = scannoise.scan(elements, "element", "element_key", "text", known, html=False)
    rows = cut(rows.unionByName(scannoise.scan(pages, "page", "page_key", "html", known, html=True)))
    edges = scannoise.element_edges(elements).unionByName(scannoise.page_edges(rows))
    edge = scannoise.edge_noise(edges, table(spark, d, "books")).withColumn("stored", F.col("value"))
    return scannoise.word_noise(rows).unionByName(edge)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Divided and misread words, running heads and page numbers of every element and page."""
    return _noise(spark, d).select("src_table", "rec_key", "noise", "value").distinct()


def p3_texts(spark: SparkSession, d: str) -> DataFrame:
    """Repaired text of every element and page."""
    noise = cut(_noise(spark, d).distinct())
    elements = scannoise.repair(table(spark, d, ELEMENTS), "element", "element_key", "text", noise, html=False)
    return elements.unionByName(scannoise.repair(table(spark, d, "pages_html"), "page", "page_key", "html", noise, html=True))


def _vocabulary(spark: SparkSession) -> str:
    """The file that spark.quire.vocabulary names, or the public one."""
    return spark.conf.get("spark.quire.vocabulary", bpe.VOCABULARY)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_column(table(spark, d, "documents"), "doc_id", "text", "ids", _vocabulary(spark))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container of every document (of every piece, for documents above the capacity)."""
    sizes = bpe.count_column(table(spark, d, "documents"), "doc_id", "text", "n_tokens", _vocabulary(spark))
    return packing.pack(sizes, "doc_id", "n_tokens")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Number of containers, their total content and the share of the room that is used."""
    per = p8_containers(spark, d).groupBy("container").agg(F.sum("size").alias("used"))
    out = per.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return out.withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * packing.CAPACITY), 6))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return pii.entities(table(spark, d, "documents"), "doc_id", "text", surrogates.secret_of(spark))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Personal information of every document, as far as it gets a surrogate (all of it does)."""
    return _entities(spark, d).where("surrogate is not null").select("doc_id", "kind", "value")


def p9_surrogates(spark: SparkSession, d: str) -> DataFrame:
    """The keyed replacement of every distinct value, under the key of spark.quire.surrogateKey."""
    return _entities(spark, d).select("kind", "value", "surrogate").distinct()


def p9_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every document with typed placeholders, and with surrogates."""
    return pii.replace(table(spark, d, "documents"), "doc_id", "text", cut(_entities(spark, d)))


QUERIES = {
    "p1_found": p1_found,
    "p1_types": p1_types,
    "p1_statistics": p1_statistics,
    "p2_found": p2_found,
    "p2_forms": p2_forms,
    "p9_found": p9_found,
    "p9_surrogates": p9_surrogates,
    "p9_texts": p9_texts,
    "p3_found": p3_found,
    "p3_texts": p3_texts,
    "p7_ids": p7_ids,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
}

ORACLE_SQL: dict[str, str] = {}
