"""Bag-of-words corpora: (doc = address, word, count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.domains import domain_info, domain_parts
from ..functions.words import WORD_ERROR, dns_word, flow_words, proxy_word
from .joins import lookup_join

WEIGHT = "weight"


def with_feedback(records: DataFrame, feedback: DataFrame | None, columns, duplication: int = 1) -> DataFrame:
    """Training records plus feedback. A feedback row counts ``duplication`` times by
    its weight, which gives the counts of repeated rows without repeating them."""
    out = records.select(*columns, F.lit(1).cast("bigint").alias(WEIGHT))
    if feedback is None:
        return out
    extra = feedback.select(*columns, F.lit(duplication).cast("bigint").alias(WEIGHT))
    return out.unionByName(extra)


def repeat_rows(df: DataFrame, times: int) -> DataFrame:
    """Literal form of the duplication: every row ``times`` times."""
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_i")


def top_domain_labels(top_domains: DataFrame) -> DataFrame:
    """First label of each listed domain."""
    return top_domains.select(F.get(F.split("domain", r"\."), F.lit(0)).alias("domain")).distinct()


def with_top_flag(df: DataFrame, name: str, top_domains: DataFrame, country_codes=None) -> DataFrame:
    """Add ``parts`` (domain, subdomain) of a name column and ``in_top``."""
    labels = top_domain_labels(top_domains).select(F.col("domain").alias("_domain"), F.lit(True).alias("in_top"))
    df = df.withColumn("parts", domain_parts(F.col(name), country_codes))
    df = df.withColumn("_domain", F.col("parts.domain"))
    out = lookup_join(df, labels, "_domain")
    return out.withColumn("in_top", F.coalesce("in_top", F.lit(False))).drop("_domain")


def with_flow_words(df: DataFrame) -> DataFrame:
    return df.withColumn("_w", flow_words()).select("*", "_w.src_word", "_w.dst_word").drop("_w")


def with_domain_info(df: DataFrame, top_domains: DataFrame, own_domain: str = "", name: str = "dns_qry_name") -> DataFrame:
    df = with_top_flag(df, name, top_domains)
    info = domain_info(F.col(name), F.col("parts"), F.col("in_top"), own_domain)
    return df.withColumn("info", info).drop("parts", "in_top")


def with_dns_word(df: DataFrame, top_domains: DataFrame, own_domain: str = "") -> DataFrame:
    return with_domain_info(df, top_domains, own_domain).withColumn("word", dns_word(F.col("info"))).drop("info")


def agent_counts(df: DataFrame) -> DataFrame:
    """User agents and how many records carry them."""
    weight = F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1).cast("bigint")
    return df.groupBy("useragent").agg(F.sum(weight).alias("agent_count"))


def with_host_class(df: DataFrame, top_domains: DataFrame, safe_domains=(), name: str = "host") -> DataFrame:
    """2 for a domain of the safe list, 1 for a top domain, 0 for any other."""
    df = with_top_flag(df, name, top_domains)
    cls = (
        F.when(F.col("parts.domain").isin(*safe_domains), F.lit(2))
        .when(F.col("in_top"), F.lit(1))
        .otherwise(F.lit(0))
    )
    return df.withColumn("host_class", F.when(F.col(name).isNotNull(), cls)).drop("parts", "in_top")


def with_proxy_word(df: DataFrame, top_domains: DataFrame, counts: DataFrame, safe_domains=()) -> DataFrame:
    df = with_host_class(df, top_domains, safe_domains)
    df = lookup_join(df, counts.select("useragent", "agent_count"), "useragent")
    return df.withColumn("word", proxy_word(F.col("host_class"), F.col("agent_count"))).drop("host_class", "agent_count")


def drop_word_errors(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns or ("word",):
        df = df.filter(F.col(c) != WORD_ERROR)
    return df


def _weight(df: DataFrame):
    return F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1).cast("bigint")


def flow_corpus(df: DataFrame) -> DataFrame:
    """Counts of (address, word) over both ends of a flow, in one shuffle: the
    partial sums of a task leave it already reduced to one row per pair."""
    words = df.select(flow_words().alias("w"), "sip", "dip", _weight(df).alias(WEIGHT))
    pairs = words.select(
        F.explode(
            F.array(
                F.struct(F.col("sip").alias("doc"), F.col("w.src_word").alias("word")),
                F.struct(F.col("dip").alias("doc"), F.col("w.dst_word").alias("word")),
            )
        ).alias("p"),
        WEIGHT,
    ).select("p.doc", "p.word", WEIGHT)
    return drop_word_errors(pairs).groupBy("doc", "word").agg(F.sum(WEIGHT).alias("count"))


def client_corpus(df: DataFrame, client: str) -> DataFrame:
    """Counts of (client, word) of DNS or proxy records that carry a ``word``."""
    pairs = df.select(F.col(client).alias("doc"), "word", _weight(df).alias(WEIGHT))
    return drop_word_errors(pairs).groupBy("doc", "word").agg(F.sum(WEIGHT).alias("count"))


def corpus_size(corpus: DataFrame) -> DataFrame:
    """Distinct documents and words and the number of tokens."""
    return corpus.agg(
        F.countDistinct("doc").alias("documents"),
        F.countDistinct("word").alias("words"),
        F.sum("count").alias("tokens"),
    )


def flow_training(records: DataFrame, feedback: DataFrame | None, duplication: int) -> DataFrame:
    return with_feedback(records, feedback, schemas.FLOW_MODEL, duplication)


def dns_training(records: DataFrame, feedback: DataFrame | None, duplication: int) -> DataFrame:
    return with_feedback(records, feedback, schemas.DNS_MODEL, duplication)


def proxy_training(records: DataFrame, feedback: DataFrame | None, duplication: int) -> DataFrame:
    return with_feedback(records, feedback, schemas.PROXY_MODEL, duplication)
