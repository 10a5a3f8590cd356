"""Topic model over an address-word corpus."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.words import SCORE_ERROR, WORD_ERROR
from ..session import cut_lineage, cut_to_files, shared_dir, spread_and_cut, work_path
from .indexing import dense_index
from .joins import is_small, lookup_join


@dataclass
class TopicModel:
    """Topic mix per document and topic probabilities per word, both as tables."""

    k: int
    doc_topics: DataFrame
    word_topics: DataFrame
    small: bool | None = field(default=None, repr=False, compare=False)  # as measured by is_small_model

    def save(self, path: str) -> None:
        self.doc_topics.write.mode("overwrite").parquet(f"{path}/doc_topics")
        self.word_topics.write.mode("overwrite").parquet(f"{path}/word_topics")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TopicModel":
        words = spark.read.parquet(f"{path}/word_topics")
        docs = spark.read.parquet(f"{path}/doc_topics")
        return TopicModel(len(words.first()["probs"]), docs, words)


def doc_vectors(corpus: DataFrame, words: DataFrame) -> DataFrame:
    """(doc, features): one sparse count vector per document.

    The corpus has one row per (doc, word), so a vector has no more entries than
    there are words. The vectors are built as plain structs, written to the shared
    folder and read back as vectors: no value passes Python.
    """
    spark = corpus.sparkSession
    size = words.count()
    entry = F.struct(F.col("idx").cast("int").alias("i"), F.col("count").cast("double").alias("c"))
    docs = lookup_join(corpus, words, "word", "inner").groupBy("doc").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col("e.i").alias("indices"), F.col("e.c").alias("values")
    )
    path = work_path(spark, "vectors")
    docs.select("doc", sparse.alias("features")).write.parquet(path)
    schema = T.StructType([T.StructField("doc", T.StringType()), T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


@F.udf(T.StructType().add("entries", "long").add("tokens", "double"))
def entry_sums(vector):
    """Number and sum of the entries above zero of a vector. Only stored entries are read: a dense row would be as long as
    the list of all words."""
    stored = vector.values[vector.values > 0]
    return len(stored), float(stored.sum())


def _normalised(weights: DataFrame, k: int) -> DataFrame:
    """(word, probs) from (word, weights): every topic sums to one over the words."""
    total = weights.agg(*[F.sum(F.get("weights", F.lit(i))).alias(f"t{i}") for i in range(k)]).first()
    sums = F.array(*[F.lit(float(total[f"t{i}"])) for i in range(k)])
    return weights.select("word", F.zip_with("weights", sums, lambda w, t: w / t).alias("probs"))


def _em_tables(spark: SparkSession, model, vectors: DataFrame, words: DataFrame, name: str):
    """Topic weights of documents and words from the saved graph of the model.

    The fitted model is saved in the shared folder and read back as a table, so the
    document mixes are those of the training and nothing passes the driver. Document
    vertices carry the row ids of the input, word vertices -(index + 1).
    """
    path = work_path(spark, name)
    model.save(path)
    vertices = spark.read.parquet(f"{path}/oldModel/data/topicCounts").select(
        "id", vector_to_array("topicWeights").alias("weights")
    )
    docs = vectors.select("doc", F.monotonically_increasing_id().alias("id"))
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    doc_topics = docs.join(vertices.filter("id >= 0"), "id").select(
        "doc", F.transform("weights", lambda w: w / total).alias("mix")
    )
    weights = vertices.filter("id < 0").select((-F.col("id") - 1).alias("idx"), "weights").join(words, "idx").select("word", "weights")
    return doc_topics, weights


def _online_tables(spark: SparkSession, model, vectors: DataFrame, words: DataFrame):
    """The online optimiser keeps its word-topic matrix on the driver; it becomes a table here."""
    doc_topics = model.transform(vectors).select("doc", vector_to_array("topicDistribution").alias("mix"))
    matrix = model.topicsMatrix().toArray()
    rows = spark.createDataFrame(((i, [float(x) for x in row]) for i, row in enumerate(matrix)), "idx bigint, weights array<double>")
    return doc_topics, rows.join(words, "idx").select("word", "weights")


def fit_topics(
    corpus: DataFrame,
    k: int = 20,
    alpha: float = 1.02,
    beta: float = 1.001,
    max_iter: int = 20,
    optimizer: str = "em",
    seed: int | None = None,
    precision: int = 64,
) -> TopicModel:
    """Fit the topic model of a corpus (doc, word, count)."""
    if optimizer not in ("em", "online"):
        raise ValueError(f"unknown optimizer {optimizer!r}")
    spark = corpus.sparkSession
    shared_dir(spark)
    corpus = cut_to_files(corpus, "corpus")
    words = cut_lineage(dense_index(corpus, "word"))
    # The row ids that link documents to the model need a fixed table.
    vectors = spread_and_cut(doc_vectors(corpus, words))
    lda = LDA(k=k, maxIter=max_iter, optimizer=optimizer, docConcentration=[alpha], topicConcentration=beta)
    if seed is not None:
        lda = lda.setSeed(seed)
    if optimizer == "online":
        n = vectors.count()
        rate = 0.75 if n < 2 else (0.05 + 1) / n
        lda = lda.setSubsamplingRate(min(rate, 1.0)).setOptimizeDocConcentration(True)
    model = lda.fit(vectors.select("features"))
    if optimizer == "em":
        doc_topics, weights = _em_tables(spark, model, vectors, words, "topics")
    else:
        doc_topics, weights = _online_tables(spark, model, vectors, words)
    if precision == 32:
        doc_topics = doc_topics.withColumn("mix", F.col("mix").cast("array<float>"))
    return TopicModel(k, cut_lineage(doc_topics), cut_lineage(_normalised(weights, k)))


def _probability(word: str, k: int) -> Column:
    """Score of ``mix`` and ``probs`` for the column ``word``: the products are added in the order of the topics."""
    dot = F.lit(0.0)
    for i in range(k):
        dot = dot + F.get("mix", F.lit(i)).cast("double") * F.get("probs", F.lit(i))
    return F.when(F.col(word) == WORD_ERROR, F.lit(SCORE_ERROR)).otherwise(F.coalesce(dot, F.lit(0.0)))


def is_small_model(model: TopicModel) -> bool:
    """Whether both tables may be broadcast; they are measured once, not again for every batch of a stream."""
    if model.small is None:
        model.small = is_small(model.doc_topics) and is_small(model.word_topics)
    return model.small


def with_probability(rows: DataFrame, model: TopicModel, doc: str, word: str, out: str) -> DataFrame:
    """Add the score of (doc, word) to every record by broadcast lookups in a small model: no record is shuffled.

    The scores are those of ``score_pairs``; a record without a document or a word has none.
    """
    mixes = F.broadcast(model.doc_topics.withColumnRenamed("doc", doc))
    probs = F.broadcast(model.word_topics.withColumnRenamed("word", word))
    known = F.col(doc).isNotNull() & F.col(word).isNotNull()
    rows = rows.join(mixes, doc, "left").join(probs, word, "left")
    return rows.withColumn(out, F.when(known, _probability(word, model.k))).drop("mix", "probs")


def score_pairs(pairs: DataFrame, model: TopicModel) -> DataFrame:
    """Probability of each distinct (doc, word): (doc, word, score, is_unseen).

    An error word scores -1; a word or a document that training has not seen scores 0.
    """
    rows = pairs.join(model.doc_topics, "doc", "left").join(model.word_topics, "word", "left")
    score = _probability("word", model.k)
    unseen = F.col("mix").isNull() | F.col("probs").isNull()
    return rows.select("doc", "word", score.alias("score"), unseen.alias("is_unseen"))
