"""MinHash near-duplicate removal with min-max hashing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jaccard import signatures, similar
from .shared import keep, small
from .shingles import Bands

#: 128 values from 64 permutations: minimum and maximum of each. At a similarity of 0.8 a pair shares no key with
#: a probability of 5e-8.
MIN_MAX = Bands(bands=32, rows=4, both=True)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: Bands = MIN_MAX) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs(doc_id, text)``.

    A-Z are lower-cased; words are runs without space, tab, newline, vertical tab, form feed and carriage return; the
    set of a document holds its distinct shingles of ``width`` words, or the whole sequence if it has fewer words.
    Documents link if 100 * intersection >= percent * union; ``component_id`` is the smallest id reachable over links
    and ``kept`` marks the document that bears it.

    Null or empty texts have empty sets and link with nothing. A row without doc_id links with nothing, its
    component_id is null and it is kept. Rows that repeat a doc_id are one document: they get the same component. Other
    columns of ``docs`` are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    groups = _groups(rows, width, percent, bands).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    unnamed = rows.where("id is null").select(
        F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return groups.union(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _groups(rows: DataFrame, width: int, percent: int, bands: Bands) -> DataFrame:
    groups = similar(rows.where("id is not null"), width, percent, bands)
    return groups.select(F.col("id").alias("doc_id"), "n", "one", "two", "component")


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: Bands = MIN_MAX) -> DataFrame:
    """Rows of ``docs`` without the near duplicates: of each group the texts of the document with the smallest id stay.

    Rows that repeat a doc_id are told apart by their sets: each goes or stays with the group of its own text, and of rows with
    the same doc_id and the same set one stays. Rows without doc_id or without words stay. All columns keep their values,
    whatever their names; texts of any length are read in slices.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    groups = keep(_groups(rows, width, percent, bands), "groups")
    gone = groups.where("doc_id <> component")
    packed = docs.select(F.struct(*docs.columns).alias("row")).withColumn("id", F.col("row.doc_id").cast("long"))
    repeated = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc_id").alias("id"))
    repeated = small(keep(repeated, "repeated-ids"))
    once = packed.join(repeated, "id", "left_anti")
    once = once.join(small(keep(gone.select(F.col("doc_id").alias("id")).distinct(), "gone")), "id", "left_anti")

    several = packed.join(repeated, "id", "left_semi").withColumn("text_key", F.xxhash64("row.text"))
    texts = several.where("row.text is not null").groupBy("text_key").agg(F.first("row.text").alias("text"))
    digests = signatures(texts.select(F.col("text_key").alias("id"), "text"), width, bands).where("n > 0")
    digests = digests.select(F.col("id").alias("text_key"), "n", "one", "two")
    known = several.join(digests, "text_key", "left")
    wordless = known.where("n is null")
    keys = ["id", "n", "one", "two"]
    known = known.where("n is not null").join(gone.select(F.col("doc_id").alias("id"), "n", "one", "two"), keys, "left_anti")
    parts = [once, known.dropDuplicates(keys), wordless]
    return reduce(DataFrame.union, [part.select("row") for part in parts]).select("row.*")
