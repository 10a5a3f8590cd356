"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

posterior(language) ~ text likelihood * P(declared language | language) * prior(language | address)

The prior of an address is smoothed down a hierarchy, for web pages all pages -> suffix -> domain -> host: every level adds its
own counts to ``STRENGTH`` pseudo-counts of the level above. Counts and the reliability of declared languages come from
grouped aggregations over all rows, in which a row votes for the language of its text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import keep, map_batches, small
from .shingles import buffers

#: Labelled rows of each language that the text model is fitted on at most.
PER_LANGUAGE = 500

#: Hash table of byte trigrams, and trigrams whose evidence counts in full: those of a text depend on each other, so a longer
#: text weighs no more than this many.
TABLE, EVIDENCE = 1 << 16, 60

#: Pseudo-counts that a level of the address takes from the level above; trigrams that a row needs to vote.
STRENGTH, VOTE = 10.0, 20

#: Least posterior of an accepted row.
LEAST_POSTERIOR = 0.5

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)

#: Bytes that are scored at once.
SLICE = 1 << 20


def trigrams(data: np.ndarray) -> np.ndarray:
    """Table places of the byte trigrams of folded text that hold a letter; -1 elsewhere (one value per start)."""
    folded = _FOLD[data].astype(np.uint32)
    code = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    place = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
    return np.where(code == 0x202020, -1, place)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of trigrams, one row per language."""

    languages: list[str]
    scores: np.ndarray

    def evidence(self, column: pa.Array) -> np.ndarray:
        """Per row: the log-likelihood of every language for up to ``EVIDENCE`` average trigrams, and the number of
        trigrams. The whole text is scored."""
        data, offsets = buffers(column)
        out = np.zeros((len(column), len(self.languages) + 1))
        for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for at in range(lo, hi - 2, SLICE):
                grams = trigrams(data[at : min(hi, at + SLICE + 2)])
                grams = grams[grams >= 0]
                out[row, :-1] += self.scores[:, grams].sum(axis=1)
                out[row, -1] += len(grams)
        number = out[:, -1:]
        out[:, :-1] *= np.minimum(number, EVIDENCE) / np.maximum(number, 1)
        return out


def fit_text_model(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> TextModel:
    """Fit on at most ``per_language`` rows of every language of ``labelled(id, text, language)``, picked by a hash of the id.

    The result is bounded by languages times ``TABLE``. Rows without language or text are left out.
    """
    usable = labelled.where("language is not null and text is not null")
    order = Window.partitionBy("language").orderBy(F.xxhash64("id"), "id")
    chosen = usable.select("id", "language").withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= per_language)
    chosen = keep(chosen.select("id", "language").distinct(), "language-sample")
    sample = usable.join(small(chosen), ["id", "language"], "left_semi").select("language", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = buffers(batch.column(1))
            held: dict[str, np.ndarray] = {}
            for name, lo, hi in zip(names, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for at in range(lo, hi - 2, SLICE):
                    grams = trigrams(data[at : min(hi, at + SLICE + 2)])
                    table = held.setdefault(name, np.zeros(TABLE, np.int64))
                    table += np.bincount(grams[grams >= 0], minlength=TABLE)
            for name, table in held.items():
                at = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(table[at])], ["language", "place", "n"])

    counted = map_batches(sample, count, "language string, place int, n long").groupBy("language", "place").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    names = sorted(set(rows.column("language").to_pylist()))
    table = np.zeros((len(names), TABLE))
    at = np.array([names.index(x) for x in rows.column("language").to_pylist()], np.int64)
    table[at, rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    table += 0.5
    return TextModel(names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _evidence(model: TextModel, text: Column, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def evidence(column: pa.Array) -> pa.Array:
        found = shared.value.evidence(column)
        each = pa.array(range(0, found.size + 1, found.shape[1]), pa.int32())
        return pa.ListArray.from_arrays(each, pa.array(found.reshape(-1)))

    return evidence(text)


def _declared(column: Column, languages: list[str]) -> Column:
    """Primary subtag of a declared language: one of the languages, "other" or "none"."""
    tag = F.lower(F.regexp_extract(F.coalesce(column.cast("string"), F.lit("")), "^\\s*([A-Za-z]+)", 1))
    return F.when(tag == "", "none").when(tag.isin(languages), tag).otherwise("other")


def _best(values: Column, languages: list[str]) -> Column:
    at = F.array_position(values, F.array_max(values)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in languages]), at)


@dataclass(frozen=True)
class Fusion:
    """Everything that ``identify`` needs: the text model, P(declared | language) and the priors of addresses."""

    model: TextModel
    declared: dict[str, list[float]]
    overall: list[float]
    priors: DataFrame
    levels: tuple[str, ...]


def fit(rows: DataFrame, model: TextModel, levels: tuple[str, ...], strength: float = STRENGTH) -> Fusion:
    """Learn reliability and priors from all rows of ``rows(text, declared, *levels)``.

    ``levels``: columns of the address from the widest to the narrowest; null reads as an empty address.
    """
    spark, names = rows.sparkSession, model.languages
    scored = rows.select(
        _evidence(model, F.col("text"), spark).alias("evidence"),
        _declared(F.col("declared"), names).alias("declared"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels],
    )
    votes = scored.where(F.element_at("evidence", -1) >= VOTE)
    votes = votes.withColumn("vote", _best(F.slice("evidence", 1, len(names)), names))
    counted = keep(votes.groupBy(*levels, "declared", "vote").agg(F.count(F.lit(1)).alias("n")), "votes")

    table = {(r["declared"], r["vote"]): r["n"] for r in counted.groupBy("declared", "vote").agg(F.sum("n").alias("n")).collect()}
    tags = [*names, "other", "none"]
    total = {x: sum(table.get((d, x), 0) for d in tags) for x in names}
    declared = {d: [float(np.log((table.get((d, x), 0) + 1) / (total[x] + len(tags)))) for x in names] for d in tags}
    everything = sum(total.values())
    overall = [(total[x] + 1) / (everything + len(names)) for x in names]

    sums = [F.sum(F.when(F.col("vote") == x, F.col("n")).otherwise(0)).cast("double") for x in names]
    above, keys = None, []
    for level in levels:
        keys.append(level)
        own = counted.groupBy(*keys).agg(F.array(*sums).alias("own"))
        if above is None:
            own = own.withColumn("above", F.array(*[F.lit(x) for x in overall]))
        else:
            own = own.join(small(above), keys[:-1])
        size = F.aggregate("own", F.lit(0.0), lambda a, b: a + b)
        mixed = F.zip_with("own", "above", lambda n, p: (n + strength * p) / (size + strength))
        above = keep(own.select(*keys, mixed.alias("above")), "prior")
    priors = above.withColumnRenamed("above", "prior") if above is not None else None
    return Fusion(model, declared, overall, priors, levels)


def identify(rows: DataFrame, fusion: Fusion, least: float = LEAST_POSTERIOR) -> DataFrame:
    """The columns of ``rows(text, declared, *levels)`` and language, posterior, accepted.

    A row is accepted if its text holds a trigram with a letter and the best posterior reaches ``least``. Null or
    empty texts have no text evidence: they get the language that address and declaration suggest and are not accepted.
    Null declarations and addresses are values of their own. Every row, repeated or not, is judged by itself. The
    names language, posterior and accepted replace columns of that name. A host that holds very many rows is one row in
    the table of priors, which is broadcast only if its measured size allows it.
    """
    names = fusion.model.languages
    clash = {c: f"_own_{c}" for c in ("language", "posterior", "accepted") if c in rows.columns}
    rows = rows.drop(*clash)
    columns = rows.columns
    marked = rows.withColumn("_evidence", _evidence(fusion.model, F.col("text"), rows.sparkSession))
    marked = marked.withColumn("_tag", _declared(F.col("declared"), names))
    marked = marked.withColumns({f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fusion.levels})
    if fusion.levels:
        priors = fusion.priors.select(*[F.col(c).alias(f"_{c}") for c in fusion.levels], F.col("prior").alias("_prior"))
        marked = marked.join(small(priors), [f"_{c}" for c in fusion.levels], "left")
    else:
        marked = marked.withColumn("_prior", F.lit(None).cast("array<double>"))
    prior = F.coalesce("_prior", F.array(*[F.lit(x) for x in fusion.overall]))
    reliability = F.create_map(*[x for d, v in fusion.declared.items() for x in (F.lit(d), F.array(*[F.lit(p) for p in v]))])
    said = F.element_at(reliability, F.col("_tag"))
    total = F.zip_with(F.slice("_evidence", 1, len(names)), F.zip_with(prior, said, lambda p, d: F.log(p) + d), lambda a, b: a + b)
    marked = marked.withColumn("_total", total)
    share = F.aggregate("_total", F.lit(0.0), lambda a, b: a + F.exp(b - F.array_max("_total")))
    marked = marked.withColumns({"language": _best(F.col("_total"), names), "posterior": F.lit(1.0) / share})
    accepted = (F.element_at("_evidence", -1) > 0) & (F.col("posterior") >= least)
    return marked.select(*columns, "language", "posterior", accepted.alias("accepted"))


def documents_fusion(docs: DataFrame) -> Fusion:
    """Fusion for ``documents``: the column lang is the declared language, source the address."""
    model = fit_text_model(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language")))
    return fit(docs.select("text", F.col("lang").alias("declared"), "source"), model, ("source",))


def identify_documents(docs: DataFrame) -> DataFrame:
    """All columns of ``documents`` and language, posterior, accepted. Without any labelled row nothing can be told:
    language and posterior are null and every row is accepted."""
    if docs.where("lang is not null and text is not null").isEmpty():
        own = [c for c in docs.columns if c not in ("language", "posterior", "accepted")]
        return docs.select(*own, F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("posterior"), F.lit(True).alias("accepted"))
    fusion = documents_fusion(docs)
    return identify(docs.withColumn("declared", F.col("lang")), fusion).drop(*(["declared"] if "declared" not in docs.columns else []))


def pages_text(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, suffix, domain, host): visible text, language attribute and address of ``pages``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    hidden = "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>"
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    return pages.select(
        "page_id",
        F.regexp_replace(html, hidden, " ").alias("text"),
        F.regexp_extract(html, "(?i)<html\\b[^>]*\\blang\\s*=\\s*[\"']?([A-Za-z-]+)", 1).alias("declared"),
        F.substring_index(host, ".", -1).alias("suffix"),
        F.substring_index(host, ".", -2).alias("domain"),
        host.alias("host"),
    )


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, language, posterior, accepted) with all four kinds of evidence."""
    rows = pages_text(pages)
    fusion = fit(rows, model, ("suffix", "domain", "host"))
    return identify(rows, fusion).select("page_id", "language", "posterior", "accepted")
