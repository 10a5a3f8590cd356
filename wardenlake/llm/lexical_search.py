"""Ranked lexical search over a length-stratified index.

Documents with the same length normaliser m form a stratum; a large stratum is cut into slices, so that no task holds more
than ``SLICE_POSTINGS`` postings unless one document has more. The index has one row per (m, slice, term, tf) with
the documents of that frequency, so an impact is worked out once per frequency. The bound of a stratum for an item adds the
impacts of the highest frequencies of its terms there; strata are visited from the highest bound on, in rounds, until no bound
reaches the kth score of an item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import give_back, keep, map_batches, small

#: Postings of one slice of a stratum.
SLICE_POSTINGS = 1_000_000

#: Documents whose strata are visited in the first round for an item; every further round visits ``GROWTH`` times as many.
FIRST_DOCS, GROWTH = 4096, 16

#: Terms of the items that are searched together; more items are searched in several blocks.
BLOCK_TERMS = 200_000

#: Bytes of a text that are split at once.
SLICE = 1 << 20

_TERM = [b for b in range(256) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A]
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _TERM else 0x20 for b in range(256))


def count_terms(text: bytes | None) -> Counter:
    """Occurrences of the terms of a UTF-8 text: runs of ASCII letters, digits and other characters, A-Z lower-cased."""
    folded, counts, at = (text or b"").translate(_FOLD), Counter(), 0
    while at < len(folded):
        stop = folded.find(b" ", at + SLICE)
        stop = len(folded) if stop < 0 else stop
        counts.update(folded[at:stop].split())
        at = stop
    return counts


def term_counts(rows: DataFrame) -> DataFrame:
    """(id, n, terms, tfs) of every row of ``rows(id, text)`` that has a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [count_terms(t) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            some = [i for i, c in enumerate(counted) if c]
            counted = [counted[i] for i in some]
            begin = pa.array(np.cumsum([0, *map(len, counted)]), pa.int32())
            terms = pa.array([t for c in counted for t in c], pa.binary()).cast(pa.string())
            tfs = pa.array([v for c in counted for v in c.values()], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some, pa.int64())), pa.array([sum(c.values()) for c in counted], pa.int64()),
                 pa.ListArray.from_arrays(begin, terms), pa.ListArray.from_arrays(begin, tfs)],
                ["id", "n", "terms", "tfs"],
            )

    return map_batches(rows.select("id", "text"), count, "id long, n long, terms array<string>, tfs array<int>")


@dataclass(frozen=True)
class Index:
    """``postings``: (m, slice, term, tf, docs); the row of a slice without a term lists its doc_ids, and ``docs`` of the others
    are places in that list. ``strata``: (m, docs, slices). ``n_docs`` and ``n_terms``: documents with a term, and all terms."""

    postings: DataFrame
    strata: DataFrame
    n_docs: int
    n_terms: int


def _invert(key: tuple, group: pa.Table) -> pa.Table:
    """Postings of one slice. Places follow the doc_ids, null last."""
    group = group.combine_chunks().sort_by([("id", "ascending")])
    terms, tfs = (group.column(c).combine_chunks() for c in ("terms", "tfs"))
    sizes = np.diff(np.asarray(terms.offsets))
    place = np.repeat(np.arange(group.num_rows), sizes)
    coded, tf = terms.flatten().dictionary_encode(), tfs.flatten().to_numpy()
    code = coded.indices.to_numpy()
    order = np.lexsort((place, tf, code))
    code, tf, place = code[order], tf[order], place[order]
    head = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])])
    begin = np.r_[0, len(head) and head + group.num_rows, len(place) + group.num_rows].astype(np.int32)
    docs = pa.concat_arrays([group.column("id").combine_chunks(), pa.array(place, pa.int64())])
    rows = len(head) + 1
    names = pa.concat_arrays([pa.array([None], pa.string()), coded.dictionary.take(pa.array(code[head]))])
    m, part = (k.as_py() for k in key)
    give_back()
    return pa.table({
        "m": pa.array(np.full(rows, m, np.int64)), "slice": pa.array(np.full(rows, part, np.int32)), "term": names,
        "tf": pa.array(np.r_[0, tf[head]], pa.int32()), "docs": pa.ListArray.from_arrays(pa.array(begin), docs),
    })


def build_index(docs: DataFrame) -> Index:
    """Index of all terms of ``docs(doc_id, text)``. Null texts and texts without a term are not in it; rows that repeat a
    doc_id, or have none, are documents of their own. Other columns are not read. Texts of any length are split in slices
    of 1 MB; the distinct terms of one text are held by one task."""
    counted = keep(term_counts(docs.select(F.col("doc_id").cast("long").alias("id"), "text")), "terms")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"50 + (cast(50 as decimal(38,0)) * n * {n_docs}) div {max(n_terms, 1)}").cast("long")
    rows = counted.withColumn("m", m)
    sizes = rows.groupBy("m").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("terms")).alias("postings"))
    strata = keep(sizes.select("m", "docs", F.ceil(F.col("postings") / SLICE_POSTINGS).cast("int").alias("slices")), "strata")
    rows = rows.join(small(strata.select("m", "slices")), "m")
    part = F.pmod(F.xxhash64("id", "terms"), F.col("slices")).cast("int")
    sliced = rows.select("m", part.alias("slice"), "id", "terms", "tfs")
    postings = sliced.groupBy("m", "slice").applyInArrow(_invert, "m long, slice int, term string, tf int, docs array<long>")
    return Index(keep(postings, "postings"), strata, n_docs, n_terms)


class _Items:
    """Terms and weights of a block of items, as tasks need them."""

    def __init__(self, table: pa.Table):
        self.codes = {t: i for i, t in enumerate(sorted(set(table.column("term").to_pylist())))}
        item = table.column("item").to_numpy()
        code = np.array([self.codes[t] for t in table.column("term").to_pylist()], np.int64)
        order = np.lexsort((code, item))
        self.item, self.code, self.weight = item[order], code[order], table.column("w").to_numpy()[order]
        self.head = np.flatnonzero(np.r_[True, self.item[1:] != self.item[:-1]])
        self.span = dict(zip(self.item[self.head].tolist(), zip(self.head, np.r_[self.head[1:], len(self.item)], strict=True), strict=True))


def impact(m: int, tf: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 20 * m)


def _bounds(shared, key: tuple, group: pa.Table) -> pa.Table:
    """Bound of one stratum for every item of the block."""
    items, m = shared.value, key[0].as_py()
    top = np.zeros(len(items.codes), np.int64)
    top[[items.codes[t] for t in group.column("term").to_pylist()]] = impact(m, group.column("tf").to_numpy())
    bound = np.add.reduceat(items.weight * top[items.code], items.head)
    some = np.flatnonzero(bound)
    return pa.table({
        "item": pa.array(items.item[items.head][some]), "m": pa.array(np.full(len(some), m, np.int64)), "bound": pa.array(bound[some]),
    })


def _scores(shared, k: int, key: tuple, group: pa.Table, visits: pa.Table) -> pa.Table:
    """Best k documents of one slice for every item that visits it, of those with at least the score ``least``."""
    items, m = shared.value, key[0].as_py()
    found: list[tuple] = []
    if group.num_rows and visits.num_rows:
        group = group.combine_chunks()
        terms = group.column("term").to_pylist()
        docs = group.column("docs").combine_chunks()
        begin, flat = np.asarray(docs.offsets), docs.values
        of_docs = terms.index(None)
        ids = flat.slice(begin[of_docs], begin[of_docs + 1] - begin[of_docs])
        flat = flat.fill_null(0).to_numpy()
        levels, tf = np.unique(group.column("tf").to_numpy(), return_inverse=True)
        once = impact(m, levels)[tf]
        lists: dict[int, list] = {}
        for row, term in enumerate(terms):
            if term is not None:
                lists.setdefault(items.codes[term], []).append((flat[begin[row] : begin[row + 1]], once[row]))
        joined = {c: (np.concatenate([d for d, _ in x]), np.repeat([i for _, i in x], [len(d) for d, _ in x])) for c, x in lists.items()}
        for item, least in zip(visits.column("item").to_pylist(), visits.column("least").to_pylist(), strict=True):
            score, (lo, hi) = np.zeros(len(ids), np.int64), items.span[item]
            for code, weight in zip(items.code[lo:hi].tolist(), items.weight[lo:hi].tolist(), strict=True):
                if code in joined:
                    places, impacts = joined[code]
                    score[places] += weight * impacts  # a document has one frequency of a term
            best = np.flatnonzero(score >= max(least, 1))
            if len(best) > k:
                best = best[np.lexsort((best, -score[best]))[:k]]
            if len(best):
                found.append((np.full(len(best), item), ids.take(pa.array(best)), score[best]))
    give_back()
    return pa.table({
        "item": pa.array(np.concatenate([x for x, _, _ in found]) if found else [], pa.int64()),
        "doc_id": pa.concat_arrays([x for _, x, _ in found]) if found else pa.array([], pa.int64()),
        "score": pa.array(np.concatenate([x for _, _, x in found]) if found else [], pa.int64()),
    })


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: Index, terms: DataFrame, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of a block of items ``terms(item, term, w)``."""
    spark = terms.sparkSession
    shared = spark.sparkContext.broadcast(_Items(terms.toArrow()))
    vocabulary = small(keep(terms.select("term").distinct(), "vocabulary"))
    hits = index.postings.join(vocabulary, "term", "left_semi")
    tops = hits.groupBy("m", "term").agg(F.max("tf").alias("tf"))
    bounds = tops.groupBy("m").applyInArrow(lambda key, group: _bounds(shared, key, group), "item long, m long, bound long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.join(index.strata, "m").withColumn("before", F.coalesce(F.sum("docs").over(order), F.lit(0)))
    bounds = keep(bounds, "bounds")

    best, seen, upto = None, -1, FIRST_DOCS
    while True:
        least = F.lit(0).cast("long")
        todo = bounds.where(F.col("before") > seen)
        if best is not None:
            last = best.where(F.col("rank") == k).select("item", F.col("score").alias("kth"))
            todo, least = todo.join(last, "item", "left"), F.coalesce("kth", F.lit(0))
        todo = keep(todo.select("item", "m", "slices", "before", "bound", least.alias("least")).where("bound >= least"), "open")
        if todo.isEmpty():
            break
        visits = todo.where(F.col("before") <= upto)
        visited = small(keep(visits.select("m").distinct(), "visited"))
        visits = visits.select("item", "m", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "least")
        rows = hits.unionByName(index.postings.where("term is null")).join(visited, "m", "left_semi")
        found = rows.groupBy("m", "slice").cogroup(visits.groupBy("m", "slice")).applyInArrow(
            lambda key, group, asks: _scores(shared, k, key, group, asks), "item long, doc_id long, score long"
        )
        found = found if best is None else found.union(best.select("item", "doc_id", "score"))
        best = keep(_best(found, k), "best")
        seen, upto = upto, upto * GROWTH
    return best if best is not None else spark.createDataFrame([], "item long, doc_id long, score long, rank int")


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item of ``items(item_id, text)`` with a score above 0.

    N, L, df, n, tf and m are those of the index (m = 50 + (50 n N) div L); a term weighs
    w = floor(1000 ln((2 N + 2) / (2 df + 1))), a document scores the sum of w ((10^9 tf) div (1000 tf + 20 m)) over the
    distinct terms of the item. Equal scores rank by doc_id, null last. Rows that repeat an item_id, or have none, are
    one item with the terms of all of them. Null texts, items and an index without terms find nothing. Other columns
    are not read. Items are searched in blocks of ``BLOCK_TERMS`` terms, whose terms every task holds; results do not
    depend on the blocks, rounds or slices.
    """
    spark = items.sparkSession
    counted = term_counts(items.select(F.col("item_id").cast("long").alias("id"), "text"))
    asked = keep(counted.select(F.col("id").alias("item_id"), F.explode("terms").alias("term")).distinct(), "asked")
    schema = "item_id long, rank int, doc_id long, score long"
    words = asked.count()
    if not words or not index.n_docs:
        return spark.createDataFrame([], schema)
    names = asked.select("item_id").distinct()
    numbered = keep(names.select("item_id", F.coalesce("item_id", F.lit(-(2**63))).alias("item")), "items")
    asked = asked.withColumn("item", F.coalesce("item_id", F.lit(-(2**63))))
    used = small(keep(asked.select("term").distinct(), "used"))
    df = index.postings.join(used, "term", "left_semi").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * index.n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    terms = keep(asked.join(df, "term").select("item", "term", weight.alias("w")), "weights")
    blocks = -(-words // BLOCK_TERMS)
    results = []
    for block in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        if not part.isEmpty():
            results.append(_search_block(index, part, k))
    if not results:
        return spark.createDataFrame([], schema)
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found.join(numbered, "item").select("item_id", "rank", "doc_id", "score")


#: The same ranks without an index.
SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
), counts as (select doc_id, term, count(*) as tf from words group by all
), lengths as (select doc_id, sum(tf)::hugeint as n from counts group by all
), whole as (select count(*)::hugeint as docs, sum(n)::hugeint as terms from lengths
), strata as (select doc_id, (50 + (50 * n * docs) // terms)::bigint as m from lengths, whole
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), weights as (
  select term, floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * count(*) + 1)))::bigint as w from counts, whole group by term, docs
), scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from asked join weights using (term) join counts using (term) join strata using (doc_id) group by all
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50
"""
