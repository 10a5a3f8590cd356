"""Phrase collocations from depth-truncated suffix subtrees.

Every place of a text begins a suffix of at most five words. Suffixes are grouped by their first words (vertical
partitioning): a prefix that heads few different suffixes joins a group within the memory budget, a prefix with more is made one word
longer, and so on. Each group is one task that sorts its suffixes and reads the counts of all phrases from the totals
of the leaves below them; no group needs another one.

Two filters keep rare suffixes at home: a bitmap of frequent words and one of frequent word pairs. Their size is
fixed; a place that they let through wrongly costs a row, none is lost, because counts are taken from the suffixes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shingles as sh
from .shared import give_back, keep, map_batches, small

#: Words of the longest phrase.
DEPTH = 5

#: Different suffixes that one task holds at once (a group holds at most two times as many).
BUDGET = 500_000

#: Bits of a filter, as a power of two: 16 MB.
FILTER = 27

#: Parts in which the best phrases of a language are looked for first.
SALTS = 64

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_PAIR = sh.U64(0x9E6C63D0876A9A47)
WORDS = [f"w{i}" for i in range(1, DEPTH + 1)]


class Batch:
    """Words of an Arrow batch (lang, text): their numbers, which differ between languages, and pieces."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        langs = batch.column(0).fill_null("und").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.data, offsets = sh.buffers(batch.column(1))
        hashes, self.starts, self.lengths = sh.located_words(self.data, offsets, _SEPARATOR)
        row = np.searchsorted(offsets, self.starts, "right") - 1
        lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
        breaks = np.flatnonzero(_BREAK[self.data[lo:hi]]) + lo
        self.piece = np.searchsorted(breaks, self.starts) + row
        salts = [int.from_bytes(hashlib.blake2b(f"{seed} {x}".encode(), digest_size=8).digest(), "little") for x in self.langs]
        self.lang = langs.indices.to_numpy()[row]
        self.ids = sh.mix(hashes ^ np.array(salts, sh.U64)[self.lang]) | sh.U64(1)  # 0 stands for no word
        del hashes

    def pairs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pairs that begin at every word but the last, and whether a pair is inside a piece and of frequent words."""
        frequent = has(words, self.ids)
        inside = (self.piece[1:] == self.piece[:-1]) & frequent[1:] & frequent[:-1]
        return sh.mix(self.ids[:-1] * _PAIR + self.ids[1:]), inside


def has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of the keys are set."""
    place = keys >> sh.U64(64 - FILTER)
    return (bitmap[(place >> sh.U64(6)).astype(np.int64)] >> (place & sh.U64(63))) & sh.U64(1) == 1


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the column ``key``: at most 2^FILTER bits, whatever the number of keys."""
    place = F.shiftrightunsigned("key", 64 - FILTER)
    rows = keys.select(F.shiftright(place, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("bit"))
    table = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER - 6), np.int64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return out.view(sh.U64)


def _over(rows: DataFrame, function: Callable[[Batch], list[pa.Array]], schema: str, seed: int) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Batch(batch, seed)
            if len(words.ids):
                yield pa.RecordBatch.from_arrays(function(words), names)

    return map_batches(rows, run, schema)


def _word_counts(batch: Batch) -> list[pa.Array]:
    ids, first, n = np.unique(batch.ids, return_index=True, return_counts=True)
    data = batch.data
    texts = [data[a : a + z].tobytes().translate(_FOLD) for a, z in zip(batch.starts[first].tolist(), batch.lengths[first].tolist(), strict=True)]
    langs = pa.DictionaryArray.from_arrays(pa.array(batch.lang[first], pa.int32()), pa.array(batch.langs, pa.string())).cast(pa.string())
    return [langs, pa.array(ids.view(np.int64)), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]


def _pair_counts(batch: Batch, words: np.ndarray) -> list[pa.Array]:
    keys, inside = batch.pairs(words)
    keys, n = np.unique(keys[inside], return_counts=True)
    return [pa.array(keys.view(np.int64)), pa.array(n, pa.int64())]


def _suffixes(batch: Batch, words: np.ndarray, pairs: np.ndarray) -> list[pa.Array]:
    """Words of the suffixes that begin with a frequent pair, cut in front of the first pair that is not frequent."""
    keys, inside = batch.pairs(words)
    go = inside & has(pairs, keys)
    at = np.flatnonzero(go)
    go = np.concatenate([go, np.zeros(DEPTH, bool)])
    ids = np.concatenate([batch.ids, np.zeros(DEPTH, sh.U64)])
    columns, open_ = [ids[at]], np.ones(len(at), bool)
    for i in range(1, DEPTH):
        open_ = open_ & go[at + i - 1]
        columns.append(np.where(open_, ids[at + i], sh.U64(0)))
    return [pa.array(c.view(np.int64)) for c in columns]


def vocabulary(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, int]:
    """(id, lang, word, f) of all words of ``docs(lang, text)``, and the seed of the numbering: another one is taken if two words
    should have the same number."""
    while True:
        counted = _over(docs, _word_counts, "lang string, id long, word string, n long", seed)
        named = F.struct("lang", "word")
        words = keep(counted.groupBy("id").agg(F.sum("n").alias("f"), F.min(named).alias("a"), F.max(named).alias("z")), "words")
        if words.where("a <> z").isEmpty():
            return words.select("id", "a.lang", "a.word", "f"), seed
        seed += 1


def suffixes(docs: DataFrame, words: DataFrame, seed: int, least: int) -> DataFrame:
    """(w1, .. w5, n): the different suffixes that begin with a frequent pair; 0 behind their end."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(bitmap(words.where(F.col("f") >= least).select(F.col("id").alias("key"))))
    counted = _over(docs, lambda b: _pair_counts(b, frequent.value), "key long, n long", seed)
    counted = counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    pairs = spark.sparkContext.broadcast(bitmap(counted.select("key")))
    found = _over(docs, lambda b: _suffixes(b, frequent.value, pairs.value), ", ".join(f"{w} long" for w in WORDS), seed)
    return keep(found.groupBy(*WORDS).agg(F.count(F.lit(1)).alias("n")), "suffixes")


def _subtrees(least: int, key: tuple, group: pa.Table) -> pa.Table:
    """Phrases of one group with their counts, from its suffixes in order."""
    columns = [group.column(w).to_numpy() for w in WORDS]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    n = group.column("n").to_numpy()[order]
    depth = max(2, group.column("depth")[0].as_py())
    new = np.zeros(len(n), bool)
    new[:1] = True
    found = []
    for i, column in enumerate(columns, 1):
        new[1:] |= column[1:] != column[:-1]
        if i < depth:
            continue
        heads = np.flatnonzero(new)
        total = np.add.reduceat(n, heads)
        good = (total >= least) & (column[heads] != 0)
        heads = heads[good]
        found.append([c[heads] if j < i else np.zeros(len(heads), np.int64) for j, c in enumerate(columns)] + [total[good]])
    give_back()
    return pa.table({c: pa.array(np.concatenate([f[i] for f in found]), pa.int64()) for i, c in enumerate([*WORDS, "f"])})


def phrase_counts(leaves: DataFrame, least: int, budget: int = BUDGET) -> DataFrame:
    """(w1, .. w5, f) of the phrases of 2 to 5 words that occur at least ``least`` times."""
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pending, grouped, inner = leaves, [], []
    for depth in range(1, DEPTH + 1):
        prefix = WORDS[:depth]
        held = keep(pending.groupBy(*prefix).agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("f")), "prefixes")
        light = held.where(F.col("held") <= budget).withColumn("part", F.pmod(F.xxhash64(*prefix), F.lit(parts)))
        filled = Window.partitionBy("part").orderBy(*prefix).rowsBetween(Window.unboundedPreceding, -1)
        number = F.floor(F.coalesce(F.sum("held").over(filled), F.lit(0)) / budget)
        light = light.select(*prefix, F.struct(F.lit(depth).alias("depth"), "part", number.alias("number")).alias("group"))
        grouped.append(pending.join(small(keep(light, "groups")), prefix).select("group", F.lit(depth).alias("depth"), *WORDS, "n"))
        heavy = keep(held.where(F.col("held") > budget), "heavy")
        if heavy.isEmpty():
            break
        if depth > 1:
            rest = [F.lit(0).cast("long").alias(w) for w in WORDS[depth:]]
            inner.append(heavy.where((F.col("f") >= least) & (F.col(prefix[-1]) != 0)).select(*prefix, *rest, "f"))
        pending = pending.join(small(heavy.select(*prefix)), prefix, "left_semi").select(*leaves.columns)
    rows = reduce(DataFrame.unionByName, grouped)
    schema = ", ".join(f"{c} long" for c in [*WORDS, "f"])
    trees = rows.groupBy("group").applyInArrow(lambda key, group: _subtrees(least, key, group), schema)
    return reduce(DataFrame.unionByName, inner, trees)


def collocations(docs: DataFrame, least: int = 100, inside: int = 100, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of every language of ``docs(lang, text)``.

    A-Z are lower-cased. Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``. n counts
    all words of a language (null: ``und``). A phrase of 2 to 5 words with a >= ``least`` occurrences inside pieces is a
    candidate; cut into parts with l and r occurrences it scores floor(1000 a n / (l r)), and its lowest score
    counts, of equal ones that with the shortest first part. A candidate inside a longer one with at least ``inside`` percent
    of its occurrences is dropped. Ranks follow score and a, both descending, and the phrase in byte order.

    Null and empty texts have no words. Rows that repeat are counted each time. Other columns are not read; an empty table
    gives no rows. Texts of any length are split in slices of 1 MB; a task holds the numbers of the words of one text.
    ``budget``: different suffixes that one task holds; results do not depend on it.
    """
    docs = docs.select("lang", "text")
    words, seed = vocabulary(docs)
    langs = keep(words.groupBy("lang").agg(F.sum("f").alias("n")), "langs")
    frequent = words.where(F.col("f") >= least)
    nodes = phrase_counts(suffixes(docs, words, seed, least), least, budget)
    key = F.filter(F.array(*WORDS), lambda w: w != 0)
    nodes = nodes.select(key.alias("key"), F.col("f").alias("a"))
    named = frequent.select(F.array("id").alias("first"), "lang")
    nodes = nodes.withColumn("first", F.slice("key", 1, 1)).join(small(keep(named, "named")), "first").drop("first")
    nodes = keep(nodes.withColumn("size", F.size("key")), "phrases")

    parts = nodes.select("key", F.col("a").alias("f")).union(frequent.select(F.array("id"), "f"))
    parts = small(keep(parts, "parts"))
    cuts = nodes.select("key", "lang", "a", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    left = parts.select(F.col("key").alias("left"), F.col("f").alias("l"))
    right = parts.select(F.col("key").alias("right"), F.col("f").alias("r"))
    cuts = cuts.withColumns({"left": F.expr("slice(key, 1, k)"), "right": F.expr("slice(key, k + 1, size - k)")})
    cuts = cuts.join(left, "left").join(right, "right").join(small(langs), "lang")
    exact = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)")
    cuts = cuts.withColumn("score", exact)
    scored = cuts.groupBy("key", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = F.expr("flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> slice(key, i, s))))")
    longer = nodes.where("size > 2").select(F.explode(spans).alias("key"), F.col("a").alias("longer"))
    longer = longer.groupBy("key").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, "key", "left").where(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True)))
    kept = kept.select("key", "lang", "a", "n", "cut.score", "cut.l", "cut.r")

    order = [F.desc("score"), F.desc("a")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= top)
    best = keep(salted.drop("salt", "place"), "best")
    spelled = best.select("key", F.posexplode("key").alias("at", "id")).join(frequent.select("id", "word"), "id")
    spelled = _spelled(spelled)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    ranked = best.join(spelled, "key").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _spelled(words: DataFrame) -> DataFrame:
    """(key, phrase) from ``words(key, at, word)``."""
    listed = words.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    return listed.select("key", F.array_join(F.col("words.word"), " ").alias("phrase"))


#: The same counts from all runs of words.
SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents
), lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces
), totals as (select lang, sum(len(ws))::hugeint as n from lists group by all
), runs as (
  select lang, s as size, unnest(list_transform(range(1, len(ws) - s + 2), lambda i: ws[i : i + s - 1])) as words
  from lists, (select unnest([1, 2, 3, 4, 5]) as s) where len(ws) >= s
), counts as (
  select lang, size, words, count(*)::hugeint as f from runs group by all having count(*) >= 100
), cuts as (
  select c.lang, c.words, c.size, c.f as a, l.f as l, r.f as r, n, k, (1000 * c.f * n) // (l.f * r.f) as score
  from counts c, (select unnest([1, 2, 3, 4]) as k), totals t, counts l, counts r
  where c.size >= 2 and k < c.size and t.lang = c.lang
    and l.lang = c.lang and l.words = c.words[1 : k] and r.lang = c.lang and r.words = c.words[k + 1 :]
), scored as (
  select lang, words, size, a, n, arg_min(l, score * 10 + k) as l, arg_min(r, score * 10 + k) as r, min(score) as score
  from cuts group by all
), inner_runs as (
  select lang, f, unnest(list_transform(range(1, size - s + 2), lambda i: words[i : i + s - 1])) as words
  from counts, (select unnest([2, 3, 4]) as s) where s < size
), longer as (select lang, words, max(f) as f from inner_runs group by all
), kept as (
  select s.*, array_to_string(s.words, ' ') as phrase from scored s left join longer o on o.lang = s.lang and o.words = s.words
  where o.f is null or 100 * o.f < 100 * s.a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase collate "C") as rank from kept
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""
