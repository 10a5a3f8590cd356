"""Benchmark decontamination by canonical templates, in DataFrame functions only.

Names, numbers and units of a text become typed placeholders, so a question keeps its template when its parameters are
changed. Windows of the template are joined by hash with the windows of the benchmark items. Where windows line up, the
values in the slots must map consistently from the item to the document; then the document holds the item, unchanged
or with new parameters.

A capitalised word at the start of a sentence may be a name or a plain word, so texts are compared in two readings: in
the first it is a word, in the second a name. A word that the benchmark also has in lower case, and that the item has
nowhere inside a sentence as a name, must be the same in both texts of the second reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, small

#: Tokens of a window.
WINDOW = 8

#: Share of an item's windows that a document must hold.
SHARE = 0.5

#: Units after a number.
UNITS = (
    "%|percent|dollars?|euros?|pounds?|cents?|km|cm|mm|metres?|meters?|miles?|feet|foot|inch(?:es)?|kg|grams?|mg|tons?|"
    "seconds?|minutes?|hours?|days?|weeks?|months?|years?|litres?|liters?|ml|degrees?"
)

# Marks in front of names and units, and the placeholders; private characters, which are taken out of the text first.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
# Names at the start of a sentence, and those whose first word must stay.
START, PLAIN = "\ue004", "\ue005"

#: Words besides placeholders that a window of an item must hold in the second reading.
LEAST_LITERAL = 2

_WORD = "[\\p{L}\\p{N}]"
_CAPITAL = "\\p{Lu}[\\p{L}]*+(?: \\p{Lu}[\\p{L}]*+)*+"


def tokens(text: Column) -> Column:
    """Tokens of a text in the second reading. A run of capitalised words is one token, marked as name inside a sentence
    and as start elsewhere; in a start the mark of a name stands in front of the part that is a name in both readings. A unit
    behind a number is marked as unit; a number is one token."""
    plain = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT + START + PLAIN, "")
    # both begin with one character that few places have: a look behind at every place costs more
    named = F.regexp_replace(plain, f" (?<=[\\p{{L}}\\p{{N}},;:] )({_CAPITAL})", f" {NAME}$1")
    marked = F.regexp_replace(named, f"(?i)([0-9] ?)({UNITS})(?![\\p{{L}}\\p{{N}}])", f"$1{UNIT}$2")
    begun = f"\\p{{Lu}}\\p{{L}}*+(?![\\p{{L}}\\p{{N}}])(?: {NAME}{_CAPITAL})?+"
    each = f"{NAME}{_CAPITAL}|{UNIT}(?:%|\\p{{L}}++)|[0-9]++(?:[.,:/-][0-9]++)*+|{begun}|{_WORD}++"
    words = F.regexp_extract_all(marked, F.lit(each), F.lit(0))
    return F.transform(words, lambda w: F.when(F.substring(w, 1, 1) != F.lower(F.substring(w, 1, 1)), F.concat(F.lit(START), w)).otherwise(w))


def first_reading(words: Column) -> Column:
    """Tokens in which the word at the start of a sentence is a word and the rest of its run a name."""

    def parts(word: Column) -> Column:
        bare = F.substring(word, 2, 1 << 30)
        split = F.when(F.instr(bare, f" {NAME}") > 0, F.split(bare, f" (?={NAME})")).otherwise(F.array(bare))
        return F.when(F.substring(word, 1, 1) == START, split).otherwise(F.array(word))

    return F.flatten(F.transform(words, parts))


def _form(word: Column) -> Column:
    first = F.substring(word, 1, 1)
    placeholder = F.when(first.isin(NAME, START, PLAIN), NAME).when(first == UNIT, UNIT).when(first.between("0", "9"), NUMBER)
    return F.coalesce(placeholder, F.lower(word))


def canonical(words: Column) -> Column:
    """Tokens with placeholders for names, numbers and units; other words in lower case."""
    return F.transform(words, _form)


def _first_word(word: Column) -> Column:
    """First word of a name, without marks, in lower case."""
    return F.lower(F.substring_index(F.translate(word, NAME + START + PLAIN, ""), " ", 1))


def _hold_plain(rows: DataFrame) -> DataFrame:
    """Rows of items in whose ``words`` the starts that begin with a plain word are marked so."""
    each = rows.select("item_id", F.explode("words").alias("word"))
    mark = F.substring("word", 1, 1)
    lower = each.where(~mark.isin(NAME, START, UNIT) & ~mark.between("0", "9")).select(F.lower("word").alias("first")).distinct()
    starts = each.where(mark == START).select("item_id", _first_word(F.col("word")).alias("first")).distinct()
    names = each.where(mark == NAME).select("item_id", _first_word(F.col("word")).alias("first")).distinct()
    plain = starts.join(lower, "first", "left_semi").join(names, ["item_id", "first"], "left_anti")
    rows = rows.join(plain.groupBy("item_id").agg(F.collect_set("first").alias("plain")), "item_id", "left")

    def one(word: Column) -> Column:
        stays = (F.substring(word, 1, 1) == START) & F.coalesce(F.array_contains("plain", _first_word(word)), F.lit(False))
        return F.when(stays, F.concat(F.lit(PLAIN), F.substring(word, 2, 1 << 30))).otherwise(word)

    return rows.withColumn("words", F.transform("words", one)).drop("plain")


def _starts(size: Column, window: Column | int) -> Column:
    """Places (from 1) at which windows begin; a text that is shorter than a window has none."""
    last = size - window + 1
    return F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(1))).otherwise(F.array().cast("array<int>"))


def _codes(words: Column) -> Column:
    """Hashes of the canonical tokens: every token is hashed once and not by each of its windows."""
    return F.transform(words, lambda w: F.xxhash64(_form(w)))


def _key_at(codes: Column, at: Column, window: Column | int, reading: Column) -> Column:
    return F.xxhash64(F.slice(codes, at, window), reading)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, reading, width, at, key, n_windows, item_words) of all windows of all items in both readings. An item with
    fewer tokens than a window is one window of its own width; an item without tokens has none."""
    rows = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("words"))
    rows = keep(rows.distinct(), "items")
    rows = rows.select("item_id", F.lit(1).alias("reading"), first_reading(F.col("words")).alias("words")).union(
        _hold_plain(rows).select("item_id", F.lit(2).alias("reading"), "words")
    )
    rows = rows.withColumn("codes", _codes(F.col("words"))).withColumn("size", F.size("words")).where("size > 0")
    rows = rows.withColumn("width", F.least("size", F.lit(window)))
    rows = rows.select("*", F.explode(_starts(F.col("size"), F.col("width"))).alias("at"))
    rows = rows.select(
        "item_id", "reading", "width", "at", _key_at(F.col("codes"), F.col("at"), F.col("width"), F.col("reading")).alias("key"),
        (F.col("size") - F.col("width") + 1).alias("n_windows"), F.slice("words", "at", "width").alias("item_words"),
    )
    literal = F.filter("item_words", lambda w: ~F.substring(w, 1, 1).isin(NAME, START, UNIT) & ~F.substring(w, 1, 1).between("0", "9"))
    return rows.where((F.col("reading") == 1) | (F.size(literal) >= LEAST_LITERAL))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_windows, matched, n_slots, changed) of the documents that hold a benchmark item.

    ``matched``: windows of the item found at consistent places; at least ``share`` of ``n_windows``. ``n_slots`` counts the
    distinct placeholder values of the item there and ``changed`` those with another value in the document. A place
    is the distance between window and item; it is consistent if each value of the item stands for one value.

    Null or empty texts hold nothing; null ids are not reported. Rows that repeat a doc_id are one document; repeated
    items are one item. Items shorter than a window must be held whole. Other columns are not read; empty tables give
    no rows. The windows of the benchmark are broadcast only if their measured size allows it.
    """
    items = keep(item_windows(benchmark, window), "item-windows")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most ``window`` numbers
    keys = small(keep(items.select("key").distinct(), "item-keys"))
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not widths:
        return rows.limit(0).select(
            "doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("n_windows"), F.lit(0).cast("long").alias("matched"),
            F.lit(0).alias("n_slots"), F.lit(0).alias("changed"),
        )

    def windows(text: DataFrame, carried: list[str]) -> DataFrame:
        read = text.withColumn("second", tokens(F.col("text"))).withColumn("first", first_reading(F.col("second")))
        both = [F.struct(F.lit(n).alias("reading"), F.col(c).alias("words"), _codes(F.col(c)).alias("codes")) for n, c in ((1, "first"), (2, "second"))]
        forms = read.select("doc_id", F.explode(F.array(*both)).alias("r")).select("doc_id", "r.*")
        # nothing interpreted from here on: a row of every place would hold a copy of its text
        begun = forms.select(*carried, "codes", F.explode(_starts(F.size("codes"), widths[0])).alias("at"))
        begun = begun.select("*", F.explode(F.array(*[F.lit(w) for w in widths])).alias("width")).where("at + width - 1 <= size(codes)")
        return begun.select(*carried, "at", "width", _key_at(F.col("codes"), F.col("at"), F.col("width"), F.col("reading")).alias("key"))

    looked = windows(rows, ["doc_id", "reading"])
    candidates = small(keep(looked.join(keys, "key", "left_semi").select("doc_id").distinct(), "candidates"))
    near = rows.join(candidates, "doc_id", "left_semi").distinct()
    found = windows(near, ["doc_id", "reading", "words"])
    found = found.join(keys, "key", "left_semi").withColumn("words", F.slice("words", F.col("at"), F.col("width")))
    met = found.join(small(items.withColumnRenamed("at", "item_at")), ["reading", "key", "width"])

    both = F.arrays_zip(F.col("item_words").alias("item"), F.col("words").alias("doc"))
    mark = lambda p: F.substring(p["item"], 1, 1)
    alone = lambda w: F.instr(w, " ") == 0
    other = lambda p: (_first_word(p["item"]) != _first_word(p["doc"])) | (alone(p["item"]) != alone(p["doc"]))
    met = met.withColumn("pairs", both).where(~F.exists("pairs", lambda p: (mark(p) == PLAIN) & other(p)))

    def value(word: Column, item: Column) -> Column:
        bare = F.translate(word, NAME + START + PLAIN, "")
        return F.when(F.substring(item, 1, 1) == PLAIN, F.substring(bare, F.instr(bare, " ") + 1, F.length(bare))).otherwise(bare)

    slots = F.filter("pairs", lambda p: mark(p).isin(NAME, START, UNIT) | mark(p).between("0", "9") | ((mark(p) == PLAIN) & ~alone(p["item"])))
    slots = F.transform(slots, lambda p: F.struct(value(p["item"], p["item"]).alias("item"), value(p["doc"], p["item"]).alias("doc")))
    met = met.select("doc_id", "item_id", "reading", "n_windows", "item_at", (F.col("at") - F.col("item_at")).alias("place"), slots.alias("slots"))
    lined = met.groupBy("doc_id", "item_id", "reading", "n_windows", "place").agg(
        F.collect_set("item_at").alias("held"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")
    )
    lined = lined.where(F.size("slots") == F.size(F.array_distinct(F.col("slots.item"))))
    joined = lined.groupBy("doc_id", "item_id", "reading", "n_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("held")))).cast("long").alias("matched"),
        F.max(F.size("slots")).alias("n_slots"),
        F.max(F.size(F.filter("slots", lambda s: s["item"] != s["doc"]))).alias("changed"),
    )
    enough = joined.where(F.col("matched") >= share * F.col("n_windows"))
    best = enough.groupBy("doc_id", "item_id").agg(F.min(F.struct("reading", "n_windows", "matched", "n_slots", "changed")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_windows", "best.matched", "best.n_slots", "best.changed")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with the columns they have. Rows without doc_id stay."""
    gone = small(keep(contaminated(docs, benchmark, **options).select("doc_id").distinct(), "contaminated"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.join(gone, F.col("row.doc_id").cast("long") == F.col("doc_id"), "left_anti").select("row.*")
