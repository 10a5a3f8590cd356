"""Line removal with a tree of log templates, in DataFrame functions only.

A line falls through a tree of fixed depth: number of tokens, then its leading tokens, with tokens that hold a digit or an @
already replaced by a placeholder. Inside a leaf a token stays constant at its place if it recurs there in enough
documents and is generalised otherwise. Lines with the same constants share a template. A template recurs if enough
documents hold it and enough of its tokens are constant; its lines are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep, small

#: Leading tokens that select a leaf, documents that make a token or template recur, least share of constant tokens.
DEPTH, DOCUMENTS, CONSTANT = 3, 10, 0.6

#: A document of which recurring lines make up more than this share of the characters is a copy, not a document with
#: boilerplate; its lines stay and near-duplicate removal decides.
WHOLE = 0.9

VARIABLE = "<*>"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, size, masked) of every line that is not blank. ``text_key`` tells rows apart that
    repeat a doc_id with another text."""
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.select("doc_id", "text_key", "line_no", F.trim("line").alias("line")).where("line <> ''")
    masked = F.regexp_replace("line", "(?<![^ \t])[^ \t0-9@]*+[0-9@][^ \t]*+", VARIABLE)
    return rows.select("doc_id", "text_key", "line_no", F.length("line").cast("long").alias("size"), masked.alias("masked"))


def _leaf(masked, depth: int):
    """Key of the leaf of a masked line."""
    tokens = F.split(masked, " ")
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, depth))


def templates(docs: DataFrame, depth: int = DEPTH, documents: int = DOCUMENTS, constant: float = CONSTANT) -> tuple[DataFrame, DataFrame]:
    """(lines, templates): ``lines(doc_id, text_key, line_no, size, leaf, line_key)`` of all documents and
    ``templates(leaf, line_key, template, n_documents)`` of the masked lines whose template recurs.

    Texts are not shuffled: the first pass counts documents per leaf, the second goes back to the texts for the lines
    of leaves with enough documents and reduces them to distinct masked lines before their tokens are taken apart.
    """
    lines = _lines(docs).withColumns({"leaf": _leaf(F.col("masked"), depth), "line_key": F.xxhash64("masked", F.lit(1))})
    keys = keep(lines.drop("masked"), "line-keys")
    often = keys.select("leaf", "doc_id").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("held"))
    often = small(keep(often.where(F.col("held") >= documents).select("leaf"), "leaves"))
    chosen = lines.join(often, "leaf", "left_semi").select("leaf", "line_key", "masked", "doc_id").distinct()
    distinct = keep(chosen.groupBy("leaf", "line_key", "masked").agg(F.count(F.lit(1)).alias("weight")), "masked-lines")

    tokens = distinct.select("leaf", "line_key", "weight", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    support = tokens.groupBy("leaf", "place", "token").agg(F.sum("weight").alias("support")).where(F.col("support") >= documents)
    fixed = (F.col("support").isNotNull() & (F.col("token") != VARIABLE)) | (F.col("place") < depth)
    tokens = tokens.join(support, ["leaf", "place", "token"], "left").select(
        "leaf", "line_key", "place", F.when(fixed, F.col("token")).otherwise(VARIABLE).alias("token")
    )
    parts = F.array_sort(F.collect_list(F.struct("place", "token")))
    general = tokens.groupBy("leaf", "line_key").agg(parts.alias("parts")).withColumn("words", F.col("parts.token"))
    kept = F.size(F.filter("words", lambda t: t != VARIABLE)) / F.size("words")
    general = general.where(kept >= constant).select("leaf", "line_key", F.concat_ws(" ", "words").alias("template"))
    general = keep(general, "templates")

    held = keys.select("leaf", "line_key", "doc_id").distinct().join(small(general), ["leaf", "line_key"])
    held = held.select("leaf", "template", "doc_id").distinct().groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n_documents"))
    recurring = general.join(held.where(F.col("n_documents") >= documents), ["leaf", "template"])
    return keys, keep(recurring.select("leaf", "line_key", "template", "n_documents"), "recurring")


def recurring_lines(
    docs: DataFrame, depth: int = DEPTH, documents: int = DOCUMENTS, constant: float = CONSTANT, copy: float = WHOLE
) -> DataFrame:
    """(doc_id, text_key, line_no, template, n_documents) of every line to drop from ``docs(doc_id, text)``.

    Lines end at newlines; blanks around a line do not count; blank lines are never dropped. Rows with a null text or
    doc_id have no lines here and stay as they are. Rows that repeat a doc_id count as one document. The lines of
    a document that consists of recurring lines by more than ``copy`` of its characters stay: such a document is a
    copy, which near-duplicate removal handles. Other columns are not read; an empty table gives no rows.
    """
    keys, recurring = templates(docs, depth, documents, constant)
    hits = keep(keys.join(small(recurring), ["leaf", "line_key"]), "hits")
    whole = keys.groupBy("doc_id", "text_key").agg(F.sum("size").alias("whole"))
    share = hits.groupBy("doc_id", "text_key").agg(F.sum("size").alias("part")).join(whole, ["doc_id", "text_key"])
    share = share.where(F.col("part") <= copy * F.col("whole")).select("doc_id", "text_key")
    return hits.join(share, ["doc_id", "text_key"], "left_semi").select("doc_id", "text_key", "line_no", "template", "n_documents").distinct()


def drop_recurring_lines(docs: DataFrame, copy: float = WHOLE, **options) -> DataFrame:
    """``docs`` with the columns it has and the recurring lines cut from the texts; no row is dropped. A column n_chars
    follows the new text. Rows without doc_id or text are unchanged."""
    gone = recurring_lines(docs, copy=copy, **options).groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = (F.col("row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_key"))
    joined = rows.join(small(keep(gone, "gone")), same, "left")
    left = F.filter(F.split("row.text", "\n"), lambda line, i: ~F.array_contains("gone", i))
    text = F.array_join(left, "\n")
    changed = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.select(F.when(F.col("gone").isNull(), F.col("row")).otherwise(changed).alias("row")).select("row.*")


SQL = f"""
with lines as (
  select doc_id, line_no, trim(line, ' ') as line
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no
        from documents where doc_id is not null and text is not null)
),
masked as (
  select doc_id, line_no, length(line) as size, regexp_replace(line, '[^ \\t0-9@]*[0-9@][^ \\t]*', '{VARIABLE}', 'g') as masked
  from lines where line <> ''
),
keyed as (
  select *, string_split(masked, ' ') as tokens, len(string_split(masked, ' ')) as width, string_split(masked, ' ')[1:{DEPTH}] as lead
  from masked
),
leaves as (select width, lead from keyed group by all having count(distinct doc_id) >= {DOCUMENTS}),
chosen as (
  select width, lead, masked, tokens, count(distinct doc_id) as weight from keyed semi join leaves using (width, lead) group by all
),
tokens as (
  select width, lead, masked, weight, unnest(tokens) as token, generate_subscripts(tokens, 1) as place from chosen
),
support as (select width, lead, place, token from tokens group by all having sum(weight) >= {DOCUMENTS}),
general as (
  select t.width, t.lead, t.masked,
    list(case when (s.token is not null and t.token <> '{VARIABLE}') or t.place <= {DEPTH} then t.token else '{VARIABLE}' end order by t.place) as words
  from tokens t left join support s on t.width = s.width and t.lead = s.lead and t.place = s.place and t.token = s.token
  group by t.width, t.lead, t.masked
),
named as (
  select width, lead, masked, array_to_string(words, ' ') as template from general
  where len(list_filter(words, lambda w: w <> '{VARIABLE}')) / len(words) >= {CONSTANT}
),
held as (
  select n.width, n.lead, n.template, count(distinct k.doc_id) as n_documents
  from keyed k join named n on k.width = n.width and k.lead = n.lead and k.masked = n.masked group by all
  having count(distinct k.doc_id) >= {DOCUMENTS}
),
hits as (
  select k.doc_id, k.line_no, k.size, h.template, h.n_documents
  from keyed k join named n on k.width = n.width and k.lead = n.lead and k.masked = n.masked
  join held h on h.width = n.width and h.lead = n.lead and h.template = n.template
),
copies as (
  select doc_id from (select doc_id, sum(size) as part from hits group by 1) join (select doc_id, sum(size) as whole from keyed group by 1) using (doc_id)
  where part > {WHOLE} * whole
)
select doc_id, cast(line_no as integer) as line_no, template, n_documents from hits anti join copies using (doc_id)
"""
