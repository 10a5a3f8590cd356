"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of the turn sizes lay every conversation along a line that is cut into spans of equal length; a turn belongs
to the span in which it ends. So the windows need no walk over a conversation, and a conversation of any
length is worked on in pieces of ``CHUNK`` turn numbers. Places are worked out on sizes alone; a text then moves once to
its place, and again only where it is repeated as history.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import keep

#: Turn numbers (as a power of two) that are summed up in one group.
CHUNK = 6

#: Size of the marks around a turn, added to the size of its text.
MARKS = 4

#: Words of ASCII letters and digits, and every other visible character: an upper estimate for most byte-pair tokenizers.
PIECES = r"[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]"

FIRST = -(2**63)
SYSTEM, TARGET = "system", "assistant"
OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "</turn>\n"


def pieces(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PIECES)).cast("long")


def escape_text(text: Column) -> Column:
    """Texts hold no mark afterwards: each ``<turn`` or ``</turn``, with any backslashes inside, gets one more backslash."""
    return F.regexp_replace(text, r"(</?\\*)(turn)", r"$1\\$2")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"(</?\\*)\\(turn)", "$1$2")


def escape_role(role: Column) -> Column:
    """Roles hold no angle bracket afterwards."""
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), [("\\", "\\b"), ("<", "\\l"), (">", "\\g")], role)


def unescape_role(role: Column) -> Column:
    return reduce(lambda c, r: F.replace(c, F.lit(r[1]), F.lit(r[0])), [("<", "\\l"), (">", "\\g"), ("\\", "\\b")], role)


def _equal(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on columns in which nulls are equal; they appear once in the result."""
    other = right.select(*[F.col(n).alias(f"_{n}") for n in names], *[c for c in right.columns if c not in names])
    on = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    joined = left.join(other, on, how)
    if how == "full":
        joined = joined.withColumns({n: F.coalesce(n, f"_{n}") for n in names})
    return joined.drop(*[f"_{n}" for n in names])


def _places(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Windows of every turn of ``turns(conv_id, turn, role, tie, size)``: (conv_id, turn, role, tie, ord, size, system, home,
    again). ``ord``: place in the conversation; ``system``: it is retained in every window; ``home``: ``ord`` of the first
    turn of its window; ``again``: the same of the windows that repeat it."""
    chunk = F.shiftright(F.coalesce("turn", F.lit(FIRST)), CHUNK)
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "tie")
    rows = turns.withColumn("chunk", chunk)
    rows = rows.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("turn_rank", F.row_number().over(inside).cast("long"))
    sums = turns.withColumn("chunk", chunk).groupBy("conv_id", "chunk").agg(F.sum("size").alias("sizes"), F.count(F.lit(1)).alias("turns"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id", "chunk", F.coalesce(F.sum("sizes").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
    )
    rows = _equal(rows, sums, ["conv_id", "chunk"], "inner")
    rows = rows.withColumns({
        "ord": F.col("turns_before") + F.col("turn_rank"), "end": F.col("before") + F.col("upto"),
    }).select("conv_id", "turn", "role", "tie", "size", "ord", "end")
    rows = keep(rows, "turns")

    is_system = (F.col("ord") == 1) & (F.col("role") == SYSTEM) & (2 * F.col("size") <= budget)
    systems = rows.where(is_system).select("conv_id", F.col("size").alias("kept_size"))
    rows = _equal(rows, systems, ["conv_id"], "left").fillna({"kept_size": 0})
    room = budget - F.col("kept_size")
    rows = rows.withColumn("system", is_system).withColumn("end", F.col("end") - F.col("kept_size"))
    rows = rows.withColumn("past", F.least(F.lit(history), F.expr(f"({budget} - kept_size) div 2"))).withColumn("room", room)
    rows = rows.withColumn("span", F.col("room") - F.col("past")).withColumn("start", F.col("end") - F.col("size"))
    rows = rows.withColumn("cell", F.expr("(end - 1) div span"))
    # A turn that begins before its span stays with it if the history gives up the place; else it has a window of its own.
    alone = F.col("cell") * F.col("span") - F.col("start") > F.col("past")
    rows = rows.withColumn("alone", F.when(F.col("system"), F.lit(False)).otherwise(alone))
    plain = rows.where("not system")

    bounds = plain.groupBy("conv_id", "cell", "alone").agg(
        F.min("ord").alias("home"), F.min("start").alias("from"), F.max("end").alias("to"),
        F.first("span").alias("span"), F.first("past").alias("past"), F.first("room").alias("room"),
    )
    bounds = keep(bounds.withColumn("reach", F.least("past", F.col("room") - (F.col("to") - F.col("from")))), "windows")
    placed = _equal(plain, bounds.select("conv_id", "cell", "alone", "home"), ["conv_id", "cell", "alone"], "inner")

    # A window repeats turns that begin at most ``past`` before it, so they begin in the same span as it or in the one before.
    near = plain.select("conv_id", "ord", "start", "end", F.explode(F.expr("array(start div span, start div span + 1)")).alias("at"))
    asks = bounds.select("conv_id", F.expr("from div span").alias("at"), F.col("home").alias("by"), "from", "reach")
    near = _equal(near, asks, ["conv_id", "at"], "inner").where("end <= from and start >= from - reach")
    again = near.groupBy("conv_id", "ord").agg(F.collect_list("by").alias("again"))
    placed = _equal(placed.select("conv_id", "turn", "role", "tie", "ord", "system", "home"), again, ["conv_id", "ord"], "left")
    return placed.unionByName(
        rows.where("system").select("conv_id", "turn", "role", "tie", "ord", "system", F.lit(2).cast("long").alias("home")),
        allowMissingColumns=True,
    )


def windows(
    conversations: DataFrame, budget: int = 1024, history: int = 128, tokens: Callable[[Column], Column] = pieces
) -> DataFrame:
    """(conv_id, window, n_turns, n_repeated, size, over_budget, formatted, loss) from ``conversations(conv_id, turn, role, text)``.

    Every turn is new in exactly one window; ``window`` numbers the windows of a conversation by the place of their first
    new turn. A window holds the system turn (a first turn of role ``system`` of at most half the budget), then
    history, that is whole turns before it of at most ``history`` tokens, then its new turns. ``n_repeated`` counts the
    leading turns that an earlier window has already. ``size`` is the sum of ``tokens`` of the texts and of ``MARKS`` for
    each turn. ``formatted`` marks turns as ``<turn role>``, newline, text, ``</turn>``, newline; marks inside texts and roles are
    escaped reversibly. ``loss`` lists the spans (start, end in code points of ``formatted``) of the texts of new
    assistant turns, so each assistant text is a target once; repeated ones are masked.

    Turns are ordered by turn (null first), role and MD5 of the text; rows that are equal in all are turns of their own. Null
    roles and texts read as empty. Rows without conv_id make up one conversation. A turn longer than a span keeps a window
    of its own, with ``over_budget`` if it does not fit at all; texts are never cut. A system turn alone makes one
    window. Other columns are not read; an empty table gives no rows. Turn numbers of one conversation are summed in
    groups of 64; only rows that repeat one turn number meet in one group.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tie", F.md5("text"))
    key = ["conv_id", "turn", "role", "tie"]
    places = keep(_places(turns.select(*key, (tokens(F.col("text")) + MARKS).alias("size")), budget, history), "places")

    texts = turns.groupBy(*key).agg(F.first("text").alias("text"))
    spots = F.array(F.struct(F.col("home").alias("window"), F.lit(False).alias("again"), "ord", "system"))
    repeats = F.transform("again", lambda w: F.struct(w.alias("window"), F.lit(True).alias("again"), F.col("ord").alias("ord"), F.col("system").alias("system")))
    listed = places.select(*key, F.concat(spots, F.coalesce(repeats, F.expr("array()"))).alias("spots"))
    listed = listed.groupBy(*key).agg(F.flatten(F.collect_list("spots")).alias("spots"))
    moved = _equal(texts, listed, key, "inner").select("conv_id", "role", "text", F.inline("spots"))

    first = turns.where(F.col("role") == SYSTEM).dropDuplicates(key)
    systems = _equal(first, places.where("system").select(*key, "system"), key, "inner").select("conv_id", F.col("text").alias("system_text"))
    body = F.sort_array(F.collect_list(F.struct("ord", "again", "role", "text")))
    grouped = moved.where("not system").groupBy("conv_id", "window").agg(body.alias("turns"))
    grouped = grouped.withColumn("first", F.get(F.filter("turns", lambda t: ~t["again"]), F.lit(0))["ord"])
    whole = _equal(grouped, systems, ["conv_id"], "full").withColumn("window", F.coalesce("window", F.lit(2).cast("long")))
    return _formatted(whole, budget, tokens)


def _formatted(grouped: DataFrame, budget: int, tokens: Callable[[Column], Column]) -> DataFrame:
    opening = F.struct(
        F.lit(1).cast("long").alias("ord"), (F.col("window") > 2).alias("again"), F.lit(SYSTEM).alias("role"), F.col("system_text").alias("text")
    )
    every = F.concat(F.when(F.col("system_text").isNotNull(), F.array(opening)).otherwise(F.expr("array()")), F.coalesce("turns", F.expr("array()")))
    rows = grouped.select("conv_id", "window", every.alias("turns"))
    marked = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(HEAD_END)).alias("head"), escape_text(t["text"]).alias("body"),
        (~t["again"] & (t["role"] == TARGET)).alias("target"),
    ))
    repeated = F.size(F.filter("turns", lambda t: t["again"]))
    size = F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + tokens(t["text"]) + MARKS)
    rows = rows.select("conv_id", "window", F.size("turns").alias("n_turns"), repeated.alias("n_repeated"), size.alias("size"), marked.alias("marked"))
    formatted = F.array_join(F.transform("marked", lambda m: F.concat(m["head"], m["body"], F.lit(CLOSE))), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"))

    def step(done: Column, m: Column) -> Column:
        begin = done["at"] + F.length(m["head"])
        end = begin + F.length(m["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(m["target"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    loss = F.aggregate("marked", start, step, lambda done: done["spans"])
    return rows.select(
        "conv_id", "window", "n_turns", "n_repeated", "size", (F.col("size") > budget).alias("over_budget"), formatted.alias("formatted"), loss.alias("loss")
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of a formatted window."""
    marked = F.split(formatted, CLOSE)
    marked = F.slice(marked, 1, F.size(marked) - 1)

    def one(turn: Column) -> Column:
        end = F.instr(turn, F.lit(HEAD_END))
        role = turn.substr(F.lit(len(OPEN) + 1), end - len(OPEN) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape_text(turn.substr(end + len(HEAD_END), F.length(turn))).alias("text"))

    return F.transform(marked, one)


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows hold, one row per conversation, read back from their formatted texts and loss spans.

    A digest of a whole conversation has to see it in one place, so its texts are joined here; the windows are not.
    """
    new = F.expr("slice(turns, n_repeated + 1, size(turns))")
    rows = formatted.withColumn("turns", read_turns(F.col("formatted")))
    under = F.transform("loss", lambda s: unescape_text(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    text = F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = rows.select("conv_id", "window", new.alias("new"), F.array_join(under, "").alias("loss"), F.length("formatted").alias("chars"))
    rows = rows.select("conv_id", "window", F.size("new").alias("turns"), F.array_join(text, "").alias("text"), "loss", "chars")
    ordered = F.sort_array(F.collect_list(F.struct("window", "text", "loss")))
    rows = rows.groupBy("conv_id").agg(F.sum("turns").alias("n_turns"), ordered.alias("parts"), F.sum("chars").cast("long").alias("formatted_chars"))
    joined = [F.array_join(F.col(f"parts.{n}"), "") for n in ("text", "loss")]
    return rows.select(
        "conv_id", "n_turns", F.sha2(joined[0], 256).alias("turns_sha256"), F.length(joined[1]).cast("long").alias("loss_chars"),
        F.sha2(joined[1], 256).alias("loss_sha256"), "formatted_chars",
    )


def awkward_conversation(spark: SparkSession) -> DataFrame:
    """A conversation whose texts hold marks of usual templates."""
    text = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise(TARGET)
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(text).alias("text"))


#: Sizes, windows and digests of ``windows(budget=1024, history=128)`` and ``digests``.
SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized as (
  select *, 4 + len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]')) as size,
    length('<turn >' || chr(10)) + length(role) + len(regexp_extract_all(role, '[\\<>]'))
      + length(regexp_replace(text, '(</?\\*)(turn)', '\1\\\2', 'g')) + length('</turn>' || chr(10)) as chars,
    row_number() over w as ord, sum(4 + len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]'))) over
      (partition by conv_id order by turn nulls first, role, md5(text) rows unbounded preceding) as upto
  from turns window w as (partition by conv_id order by turn nulls first, role, md5(text))
), systems as (
  select conv_id, size as kept_size, chars as kept_chars from sized where ord = 1 and role = 'system' and 2 * size <= 1024
), laid as (
  select s.*, coalesce(kept_size, 0) as kept, coalesce(kept_chars, 0) as kept_chars,
    kept_size is not null and ord = 1 as is_system, upto - coalesce(kept_size, 0) as stop,
    least(128, (1024 - coalesce(kept_size, 0)) // 2) as past
  from sized s left join systems y on s.conv_id is not distinct from y.conv_id
), celled as (
  select *, stop - size as start, 1024 - kept - past as span, (stop - 1) // (1024 - kept - past) as cell from laid
), plain as (
  select *, cell * span - start > past as alone from celled where not is_system
), bounds as (
  select conv_id, cell, alone, min(ord) as home, min(start) as lo, max(stop) as hi, any_value(past) as past,
    any_value(1024 - kept) as room, any_value(kept_chars) as kept_chars, sum(chars) as chars
  from plain group by all
), repeated as (
  select b.conv_id, b.home, sum(p.chars) as chars from bounds b join plain p on p.conv_id is not distinct from b.conv_id
    and p.stop <= b.lo and p.start >= b.lo - least(b.past, b.room - (b.hi - b.lo)) group by all
), totals as (
  select b.conv_id, sum(b.chars + b.kept_chars + coalesce(r.chars, 0)) as chars
  from bounds b left join repeated r on r.conv_id is not distinct from b.conv_id and r.home = b.home group by all
)
select s.conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by ord)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by ord) filter (role = 'assistant'), '')) as loss_sha256,
  cast(coalesce(any_value(t.chars), sum(s.chars)) as bigint) as formatted_chars
from sized s left join totals t on s.conv_id is not distinct from t.conv_id group by s.conv_id
"""
