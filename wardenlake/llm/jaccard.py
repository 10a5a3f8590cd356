"""Groups of texts whose shingle sets are similar, from banded signatures and exact confirmation.

The caller chooses the signature (``shingles.Bands``). All pairs that share a band key are decided exactly, without
listing the pairs of a bucket:

1. Equal sets become one class, so copies cost nothing further.
2. Every bucket gets a lead, the member that collides most often (the original of a family of copies), and every
   member is compared with the leads of its buckets on full sets.
3. Two members that both link with a lead are connected already. If one of them is more than twice the allowed
   distance away from the lead, the triangle inequality of the Jaccard distance rules out links to the linked ones.
4. For a member that just misses its lead, only the differences to the lead matter: two members can link only if
   their differences share a computed number of elements, so a prefix of the rarest differences finds the partners.
5. Members far from the lead meet the other unlinked members over the rarest elements of their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shingles as sh
from .components import components
from .shared import keep, map_batches, small

#: Similarity to a lead in percent from which the differences to it decide all pairs around it (``_over_differences``); at
#: most 2 * percent - 100, so that members below it cannot link with members that link with the lead.
NEAR = 30

SIGNATURES = "id long, n long, one long, two long, keys array<long>"


def signatures(items: DataFrame, width: int, bands: sh.Bands) -> DataFrame:
    """Set size, set digests and band keys of every row of ``items(id, text)``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, begin = sh.distinct_rows(*sh.shingle_rows(*sh.words(batch.column(1)), width))
            keys = bands.keys(values, begin)
            one, two = sh.set_digests(values, begin)
            each = range(0, keys.size + 1, bands.bands)
            listed = pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.array(keys.reshape(-1)))
            sizes = pa.array(begin[1:] - begin[:-1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(one), pa.array(two), listed], ["id", "n", "one", "two", "keys"]
            )

    return map_batches(items.select("id", "text"), sign, SIGNATURES)


def shingle_sets(items: DataFrame, width: int) -> DataFrame:
    """(id, set) with the distinct shingles of every row of ``items(id, text)``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, begin = sh.distinct_rows(*sh.shingle_rows(*sh.words(batch.column(1)), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), sh.list_column(values, begin)], ["id", "set"])

    return map_batches(items.select("id", "text"), sets, "id long, set array<long>")


def similar(items: DataFrame, width: int, percent: int, bands: sh.Bands) -> DataFrame:
    """(id, n, one, two, rep, component) of every row of ``items(id long, text)``.

    ``n``: size of the shingle set; (``n``, ``one``, ``two``) identify the set; ``rep``: smallest id with this set;
    ``component``: smallest id that can be reached over links (100 * intersection >= percent * union).
    A row without words is linked with nothing. Null ids are not allowed here; the callers leave them out.
    """
    items = items.select("id", "text")
    signed = keep(signatures(items, width, bands), "signatures")
    classes = keep(
        signed.where("n > 0").groupBy("n", "one", "two").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    reps = signed.join(classes.select("n", "one", "two", F.col("rep").alias("id")), ["n", "one", "two", "id"], "left_semi")
    buckets = _buckets(reps)
    links = components(_links(items, buckets, width, percent))
    known = small(keep(classes.where("copies > 1").select("n", "one", "two", "rep"), "copied"))
    rows = signed.select("id", "n", "one", "two").join(known, ["n", "one", "two"], "left")
    rows = rows.withColumn("rep", F.coalesce("rep", "id"))
    labelled = rows.join(small(links.select(F.col("id").alias("rep"), "component")), "rep", "left")
    return labelled.select("id", "n", "one", "two", "rep", F.coalesce("component", "rep").alias("component"))


def _buckets(reps: DataFrame) -> DataFrame:
    """(key, id, lead) of the buckets with at least two different sets. The lead is the member with the most
    collisions over all its buckets, ties by id."""
    members = reps.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    shared = members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("size"))
    shared = keep(shared.where("lo <> hi").select("key", "size"), "shared")
    members = keep(members.join(shared, "key"), "members")
    score = members.groupBy("id").agg(F.sum("size").alias("score"))
    scored = keep(members.select("key", "id").join(score, "id"), "scored")
    leads = scored.groupBy("key").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("lead"))
    return keep(scored.select("key", "id").join(leads, "key"), "buckets")


def _links(items: DataFrame, buckets: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect the members of all buckets exactly as all their linked pairs would."""
    inside = buckets.select("id").distinct()
    sets = keep(shingle_sets(items.join(small(keep(inside, "inside")), "id", "left_semi"), width), "sets")
    one = sets.select(F.col("id").alias("x"), F.col("set").alias("x_set"))
    two = sets.select(F.col("id").alias("lead"), F.col("set").alias("lead_set"))

    pairs = buckets.where("id <> lead").select("lead", F.col("id").alias("x")).distinct()
    met = pairs.join(one, "x").join(two, "lead")
    gone, new = F.array_except("lead_set", "x_set"), F.array_except("x_set", "lead_set")
    met = met.select("lead", "x", F.size("lead_set").cast("long").alias("n"), gone.alias("gone"), new.alias("new"))
    met = met.withColumns({"r": F.size("gone").cast("long"), "a": F.size("new").cast("long")})
    met = met.withColumns({
        "linked": F.col("n") * (100 - percent) >= 100 * F.col("r") + percent * F.col("a"),
        "near": 100 * (F.col("n") - F.col("r")) >= min(NEAR, 2 * percent - 100) * (F.col("n") + F.col("a")),
    })
    differences = F.when(F.col("near") | F.col("linked"), F.concat("gone", "new"))
    star = keep(met.select("lead", "x", "n", "r", "a", "linked", "near", differences.alias("differences")), "star")

    to_leads = star.where("linked").select(F.col("lead").alias("a"), F.col("x").alias("b"))
    found = [
        to_leads,
        _over_differences(star, components(to_leads), percent),
        _far_pairs(star, buckets, sets, percent),
    ]
    return reduce(DataFrame.union, found)


def _over_differences(star: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links between members near the same lead of which at least one does not link with it, but for pairs that the links with
    leads connect already (``known(id, component)``).

    With the differences to the lead (r elements gone, a elements new) a pair (x, y) links if and only if
    (100 - p) n + (100 + p) o >= 100 (r_x + r_y) + p (a_x + a_y), where o counts the common differences. For an x
    that misses the lead this sets a least o, so x meets one of the rarest differences of y.

    Copies of one text lose elements at the same places, so gone elements are common to very many of them. But from the first
    common element in the order of rarity on, at most the gone elements and the new elements that are still left in both can be
    common as well; where those are too few, the element leads to no pair.
    """
    near = star.where("near or linked").select("lead", "x", "n", "r", "a", "linked", "differences")
    cost = 100 * F.col("r") + percent * F.col("a")
    near = near.withColumns({"cost": cost, "full": (100 - percent) * F.col("n")})
    over = F.min(F.when(~F.col("linked"), F.col("cost") - F.col("full"))).alias("least_over")
    leads = near.groupBy("lead").agg(F.count(F.lit(1)).alias("members"), over, F.min("cost").alias("least_cost"))
    leads = leads.where("members > 1 and least_over is not null").select("lead", "least_over", "least_cost")
    near = keep(near.join(leads, "lead"), "near")

    spread = near.select(*[c for c in near.columns if c != "differences"], F.posexplode("differences").alias("at", "part"))
    spread = spread.withColumn("new", F.col("at") >= F.col("r")).drop("at", "n")
    often = spread.groupBy("lead", "part").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    parts = keep(spread.join(often, ["lead", "part"]), "parts")  # an element of one member alone comes first but finds nobody
    each, order = Window.partitionBy("lead", "x"), Window.partitionBy("lead", "x").orderBy("often", "part")
    left = order.rowsBetween(1, Window.unboundedFollowing)
    size = F.col("r") + F.col("a")
    parts = parts.withColumns({
        "turn": size - F.count(F.lit(1)).over(each) + F.row_number().over(order),
        "new_left": F.coalesce(F.sum(F.col("new").cast("int")).over(left), F.lit(0)),
        "gone_left": F.coalesce(F.sum((~F.col("new")).cast("int")).over(left), F.lit(0)),
    })
    least_y = F.ceil((F.col("cost") + F.col("least_over")) / (100 + percent))
    least_x = F.ceil((F.col("cost") - F.col("full") + F.col("least_cost")) / (100 + percent))
    first = parts.where(F.col("turn") <= size - least_y + 1)
    asks = parts.where(~F.col("linked") & (F.col("turn") <= size - least_x + 1))
    x, y = ([F.col(c).alias(f"{c}_{v}") for c in ("cost", "new_left", "gone_left")] for v in "xy")
    pairs = asks.select("lead", "part", "full", "x", *x).join(first.select("lead", "part", F.col("x").alias("y"), *y), ["lead", "part"])
    most = 1 + F.least("gone_left_x", "gone_left_y") + F.least("new_left_x", "new_left_y")
    enough = F.col("cost_x") + F.col("cost_y") - F.col("full") <= (100 + percent) * most
    pairs = pairs.where((F.col("x") != F.col("y")) & enough).select("lead", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    pairs = pairs.groupBy("x", "y").agg(F.min("lead").alias("lead"))  # one lead decides a pair
    for v in "xy":
        pairs = pairs.join(known.select(F.col("id").alias(v), F.col("component").alias(f"at_{v}")), v, "left")
    pairs = pairs.where(F.coalesce("at_x", "x") != F.coalesce("at_y", "y")).select("lead", "x", "y")

    side = [near.select("lead", F.col("x").alias(v), "n", *[F.col(c).alias(f"{c}_{v}") for c in ("r", "a", "differences")]) for v in "xy"]
    pairs = pairs.join(side[0], ["lead", "x"]).join(side[1].drop("n"), ["lead", "y"])
    common = F.size(F.array_intersect("differences_x", "differences_y"))
    cost = 100 * (F.col("r_x") + F.col("r_y")) + percent * (F.col("a_x") + F.col("a_y"))
    linked = (100 - percent) * F.col("n") + (100 + percent) * common >= cost
    return pairs.where(linked).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _far_pairs(star: DataFrame, buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between a member far from the lead of its bucket and another member that does not link with the lead.

    Pairs with a common home, a lead that both are near to, are left out: ``_over_differences`` has decided them. The
    others link only if one of the rarest elements of both is common: of n elements, the n - ceil(p n / 100) + 1 rarest.
    """
    around = star.where("near or linked").select("lead", F.col("x").alias("id"))
    around = around.union(around.select("lead", F.col("lead").alias("id"))).distinct()
    members = around.groupBy("lead").agg(F.count(F.lit(1)).alias("members"))
    home = around.join(members, "lead").groupBy("id").agg(F.max_by("lead", F.struct("members", -F.col("lead"))).alias("home"))
    alike = ((F.col("n") - F.col("r")) / (F.col("n") + F.col("a"))).alias("alike")  # similarity to the lead
    state = star.where("not linked").select("lead", F.col("x").alias("id"), "near", alike, (F.col("n") - F.col("r") + F.col("a")).alias("size"))
    loose = buckets.where("id <> lead").join(state, ["lead", "id"]).select("key", "id", "near", "alike", "size")
    loose = keep(loose, "loose")
    # Partners of the far members of a bucket are about as similar to its lead (triangle inequality) and of about their size.
    wide = loose.where("not near").groupBy("key").agg(
        F.max("alike").alias("most"), F.min("size").alias("least_size"), F.max("size").alias("most_size")
    )
    partner = (F.col("alike") <= F.col("most") + (100 - percent) / 100 + 1e-9) & (100 * F.col("size") >= percent * F.col("least_size"))
    partner = partner & (percent * F.col("size") <= 100 * F.col("most_size"))
    loose = loose.join(wide, "key").where(~F.col("near") | partner).groupBy("id").agg(F.min("near").alias("near"))
    loose = keep(loose.join(home, "id", "left"), "wide")

    parts = loose.join(sets, "id").select("id", "near", "home", F.size("set").alias("n"), F.explode("set").alias("part"))
    often = parts.groupBy("part").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    parts = keep(parts.join(often, "part"), "set-parts")  # an element that no other set has comes first but finds nobody
    each = Window.partitionBy("id")
    turn = F.col("n") - F.count(F.lit(1)).over(each) + F.row_number().over(each.orderBy("often", "part"))
    rare = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    first = parts.withColumn("turn", turn).where(F.col("turn") <= rare)
    x, y = (first.select("part", *[F.col(c).alias(f"{c}_{v}") for c in ("id", "near", "home", "n")]) for v in "xy")
    pairs = x.where("not near_x").join(y, "part").where("id_x < id_y or (near_y and id_x <> id_y)").where("coalesce(home_x <> home_y, true)")
    pairs = pairs.where((100 * F.col("n_x") >= percent * F.col("n_y")) & (100 * F.col("n_y") >= percent * F.col("n_x")))
    pairs = keep(pairs.select(F.least("id_x", "id_y").alias("x"), F.greatest("id_x", "id_y").alias("y")).distinct(), "far")
    pairs = pairs.join(sets.select(F.col("id").alias("x"), F.col("set").alias("x_set")), "x")
    pairs = pairs.join(sets.select(F.col("id").alias("y"), F.col("set").alias("y_set")), "y")
    common = F.size(F.array_intersect("x_set", "y_set"))
    linked = (100 + percent) * common >= percent * (F.size("x_set") + F.size("y_set"))
    return pairs.where(linked).select(F.col("x").alias("a"), F.col("y").alias("b"))
