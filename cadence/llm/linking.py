"""Links between sets from band buckets, and the components they form.

``band_components`` takes items (vid, n, bands) and finds every link among the
pairs that share a bucket, up to connectedness, without pairing the members of
a bucket with one another:

1. Each bucket has a hub: the member whose buckets hold most members in all
   (then the smallest vid). In a family of near copies that is the member nearest
   to the common original. Every member is compared with its hubs on full sets
   (a star: as many pairs as members), and the links found give first components.
2. A pair that shares a bucket and is still in two components is compared too,
   unless it provably cannot link: sizes too different; similarities to the
   bucket's hub further apart than a linked pair allows (1 - Jaccard is a
   metric); or too few items that any other candidate holds, inside the hub's
   set and outside it, since items of one set alone count for the union only.
   A large group of near copies is one component after step 1; its outsiders are
   those with many edits of their own, and the last bound settles most of them
   without pairing. A pair is taken from the first band it shares.

Both steps are joins on the bucket, followed by an exact intersection of the
two sets; all tables that feed a possibly skewed join are stored first, so that
adaptive execution can split a hot bucket, hub or component.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.bloom import shared_items
from cadence.llm.common import scratch_table


def _bounded(n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether the sizes allow a Jaccard similarity of ``percent``."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, jaccard, linked) of the pairs (a, b), on full sets (vid, items)."""
    left = sets.select(F.col("vid").alias("b"), F.col("items").alias("items_b"))
    right = sets.select(F.col("vid").alias("a"), F.col("items").alias("items_a"))
    both = pairs.select("a", "b").join(left, "b").join(right, "a")
    shared = F.size(F.array_intersect("items_a", "items_b")).cast("bigint")
    return (
        both.select("a", "b", shared.alias("s"), (F.size("items_a") + F.size("items_b")).cast("bigint").alias("t"))
        .select("a", "b", (F.col("s") / (F.col("t") - F.col("s"))).alias("jaccard"),
                (F.col("s") * 100 >= (F.col("t") - F.col("s")) * percent).alias("linked")))


def band_components(items: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(vid, label) of every item that has a link; label is its component's
    smallest vid. ``items``: vid long, n int, bands array<long>, stored.
    ``sets_of`` gives (vid, items array<long>) of a frame of distinct vids."""
    members = items.select("vid", "n", F.explode("bands").alias("bucket"))
    sizes = scratch_table(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    shared = scratch_table(members.join(sizes, "bucket"), "members")
    return shared_components(shared, items.select("vid", "bands"), sets_of, percent)


def shared_components(shared: DataFrame, bands: DataFrame, sets_of: Callable[[DataFrame], DataFrame],
                      percent: int) -> DataFrame:
    """As ``band_components``, from the stored members (vid, n, bucket, size) of
    buckets with several, and the ``bands`` (vid, bands) of at least these."""
    weights = scratch_table(shared.groupBy("vid").agg(F.sum("size").alias("weight")), "weights")
    hubs = scratch_table(
        shared.join(weights, "vid").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("vid")).alias("neg"), "n")).alias("top"))
        .select("bucket", (-F.col("top.neg")).alias("hub"), F.col("top.n").alias("hub_n")), "hubs")
    shared = scratch_table(shared.join(hubs, "bucket").where("vid <> hub"), "placed")
    star = scratch_table(
        shared.where(_bounded(F.col("n"), F.col("hub_n"), percent))
        .groupBy(F.col("hub").alias("a"), F.col("vid").alias("b")).agg(F.lit(1).alias("x")), "star")
    # Only sets that a pair of either step can need are fetched.
    several = shared.where("size > 2")
    needed = (
        star.select(F.col("a").alias("vid")).unionByName(star.select(F.col("b").alias("vid")))
        .unionByName(several.select("vid")).unionByName(several.select(F.col("hub").alias("vid"))).distinct())
    sets = scratch_table(sets_of(needed), "sets")
    tested = scratch_table(compare(star, sets, percent), "tested")
    links = tested.where("linked").select("a", "b")
    first = components(links)

    # Step 2: members of buckets of three or more, with their component and
    # their similarity to the hub (0 when the sizes ruled a link out).
    label = first.select("vid", "label")
    hub_label = first.select(F.col("vid").alias("hub"), F.col("label").alias("hub_label"))
    placed = (
        shared.where("size > 2").join(label, "vid", "left")
        .join(tested.select(F.col("a").alias("hub"), F.col("b").alias("vid"), "jaccard"), ["hub", "vid"], "left")
        .join(hub_label, "hub", "left")
        .withColumn("in_hub", F.round(F.col("jaccard") * (F.col("n") + F.col("hub_n")) / (1 + F.col("jaccard"))))
        .select("bucket", "hub", "vid", "n", F.coalesce("label", "vid").alias("label"), "jaccard", "in_hub",
                (F.coalesce("label", "vid") != F.coalesce("hub_label", "hub")).alias("outside")))
    placed = scratch_table(placed, "placed")
    # With the hubs, so that every item shared with a hub counts as common and
    # common - in_hub is what another candidate may share outside the hub's set.
    some = placed.select("vid").unionByName(placed.select(F.col("hub").alias("vid"))).distinct()
    some = scratch_table(sets.join(some, "vid", "left_semi"), "some")
    placed = scratch_table(
        placed.join(shared_items(some), "vid").join(bands, "vid").where(F.col("common") * 100 >= F.col("n") * percent), "common")
    reach = 1 - percent / 100
    outside = placed.where("outside").select(
        "bucket", F.col("vid").alias("x"), F.col("n").alias("x_n"), F.col("label").alias("x_label"),
        F.col("jaccard").alias("x_j"), F.col("common").alias("x_common"), F.col("in_hub").alias("x_in_hub"),
        F.col("bands").alias("x_bands"))
    edge = scratch_table(outside.groupBy("bucket").agg(
        F.max(F.coalesce("x_j", F.lit(1.0))).alias("most"), F.min("x_n").alias("least_n"),
        F.max("x_n").alias("most_n")), "edge")
    near = placed.join(edge, "bucket").where(
        (F.coalesce("jaccard", F.lit(0.0)) <= F.col("most") + reach + 1e-9)
        & (F.col("n") * 100 >= F.col("least_n") * percent) & (F.col("most_n") * 100 >= F.col("n") * percent))
    shareable = F.least(
        F.least("x_common", "common"),
        F.least("x_in_hub", "in_hub") + F.least(F.col("x_common") - F.col("x_in_hub"),
                                                F.col("common") - F.col("in_hub")))
    rest = (
        outside.join(near, "bucket")
        .where((F.col("x_label") != F.col("label")) & (~F.col("outside") | (F.col("x") < F.col("vid")))
               & (shareable * 100 >= (F.col("x_n") + F.col("n") - shareable) * percent)
               & F.coalesce(F.abs(F.col("x_j") - F.col("jaccard")) <= reach + 1e-9, F.lit(True))
               & (F.get(F.array_intersect("x_bands", "bands"), F.lit(0)) == F.col("bucket")))
        .select(F.least("x", "vid").alias("a"), F.greatest("x", "vid").alias("b")).distinct())
    rest = scratch_table(rest, "rest")
    if rest.isEmpty():
        return first
    more = compare(rest, sets, percent).where("linked").select("a", "b")
    known = first.select(F.col("vid").alias("a"), F.col("label").alias("b"))
    return components(known.unionByName(more))


def components(links: DataFrame) -> DataFrame:
    """(vid, label) of every vertex of the links (a, b): label is the smallest
    vertex of its component. Alternating large-star and small-star steps; the
    pairs are written to the shared folder each round, and the number of rounds
    grows with the logarithm of the longest path. The neighbour counts that a
    round starts with also tell whether all components are stars already: no
    vertex has two smaller neighbours, or a smaller and a larger one."""
    pairs = scratch_table(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = scratch_table(both.groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("below"),
            F.count_if(F.col("v") > F.col("u")).alias("above")), "around")
        if around.where("below > 1 or (below = 1 and above > 0)").isEmpty():
            break
        # Large star: larger neighbours move to the smallest one.
        large = scratch_table(both.where("v > u").join(around.select("u", "m"), "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # Small star: smaller neighbours, and the vertex itself.
        least = scratch_table(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = scratch_table(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    labels = pairs.select(F.col("u").alias("vid"), F.col("v").alias("label"))
    return scratch_table(labels.unionByName(pairs.select(F.col("v").alias("vid"), F.col("v").alias("label")).distinct()),
                         "labels")
