"""Near-duplicates by min-max hashing.

Under each permutation both the smallest and the largest value of a set are kept: two set members drawn
without bias for one hash evaluation. Sixty-five permutations give 130 components. They are banded,
and documents that share a band are candidates. Candidates are compared on their full sets.

A group of thousands of copies makes neither a large task nor all its pairs:

* Texts of equal sets are one class, found by a digest; one of them stands for all. A key that has
  several texts is in several classes, which start in one component.
* A shingle that no other candidate has cannot be shared: from how many others a document has follows
  whom it can be linked with at all, which settles most copies that were edited too much.
* Each band bucket has one leader, and the others are compared with it. Components are merged along the
  new links. Pairs in one component need no comparison, so only a bucket whose other members still lie
  in several components goes on.
* What goes on is settled by differences, see ``_by_differences``: all members of buckets that hang
  together are a block, a set is stored as its difference to what most of its block have in common, and
  only pairs whose differences share one of their rarest members are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import words as W
from acervo.llm.bitmaps import bitmap, in_bitmap
from acervo.llm.common import at_work, cut, release, tidy
from acervo.llm.components import components

PERMUTATIONS = 65
#: The most that a pair at the threshold may be missed with, as a probability.
MISS = 1e-6

_rng = np.random.Generator(np.random.PCG64(130))
_FACTORS = _rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]


def band_rows(threshold: float, size: int = 2 * PERMUTATIONS, miss: float = MISS) -> int:
    """The longest band that misses a pair at the threshold with a probability of at most ``miss``."""
    good = [r for r in range(1, 33) if (1 - threshold**r) ** (size // r) <= miss]
    return max(good, default=1)


def min_max(items: np.ndarray) -> np.ndarray:
    """The smallest values under all permutations, then the largest."""
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    short = (items >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 1 << 14):
        values = _FACTORS * short[None, start : start + (1 << 14)] + _SHIFTS
        low = np.minimum(low, values.min(axis=1))
        high = np.maximum(high, values.max(axis=1))
    return np.concatenate((low, high))


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A hash per band, the band's number in it."""
    used = signature[: len(signature) // rows * rows].astype(np.uint64).reshape(-1, rows)
    total = np.arange(len(used), dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    for column in used.T:
        total = W.mix(total + column + np.uint64(1))
    return total.view(np.int64)


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    at_work("minhash")
    for data in W.pieces(texts):
        hashes, at = W.hash_words(data)
        for i in range(len(data)):
            yield W.shingles(hashes[at[i] : at[i + 1]], width)


def sketches(df: DataFrame, width: int, rows: int) -> DataFrame:
    """id, text, text_hash -> id, text_hash, n (set size), digest (null for an empty set) and the bands."""

    @tidy
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, all_bands = [], [], []
            for items in _sets(batch.column(1), width):
                sizes.append(len(items))
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                all_bands.append(bands(min_max(items), rows) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(all_bands, pa.list_(pa.int64())),
                ],
                ["id", "text_hash", "n", "digest", "bands"],
            )

    return df.mapInArrow(sketch, "id long, text_hash long, n long, digest binary, bands array<long>")


def _may_link(percent: int, n: str, m: str, other_n: str, other_m: str):
    """Whether two sets can be similar enough, going by their sizes and by how many members others have too."""
    shared = F.least(m, other_m)
    return 100 * shared >= percent * (F.col(n) + F.greatest(F.col(other_n), shared) - shared)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b, label_a, label_b) with ``linked``: whether their full sets are similar enough."""
    one = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    two = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    both = pairs.join(one, "b").join(two, "a")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    linked = 100 * shared >= percent * (F.size("items_a") + F.size("items_b") - shared)
    return both.select("a", "b", "label_a", "label_b", linked.alias("linked"))


def _class_sets(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """id, items: the set of each class of ``chosen``, of one row of its text, as sorted hashes of its shingles.

    ``chosen`` (class, id, text_hash, row, repeated) is stored. A bitmap of bounded size lets its rows
    through, so that of the other texts few or none are shuffled; beyond that size more are, with the same result.
    """
    found, bits = bitmap(chosen, "row")

    @tidy
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(2).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(in_bitmap(found.value, bits, row)))
            items = [s.view(np.int64) for s in _sets(batch.column(3), width)]
            arrays = [batch.column(0), batch.column(1), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "text_hash", "items"])

    rows = docs.select("id", "text_hash", F.xxhash64("id", "text_hash").alias("row"), "text")
    sets = rows.mapInArrow(make, "id long, text_hash long, items array<long>").join(chosen, ["id", "text_hash"])
    sets = sets.select(F.col("class").alias("id"), "items", "repeated")
    one = sets.where("not repeated").select("id", "items")
    # Equal rows are brought together; their partial aggregate keeps one per task.
    if chosen.where("repeated").take(1):
        one = one.unionByName(sets.where("repeated").groupBy("id").agg(F.first("items").alias("items")))
    return one


def _contested(members: DataFrame, percent: int) -> DataFrame:
    """The rows of buckets whose members lie in several components, without those that can't be linked."""
    keys = members.groupBy("key").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.min("n").alias("least_n"), F.max("m").alias("most_m")
    )
    # Stored, so that the rows of a bucket with very many members can be split in the join.
    keys = cut(keys.where("x != y").drop("x", "y"))
    alive = members.join(keys, "key").where(_may_link(percent, "n", "m", "least_n", "most_m"))
    return alive.select("key", "id", "n", "m", "label")


def _merge(compared: DataFrame) -> DataFrame:
    """label, new_label: what becomes of the labels that the links of ``compared`` join up."""
    merged = components(cut(compared.where("linked").select("label_a", "label_b").distinct()), "label_a", "label_b")
    return cut(merged.select(F.col("id").alias("label"), F.col("label").alias("new_label")))


def _by_differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (label_a, label_b, linked) that join up whatever members (key, id, label) of one bucket are linked.

    Buckets with common members form a block. D(x) is the difference between the set x and the block's
    reference, the members that more than half of its sets have. With p for ``percent`` and
    cost(x) = (100 + p) |D(x)| - (100 - p) |x|, two sets are similar enough exactly where
    cost(x) + cost(y) <= 2 (100 + p) |D(x) & D(y)|. So, in each block:

    * A set that is linked by costs alone, whatever the differences share, is linked with the set of least
      cost. Those are ``near``, one component; what follows links the others with them and each other.
    * |D(x) & D(y)| is at most the number of members of D(x) that another difference has, too. Whoever
      can't reach anyone's cost by that is settled.
    * Linked differences share at least the smallest number that any partner's cost asks for, hence one of
      the rarest members of each (prefix filter). Pairs that do are compared on their full sets.
    """
    scale = 100 + percent
    hubs = members.groupBy("key").agg(F.min("id").alias("hub"))
    joined = cut(members.join(hubs, "key").select("hub", "id").where("hub != id").distinct())
    blocks = components(joined, "hub", "id").withColumnRenamed("label", "block")
    nodes = members.select("id", "label").distinct().join(blocks, "id", "left")
    nodes = cut(nodes.withColumn("block", F.coalesce("block", "id")).join(sets, "id"))

    total = nodes.groupBy("block").agg(F.count("*").alias("total"))
    counts = nodes.select("block", F.explode("items").alias("item")).groupBy("block", "item").agg(F.count("*").alias("count"))
    # At most twice as many as a set of the block has on the average.
    common = counts.join(total, "block").where("2 * count > total").groupBy("block").agg(F.collect_list("item").alias("common"))
    diff = F.concat(F.array_except("items", "common"), F.array_except("common", "items"))
    diffs = nodes.join(common, "block", "left").withColumn("common", F.coalesce("common", F.array().cast("array<long>")))
    cost = scale * F.size("diff") - (100 - percent) * F.size("items")
    diffs = diffs.withColumn("diff", diff).select("block", "id", "label", cost.cast("long").alias("cost"), "diff")
    least = F.min(F.struct("cost", "id", "label")).alias("least")
    diffs = cut(diffs.join(diffs.groupBy("block").agg(least), "block").withColumn("near", F.col("cost") + F.col("least.cost") <= 0))
    star = diffs.where("near and label != least.label").select(F.col("label").alias("label_a"), F.col("least.label").alias("label_b"))

    # The members of differences that several have, rarest first.
    items = diffs.select("block", "id", F.explode("diff").alias("item"))
    several = cut(items.groupBy("block", "item").agg(F.count("*").alias("count")).where("count > 1"))
    shared = items.join(several, ["block", "item"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("count", "item"))).alias("shared"))
    reach = (2 * scale * F.size("shared") - F.col("cost")).alias("reach")
    rest = cut(diffs.join(shared, "id").select("block", "id", "label", "cost", "near", "shared", reach))
    limits = rest.groupBy("block").agg(F.max("reach").alias("most"), F.min("cost").alias("least"))
    far = rest.where("not near").join(limits, "block").where("cost <= most and reach >= least").drop("most", "least")
    limits = far.groupBy("block").agg(F.max("reach").alias("most"), F.min("cost").alias("least"))
    near = rest.where("near").join(limits, "block").where("cost <= most and reach >= least").drop("most", "least")
    alive = cut(far.unionByName(near))
    limits = alive.groupBy("block").agg(F.min("cost").alias("least"))
    needed = F.greatest(F.ceil((F.col("cost") + F.col("least")) / (2 * scale)), F.lit(1)).cast("int")
    rarest = F.slice("shared", F.lit(1), F.greatest(F.size("shared") - needed + 1, F.lit(0)))
    keyed = alive.join(limits, "block").select("block", "id", "label", "cost", "reach", "near", F.explode(rarest).alias("rare"))
    keyed = cut(keyed.withColumn("item", F.col("rare.item")).drop("rare"))
    other = keyed.select("block", "item", *[F.col(c).alias(f"other_{c}") for c in ("id", "label", "cost", "reach", "near")])
    meet = (F.col("label") != F.col("other_label")) & (F.col("cost") <= F.col("other_reach")) & (F.col("other_cost") <= F.col("reach"))
    once = F.col("other_near") | (F.col("id") < F.col("other_id"))
    pairs = keyed.where("not near").join(other, ["block", "item"]).where(meet & once)
    pairs = pairs.select(
        F.col("id").alias("a"), F.col("other_id").alias("b"), F.col("label").alias("label_a"), F.col("other_label").alias("label_b")
    )
    found = _compared(pairs.distinct(), sets, percent).select("label_a", "label_b", "linked")
    return found.unionByName(star.withColumn("linked", F.lit(True)))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """A row per document: ``key``, n_shingles, component_id and kept.

    Words are runs of other than ASCII white space, A-Z as a-z. A document's set holds its distinct
    shingles of ``width`` words; with fewer words, the whole sequence. Documents are linked where
    100 * intersection >= ``percent`` * union; ``component_id`` is the smallest key reachable, and a
    document is kept where that is its own.

    * Null and empty texts, and such of white space alone: no shingles, linked with nothing, kept.
    * Rows with a null key are no documents and left out. Repeated rows each give a row; rows of one
      key are one document, linked with whatever one of them is. No rows: no rows.
    * Only ``key``, an integer, and ``text`` are read.
    * A set is one of 64-bit hashes: two different shingles of one comparison are taken for one with a
      probability under 1e-10. A pair at the threshold shares no band with one of at most 1e-6.
    """
    docs = df.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sketched = cut(sketches(docs, width, band_rows(percent / 100)))
    classes = sketched.where("n > 0").groupBy("digest").agg(F.min(F.struct("id", "text_hash", "n", "bands")).alias("c"))
    # A class goes by a number of its own, ``class``; its label is the smallest key in it.
    classes = cut(classes.select("digest", F.xxhash64("digest").alias("class"), "c.*"))

    # Classes that share a key start with one label.
    several = sketched.where("n > 0").groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
    several = cut(several.where("x != y").select("id"))
    shared = sketched.where("n > 0").join(several, "id").select("id", "digest").distinct()
    shared = cut(shared.join(classes.select("digest", F.col("id").alias("label")), "digest").select("id", "label").distinct())
    least = shared.groupBy("id").agg(F.min("label").alias("least"))
    start = components(shared.join(least, "id").where("label != least"), "least", "label")
    start = cut(start.select(F.col("id").alias("label"), F.col("label").alias("new_label")))

    # Members of band buckets that several classes share.
    banded = classes.join(start, classes["id"] == start["label"], "left").select(
        F.explode("bands").alias("key"), F.col("class").alias("id"), "n", F.col("n").alias("m"), F.coalesce("new_label", "id").alias("label")
    )
    members = cut(_contested(banded, percent))
    # A set per class, of whichever rows; those rows that repeat are counted.
    chosen = classes.join(members.select(F.col("id").alias("class")).distinct(), "class").select("class", "id", "text_hash")
    repeats = sketched.where("n > 0").groupBy("id", "text_hash").agg((F.count("*") > 1).alias("repeated"))
    chosen = cut(chosen.join(repeats, ["id", "text_hash"]).withColumn("row", F.xxhash64("id", "text_hash")))
    sets = cut(_class_sets(docs, chosen, width))
    # A shingle that only one of them has is in no intersection: ``m`` are the others.
    single = sets.select("id", F.explode("items").alias("item")).groupBy("item")
    single = single.agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").groupBy("id").agg(F.count("*").alias("own"))
    known = members.drop("m").join(single, "id", "left").withColumn("m", F.col("n") - F.coalesce("own", F.lit(0)))
    open_members = cut(_contested(known.where(100 * F.col("m") >= percent * F.col("n")), percent))
    release(members, chosen)
    members = open_members

    merges = [start]
    if members.take(1):
        # Those with the fewest shingles of their own lead: they have the most links.
        rank = F.struct((F.col("n") - F.col("m")).alias("own"), "id", "n", "m", "label")
        led = cut(members.groupBy("key").agg(F.min(rank).alias("leader")).select("key", "leader.*").drop("own"))
        lead = led.select("key", *[F.col(c).alias(f"lead_{c}") for c in ("id", "n", "m", "label")])
        near = _may_link(percent, "n", "m", "lead_n", "lead_m")
        pairs = members.join(lead, "key").where(near & (F.col("label") != F.col("lead_label")))
        first, second = F.struct("id", "label"), F.struct(F.col("lead_id").alias("id"), F.col("lead_label").alias("label"))
        pairs = pairs.select(F.least(first, second).alias("x"), F.greatest(first, second).alias("y")).distinct()
        pairs = pairs.select(
            F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.label").alias("label_a"), F.col("y.label").alias("label_b")
        )
        merges.append(_merge(_compared(pairs, sets, percent)))
        left = members.join(led.select("key", "id"), ["key", "id"], "left_anti").join(merges[-1], "label", "left")
        left = left.select("key", "id", "n", "m", F.coalesce("new_label", "label").alias("label"))
        rest = cut(_contested(left, percent))
        if rest.take(1):
            merges.append(_merge(_by_differences(rest, sets, percent)))
    # From a class to the smallest id of its component, round by round.
    found = classes.select("digest", F.col("id").alias("component"))
    for merge in merges:
        found = found.join(merge.withColumnRenamed("label", "component"), "component", "left")
        found = found.select("digest", F.coalesce("new_label", "component").alias("component"))
    found = cut(found)
    component = F.least("id", F.coalesce("component", "id"))
    return (
        sketched.join(found, "digest", "left")
        .select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.col("component_id") == F.col(key))
    )
