"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text.

Native: every step is a DataFrame expression.

A section is a line of the text. Its paragraphs, the leaves, end with a full stop or after 48
characters. A leaf's node is the MD5 of its text, a section's node that of its leaves' nodes, the root
that of the sections' nodes. The fingerprint holds the root, and per section its node and its leaves'
nodes, the latter two cut to 8 hexadecimal digits::

    ROOT|SECTION:LEAF LEAF ...|SECTION:LEAF ...

Equal roots mean equal texts. Otherwise sections with equal nodes are skipped and the leaves of the
others tell where the texts differ. Likeness is Dice's measure of the distinct leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm.common import cut, partitions, text_or_empty

LEAF = r"(?s)[^.]{1,48}\.*|\.+"


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; of an empty text that of one section without paragraphs."""

    def section(line: Column) -> Column:
        nodes = F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), F.md5)
        return F.struct(
            F.md5(F.array_join(nodes, "")).alias("node"),
            F.array_join(F.transform(nodes, lambda n: F.left(n, F.lit(8))), " ").alias("leaves"),
        )

    def joined(sections: Column) -> Column:
        root = F.md5(F.array_join(F.transform(sections, lambda s: s["node"]), ""))
        parts = F.transform(sections, lambda s: F.concat(F.left(s["node"], F.lit(8)), F.lit(":"), s["leaves"]))
        return F.concat_ws("|", root, F.array_join(parts, "|"))

    # A one-element array binds the sections, so that they are worked out once.
    bound = F.array(F.transform(F.split(text, "\n"), section))
    return F.element_at(F.transform(bound, joined), 1)


def leaves(fp: Column) -> Column:
    """The distinct leaves of a fingerprint."""
    found = F.regexp_extract_all(fp, F.lit(r"(?<=[: ])[0-9a-f]{8}"), F.lit(0))
    return F.array_distinct(found)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the shared leaves over the leaves of both; 0 where neither has any."""

    def dice(x: Column, y: Column) -> Column:
        total = F.size(x) + F.size(y)
        return F.when(total > 0, 2.0 * F.size(F.array_intersect(x, y)) / total).otherwise(0.0)

    return F.when(F.left(a, F.lit(32)) == F.left(b, F.lit(32)), 1.0).otherwise(dice(leaves(a), leaves(b)))


def differences(a: Column, b: Column) -> Column:
    """Where ``b`` differs from ``a``: the numbers, from 0, of sections of ``b`` whose node ``a`` lacks."""
    of = lambda fp: F.filter(F.split(fp, r"\|"), lambda _, i: i > 0)
    nodes = F.transform(of(a), lambda s: F.left(s, F.lit(8)))
    marked = F.transform(of(b), lambda s, i: F.when(~F.array_contains(nodes, F.left(s, F.lit(8))), i))
    return F.when(F.left(a, F.lit(32)) == F.left(b, F.lit(32)), F.array().cast("array<int>")).otherwise(
        F.filter(marked, lambda i: i.isNotNull())
    )


def next_ids(ids: DataFrame, key: str) -> DataFrame:
    """Each distinct ``key`` with the next lower one as ``next_id``; the lowest gets the highest.

    The order is cut into the blocks of a range partitioning; the first key of each block, one row per
    block, leads over to it.
    """
    dealt = ids.where(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
    dealt = dealt.repartitionByRange(partitions(ids.sparkSession), F.desc("id"))
    dealt = cut(dealt.withColumn("block", F.spark_partition_id()))
    here = Window.partitionBy("block").orderBy(F.desc("id"))
    firsts = dealt.groupBy("block").agg(F.max("id").alias("first"))
    # One row per block: as many as there are partitions.
    order = Window.orderBy("block")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("block", F.coalesce(F.lead("first").over(order), F.first("first").over(whole)).alias("after"))
    linked = dealt.withColumn("within", F.lead("id").over(here)).join(F.broadcast(after), "block")
    return linked.select(F.col("id").alias(key), F.coalesce("within", "after").alias("next_id"))


def fingerprint_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of every text, of an edited text, and how like they and the next document are.

    The edited text: the last third of the characters, rounded down, replaced by the first as many (or
    all) of the next document, in descending order of ``key``; after the last comes the first.
    Returns ``key``, n_chars, edited_text, fingerprint, edited_fingerprint, next_fingerprint.

    * Null text: empty. A row without a key has no place in the order and is left out.
    * Repeated keys: each row gives a row; the next document of a key is the next lower key, of its
      rows the one whose text sorts first. A single document follows itself. No rows: no rows.
    """
    docs = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    # The need goes to the next document, and only the characters needed come back.
    needs = docs.groupBy("id").agg(F.max(F.floor(F.length("text") / 3)).cast("int").alias("need"))
    asked = next_ids(df, key).withColumnRenamed(key, "id").join(needs, "id")
    asked = asked.select(F.col("id").alias("asker"), F.col("next_id").alias("id"), "need")
    given = docs.join(asked, "id").select(
        F.col("asker").alias("id"),
        F.struct(F.left("text", F.col("need")).alias("start"), fingerprint(F.col("text")).alias("fp")).alias("next"),
    )
    given = given.groupBy("id").agg(F.min("next").alias("next"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = docs.join(given, "id").select(
        "id",
        "text",
        n.cast("long").alias("n_chars"),
        F.concat(F.left("text", n - third), F.left("next.start", third)).alias("edited_text"),
        F.col("next.fp").alias("next_fingerprint"),
    )
    return edited.select(
        F.col("id").alias(key),
        "n_chars",
        "edited_text",
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited_text")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
