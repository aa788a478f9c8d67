"""Mix sources to target weights by weighted fair queueing.

Every document of a source, in shuffled order and once per pass over the source, gets a virtual
finish time: the source's words up to and including it, divided by the source's target. Sorted by
that time the sources are interleaved in proportion to their targets, so the mix is cut where its
words reach the budget. The document in which a source reaches its target is cut there.

Running totals use range partitions of bounded size with their offsets, never one task per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import WORD
from curbstar.sources.scratch import stored

#: Rows of a range partition of a running total.
PARTITION_ROWS = 200_000


def running_total(df: DataFrame, groups: list[str], order: list[str], value: str, name: str, rows: int = PARTITION_ROWS) -> DataFrame:
    """``df`` with ``name``, the total of ``value`` over the row's group up to and including it.

    ``order`` must tell all rows of a group apart, else ties share one total in some order. The rows
    are sorted by range; each part's totals per group are added up over the parts of the group, of
    which there are as many as parts, and then added to the totals within the part.
    """
    parts = max(1, -(-df.count() // rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *groups, *order).withColumn("__part", F.spark_partition_id())
    ranged = stored(ranged, "running-total")
    sums = ranged.groupBy("__part", *groups).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sums.select("__part", *groups, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")), "offsets")
    within = Window.partitionBy("__part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = ranged.withColumn("__own", F.sum(value).over(within))
    return own.join(offsets, ["__part", *groups]).withColumn(name, F.col("__own") + F.col("__before")).drop("__part", "__own", "__before")


def numbered_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources with their number by code point, null last, and the weight of that number, repeating."""
    keyed = sizes.withColumn("__one", F.lit(1)).withColumn("__null", F.col("source").isNull().cast("int"))
    keyed = running_total(keyed, [], ["__null", "source"], "__one", "number").drop("__one", "__null")
    n = F.pmod(F.col("number") - 1, F.lit(len(weights))).cast("int")
    return keyed.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), n).cast("long"))


def source_targets(sources: DataFrame, budget: int, most: int) -> DataFrame:
    """Sources with ``target``: shares of the budget by weight, none above ``most`` times its size,
    what is above reshared by weight among the others until none is above.

    With level = (budget - what capped sources take) / (weights of the others), a source is capped
    if level * weight reaches its cap. The level only rises, so the capped only grow in number.
    """
    cap = F.col("source_size") * most
    left, weight = budget, sources.agg(F.sum("weight")).first()[0] or 1
    while True:
        capped = cap.cast("decimal(38,0)") * F.lit(weight) <= F.lit(left).cast("decimal(38,0)") * F.col("weight")
        taken = sources.agg(F.sum(F.when(capped, cap)).alias("size"), F.sum(F.when(~capped, F.col("weight"))).alias("weight")).first()
        now = (budget - (taken["size"] or 0), taken["weight"] or 0)
        if now == (left, weight) or not now[1]:
            break
        left, weight = now
    share = F.lit(left).cast("double") * F.col("weight") / F.lit(weight).cast("double")
    return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share))


def shuffle_key(doc_id: str, salt: Column) -> Column:
    """A key that orders documents at random, alike in every run."""
    return F.md5(F.concat_ws(":", salt.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))


def mixed_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), budget_percent: int = 100, most: int = 3,
) -> DataFrame:
    """One row per input row: doc_id, size, source, source_size, target, taken, mix_begin.

    ``taken`` counts the words that the mix takes of the document, over all passes; ``mix_begin``
    is the place in the mix of the first of them, null if there is none. The budget is a percentage
    of all words. Null and empty texts have size 0 and nothing is taken. A null source is a source,
    numbered last. Rows that share an id are ordered by their texts, so reruns agree however the
    input is split; rows that repeat whole are documents of their own that may change places. Other columns are ignored; an empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    docs = stored(
        documents.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), size.alias("size"), F.xxhash64(text).alias("tie")), "mix"
    )
    sizes = stored(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    budget = (sizes.agg(F.sum("source_size")).first()[0] or 0) * budget_percent // 100
    sources = stored(source_targets(stored(numbered_sources(sizes, weights), "mix-numbers"), budget, most), "mix-targets")
    known = docs.join(sources.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    known = stored(known.select("row", "doc_id", "source", "size", "tie", "source_size", "number", "target"), "mix-known")

    passes = F.when((F.col("size") > 0) & (F.col("target") > 0), F.ceil(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    turns = known.filter(passes > 0).withColumn("turn", F.explode(F.sequence(F.lit(1), passes)))
    turns = turns.select("row", "number", "size", "tie", "target", "turn", shuffle_key("doc_id", F.col("turn")).alias("key"))
    queued = running_total(turns, ["number"], ["turn", "key", "tie", "row"], "size", "finish")
    goal = F.round("target").cast("long")
    queued = queued.withColumn("part", F.least("finish", goal) - (F.col("finish") - F.col("size"))).filter("part > 0")
    queued = queued.withColumn("time", F.least(F.col("finish"), goal) / F.col("target"))
    mixed = running_total(queued.select("row", "number", "turn", "part", "time"), [], ["time", "number", "turn", "row"], "part", "mix_end")
    begin = F.col("mix_end") - F.col("part")
    taken = F.greatest(F.lit(0), F.least("mix_end", F.lit(budget)) - begin)
    mixed = mixed.withColumn("taken", taken).filter("taken > 0")
    totals = mixed.groupBy("row").agg(F.sum("taken").alias("taken"), F.min(begin).alias("mix_begin"))
    out = known.join(totals, "row", "left")
    return out.select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "mix_begin")
