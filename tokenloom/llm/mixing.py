"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within its source, documents are put in key order by range:
the leading bits of the key name one of ``RANGES`` ranges, each range is sorted on its own, and prefix sums of
token counts are range totals before it plus the running sum inside it. A source's target is
met by whole epochs over the source plus a cut of the key order at the exact remaining budget; the
document at the cut gives its first words only.

A source with a third of all rows is spread over ``RANGES`` sorts; only range totals (partially
aggregated) meet in one window. No task sees a whole source, nor all sources: those are ordered by ranges too, and the driver
gets one row of totals per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import WORD, id_of, stage
from tokenloom.operators.position import with_position

#: Production parameters: weights repeat over the sources in code-point order.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
RANGES = 4096
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, size: Column, seed: str = SEED) -> Column:
    """48 hash bits of id and size."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), size.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple = WEIGHTS) -> DataFrame:
    """``(source, source_size, target double)`` from ``(source, source_size)``, one row per source.

    ``share`` of all sizes is dealt by weight; a target above ``epochs`` times its source stops there and the
    excess is dealt again, until none is above. That end state gives every source min(cap, level * weight)
    for one level, found by one ordered pass over the ratios cap / weight.
    """
    spark, last = sizes.sparkSession, F.col("source").isNull()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    d = with_position(sizes, [last, "source"], out="place").withColumn("weight", w).withColumn("cap", F.col("source_size") * float(epochs))
    d = d.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("last", last)
    # sums over all sources before one, in the order of the ratios: totals of the ranges before its own, and a running sum inside
    order = ["ratio", "last", "source"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = stage(spark, d.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "sources")
    parts = d.groupBy("part").agg(F.sum("cap").alias("part_cap"), F.sum("weight").alias("part_weight"), F.sum("source_size").alias("part_size"))
    rows = sorted(map(tuple, parts.collect()))  # one row per range
    starts, cap, weight, size = [], 0.0, 0.0, 0
    for part, c, v, x in rows:
        starts.append((part, cap, weight))
        cap, weight, size = cap + c, weight + v, size + x
    starts = spark.createDataFrame(starts, "part int, start_cap double, start_weight double")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.col(f"start_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0.0))
    d = d.join(starts, "part").withColumn("level", (F.lit(size * share) - before("cap")) / (F.lit(weight) - before("weight")))
    # the first source that the level doesn't lift above its cap fixes the level
    fixed = d.where("level <= ratio").agg(F.min(F.struct(*order, "level"))["level"].alias("level")).first()["level"]
    level = F.lit(fixed).cast("double")
    return d.select("source", "source_size", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def mix(spark: SparkSession, docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken`` (words, repeats counted).

    A null text has size 0; null sources form one source after all others. Repeated rows are
    documents of their own. The order of equal keys is by id, so reruns agree. No documents give no rows.
    """
    narrow = docs.select("doc_id", "source", n_words(F.col("text").cast("string")).alias("size"))
    narrow = stage(spark, narrow.withColumn("key", random_key(F.col("doc_id"), F.col("size"), seed))
                   .withColumn("part", F.shiftright("key", 48 - (RANGES - 1).bit_length())), "mix")
    parts = narrow.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ordered = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    goals = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")))
    parts = parts.withColumn("start", F.coalesce(F.sum("part_size").over(ordered), F.lit(0)))
    parts = (parts.alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
             .select("p.source", "p.part", "p.start", "g.source_size", "g.target"))
    within = (Window.partitionBy("source", "part").orderBy("key", id_of(), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = narrow.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    d = (d.alias("d").join(parts.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))
                           & (F.col("d.part") == F.col("p.part")))
         .select("d.doc_id", "d.source", "d.size", "p.source_size", "p.target",
                 (F.col("p.start") + F.col("d.inner")).alias("before")))
    budget = F.floor(F.col("target")).cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - rounds * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least("size", rest - F.col("before")))
    return d.select("doc_id", "source", "size", "source_size", "target",
                    (rounds * F.col("size") + cut).cast("long").alias("taken"))


def apply_mix(spark: SparkSession, docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a document taken twice appears twice, one that the cut
    leaves out is absent, and the document at a cut holds the words it gives, joined by single spaces.

    Rows that agree in id, source and size are interchangeable; of a set of them some may be taken and others not.
    """
    keys = ["__id", "__source", "__none", "__size"]
    named = lambda d: d.withColumns({"__id": id_of(), "__source": F.coalesce("source", F.lit("")),
                                     "__none": F.col("source").isNull()})
    taken = named(mix(spark, docs, seed)).groupBy("__id", "__source", "__none", F.col("size").alias("__size")).agg(
        F.sort_array(F.collect_list("taken"), asc=False).alias("__all"))
    d = named(docs).withColumn("__size", n_words(F.col("text").cast("string"))).join(taken, keys)
    # rows that agree in id, source and size share their amounts out
    d = d.withColumn("__taken", F.element_at("__all", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("text")))))
    d = d.where("__taken > 0")
    names = docs.columns
    d = d.select(*names, "__size", "__taken")
    times = F.floor(F.col("__taken") / F.col("__size")).cast("int")
    rest = (F.col("__taken") - times * F.col("__size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), times), F.array_repeat(rest, (rest > 0).cast("int")))
    d = d.select("*", F.explode(copies).alias("__first"))
    words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__first")), " ")
    d = d.withColumn("text", F.when(F.col("__first") > 0, words).otherwise(F.col("text")))
    if "n_chars" in names:
        d = d.withColumn("n_chars", F.when(F.col("__first") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return d.select(*names)
