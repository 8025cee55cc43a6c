"""N-gram Jaccard join by grouped prefixes, as connected classes of documents.

1. Documents with equal shingle sets form one class; only its smallest document goes on.
2. Shingles are put in one global order, rare before common by a sketch of hashed counts over all documents. Two sets that
   reach the threshold share a shingle in their prefixes (the first n - ceil(t n) + 1 of the order).
3. Classes with the same prefix and size collapse into one group. A prefix shingle in two groups makes a bucket;
   the members of a group make a bucket too.
4. In each bucket a few hubs meet the others: pairs that pass the size and position filters are expanded to
   members and verified on whole sets. Links are contracted to components; a bucket that lies in one component is
   finished, in the others further, more numerous hubs follow until every member has been a hub. So every pair that
   could link is verified unless its ends are connected already, and a bucket of thousands of near copies costs a few passes, not all pairs.

Buckets are never gathered: hubs meet the other rows in a join on the bucket that Spark can split.
The sketch has a counter for every ``A_COUNTER`` words, ``SKETCH`` to ``SKETCH_MOST`` of them. What rare shingles put into any
counter, its median, is taken off, so a frequent shingle shows by the spread of the counters, also where each of them sums
very many shingles. A poor estimate costs candidates, never a link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import components, dense_counts, gram_hashes, id_of, mix64, stage, texts_of, word_hashes

#: Production parameters: words in a shingle, and the threshold as a fraction.
SHINGLE = 3
SIMILARITY = (90, 100)
SKETCH = 1 << 18
SKETCH_MOST = 1 << 24
A_COUNTER = 1 << 10
MIN_BITS = 512
#: Buckets of up to ALL_HUBS members are done at once, larger ones by HUBS hubs, then HUB_GROWTH times as many.
ALL_HUBS = 128
HUBS = 2
HUB_GROWTH = 512


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles; a shorter text is one shingle, no word none."""
    words = word_hashes((text or b"").lower())
    if not len(words):
        return words
    s = np.sort(gram_hashes(words, min(k, len(words))))
    return s[np.r_[True, s[1:] != s[:-1]]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(id_of().alias("id"), F.col("text").cast("string").alias("text"))


def sketch_size(docs: DataFrame) -> int:
    """Counters for the corpus: a power of two, by its words at six bytes each."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return min(SKETCH_MOST, max(SKETCH, 1 << (size // (6 * A_COUNTER)).bit_length()))


def levels_of(total: np.ndarray) -> np.ndarray:
    """Binary logarithm of what a counter holds above the median; any order will do, this one puts frequent shingles last."""
    return np.floor(np.log2(np.maximum(total - int(np.median(total)), 0) + 1)).astype(np.uint8)


def frequency_levels(docs: DataFrame, k: int) -> np.ndarray:
    """Level of each hash bucket by its number of documents, over all documents; ``sketch_size`` small integers."""
    size = sketch_size(docs)

    def count(texts, total):
        for text in texts:
            # the set's hashes are distinct but their buckets needn't be
            np.add.at(total, (shingle_set(text, k) % np.uint64(size)).astype(np.int64), 1)

    return levels_of(dense_counts(docs.select(F.col("text").cast("string")), size, count))


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def prefixes(docs: DataFrame, levels: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """``(id, n, s1, s2, prefix array<long>, bits array<long>)`` per document.

    (n, s1, s2) names its shingle set; ``bits`` holds the parities of the set's hashes in a number of
    classes that is a power of two of at least half the set's size.
    """
    held = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        level = held.value
        for b in batches:
            n, s1, s2, pre, bits = [], [], [], [], []
            for text in texts_of(b.column(1)):
                s = shingle_set(text, k)
                m = mix64(s)
                s1.append(int(m.sum(dtype=np.uint64)))
                s2.append(int((m * m).sum(dtype=np.uint64)))
                n.append(len(s))
                # rare first: the sketch's level, then the hash. Levels are below 64
                key = (level[(s % np.uint64(len(level))).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6))
                keep = len(s) - -(-num * len(s) // den) + 1 if len(s) else 0
                at = np.argpartition(key, keep - 1)[:keep] if 0 < keep < len(s) else np.arange(len(s))
                pre.append(s[at[np.argsort(key[at])]].view(np.int64))
                size = max(MIN_BITS, 1 << (len(s) // 2).bit_length())
                odd = np.bincount((m % np.uint64(size)).astype(np.int64), minlength=size) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), _signed(np.array(s1, np.uint64)), _signed(np.array(s2, np.uint64)),
                 pa.array(pre, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                names=["id", "n", "s1", "s2", "prefix", "bits"])

    return _texts(docs).mapInArrow(run, "id long, n int, s1 long, s2 long, prefix array<long>, bits array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(node, set array<long>)`` of the wanted documents; rows that agree in id and text make one."""

    def run(batches):
        for b in batches:
            sets = [shingle_set(t, k).view(np.int64) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])

    return _texts(docs).join(wanted, "id", "left_semi").dropDuplicates(["id", "text"]).mapInArrow(run, "node long, set array<long>")


def _verified(spark: SparkSession, docs: DataFrame, pairs: DataFrame, nodes: DataFrame, have: DataFrame | None,
              k: int, num: int, den: int) -> tuple:
    """``(sets, links)``: the pairs ``(a, b)`` that link, and the sets made for them; links is None if no pair is left to compare.

    Parities come first, which differ in at most as many places as the sets, then whole sets. ``have``: sets made before.
    """
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"b{s}"))
    # sizes that can link differ by less than two: the longer parities fold to the length of the shorter
    def fold(x, y):
        middle = (F.size(x) / 2).cast("int")
        halves = F.slice(x, F.lit(1), middle), F.slice(x, middle + 1, middle)
        return F.when(F.size(x) > F.size(y), F.zip_with(*halves, lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))

    differ = F.aggregate(F.zip_with(fold("ba", "bb"), fold("bb", "ba"), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                         F.lit(0), lambda x, y: x + y)
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num))
    uneven = (F.size("ba") > 2 * F.size("bb")) | (F.size("bb") > 2 * F.size("ba"))  # at low thresholds only
    near = differ * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)
    close = stage(spark, sized.where(uneven | near).select("a", "b"), "pairs")
    if not close.head(1):
        return have, None
    wanted = close.select(F.col("a").alias("id")).unionAll(close.select("b")).distinct()
    if have is not None:
        wanted = wanted.join(have.select(F.col("node").alias("id")), "id", "left_anti")
    sets = stage(spark, _sets(docs, wanted if have is not None else wanted.hint("merge"), k), "sets")
    sets = sets if have is None else have.unionAll(sets)
    both = F.size(F.array_intersect("x", "y"))
    return sets, (close.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
            .where(den * both >= num * (F.size("x") + F.size("y") - both)).select("a", "b"))


def _link(spark: SparkSession, docs: DataFrame, slots: DataFrame, members: DataFrame, nodes: DataFrame,
          k: int, num: int, den: int) -> DataFrame:
    """Components ``(node, comp)`` of everything that links within the buckets.

    ``slots (bucket, units, unit, n, pos, weight)``; ``members (unit, node)``; ``nodes (node, n, bits)``.
    """
    links, comps, sets, hubs = None, None, None, HUBS
    slots = slots.withColumn("comp", F.lit(None).cast("long"))
    while True:
        order = Window.partitionBy("bucket").orderBy(F.desc("weight"), "turn", "unit")
        chosen = (slots.select("bucket", "units", "unit", "n", "pos", "comp", "weight", F.xxhash64("unit").alias("turn"))
                  .withColumn("k", F.row_number().over(order)).where(F.col("k") <= max(hubs, ALL_HUBS))
                  .where((F.col("units") <= ALL_HUBS) | (F.col("k") <= hubs)))
        chosen = stage(spark, chosen, "hubs")
        if not chosen.head(1):
            break
        slots = slots.join(chosen.select("bucket", "unit", "k"), ["bucket", "unit"], "left")
        h = chosen.select("bucket", F.col("unit").alias("u"), F.col("n").alias("hn"), F.col("pos").alias("hpos"),
                          F.col("comp").alias("hcomp"), F.col("k").alias("hk"))
        small, large = F.least("n", "hn"), F.greatest("n", "hn")
        # if the shared shingle is the first one, it and what follows can overlap this much
        reach = F.least(F.col("n") - F.col("pos"), F.col("hn") - F.col("hpos"))
        pairs = (slots.join(h, "bucket").where((F.col("unit") != F.col("u")) & (F.col("k").isNull() | (F.col("k") > F.col("hk"))))
                 .where((F.col("comp") != F.col("hcomp")) | F.col("comp").isNull() | F.col("hcomp").isNull())
                 .where((small * den >= large * num) & (reach * (num + den) >= num * (F.col("n") + F.col("hn"))))
                 .select(F.least("unit", "u").alias("p"), F.greatest("unit", "u").alias("q")).distinct())
        pairs = (pairs.join(members.select(F.col("unit").alias("p"), F.col("node").alias("a")), "p")
                 .join(members.select(F.col("unit").alias("q"), F.col("node").alias("b")), "q")
                 .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        sets, found = _verified(spark, docs, pairs, nodes, sets, k, num, den)
        if found is not None:
            found = stage(spark, found, "links")
            links = found if links is None else links.unionAll(found)
            comps = components(spark, links)
        elif comps is None:
            comps = spark.createDataFrame([], "node long, comp long")
        # the hubs have met everyone; a unit whose nodes are in one component carries it
        m = members.join(comps, "node", "left").select("unit", F.coalesce("comp", "node").alias("c"))
        of = m.groupBy("unit").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).select(
            "unit", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("comp"))
        rest = slots.where("k is null").select("bucket", "unit", "n", "pos", "weight").join(of, "unit")
        rest = stage(spark, rest, "slots")
        # a bucket that lies in one component is finished
        open_ = (rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                            F.count("*").alias("units"), F.count("comp").alias("whole"))
                 .where("units > 1 and (lo <> hi or whole < units)").select("bucket", "units"))
        slots = stage(spark, rest.join(open_, "bucket"), "slots")
        hubs *= HUB_GROWTH
    return comps if comps is not None else spark.createDataFrame([], "node long, comp long")


def jaccard_classes(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, similarity: tuple = SIMILARITY) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document.

    Documents link when den * |x & y| >= num * |x | y| over sets of distinct shingles of lower-cased words; a text with
    fewer words is one shingle, one without words links with nothing. ``component_id`` is the smallest id reachable.
    Rows with the same id are one document as to links (the union of theirs) and each returned; rows with a null id are
    one document after all others, returned with null ids. No documents give no rows.
    """
    num, den = similarity
    p = stage(spark, prefixes(docs, frequency_levels(docs, shingle), shingle, num, den), "prefixes")
    classes = p.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    reps = (p.where("n > 0").join(classes.select("n", "s1", "s2", F.col("rep").alias("id")), ["n", "s1", "s2", "id"], "left_semi")
            .dropDuplicates(["id", "n", "s1", "s2"]))
    # groups: same prefix and size. A unit is a group, or one document within its group
    reps = stage(spark, reps.select(F.col("id").alias("node"), "n", "prefix", "bits", F.xxhash64("n", "prefix").alias("g1"),
                                    F.hash("prefix").alias("g2")), "sets")
    groups = (reps.groupBy("n", "g1", "g2").agg(F.min("node").alias("gid"), F.count("*").alias("size")))
    groups = stage(spark, groups, "groups")
    grouped = reps.select("node", "n", "g1", "g2").join(groups, ["n", "g1", "g2"]).select("gid", "node", "n", "size")
    tokens = (reps.join(groups.select(F.col("gid").alias("node"), "n", "g1", "g2"), ["node", "n", "g1", "g2"], "left_semi")
              .select("node", "n", F.posexplode("prefix").alias("pos", "token")))
    shared = tokens.groupBy("token").agg(F.count("*").alias("units")).where("units > 1")
    slots = tokens.join(shared, "token").select(
        F.xxhash64(F.lit("t"), "token").alias("bucket"), "units", F.xxhash64(F.lit("group"), "node").alias("unit"), "n", "pos")
    inner = grouped.where("size > 1").select(F.xxhash64(F.lit("g"), "gid").alias("bucket"), F.col("size").alias("units"),
                                             F.xxhash64(F.lit("one"), "node").alias("unit"), "n", F.lit(0).alias("pos"))
    slots = slots.unionAll(inner)
    # a member that shares most of its prefix is in the middle of its near copies: it makes the best hub
    slots = stage(spark, slots.withColumn("weight", F.count("*").over(Window.partitionBy("unit"))), "slots")
    members = (grouped.select(F.xxhash64(F.lit("group"), "gid").alias("unit"), "node")
               .unionAll(grouped.where("size > 1").select(F.xxhash64(F.lit("one"), "node").alias("unit"), "node")))
    members = stage(spark, members.join(slots.select("unit").distinct(), "unit", "left_semi"), "members")
    comps = _link(spark, docs, slots, members, reps.select("node", "n", "bits"), shingle, num, den)
    classes = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "s1", "s2", F.coalesce("comp", "rep").alias("comp"))
    out = p.select("id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left")
    null_id = lambda c: F.when(c != F.lit((1 << 63) - 1), c)
    return out.select(null_id(F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      null_id(F.coalesce("comp", "id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 5, similarity: tuple = (80, 100)) -> DataFrame:
    """``docs`` without the documents that have an earlier one in their class; rows with a null id stay.

    Of rows that agree in id and text, one stays. Rows that share an id only are documents of their own, in the order of their
    texts' hashes.
    """
    d = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__text": F.coalesce(F.col("text").cast("string"), F.lit(""))})
    d = d.withColumn("__rid", F.xxhash64("__id", "__text"))
    named = d.where("__id is not null")
    # rows that agree in id and text are one node to the join: no text is moved before it to tell them apart
    nodes = named.select(F.col("__rid").alias("doc_id"), F.col("__text").alias("text"))
    classes = jaccard_classes(spark, nodes, shingle, similarity).select(F.col("doc_id").alias("__rid"), "component_id").distinct()
    # nodes are hashes: the first of a class is the smallest by id
    first = (named.select("__rid", "__id").distinct().join(classes, "__rid").groupBy("component_id")
             .agg(F.min(F.struct("__id", "__rid"))["__rid"].alias("__rid")).select("__rid"))
    kept = named.dropDuplicates(["__rid"]).join(first, "__rid", "left_semi").unionByName(d.where("__id is null"))
    return kept.drop("__id", "__text", "__rid")
