"""Key joins: sample assembly, resume, memoisation, positional zip, guidance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _artifact_joins(manifest: DataFrame, text: DataFrame, embedding: DataFrame, codes: DataFrame, key: str,
                    how: str) -> DataFrame:
    # artifact payloads are large computed arrays whose size Spark cannot estimate from
    # file statistics: never broadcast them, join by key with a sort-merge join
    t = text.select(key, F.col("tokens").alias("text_tokens")).hint("merge")
    e = embedding.select(key, "embedding").hint("merge")
    c = codes.select(key, "codes").hint("merge")
    return manifest.join(t, key, how).join(e, key, how).join(c, key, how)


def assemble_samples(manifest: DataFrame, text: DataFrame, embedding: DataFrame, codes: DataFrame,
                     key: str = "key", strict: bool = True) -> DataFrame:
    """Manifest rows joined with their three artifacts by key (duplicates kept).

    All four sides are hash-partitioned on ``key`` once and joined with sort-merge joins
    sharing that partitioning. A manifest row without one of its artifacts fails the job that
    reads it (as a missing file would), in the same pass. ``strict=False`` is for manifests whose
    rows have been admitted before (:func:`admit`): rows without artifact are left out.
    """
    if not strict:
        return _artifact_joins(manifest, text, embedding, codes, key, "inner")
    out = _artifact_joins(manifest, text, embedding, codes, key, "left")
    whole = F.col("text_tokens").isNotNull() & F.col("embedding").isNotNull() & F.col("codes").isNotNull()
    error = F.concat(F.lit("missing artifact for key "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return out.where(F.when(whole, True).otherwise(F.raise_error(error).cast("boolean")))


def admit(manifest: DataFrame, artifacts: dict[str, DataFrame], key: str = "key") -> DataFrame:
    """J1, lenient form: every manifest row with ``reason``, null if all artifacts exist, else
    ``missing `` and the kinds that lack. Presence is decided once, on keys alone."""
    out = manifest
    for name, art in artifacts.items():
        flag = art.select(key).distinct().withColumn(f"_tl_{name}", F.lit(True))
        out = out.join(flag, key, "left")
    lacks = F.array_compact(F.array(*[F.when(F.col(f"_tl_{n}").isNull(), F.lit(n)) for n in artifacts]))
    reason = F.when(F.size(lacks) > 0, F.concat(F.lit("missing "), F.array_join(lacks, ", ")))
    return out.withColumn("reason", reason).drop(*[f"_tl_{n}" for n in artifacts])


def pending(manifest: DataFrame, artifact: DataFrame, key: str = "key") -> DataFrame:
    """Manifest rows whose artifact does not exist yet (resume)."""
    return manifest.join(artifact.select(key), key, "left_anti")


def missing_artifacts(manifest: DataFrame, artifacts: dict[str, DataFrame], key: str = "key") -> DataFrame:
    """One row per manifest row lacking at least one artifact, with a flag per kind."""
    out = manifest.select(key, "pos")
    for name, art in artifacts.items():
        flag = art.select(key).distinct().withColumn(f"has_{name}", F.lit(True))
        out = out.join(flag, key, "left").withColumn(f"has_{name}", F.coalesce(F.col(f"has_{name}"), F.lit(False)))
    flags = [F.col(f"has_{n}") for n in artifacts]
    cond = ~flags[0]
    for f in flags[1:]:
        cond = cond | ~f
    return out.filter(cond)


def content_key(*cols: str) -> F.Column:
    """Hash of the columns' values, nulls told from empty strings."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in cols]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def memoize(df: DataFrame, cache: DataFrame, compute: Callable[[DataFrame], DataFrame], cache_key: str,
            value: str, content: list[str] | None = None) -> DataFrame:
    """Stored value for cache hits, ``compute`` for misses; result = hits and computed.

    ``cache`` holds ``(cache_key, value)``; one value per key is used if a key is stored more
    than once. With ``content``, the key is :func:`content_key` of these columns, added to ``df`` under
    the name ``cache_key``. ``compute`` receives the miss rows and returns them with ``value`` added; see :func:`write_back`.
    """
    if content:
        df = df.withColumn(cache_key, content_key(*content))
    stored = cache.groupBy(cache_key).agg(F.min_by(value, F.xxhash64(value)).alias(value))
    hits = df.join(stored, cache_key, "inner").withColumn("cache_hit", F.lit(True))
    misses = df.join(stored.select(cache_key), cache_key, "left_anti")
    computed = compute(misses).withColumn("cache_hit", F.lit(False))
    return hits.unionByName(computed.select(*hits.columns))


def write_back(result: DataFrame, base: str, kind: str, cache_key: str, value: str) -> DataFrame:
    """Store the computed values of :func:`memoize` under their keys (idempotent, see S6)."""
    from tokenloom.sources.files import write_artifact

    return write_artifact(result.where("not cache_hit").select(cache_key, value), base, kind, cache_key)


def zip_results(left: DataFrame, right: DataFrame, pos: str = "pos", value: str | None = None) -> DataFrame:
    """Positional zip; rows whose result is null are skipped, unmatched positions dropped."""
    out = left.join(right, pos, "inner")
    return out.filter(F.col(value).isNotNull()) if value else out


def guide(cond: DataFrame, uncond: DataFrame, scale: float, keys=("grp", "item"),
          logit: str = "logit") -> DataFrame:
    """Classifier-free guidance ``g*cond + (1-g)*uncond`` per (group, item)."""
    u = uncond.select(*keys, F.col(logit).alias("_tl_u"))
    return cond.join(u, list(keys), "inner").select(
        *keys, (F.lit(scale) * F.col(logit) + F.lit(1.0 - scale) * F.col("_tl_u")).alias(logit))


def resolve_preset(requests: DataFrame, presets: DataFrame, name: str = "preset", url: str = "url") -> DataFrame:
    """Preset name -> URL from a dictionary table (Spark broadcasts it if its bytes are few)."""
    return requests.join(presets.select(F.col("name").alias(name), url), name, "left")
