"""Manifest files and artifact tables."""

from __future__ import annotations

import fnmatch
import os
import re
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.session import checkpoint_dir
from tokenloom.sources.fsio import resolve

# Strings pandas' CSV reader turns into a missing value by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

MANIFEST_SCHEMA = "key string, text string, pos long"

#: Bytes that are copied at once; files and bytes of them that one task reads.
BLOCK = 4 << 20
FILES_A_TASK = 4096
BYTES_A_TASK = 64 << 20


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job's files inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tokenloom-work", f"{name}-{uuid.uuid4().hex[:12]}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: evaluated once, lineage cut."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, length)`` of the files below ``root`` whose name fits ``glob``; names that begin with ``_`` or ``.`` are hidden.

    Tasks list the folders, one level after the other, so the driver holds no file names.
    """
    if re.search(r"[*?\[{]", root):
        return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
                .select("path", "length"))
    kind = pa.schema([("path", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())])

    def run(batches):
        for b in batches:
            for where in b.column(0).to_pylist():
                fs, inside = resolve(where)
                head = "file:" if isinstance(fs, pafs.LocalFileSystem) else where[:len(where) - len(inside)]
                own = fs.get_file_info(inside)
                found = [own] if own.is_file else fs.get_file_info(pafs.FileSelector(inside))
                seen = [(head + f.path, f.size, not f.is_file) for f in found if f.base_name[:1] not in ("_", ".")
                        and (not f.is_file or fnmatch.fnmatchcase(f.base_name, glob))]
                for i in range(0, len(seen), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*seen[i:i + 10_000]), kind)], schema=kind)

    out, level, n = None, spark.createDataFrame([(root.rstrip("/"),)], "path string"), 1
    while n:
        seen = stage(level.repartition(min(n, FILES_A_TASK), "path").mapInArrow(run, "path string, length long, folder boolean"), "listed")
        files, level = seen.where("not folder").select("path", "length"), seen.where("folder").select("path")
        out = files if out is None else out.unionAll(files)
        n = level.count()
    return out


def spread_files(files: DataFrame) -> DataFrame:
    """Listed files dealt by their number and bytes; by the size of the rows alone, a few tasks would read them all."""
    n, size = files.agg(F.count(F.lit(1)), F.sum("length")).first()
    least = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(max(least, -(-n // FILES_A_TASK), -(-(size or 0) // BYTES_A_TASK)), "path")


def join_files(spark: SparkSession, parts: str, target: str) -> None:
    """The files of the folder ``parts``, in the order of their names, as the one file ``target``.

    On a local or mounted file system every part is copied to its place by a task of its own; other stores only take a file
    from front to back, in one task. A task holds ``BLOCK`` bytes.
    """
    files = list_files(spark, parts).where("length > 0")
    by = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(files.select("path", F.coalesce(F.sum("length").over(by), F.lit(0)).alias("at"), "length"), "parts")
    n, size = placed.agg(F.count(F.lit(1)), F.sum("length")).first()
    fs, inside = resolve(target)
    fs.create_dir(inside.rsplit("/", 1)[0], recursive=True)
    local = isinstance(fs, pafs.LocalFileSystem)
    if local:
        with open(inside, "wb") as f:
            f.truncate(size or 0)

    def run(batches):
        whole = None if local else resolve(target)[0].open_output_stream(inside)
        for b in batches:
            for r in b.to_pylist():
                out = whole
                if local:
                    out = open(inside, "r+b")
                    out.seek(r["at"])
                source, p = resolve(r["path"])
                with source.open_input_stream(p) as data:
                    while block := data.read(BLOCK):
                        out.write(block)
                if local:
                    out.close()
                yield pa.RecordBatch.from_pydict({"path": [r["path"]]})
        if whole:
            whole.close()

    rows = placed.repartition(max(n, 1), "path") if local else placed.coalesce(1).sortWithinPartitions("at")
    rows.mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def read_tsv_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``path<TAB>text`` -> ``(key, text)``.

    Double-quote quoting with ``""`` escapes, also around newlines; blank lines skipped; pandas'
    missing-value tokens become null. Every ``.flac`` in the path is removed, not only
    a suffix. A quoted newline belongs to its record, so a file is parsed by one task: the corpus is split
    into files (as writers do), not one huge file.
    """
    raw = (spark.read.option("sep", "\t").option("quote", '"').option("escape", '"')
           .option("header", "false").option("multiLine", "true")
           .schema("path string, text string").csv(path))
    text = F.when(F.col("text").isNull() | F.col("text").isin(NA_TOKENS), F.lit(None).cast("string")) \
        .otherwise(F.col("text"))
    return raw.select(F.replace(F.col("path"), F.lit(".flac"), F.lit("")).alias("key"), text.alias("text"))


def quarantine(df: DataFrame, text: str = "text", corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """S1/S2 rows that can go on, and the others with their ``reason``: ``corrupt line`` or ``null text``."""
    bad = F.lit(None).cast("string")
    if corrupt in df.columns:
        bad = F.when(F.col(corrupt).isNotNull(), F.lit("corrupt line"))
    reason = F.coalesce(bad, F.when(F.col(text).isNull(), F.lit("null text")))
    tagged = df.withColumn("reason", reason)
    return tagged.where("reason is null").drop("reason", corrupt), tagged.where("reason is not null")


def write_tsv_manifest(df: DataFrame, path: str, path_col: str = "path", text_col: str = "text") -> None:
    """Write ``(path, text)`` as a headerless TSV with the quoting S1 reads."""
    (df.select(path_col, text_col).write.mode("overwrite").option("sep", "\t").option("quote", '"')
     .option("escape", '"').option("header", "false").csv(path))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: one JSON object per line, nulls kept as ``null``, non-ASCII kept as is."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = MANIFEST_SCHEMA, corrupt: bool = True) -> DataFrame:
    """JSON lines with an explicit schema; malformed lines land in ``_corrupt_record``."""
    r = spark.read.option("mode", "PERMISSIVE")
    if corrupt:
        schema = f"{schema}, _corrupt_record string"
        r = r.option("columnNameOfCorruptRecord", "_corrupt_record")
    return r.schema(schema).json(path)


def with_file_order(df: DataFrame, out: str = "pos") -> DataFrame:
    """S2 without a stored position: O1 over file order.

    Rows are ordered by (file path, start of the split they were read from, read order
    inside the task). File splits are packed into partitions out of offset order, but each
    split is read front to back, so this triple is the line order of the files. The read
    order comes from ``monotonically_increasing_id``, which is stable as long as the file
    listing is; O1 turns the triple into dense positions.
    """
    from tokenloom.operators.position import with_position

    tagged = df.select("*", F.col("_metadata.file_path").alias("_tl_file"),
                       F.col("_metadata.file_block_start").alias("_tl_block"),
                       F.monotonically_increasing_id().alias("_tl_seq"))
    return with_position(tagged, ["_tl_file", "_tl_block", "_tl_seq"], out=out).drop("_tl_file", "_tl_block", "_tl_seq")


def write_artifact(df: DataFrame, base: str, kind: str, key: str = "key", unique: bool = False) -> DataFrame:
    """Add the rows whose key is not stored yet to the ``kind`` table.

    Returns the rows that were written. Each run writes one folder ``run=<id>`` of its own and
    moves it into the table only when its job has succeeded, so a failed run leaves
    nothing in the table and a rerun adds no key twice. Of rows with one key in ``df`` the first
    by ``pos`` stays if there is such a column. Only a missing table means a
    first write; any other read failure is raised. One writer per table at a time. ``unique``: ``df`` has one row per key,
    so whole rows needn't be sorted to find that out.
    """
    from tokenloom.operators.joins import pending
    from tokenloom.operators.position import first_wins

    spark, target = df.sparkSession, os.path.join(base, kind)
    if path_exists(spark, target):
        df = pending(df, spark.read.parquet(target).select(key), key)
    if not unique:
        df = first_wins(df, key, "pos") if "pos" in df.columns else df.dropDuplicates([key])
    run = uuid.uuid4().hex[:12]
    staged = os.path.join(base, f"_{kind}-{run}")
    df.write.parquet(staged)
    move(spark, staged, os.path.join(target, f"run={run}"))
    return spark.read.schema(df.schema).parquet(os.path.join(target, f"run={run}"))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder into place, on whatever file system holds it."""
    a, fs = _hadoop_path(spark, source)
    b, _ = _hadoop_path(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def read_artifact(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """The stored ``kind`` table."""
    return spark.read.parquet(os.path.join(base, kind)).drop("run")


def write_bucketed_artifact(df: DataFrame, table_name: str, path: str, buckets: int, key: str = "key") -> None:
    """S6, co-located form: store an artifact hash-bucketed and sorted by ``key``.

    Tables written with the same bucket count join on ``key`` without any shuffle (the
    scan reports its bucketing to the planner). The table is registered in the session
    catalog over files in ``path`` (a shared folder).
    """
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table_name))


def read_bucketed_artifact(spark: SparkSession, table_name: str) -> DataFrame:
    return spark.table(table_name)
