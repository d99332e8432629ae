"""Snapshots of a computed table, keyed by what went into it."""

import os
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.functions.ids import signature
from epiframe.storage import exists, is_complete, publish, published

FORMAT_VERSION = 1
#: The file that names the version to read.
POINTER = "current"


def input_fingerprint(spark: SparkSession, paths: str | list[str]) -> str:
    """A digest of the input files' names, sizes and times; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    row = files.agg(F.count("*"), F.sum("length"), F.bit_xor(each)).first()
    return "-".join(str(v) for v in row)


def snapshot_signature(
    spark: SparkSession, repo_id: str, root: str, n_rows: int, image_keys: Sequence[str], inputs: str = "",
    selection: str = "",
) -> str:
    """The signature of a snapshot; ``inputs`` and ``selection`` tell apart equal row counts.

    A local ``root`` counts as its absolute path.
    """
    if root and "://" not in root:
        root = os.path.abspath(root)
    keys = F.array(*[F.lit(k) for k in image_keys]) if image_keys else F.array().cast("array<string>")
    fields = [F.lit(repo_id), F.lit(root), F.lit(n_rows), keys, F.lit(str(FORMAT_VERSION)), F.lit(inputs), F.lit(selection)]
    return spark.range(1).select(signature(*fields)).first()[0]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the snapshot's published version, or None."""
    name = published(spark, f"{path}/{POINTER}")
    return f"{path}/versions/{name.strip()}" if name and name.strip() else None


def _guarded(read):
    """``read()``, or None if what it reads is damaged."""
    try:
        return read()
    except PySparkException:
        return None
    except Exception as error:  # a damaged file surfaces as the JVM's own error
        if type(error).__module__.startswith(("py4j", "pyspark")):
            return None
        raise


def _manifest(spark: SparkSession, version: str | None, key: str):
    """The manifest of a version, if it is complete and of this signature."""
    if version is None or not exists(spark, f"{version}/manifest"):
        return None
    row = spark.read.parquet(f"{version}/manifest").first()
    return row if row is not None and row["version"] == FORMAT_VERSION and row["signature"] == key else None


def load(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The stored table if its manifest fits and its files can be read, else None."""

    def read() -> DataFrame | None:
        version = current(spark, path)
        manifest = _manifest(spark, version, key)
        if manifest is None or not is_complete(spark, f"{version}/data"):
            return None
        data = spark.read.parquet(f"{version}/data")
        return data if data.count() == manifest["n_rows"] else None

    return _guarded(read)


def read_manifest(spark: SparkSession, directory: str, key: str) -> dict:
    """What was written beside a snapshot."""
    return spark.read.parquet(f"{current(spark, f'{directory.rstrip("/")}/{key}')}/manifest").first().asDict()


def _write_manifest(data: DataFrame, version: str, key: str, notes: Mapping[str, Sequence[str]]) -> None:
    manifest = data.agg(
        F.lit(FORMAT_VERSION).alias("version"), F.lit(key).alias("signature"), F.count("*").alias("n_rows"),
        *[F.array(*[F.lit(v) for v in values]).cast("array<string>").alias(name) for name, values in notes.items()],
    )
    manifest.coalesce(1).write.parquet(f"{version}/manifest")


def materialize(
    df: DataFrame, directory: str | None, key: str, refresh: bool = False, notes: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """``df`` from its snapshot; computed and stored when there is no valid one.

    ``directory=None`` turns snapshots off. A snapshot is written beside the one that is there, with
    its manifest (which holds ``notes``, lists of names), and published by a pointer that changes in one step:
    whoever reads the old version goes on reading it, and a write that did not finish is
    never taken for a snapshot. ``drop_old_versions`` removes what no one reads any more.
    """
    if directory is None:
        return df
    spark = df.sparkSession
    path = f"{directory.rstrip('/')}/{key}"
    stored = None if refresh else load(spark, path, key)
    if stored is not None:
        return stored
    name = uuid.uuid4().hex
    version = f"{path}/versions/{name}"
    df.write.parquet(f"{version}/data")
    data = spark.read.schema(df.schema).parquet(f"{version}/data")
    _write_manifest(data, version, key, notes or {})
    publish(spark, f"{path}/{POINTER}", name)
    return data


def _input_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, uri and digest (of name, size and time) of every input file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    facts = F.concat_ws("|", "_metadata.file_path", F.col("_metadata.file_size").cast("string"), F.unix_micros("_metadata.file_modification_time").cast("string"))
    return files.select("path", F.col("_metadata.file_path").alias("uri"), F.sha1(facts.cast("binary")).alias("digest"))


def materialize_files(
    spark: SparkSession, paths: str | Sequence[str], transform: Callable[[DataFrame], DataFrame], directory: str, key: str, refresh: bool = False
) -> DataFrame:
    """``transform`` of the rows of Parquet files, kept per input file: only files that are new or changed are computed.

    ``transform`` must treat rows one by one or file by file, and keep the column ``_digest``, which names a row's file.
    Every version lists the files it consists of and where the rows of each are stored; versions share what did not change.
    Rows of files that are gone are left out. Publishing is as in ``materialize``. As Spark does to read
    them, the driver holds the list of files.
    """
    path = f"{directory.rstrip('/')}/{key}"
    files = {r["digest"]: r for r in _input_files(spark, [paths] if isinstance(paths, str) else paths).collect()}

    def before() -> tuple[str, dict] | None:
        version = current(spark, path)
        if _manifest(spark, version, key) is None:
            return None
        return version, {r["digest"]: r for r in spark.read.parquet(f"{version}/files").collect()}

    known = None if refresh else _guarded(before)
    stored = known[1] if known else {}
    fresh = [r for digest, r in files.items() if digest not in stored]
    kept = [r for digest, r in stored.items() if digest in files]
    if known and not fresh and len(kept) == len(stored):
        return _read_parts(spark, path, kept, spark.read.parquet(f"{known[0]}/schema").schema)
    name = uuid.uuid4().hex
    version = f"{path}/versions/{name}"
    # the schema of the result, whichever files there are
    source = spark.read.parquet(*[r["path"] for r in (fresh or files.values())]) if files else None
    if source is None:
        raise FileNotFoundError(f"no input files at {paths}")
    digests = spark.createDataFrame([(r["uri"], r["digest"]) for r in files.values()], "_uri string, _digest string")
    marked = source.withColumn("_uri", F.col("_metadata.file_path")).join(F.broadcast(digests), "_uri").drop("_uri")
    rows = transform(marked)
    schema = rows.drop("_digest").schema
    counts = {}
    if fresh:
        rows.write.partitionBy("_digest").parquet(f"{version}/data")
        held = spark.read.schema(rows.schema).parquet(f"{version}/data")
        counts = {r["_digest"]: r["count"] for r in held.groupBy("_digest").count().collect()}
    listed = [(r["digest"], r["path"], r["part"], r["n"]) for r in kept] + [(r["digest"], r["path"], name, counts.get(r["digest"], 0)) for r in fresh]
    spark.createDataFrame(listed, "digest string, path string, part string, n long").coalesce(1).write.parquet(f"{version}/files")
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{version}/schema")
    _write_manifest(spark.read.parquet(f"{version}/files"), version, key, {})
    publish(spark, f"{path}/{POINTER}", name)
    return _read_parts(spark, path, spark.read.parquet(f"{version}/files").collect(), schema)


def _read_parts(spark: SparkSession, path: str, files: Sequence, schema) -> DataFrame:
    folders = [f"{path}/versions/{r['part']}/data/_digest={r['digest']}" for r in files if r["n"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def drop_old_versions(spark: SparkSession, directory: str, key: str) -> list[str]:
    """Delete the versions of a snapshot that its published one does not need; who reads them still, fails. Their names."""
    path = f"{directory.rstrip('/')}/{key}"
    version = current(spark, path)
    if version is None:
        return []
    needed = {version.rsplit("/", 1)[1]}
    if exists(spark, f"{version}/files"):
        needed |= {r["part"] for r in spark.read.parquet(f"{version}/files").select("part").distinct().collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName() not in needed]
    for old in gone:
        files.delete(old, True)
    return [old.getName() for old in gone]
