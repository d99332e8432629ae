"""Where intermediate tables live, and how a result is pinned before it is reused.

Everything that must outlive an executor goes to the shared folder named by
``spark.checkpoint.dir``. Only a local master without that setting falls back
to a temporary folder, which is what the tests use.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; sets one only on a local master."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="epiframe-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/epiframe-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder.

    Used before a result is read more than once when its values could differ
    between two evaluations (floating-point sums) or are costly to repeat.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` stored at ``path`` and read back: computed once, whatever reads it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system it names."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job committed its output at ``path``."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` at ``path`` in one step: a reader sees what was there before, or this, never a part."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target, aside = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    kinds = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE
    hadoop.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(aside), files.makeQualified(target), how)


def published(spark: SparkSession, path: str) -> str | None:
    """The text at ``path``, or None where there is none."""
    if not exists(spark, path):
        return None
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
