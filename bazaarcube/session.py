"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A dimension is broadcast only when its measured row count is at most this.
BROADCAST_ROWS_CONF = "bazaarcube.broadcast.rows"
BROADCAST_ROWS_DEFAULT = 1_000_000


def build_session(app: str = "bazaarcube", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; clusters may bring their own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_ROWS_DEFAULT)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster session without it is refused, since a machine-local folder would
    lose the staged tables together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="bazaarcube-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    fixes rows that depend on the physical partitioning."""
    return stage_at(df, new_folder(df.sparkSession, name))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _file_system(spark, path)
    return fs.exists(found)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, found = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(found)] if fs.exists(found) else []


def move_folder(spark: SparkSession, path: str, target: str) -> bool:
    """Give a complete folder its final name in one step; False if the name is taken."""
    fs, source = _file_system(spark, path)
    _, final = _file_system(spark, target)
    if fs.exists(final):
        return False
    fs.mkdirs(final.getParent())
    return fs.rename(source, final)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, found = _file_system(spark, path)
    fs.delete(found, True)


def write_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file; readers see the old or the new one."""
    jvm = spark.sparkContext._jvm
    _, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    _, final = _file_system(spark, path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if final.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    fs, _ = _file_system(spark, path)
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(draft, final, options)


def read_pointer(spark: SparkSession, path: str) -> str | None:
    fs, found = _file_system(spark, path)
    if not fs.exists(found):
        return None
    return spark.read.text(path, wholetext=True).first()[0]
