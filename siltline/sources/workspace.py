"""The folder for tables, checkpoints and staged feeds: shared by all executors on a cluster."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A machine-local folder is used only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return tempfile.mkdtemp(prefix="siltline-")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, on any file system Spark reads; none if it does not exist."""
    return [name for name, is_folder in _entries(spark, path) if is_folder]


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``; none if it does not exist."""
    return [name for name, is_folder in _entries(spark, path) if not is_folder]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text, read by the driver."""
    files, file = _located(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file appear whole, or fail with ``FileExistsError`` if there is one of that name.

    It is written under a hidden name and renamed, which never replaces a file. Readers see all of it or nothing.
    """
    folder, _, name = path.rpartition("/")
    files, hidden = _located(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = files.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    _, file = _located(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(hidden), files.makeQualified(file), no_options)
    except Exception as error:
        files.delete(hidden, False)
        if "FileAlreadyExistsException" in str(error):
            raise FileExistsError(f"{path} exists") from error
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, if it exists."""
    files, folder = _located(spark, path)
    files.delete(folder, True)


def _located(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()), file


def _entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    files, folder = _located(spark, path)
    if not files.exists(folder):
        return []
    return sorted((f.getPath().getName(), f.isDirectory()) for f in files.listStatus(folder))
