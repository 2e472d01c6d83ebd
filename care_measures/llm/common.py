"""Helpers shared by the training-data operators: row keys, stored intermediate tables, learning folds."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROW, DOC = "__row", "__doc"
_MARK = "llm_row_key"


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="llm-shared-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); one of our own where none is set and all is local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return shared or _own_dir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df written to the shared folder and read again: cuts the lineage, and lost executors lose nothing.

    Texts make up most of what is stored, and zstd takes half the room of Spark's default for them."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if _temporary.get():
        _temporary.get()[-1].append((path, out))
    return out


_temporary: ContextVar[tuple[list, ...]] = ContextVar("temporary", default=())


@contextmanager
def temporary() -> Iterator[Callable[..., None]]:
    """Deletes the tables stored inside the block when it ends, but for those that are named as kept: what the block returns
    may read no others."""
    own: list[tuple[str, DataFrame]] = []
    kept: list[DataFrame] = []
    token = _temporary.set((*_temporary.get(), own))
    try:
        yield lambda *tables: kept.extend(tables)
    finally:
        _temporary.reset(token)
        for path, table in own:
            if not any(table is k for k in kept):
                drop_stored(table, path)
        _release_shuffles()


def done_with(*tables: DataFrame) -> None:
    """Deletes tables stored in the open block that no later step reads, before the block ends; tables stored elsewhere stay."""
    if _temporary.get():
        own = _temporary.get()[-1]
        for path, table in own:
            if any(table is t for t in tables):
                drop_stored(table, path)
        own[:] = [x for x in own if not any(x[1] is t for t in tables)]
        _release_shuffles()


def _release_shuffles() -> None:
    """Lets Spark delete the shuffle files of steps that are done: it does once the driver's JVM has collected their handles,
    which a large heap may put off until the disks of the executors are full."""
    gc.collect()
    context = SparkContext._active_spark_context
    if context is not None:
        context._jvm.System.gc()


def drop_stored(table: DataFrame, path: str | None = None) -> None:
    """Deletes the files of a stored table that no later step reads."""
    spark = table.sparkSession
    if path is None:
        files = table.inputFiles()
        if not files:
            return
        path = files[0].rsplit("/", 1)[0]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@cache
def _ship(application: str) -> None:
    """Sends this package to the application's Python workers, which may not have it installed."""
    package, archive = Path(__file__).resolve().parents[1], Path(tempfile.mkdtemp(prefix="llm-package-"), "package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    SparkContext.getOrCreate().addPyFile(str(archive))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a key for each row, stored: (__row, __doc), __doc holding the columns of docs whatever their names are.

    Keys that Spark numbers anew at each reading depend on how files are dealt to tasks, and that on the executors there
    are just then. So whoever reads rows more than once and joins by their keys reads them from here. What is
    numbered already is returned as it is."""
    if is_numbered(docs):
        return docs
    key = F.monotonically_increasing_id().alias(ROW, metadata={_MARK: True})
    return stored(docs.select(key, F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias(DOC)), "numbered")


def is_numbered(docs: DataFrame) -> bool:
    return docs.columns == [ROW, DOC] and bool(docs.schema[ROW].metadata.get(_MARK))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keyed(docs: DataFrame) -> DataFrame:
    """(__row, doc_id, text): a key for each row, whatever its doc_id; a null text counts as empty.

    Extra columns are left out here, so their names cannot clash. The keys of a numbered table are those stored; those of
    another hold within one reading only."""
    _ship(docs.sparkSession.sparkContext.applicationId)
    key, of = (F.col(ROW), f"{DOC}.") if is_numbered(docs) else (F.monotonically_increasing_id(), "")
    return docs.select(
        key.alias(ROW), F.col(f"{of}doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"{of}text"), F.lit("")).alias("text"))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of a numbered table whose key is in kept, with the columns it was numbered with."""
    if not is_numbered(docs):
        raise ValueError("rows can be kept by key from a numbered table only")
    return docs.join(kept.select(ROW), ROW, "left_semi").select(f"{DOC}.*")


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; a null doc_id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
