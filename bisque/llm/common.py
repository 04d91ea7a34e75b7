"""Helpers shared by the text operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts handed to Python code at once; keeps a worker's memory bounded whatever the Arrow batch holds.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, one of our own, but only for a local master: executors on other machines could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "bisque-checkpoints")


_folders: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it is removed when the driver's Python ends, or by ``clean``."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{shared_folder(spark)}/bisque-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(clean, spark)
    return _folders[app]


def clean(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; results that still read them are lost."""
    try:
        sc = spark.sparkContext
        folder = _folders.pop(sc.applicationId, None)
        if folder and sc._jsc is not None:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session is gone already, and with it the way to the folder
        return


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows and bytes in an Arrow batch for what is run inside, as JVM and worker each hold one; the session's settings are put back."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {key: spark.conf.get(key) for key in (rows, size)}
    spark.conf.set(rows, str(min(int(before[rows]), 1000) if int(before[rows]) > 0 else 1000))
    spark.conf.set(size, "4m")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut, and lost executors lose nothing of it."""
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(stage: Callable) -> Callable:
    """``stage`` with its result ``stored``: Arrow batches are as large as the session says when rows are made, so the stage makes them itself."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stored(stage(spark, docs, sf_dir))

    return run


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose names clash with ``names`` (case-insensitively)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def lower_az(c):
    """A-Z to a-z, nothing else (``lower`` would also fold other scripts)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    i, n = 0, batch.num_rows
    if n == 0:
        return
    sizes = batch.column(column)
    if pa.types.is_dictionary(sizes.type):
        sizes = sizes.dictionary_decode()
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False).cumsum()
    while i < n:
        base = int(lengths[i - 1]) if i else 0
        j = max(i + 1, int(lengths.searchsorted(base + SLICE_BYTES, "right")))
        yield batch.slice(i, j - i)
        i = j


def give_back() -> None:
    """Free memory that Arrow and the C library keep goes back to the system: a worker stays between stages, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        return


def map_text(df: DataFrame, column: str, fields: str, make: Callable[[], Callable[[list], dict]], arrow: bool = False) -> DataFrame:
    """``df`` with the columns that ``fields`` (DDL) names, made from the text column in Arrow batches.

    ``make`` is called once a task and returns a function from a list of texts (None for null), or an Arrow array of them, to lists by name.
    Columns of ``df`` that clash with a new one are replaced by it. Batches are bounded by Spark in rows and bytes
    (``spark.sql.execution.arrow.maxBytesPerBatch``), and cut again here.
    """
    new = T.StructType.fromDDL(fields)
    low = {f.name.lower() for f in new}
    keep = [c for c in df.columns if c.lower() not in low]
    src, also = "__text__", [F.col(f"`{column}`").cast("string").alias("__text__")]
    if column in keep and isinstance(df.schema[column].dataType, T.StringType):  # one copy of the text is enough
        src, also = column, []
    given = df.select(*[F.col(f"`{c}`") for c in keep], *also)
    schema = T.StructType([*(given.schema[c] for c in keep), *new])
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in new}

    def run(batches):
        f = None
        for whole in batches:
            for b in _slices(whole, src):
                f = f or make()
                made = f(b.column(src) if arrow else b.column(src).to_pylist())
                arrays = [b.column(c) for c in keep] + [pa.array(made[n], type=k) for n, k in kinds.items()]
                out = pa.RecordBatch.from_arrays(arrays, names=[*keep, *kinds])
                del b, made, arrays
                yield out
                del out
            del whole
            give_back()

    return given.mapInArrow(run, schema)
