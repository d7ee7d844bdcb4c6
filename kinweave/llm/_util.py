"""What the training-data operators share: tables, the shared folder, text buffers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share.

    It lies under ``spark.checkpoint.dir``. Where that is unset, a session on one
    machine (master ``local``) gets a temporary folder, which is set; any other fails,
    as its machines share no such folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="kinweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/kinweave-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session while a job runs; those of before come back after it."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def saved(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut
    at files that outlive any executor, so the job's shuffles can go when it ends."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a :func:`saved` table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Where the session has Spark's own 10,000 rows an Arrow batch, make it ``rows``, one
    value for all operators: texts are long, and the batches of two tasks and their workers
    share an executor. Another value of the session is left as it is. No result depends on it."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, rows)


def trim() -> None:
    """Return the free pages of this process to the system, where it can."""
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release:
        release(0)


def lean(run):
    """``run`` (a function of Arrow batches) in a worker that hands memory back: buffers
    come from the system's allocator and free pages are returned when the task ends.
    Workers are reused by later tasks, and two of them share an executor's memory."""

    def wrapped(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and its n + 1 offsets,
    without a copy of the text."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = 1 << 19):
    """Slices of a string column of about ``limit`` bytes each (one long text
    may be more): yields first row, next row, bytes, offsets."""
    data, offsets = bytes_of(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between each two offsets, 0 where there are none."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than ASCII white space, which
    don't cross rows, and the index of the first word of each row (n + 1)."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of all strings of ``gram`` bytes (8 or more). Hashes of 8 bytes are
    joined to those of 16, 32 and so on; two that overlap make any other length."""
    n = len(data)
    if n < gram:
        return np.zeros(0, np.uint64)
    h = mix(np.ndarray((n - 7,), np.uint64, np.ascontiguousarray(data), 0, (1,)) + _ODD)
    size = 8
    while size < gram:
        step = min(size, gram - size)
        h = mix(h[:-step] + h[step:] * _ODD)
        size += step
    return h


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = _POWERS[int(base)] = np.multiply.accumulate(have)
    return have[:n]


_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))


class RangeHash:
    """64-bit polynomial hashes of any byte ranges of one buffer, in O(1) each."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        base = _BASE if not seed else np.uint64(int(mix(np.array([seed], np.uint64))[0]) | 1)
        symbols = _SYMBOLS if not seed else mix(_SYMBOLS + np.uint64(seed))
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(symbols[data] * _powers(base, len(data)), out=self.prefix[1:])
        self.inverse = _powers(np.uint64(pow(int(base), -1, 1 << 64)), len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case: the caller adds its own."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def extended(df: DataFrame, **columns: str) -> T.StructType:
    """The schema of ``df`` and further columns."""
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in columns.items())).fields])


def first_of_id(df: DataFrame, twice: DataFrame, id_col: str) -> DataFrame:
    """One row of each id in ``twice`` (one column), the first by its values; all other rows."""
    name = twice.columns[0]
    if twice.isEmpty():
        return df
    alone = df.join(twice, df[id_col] == twice[name], "left_anti")
    several = df.join(twice, df[id_col] == twice[name], "left_semi")
    first = several.groupBy(id_col).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_row")).select("_row.*")
    return alone.unionByName(first)
