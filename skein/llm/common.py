"""Shared plumbing: durable intermediates, Arrow text batches and vectorised token hashing."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the numpy kernels take at once; a longer single text is taken alone.
CHUNK_BYTES = 1 << 20
#: Rows in an Arrow batch: long texts make large batches.
ARROW_ROWS = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. It comes from spark.checkpoint.dir; where that is unset, a temporary folder
    serves a session in one JVM, as in tests, and a cluster gets an error."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="skein-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut from its lineage by a reliable checkpoint; for thin tables, which Spark removes with the reference."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back; for tables of which parts are read several times."""
    spark = df.sparkSession
    return written(df, f"{shared_dir(spark)}/skein/{label}-{uuid.uuid4().hex}")


class Scratch:
    """Tables that are stored while a result is made; leaving the block removes them. What outlives it is checkpointed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            removed(self.spark, path)

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(f"{shared_dir(self.spark)}/skein/{label}-{uuid.uuid4().hex}")
        return written(df, self.paths[-1])


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ship_package(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once per context, where workers need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_skein_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="skein-src-")) / "skein_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._skein_shipped = True


def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bounds the rows of an Arrow batch, since whole texts are sent, and makes sure that workers have this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: str, folds: int):
    """crc32 of the decimal text of doc_id, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `most` bytes each, one row at least."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = b


_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (splitmix finaliser)."""
    x = (x + _M3).astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_POW = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        with np.errstate(over="ignore"):
            _POW = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 4096) * 2, 0x5851F42D4C957F2D, np.uint64)]), dtype=np.uint64)
    return _POW[:n]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: 0 white space, 1 letters, digits and all bytes above 127, 2 other signs.
_KIND = np.full(256, 2, np.uint8)
_KIND[_SPACE] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def token_spans(buf: np.ndarray, offs: np.ndarray, signs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each token: runs without white space, or (signs) runs of one kind of character."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    kind = _KIND[buf] if signs else (~_SPACE[buf]).view(np.uint8)
    cut = np.empty(len(buf) + 1, bool)
    cut[0] = cut[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
    cut[offs[1:-1]] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def token_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each token."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    total = int(first[-1] + lens[-1])
    pos = np.arange(total, dtype=np.int64) - np.repeat(first, lens)
    at = pos + np.repeat(starts, lens)
    with np.errstate(over="ignore"):
        vals = (buf[at].astype(np.uint64) + np.uint64(1)) * _powers(int(lens.max()))[pos]
        return mix64(np.add.reduceat(vals, first))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def lean(run):
    """run(batches) as a worker's function that gives freed memory back to the system at its end: workers are kept for
    later tasks, and stages that don't use them need the room."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
            trim(0)

    return whole


def mapped(df: DataFrame, kernel, schema: str, rows: int = ARROW_ROWS) -> DataFrame:
    """kernel(batch) over Arrow batches, in the executors; it may return one batch or yield several."""
    arrow_rows(df.sparkSession, rows)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = kernel(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(lean(run), schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed, and written into the plan, once."""
    return F.transform(F.array(value), body)[0]


def running(items: Column, state: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]], block: int = 128) -> Column:
    """Array of what step(state, item) = (next state, array of results) gives for each item in order. Arrays grow within
    blocks and blocks within a list of them, so long arrays are not copied for each item."""
    some, none = f"array<{out}>", F.array()

    def inner(s: Column, x: Column) -> Column:
        made = F.struct(*[c.alias(k) for k, c in zip(("state", "more"), step(s["state"], x), strict=True)])
        return let(made, lambda r: F.struct(r["state"].alias("state"), F.concat(s["out"], r["more"]).alias("out")))

    def outer(s: Column, part: Column) -> Column:
        one = F.aggregate(part, F.struct(s["state"].alias("state"), none.cast(some).alias("out")), inner)
        return let(one, lambda r: F.struct(r["state"].alias("state"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    def whole(x: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / block).cast("int")), lambda k: F.slice(x, k * block + 1, F.lit(block)))
        made = F.aggregate(parts, F.struct(state.alias("state"), none.cast(f"array<{some}>").alias("out")), outer, lambda s: F.flatten(s["out"]))
        return F.when(F.size(x) > 0, made).otherwise(none.cast(some))

    return let(items, whole)
