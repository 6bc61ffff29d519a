"""Building blocks that keep plans safe at scale: stored intermediate tables, size-checked broadcasts, salted joins."""

from __future__ import annotations

import atexit
import contextlib
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only if its rows, as counted and measured, take at most this many bytes.
BROADCAST_BYTES = 24_000_000
#: What a row of a broadcast table takes besides its values.
ROW_BYTES = 32

_own: list[str] = []
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, as in tests, a local session gets a temporary one of its own; on a
    cluster that would be a folder of each machine, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="lexmill-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return _own[0]


def new_folder(spark: SparkSession, kind: str) -> str:
    """A name for a folder of intermediate data, which goes with the innermost scope or at the end of the process."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clear)
    _written.append((spark, path))
    return path


def stored(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and returns a read of it: the lineage is cut, and a lost executor loses nothing.

    Compressed columns take far less disk than RDD checkpoints and give the optimizer true sizes."""
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope():
    """Deletes the intermediate data written within it when it is left: a query's result is to be written or collected before that."""
    start = len(_written)
    try:
        yield
    finally:
        for spark, path in _written[start:]:
            _delete(spark, path)
        del _written[start:]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _clear() -> None:
    """Deletes what this process wrote, as far as the session still lives at its end."""
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session is gone, so the folder's owner has to clear it
            return


def drop_stored(df: DataFrame) -> None:
    """Deletes the table behind stored(df) once nothing reads it any more."""
    for path in {os.path.dirname(x) for x in df.inputFiles()}:
        if os.path.basename(path).startswith("stored-"):
            _delete(df.sparkSession, path)


def _width(kind: T.DataType, c: Column) -> Column | int:
    """The bytes of a value: a number where all values of the type take the same, else an expression."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(c) + 8
    if isinstance(kind, T.StructType):
        parts = [_width(f.dataType, c[f.name]) for f in kind.fields]
        fixed = sum(p for p in parts if isinstance(p, int)) + 8
        return functools.reduce(lambda s, p: s + F.coalesce(p, F.lit(0)), (p for p in parts if not isinstance(p, int)), F.lit(fixed)) if any(not isinstance(p, int) for p in parts) else fixed
    if isinstance(kind, T.MapType):
        return _width(T.ArrayType(kind.keyType), F.map_keys(c)) + _width(T.ArrayType(kind.valueType), F.map_values(c))
    if isinstance(kind, T.ArrayType):
        if isinstance(_width(kind.elementType, c), int):
            return F.size(c) * _width(kind.elementType, c) + 16
        return F.aggregate(c, F.lit(16).cast("long"), lambda s, x: s + F.coalesce(_width(kind.elementType, x).cast("long"), F.lit(0)))
    return 16 if isinstance(kind, T.DecimalType) else 8


def bytes_of(df: DataFrame, rows: int | None = None) -> int:
    """What the rows of df take in memory: counted times their width, or measured where the width differs. rows: their number if it is known."""
    widths = [_width(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields]
    fixed = sum(w for w in widths if isinstance(w, int)) + ROW_BYTES
    open_ = [F.coalesce(w.cast("long"), F.lit(0)) for w in widths if not isinstance(w, int)]
    if not open_:
        return fixed * (df.count() if rows is None else rows)
    n, size = df.agg(F.count("*"), F.sum(functools.reduce(lambda a, b: a + b, open_))).first()
    return fixed * n + (size or 0)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcast if its measured bytes stay within the limit; else left to a shuffled join."""
    return F.broadcast(df) if bytes_of(df) <= limit else df


def salted_lookup(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", salts: int = 8, spread: Column | None = None, limit: int = BROADCAST_BYTES, rows: int | None = None) -> DataFrame:
    """left joined to a stored right that is unique by `on`, though one key may hold a third of left's rows.

    Within the limit of bytes right is broadcast. Beyond it left's rows of a key are spread over `salts` parts and right is repeated as often.
    rows is right's number of rows where it is known already. Of several columns in `on` a null equals nothing."""
    if bytes_of(right, rows) <= limit:
        return left.join(F.broadcast(right), on, how)
    by = spread if spread is not None else F.rand(7)
    lhs = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    rhs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lhs.join(rhs, [*([on] if isinstance(on, str) else on), "_salt"], how).drop("_salt")


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """A stored table cut into ranges of the order columns, with the number of its range as _range: rows of one key stay in order over the
    ranges, and however many a key has, no task holds them all."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "k") -> DataFrame:
    """df with the number of each row within its group, from 1, by the order columns; a group may hold any share of the rows.

    Rows are numbered within ranges; each range begins where the counts of those before it end. Equal order values get any order."""
    parts = ranged(df, *group, *order)
    counts = parts.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(W.partitionBy(*group).orderBy("_range")) - F.col("_n")).drop("_n")
    condition = None
    own = parts.withColumn("_k", F.row_number().over(W.partitionBy(*group, "_range").orderBy(*order)))
    b = before.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate([*group, "_range"])], "_before")
    for i, c in enumerate([*group, "_range"]):
        x = own[c].eqNullSafe(b[f"_g{i}"])
        condition = x if i == 0 else condition & x
    return own.join(b, condition).withColumn(name, F.col("_k") + F.col("_before")).select(*df.columns, name)


def carried(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """df with the last non-null value up to each row of its group, by the order columns; a group may hold any share of the rows.

    Within a range the value is carried on by a window; rows before a range's first value take the last one of the ranges before it."""
    parts = ranged(df.withColumn("_v", value), *group, *order).withColumn("_o", F.struct(*order))
    last = parts.filter("_v IS NOT NULL").groupBy(*group, "_range").agg(F.max_by("_v", "_o").alias("_l"))
    held = parts.select(*group, "_range").distinct().join(last, [*group, "_range"], "left")
    into = held.withColumn("_in", F.last("_l", ignorenulls=True).over(W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))).drop("_l")
    within = F.last("_v", ignorenulls=True).over(W.partitionBy(*group, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return parts.withColumn("_w", within).join(into, [*group, "_range"]).withColumn(name, F.coalesce("_w", "_in")).select(*df.columns, name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the workbench, one Parquet file or folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
