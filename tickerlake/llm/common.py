"""Helpers shared by the operators: words, row-wise Arrow maps, stored tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from tickerlake.session import ensure_checkpoint_dir

# ASCII letters are lower-cased, ASCII digits kept, every other ASCII byte
# becomes a space; bytes of 128 and more (all parts of non-ASCII characters)
# are word bytes.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8 bytes."""
    return utf8(text).translate(_WORD_BYTES).split()


_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, unless their path already has it (once per application)."""
    sc = spark.sparkContext
    root = os.path.dirname(_PACKAGE)
    if sc.applicationId in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tickerlake-code-"), "tickerlake.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)  # Spark's file server hands it to every executor
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, make: Callable[[], Callable[[list], Iterable[tuple]]], schema: str) -> DataFrame:
    """``mapInArrow`` on rows as tuples.

    ``make()`` runs once per task and returns a function from the list of a
    batch's rows to output tuples in ``schema`` order.  Batches stay bounded
    (Spark's Arrow batch limits), output is cut into batches of bounded size.
    """
    ship(df.sparkSession)
    fields: StructType = _parse_datatype_string(schema)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in fields])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in it:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            out: list[tuple] = []
            weight = 0
            for row in fn(rows):
                out.append(row)
                weight += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
                if weight > 8_000_000:
                    yield _batch(out, arrow)
                    out, weight = [], 0
            if out:
                yield _batch(out, arrow)

    return df.mapInArrow(batches, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow
    )


def annotate(df: DataFrame, make: Callable[[], Callable[[list], Iterable[tuple]]], inputs: list[str], schema: str) -> DataFrame:
    """Append the columns of ``schema`` to every row, one output tuple per row in order.

    The function sees only ``inputs``.  A column of the input that has the
    name of a new one is replaced.
    """
    ship(df.sparkSession)
    new: StructType = _parse_datatype_string(schema)
    keep = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new.names or c in inputs])
    kept = [c for c in keep.columns if c not in new.names]
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in new])
    out = StructType([keep.schema[c] for c in kept] + new.fields)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in it:
            if not batch.num_rows:
                continue
            rows = list(zip(*(batch.column(c).to_pylist() for c in inputs), strict=True))
            made = _batch(list(fn(rows)), arrow)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + made.columns, names=out.names)

    return keep.mapInArrow(batches, out)


def map_groups(df: DataFrame, keys: list[str], make: Callable[[], Callable[[tuple, list], Iterable[tuple]]], schema: str) -> DataFrame:
    """Call a function with (key, rows) for each group of equal ``keys``, on rows as tuples.

    Rows are dealt by a hash of the keys and sorted, so groups arrive one
    after another; the caller bounds the size of a group.
    """
    ship(df.sparkSession)
    fields: StructType = _parse_datatype_string(schema)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in fields])
    n = len(keys)
    dealt = df.select(*keys, *[c for c in df.columns if c not in keys]).repartition(*keys).sortWithinPartitions(*keys)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        key, rows, out = None, [], []
        for batch in it:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:n] != key:
                    if rows:
                        out.extend(fn(key, rows))
                    key, rows = row[:n], []
                rows.append(row[n:])
                if len(out) > 20_000:
                    yield _batch(out, arrow)
                    out = []
        if rows:
            out.extend(fn(key, rows))
        if out:
            yield _batch(out, arrow)

    return dealt.mapInArrow(batches, schema)
