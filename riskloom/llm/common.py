"""Helpers the text operators share: folds, fresh column names, text blocks and splitting at single spaces."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text a task works on at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the workers, once for each application, so that a session built anywhere can run the operators."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="riskloom-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(folds)


def fresh(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores until no column of ``taken`` has that name in any case."""
    names = {n.lower() for n in taken}
    while base.lower() in names:
        base += "_"
    return base


def slices(columns: Iterable[pa.Array], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    """Each text column, null as empty, with its consecutive parts of about ``limit`` bytes; a longer text is a part of its own."""
    for column in columns:
        if pa.types.is_large_string(column.type):
            column = column.cast(pa.string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        filled = pc.fill_null(column, "")
        parts, start = [], 0
        while start < len(column):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, "right")))
            parts.append(filled.slice(start, stop - start))
            start = stop
        yield column, parts


def in_blocks(columns: Iterable[pa.Array], work, kind: pa.StructType) -> Iterator[pa.Array]:
    """Apply ``work`` (a part of a text column -> one Arrow array or list per field) part by part; a struct array per column."""
    for _, parts in slices(columns):
        done = [work(part) for part in parts]
        fields = [pa.concat_arrays([pa.array(d[i], f.type) for d in done]) if done else pa.array([], f.type) for i, f in enumerate(kind)]
        yield pa.StructArray.from_arrays(fields, fields=list(kind))
