"""Exact duplicates by sorting on content.

Normalised texts are range-partitioned by sampled splitters and sorted within partitions, so equal texts are neighbours and a
comparison of whole neighbouring texts finds them. The sort key is the start of the text, its SHA-256 and the id: splitters stay
small whatever the texts' lengths, and a group of copies of any size is spread over as many partitions as its rows fill. Where a
group runs over the border of two partitions, the two runs at the border are compared and joined: two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm.common import ship
from riskloom.session import settle

WHITE = r"[\x20\x09-\x0D]+"
#: Characters of the text in the sort key; the digest decides between texts that start alike.
KEY_CHARS = 32


def normalised(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE, " ")


class _Runs:
    """Runs of equal neighbouring texts in one sorted partition, batch by batch. Only ids of the open run are held."""

    def __init__(self, schema: pa.Schema, carry: bool):
        self.schema, self.carry, self.part = schema, carry, TaskContext.get().partitionId()
        self.run, self.held, self.text = 0, [], None

    def batches(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("norm")
            new = np.ones(len(texts), bool)
            new[1:] = pc.not_equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
            new[0] = self.text is None or texts[0].as_py() != self.text
            starts = np.flatnonzero(new)
            self.text = texts[len(texts) - 1].as_py()
            if not len(starts):
                self._hold(batch, texts, 0, len(texts))
                continue
            self._hold(batch, texts, 0, starts[0])
            yield from self._close(last=False)
            if len(starts) > 1:
                yield self._closed(batch, texts, starts)
            self._hold(batch, texts, starts[-1], len(texts))
        yield from self._close(last=True)

    def _hold(self, batch, texts, start: int, stop: int) -> None:
        if stop > start:
            row = batch.column("row").slice(start, 1) if self.carry and not self.held else None
            self.held.append((batch.column("doc_id").slice(start, stop - start), batch.column("sha")[start], row,
                              texts[start].as_py() if not self.held else None))

    def _close(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        ids = pa.concat_arrays([h[0] for h in self.held])
        _, sha, row, text = self.held[0]
        edge = text if last or self.run == 0 else None
        size = len(ids)
        shown = ids.slice(0, 1) if self.carry else ids
        first = np.arange(len(shown)) == 0
        columns = [shown, pa.repeat(sha, len(shown)), pa.repeat(ids[0], len(shown)), pa.array(np.full(len(shown), size)), pa.array(first),
                   pa.array(np.full(len(shown), self.part, np.int64)), pa.array(np.full(len(shown), self.run, np.int64)),
                   pa.array([edge] + [None] * (len(shown) - 1), pa.string())]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns + ([row] if self.carry else []), self.schema)], schema=self.schema)
        self.run, self.held = self.run + 1, []

    def _closed(self, batch, texts, starts: np.ndarray) -> pa.RecordBatch:
        """Runs that begin and end within a batch: all from the first start to the last."""
        sizes = np.diff(starts)
        of = np.repeat(np.arange(len(sizes)), sizes)
        rows = np.arange(starts[0], starts[-1])
        first = rows == starts[of]
        if self.carry:
            of, rows, first = of[first], rows[first], first[first]
        ids = batch.column("doc_id")
        edges = [texts[int(starts[0])].as_py() if self.run == 0 and r == starts[0] else None for r in rows[:1]] + [None] * (len(rows) - 1)
        columns = [ids.take(pa.array(rows)), batch.column("sha").take(pa.array(rows)), ids.take(pa.array(starts[of])), pa.array(sizes[of]),
                   pa.array(first), pa.array(np.full(len(rows), self.part, np.int64)), pa.array(self.run + of), pa.array(edges, pa.string())]
        if self.carry:
            columns.append(batch.column("row").take(pa.array(rows)))
        self.run += len(sizes)
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def _runs(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    ship(docs.sparkSession)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    keyed = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"), *row)
    keyed = keyed.withColumn("sha", F.sha2("norm", 256))
    key = [F.substring("norm", 1, KEY_CHARS), F.col("sha"), F.col("doc_id").asc_nulls_last()]
    ordered = keyed.repartitionByRange(*key).sortWithinPartitions(*key)
    out = T.StructType([T.StructField("doc_id", keyed.schema["doc_id"].dataType), T.StructField("text_sha256", T.StringType()),
                        T.StructField("keep_id", keyed.schema["doc_id"].dataType), T.StructField("group_size", T.LongType()),
                        T.StructField("first", T.BooleanType()), T.StructField("part", T.LongType()), T.StructField("run", T.LongType()),
                        T.StructField("edge", T.StringType())] + ([keyed.schema["row"]] if carry else []))
    arrow = to_arrow_schema(out)

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _Runs(arrow, carry).batches(batches)

    return settle(ordered.mapInArrow(runs, out), "content-runs")


def _joined(runs: DataFrame) -> list[tuple]:
    """(part, run, keep_id, size, whether it is the group's first run) of runs that continue over partition borders."""
    edges = runs.filter(F.col("edge").isNotNull())
    # Two rows per partition, without texts.
    ends = sorted(edges.select("part", "run", "text_sha256", "keep_id", "group_size").collect(), key=lambda e: (e.part, e.run))
    near = [(a, b) for a, b in zip(ends, ends[1:]) if a.part != b.part and a.text_sha256 == b.text_sha256]
    if not near:
        return []
    spark = runs.sparkSession
    pairs = spark.createDataFrame([(a.part, a.run, b.part, b.run) for a, b in near], "pa long, ra long, pb long, rb long")
    a = edges.select(F.col("part").alias("pa"), F.col("run").alias("ra"), F.col("edge").alias("ta"))
    b = edges.select(F.col("part").alias("pb"), F.col("run").alias("rb"), F.col("edge").alias("tb"))
    same = pairs.join(a, ["pa", "ra"]).join(b, ["pb", "rb"]).filter("ta = tb").select("pa", "ra", "pb", "rb").collect()
    linked = {tuple(r) for r in same}
    chains: list[list] = []
    for a, b in near:
        if (a.part, a.run, b.part, b.run) not in linked:
            continue
        if chains and chains[-1][-1] is a:
            chains[-1].append(b)
        else:
            chains.append([a, b])
    return [(e.part, e.run, c[0].keep_id, sum(x.group_size for x in c), e is c[0]) for c in chains for e in c]


def _finished(runs: DataFrame) -> DataFrame:
    """Runs with the groups' ids and sizes; ``kept`` marks exactly one row of each group."""
    joined = _joined(runs)
    if not joined:
        return runs.withColumn("kept", F.col("first"))
    spark = runs.sparkSession
    kind = T.StructType([T.StructField("part", T.LongType()), T.StructField("run", T.LongType()),
                         T.StructField("to_id", runs.schema["keep_id"].dataType), T.StructField("to_size", T.LongType()),
                         T.StructField("head", T.BooleanType())])
    borders = spark.createDataFrame(joined, kind)  # at most two rows per partition
    wide = runs.join(F.broadcast(borders), ["part", "run"], "left")
    found = F.col("head").isNotNull()
    return (wide.withColumn("keep_id", F.when(found, F.col("to_id")).otherwise(F.col("keep_id")))
            .withColumn("group_size", F.when(found, F.col("to_size")).otherwise(F.col("group_size")))
            .withColumn("kept", F.col("first") & F.coalesce(F.col("head"), F.lit(True))))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's group of equal normalised texts: the id that stays, the group's rows, whether this row stays, the digest.

    One row for each row of ``docs``. A null text counts as empty; null ids come after all others; of rows that repeat both id and
    text exactly one is kept; other columns are not read; an empty table gives no rows.
    """
    return _finished(_runs(docs, id_col, text_col, carry=False)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return _finished(_runs(docs, id_col, text_col, carry=True)).filter("kept").select("row.*")
