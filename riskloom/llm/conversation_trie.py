"""The trie of shared conversation beginnings, from padded matrices of turn ids.

Rebuilt conversations are range-partitioned by their turns, so a shard is a stretch of the sorted conversations and a trie node is
a run of rows. A shard sorts a padded matrix of turn ids (`lexsort`), column by column in bands of bounded width; changes against
the row above, OR-accumulated along the columns, mark where the nodes of each depth start; `reduceat` sums each depth up. Only
beginnings of a shard's first and last row can go on in other shards. Their sums are added up by a digest of the beginning, and
what two neighbouring shards both counted is taken off again: a few rows per shard, whatever the number of conversations.

A turn's id is the first 16 bytes of a SHA-256 of role and text. Equal conversations are dealt out by their ids, so a conversation
or a first turn that very many rows share fills as many shards as its rows need. All turns of one conversation (20 bytes each,
without texts) are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ship
from riskloom.session import settle

FAMILY, MOST_HEAD = 5, 9
#: Bytes of a turn: its digest, then the length of its text.
DIGEST, TURN = 16, 20
#: Columns of one padded matrix; turns of one shard.
BAND, SHARD_TURNS = 64, 1_000_000
NOTHING = hashlib.sha256(b"").hexdigest()

_PARTS = """conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string,
  shard long, chain long, parent_chain long, key binary, parent_key binary, is_first boolean, is_last boolean, last_length long, bytes long, ends string"""
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Each conversation's id and rebuilt turns, 20 bytes a turn: the first h turns of the family's first, then its own from h on.

    h is the crc32 of the decimal id modulo 9, the family's first is the id less its remainder by 5. Turns go by their number,
    null first; turns of one number by their digest. Null roles and texts are empty; rows without a conversation are left out.
    """
    c = F.col("conv_id")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.sha2(F.coalesce(F.col(role_col), F.lit("")), 256), text), 256)
    turn = F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.octet_length(text)), 2 * (TURN - DIGEST), "0"))
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("at"), turn.alias("turn"))
    rows = rows.filter(c.isNotNull()).withColumn("family", c - c % FAMILY)
    # One exchange by family: the turns of a conversation, and the conversations of a family, are then in one partition.
    whole = (rows.repartition("family").groupBy("family", "conv_id")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("at").isNotNull(), "at", "turn"))).alias("all"))
             .select("family", "conv_id", F.array_join(F.col("all.turn"), "").alias("own")))
    width = 2 * TURN
    h = (F.crc32(c.cast("string")) % F.lit(MOST_HEAD)).cast("int")
    head = F.max(F.when(c == F.col("family"), F.substring("own", 1, width * MOST_HEAD))).over(Window.partitionBy("family"))
    start = F.coalesce(head, F.lit("")).substr(F.lit(1), h * width)
    rest = F.col("own").substr(h * width + 1, F.length("own"))
    return whole.select("conv_id", F.unhex(F.concat(start, rest)).alias("turns"))


class Shard:
    """Nodes of one stretch of sorted conversations."""

    def __init__(self, convs: np.ndarray, turns: list[bytes], number: int):
        self.number = number
        lengths = np.array([len(t) // TURN for t in turns], np.int64)
        flat = np.frombuffer(b"".join(turns), np.uint8).reshape(-1, TURN)
        digests = np.ascontiguousarray(flat[:, :DIGEST]).view(">u8").astype(np.uint64).reshape(-1, 2)
        self.sizes = np.ascontiguousarray(flat[:, DIGEST:]).view(">u4").astype(np.int64).reshape(-1)
        self.first = np.cumsum(lengths) - lengths
        self.turn_ids, self.lengths = _dense(digests), lengths
        self.order = self._sorted(convs)
        self.convs, self.lengths, self.first = convs[self.order], lengths[self.order], self.first[self.order]
        self.digests = digests
        self.valid, self.starts = self._marks()

    def _matrix(self, rows: np.ndarray, low: int) -> np.ndarray:
        """Turn ids of columns [low, low + BAND) of these rows, 0 where a row has ended."""
        held = np.minimum(self.lengths[rows] - low, BAND)
        out = np.zeros((len(rows), int(held.max(initial=0))), np.int64)
        inside = np.arange(out.shape[1]) < held[:, None]
        at = self.first[rows][:, None] + low + np.arange(out.shape[1])
        out[inside] = self.turn_ids[at[inside]]
        return out

    def _sorted(self, convs: np.ndarray) -> np.ndarray:
        """Rows by turns, then id: stable sorts from the last band to the first; only rows that reach a band are moved by it."""
        order = np.argsort(convs, kind="stable")
        for low in range(int(self.lengths.max(initial=0)) // BAND * BAND, -1, -BAND):
            reach = self.lengths[order] > low
            rows = order[reach]
            if len(rows):
                matrix = self._matrix(rows, low)
                order = np.concatenate([order[~reach], rows[np.lexsort(matrix.T[::-1])]])
        return order

    def _marks(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each depth: the rows that reach it, and where among them its nodes start."""
        rows = np.arange(len(self.lengths))
        valid, starts = [rows], [np.zeros(1, np.int64)]
        before = np.zeros(len(rows), np.int64)  # node of each row at the depth before the band
        for low in range(0, int(self.lengths.max(initial=0)), BAND):
            reach = self.lengths[rows] > low
            rows, before = rows[reach], before[reach]
            matrix = self._matrix(rows, low)
            change = np.ones(matrix.shape, bool)
            change[1:] = matrix[1:] != matrix[:-1]
            change[1:, 0] |= before[1:] != before[:-1]
            np.logical_or.accumulate(change, axis=1, out=change)
            for j in range(matrix.shape[1]):
                own = matrix[:, j] > 0
                valid.append(rows[own])
                starts.append(np.flatnonzero(change[own, j]))
            before = np.cumsum(change[:, -1])
        return valid, starts

    def _path(self, row: int) -> list[bytes]:
        """Digests of the beginnings of a row, from the empty one on."""
        out = [bytes(DIGEST)]
        for k in range(int(self.lengths[row])):
            hi, lo = self.digests[self.first[row] + k]
            out.append(hashlib.sha256(out[-1] + int(hi).to_bytes(8, "big") + int(lo).to_bytes(8, "big")).digest()[:DIGEST])
        return out

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        depths, last = len(self.valid), len(self.convs) - 1
        conv = [np.minimum.reduceat(self.convs[v], s) for v, s in zip(self.valid, self.starts)]
        paths = self._path(0), self._path(last)
        leaf, saved = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)  # sums below, kept at each node's first row
        for d in range(depths - 1, -1, -1):
            v, s = self.valid[d], self.starts[d]
            n, top = np.diff(np.append(s, len(v))), v[s]
            children = np.zeros(len(s), np.int64)
            if d + 1 < depths:
                below = self.valid[d + 1][self.starts[d + 1]]
                children = np.bincount(np.searchsorted(top, below, "right") - 1, minlength=len(s))
            size = self.sizes[self.first[top] + d - 1] if d else np.zeros(len(s), np.int64)
            leaf[top] += children == 0
            saved[top] += (n - 1) * size
            n_leaves, saved_tokens = np.add.reduceat(leaf[v], s), np.add.reduceat(saved[v], s)
            parent = np.searchsorted(self.valid[d - 1][self.starts[d - 1]], top, "right") - 1 if d else np.zeros(len(s), np.int64)
            chain, ends = self._chain(d), self._ends(v, s, d)
            known = [conv[d], np.full(len(s), d), conv[d - 1][parent] if d else conv[d], n, children, n_leaves, saved_tokens]
            above = self._chain(d - 1)[parent] if d else np.full(len(s), -1)
            shown = np.flatnonzero(chain < 0)
            yield self._closed(schema, [k[shown] for k in known], above[shown], [ends[i] for i in shown])
            yield self._open(schema, np.flatnonzero(chain >= 0), known, chain, size, ends, paths, d)

    def _chain(self, d: int) -> np.ndarray:
        """0 for the node on the first row's path, 1 for the one on the last row's path alone, -1 for all others."""
        v, s = self.valid[d], self.starts[d]
        out = np.full(len(s), -1)
        if v[-1] == len(self.convs) - 1:
            out[-1] = 1
        if v[0] == 0:
            out[0] = 0
        return out

    def _ends(self, v: np.ndarray, s: np.ndarray, d: int) -> list[str]:
        """Ids of the rows that end in each node: its first rows, as the sort put shorter rows first."""
        texts, done = [""] * len(s), v[self.lengths[v] == d]
        node = np.searchsorted(v[s], done, "right") - 1
        ids = self.convs[done].astype(str).tolist()
        edges = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(ids)]):
            texts[node[a]] = ",".join(ids[a:b])
        return texts

    def _closed(self, schema: pa.Schema, known: list[np.ndarray], above: np.ndarray, ends: list[str]) -> pa.RecordBatch:
        count = len(ends)
        columns = {name: pa.array(k) for name, k in zip(RESULT, known)}
        columns["parent_conv_id"] = pa.array(known[2], mask=above >= 0)
        columns["parent_chain"] = pa.array(above, mask=above < 0)
        columns["ends_sha256"] = pa.array([hashlib.sha256(e.encode()).hexdigest() if e else NOTHING for e in ends], pa.string())
        columns["shard"] = pa.array(np.full(count, self.number))
        return _batch(schema, columns, count)

    def _open(self, schema, nodes, known, chain, size, ends, paths, d: int) -> pa.RecordBatch:
        first = [bool(chain[i] == 0) for i in nodes]
        final = [bool(self.valid[d][-1] == len(self.convs) - 1 and i == len(chain) - 1) for i in nodes]
        path = [paths[0] if f else paths[1] for f in first]
        columns = {name: pa.array(k[nodes]) for name, k in zip(RESULT, known)}
        columns |= {"chain": pa.array(chain[nodes]), "shard": pa.array(np.full(len(nodes), self.number)), "bytes": pa.array(size[nodes]),
                    "key": pa.array([p[d] for p in path], pa.binary()), "parent_key": pa.array([p[d - 1] if d else None for p in path], pa.binary()),
                    "is_first": pa.array(first, pa.bool_()), "is_last": pa.array(final, pa.bool_()),
                    "last_length": pa.array(np.full(len(nodes), self.lengths[-1])), "ends": pa.array([ends[i] or None for i in nodes], pa.string())}
        return _batch(schema, columns | {"parent_conv_id": pa.nulls(len(nodes), pa.int64())}, len(nodes))


def _dense(digests: np.ndarray) -> np.ndarray:
    """Numbers from 1 on, equal for equal digests and in their order."""
    if not len(digests):
        return np.zeros(0, np.int64)
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    own = digests[order]
    out = np.empty(len(order), np.int64)
    out[order] = 1 + np.concatenate([[0], np.cumsum((own[1:] != own[:-1]).any(axis=1))])
    return out


def _batch(schema: pa.Schema, columns: dict[str, pa.Array], count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(count, f.type) for f in schema], schema=schema)


def _corrections(opened: DataFrame) -> DataFrame:
    """What neighbouring shards counted twice, for each beginning that a shard's last row and the next shard's first row share.

    The node itself: its text once more in the savings, once less among the parent's children; and one leaf less where the last
    row ends in the deepest shared node, as then the next shard tells whether that node is a leaf.
    """
    spark = opened.sparkSession
    shards = sorted(r["shard"] for r in opened.filter("depth = 0").select("shard").distinct().collect())  # one number for each shard
    pairs = spark.createDataFrame(list(zip(shards, shards[1:])), "shard long, follower long")
    ended = opened.filter("is_last").join(F.broadcast(pairs), "shard")
    begun = opened.filter("is_first").select(F.col("shard").alias("follower"), "key")
    shared = ended.join(begun, ["follower", "key"])
    by_shard = Window.partitionBy("shard")
    deepest = F.max("depth").over(by_shard)
    below = F.sum("bytes").over(by_shard.orderBy(F.desc("depth")))
    return shared.select(
        "key", "parent_key", "depth", F.lit(0).cast("long").alias("n_convs"), F.lit(None).cast("long").alias("conv_id"),
        F.when(F.col("depth") < deepest, -1).otherwise(0).cast("long").alias("n_children"),
        F.when(F.col("last_length") == deepest, -1).otherwise(0).cast("long").alias("n_leaves"), below.alias("saved_tokens"))


def _end_digests(opened: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end in each open node, fed shard by shard: nothing is gathered."""
    schema = pa.schema([("ended", pa.binary()), ("ends_sha256", pa.string())])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for own, text in zip(batch.column(0), batch.column(1)):
                own = own.as_py()
                if own != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_buffer())
            yield pa.RecordBatch.from_pylist([{"ended": k, "ends_sha256": h} for k, h in done], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"ended": key, "ends_sha256": state.hexdigest()}], schema=schema)

    ended = opened.filter("ends IS NOT NULL").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    return ended.select("key", "ends").mapInArrow(digest, "ended binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations: its smallest member, depth, parent's smallest member, members,
    children, leaves below, bytes saved below by storing shared turns once, and the digest of the ids that end there.

    See :func:`rebuilt` for nulls and turns of one number. A conversation without turns is a member of the root, which has depth 0
    and no parent. Repeated rows are turns like any other. An empty table gives no rows. Other columns are not read.
    """
    spark = conversations.sparkSession
    ship(spark)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-conversations.count() // SHARD_TURNS))
    dealt = rebuilt(conversations, **columns).repartitionByRange(shards, "turns", "conv_id")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_PARTS))

    def nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            convs = np.concatenate([b.column(0).to_numpy() for b in held])
            turns = [t for b in held for t in b.column(1).to_pylist()]
            yield from Shard(convs, turns, TaskContext.get().partitionId()).batches(schema)

    parts = settle(dealt.mapInArrow(nodes, _PARTS), "trie-parts")
    opened, closed = parts.filter("chain IS NOT NULL"), parts.filter("chain IS NULL")

    sums = ["key", "parent_key", "depth", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens"]
    merged = settle(opened.select(*sums).unionByName(_corrections(opened)).groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]), "trie-shared")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shared = (merged.join(parents, "parent_key", "left").join(_end_digests(opened), F.col("key") == F.col("ended"), "left")
              .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))))

    # A closed node under an open one: found by shard, path and depth, so a beginning that many share is many small keys.
    above = opened.join(merged.select("key", F.col("conv_id").alias("found")), "key").select(
        "shard", F.col("chain").alias("parent_chain"), (F.col("depth") + 1).alias("depth"), "found")
    under = closed.filter("parent_chain IS NOT NULL").join(above, ["shard", "parent_chain", "depth"]).withColumn("parent_conv_id", F.col("found"))
    inner = closed.filter("parent_chain IS NULL")
    return inner.select(*RESULT).unionByName(under.select(*RESULT)).unionByName(shared.select(*RESULT))
