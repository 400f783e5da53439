"""The prefix trie of conversations, with subtree sums.

Turns are numbered over range partitions, so a conversation of any length is spread; only the conversations that go
on from one partition into the next, at most one a partition, get an offset. A prefix is named by the running
exclusive or of hashes of (place, turn), 128 bits, which also takes offsets; texts do not move. Grouping by that name
gives the nodes, the name without the last turn the parent edges. What is summed over subtrees goes through the
centroid decomposition of :mod:`tabwright.llm.rollup`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.rollup import rollup
from tabwright.session import settle

#: A node with at least this share of all rows is joined by broadcast; there are at most 1 / share.
_HOT = 1_000
_KEY, _UP = ["k1", "k2"], ["u1", "u2"]


@dataclass(frozen=True)
class Trie:
    """``piece``: most nodes of a component that one task finishes. ``chunk``: conversation ids per piece of a list of ends."""

    piece: int = 50_000
    chunk: int = 8_000


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, part, place (from 1), a, b (hashes of role and text), size (code points) of every turn, stored.

    Turns are in order of turn, null first; turns of one number by role, then by the text's hash, and repeated
    rows count as often as they stand. Null role or text is empty. Rows without a conversation are left out. A part is a range partition.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"), F.char_length(text).cast("long").alias("size"))
    order = ["conv_id", "turn", "role", "a", "b"]
    ranged = settle(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order[1:]))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", before).where("before > 0").drop("n")
    return settle(ranged.withColumn("local", local).join(F.broadcast(offsets), ["conv_id", "part"], "left").select(  # at most one a part
        "conv_id", "part", (F.col("local") + F.coalesce("before", F.lit(0))).alias("place"), "a", "b", "size"))


def with_length(rows: DataFrame) -> DataFrame:
    """Numbered turns with the length of their conversation, the form that :func:`prefix_trie` takes."""
    parts = rows.groupBy("conv_id", "part").agg(F.max("place").alias("last"))
    length = F.max("last").over(Window.partitionBy("conv_id"))
    return rows.join(parts.select("conv_id", "part", length.alias("length")), ["conv_id", "part"])


def with_shared_head(rows: DataFrame, *, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of another: conversation c has the first h turns of c - c % every (all if
    fewer, none if absent), then its own after its first h; h is crc32 of c as text modulo ``most``.

    Numbered turns -> the same columns and the new length; a conversation left without turns has one row at place 0."""
    pieces = rows.groupBy("conv_id", "part").agg(F.max("place").alias("last"))
    convs = pieces.groupBy("conv_id").agg(F.max("last").alias("n"), F.min("part").alias("part")).select(
        "conv_id", "part", "n", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("of"))
    heads = rows.where((F.col("conv_id") % every == 0) & (F.col("place") < most)).groupBy(F.col("conv_id").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("place", "a", "b", "size"))).alias("head"))  # fewer than ``most`` turns
    head = F.coalesce("head", F.array().cast("array<struct<place:bigint,a:bigint,b:bigint,size:bigint>>"))
    known = settle(convs.join(heads, "of", "left").withColumn("head", F.slice(head, F.lit(1), F.col("h").cast("int")))
                   .withColumn("g", F.size("head")).withColumn("length", F.col("g") + F.greatest(F.lit(0), F.col("n") - F.col("h"))))
    shared = known.select("conv_id", "part", "length", F.explode_outer("head").alias("x")).select(
        "conv_id", "part", F.coalesce("x.place", F.lit(0)).alias("place"), "x.a", "x.b", F.coalesce("x.size", F.lit(0)).alias("size"), "length").where(
        "place > 0 OR length = 0")
    shift = pieces.select("conv_id", "part").join(known.select("conv_id", "h", "g", "length"), "conv_id")
    own = rows.join(shift, ["conv_id", "part"]).where("place > h").select(
        "conv_id", "part", (F.col("place") + F.col("g") - F.col("h")).alias("place"), "a", "b", "size", "length")
    return shared.unionByName(own)


def _prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (name of the prefix), u1, u2 (of the one before), size, length; depth 0 included."""
    turns = rows.where("place > 0").withColumn("x1", F.xxhash64(F.lit(3), "place", "a", "b")).withColumn("x2", F.xxhash64(F.lit(4), "place", "b", "a"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = turns.groupBy("conv_id", "part").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2")).select(
        "conv_id", "part", F.bit_xor("t1").over(before).alias("b1"), F.bit_xor("t2").over(before).alias("b2")).where("b1 IS NOT NULL")
    run = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = turns.withColumn("r1", F.bit_xor("x1").over(run)).withColumn("r2", F.bit_xor("x2").over(run)).join(
        F.broadcast(offsets), ["conv_id", "part"], "left")  # at most one a part
    for i in "12":
        named = named.withColumn(f"k{i}", F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))))
    deep = named.select("conv_id", F.col("place").alias("depth"), *_KEY, F.col("k1").bitwiseXOR(F.col("x1")).alias("u1"),
                        F.col("k2").bitwiseXOR(F.col("x2")).alias("u2"), "size", "length")
    zero = F.lit(0).cast("long")
    root = rows.where("place <= 1").select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("u1"),
                                           F.lit(None).cast("long").alias("u2"), zero.alias("size"), "length")
    return deep.unionByName(root)


def _look_up(rows: DataFrame, on: list[str], table: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the columns of the one row of ``table`` whose (k1, k2) is theirs in ``on``. The keys of ``hot``, a
    few rows of ``table``, may stand in any share of the rows."""
    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed(dict(zip(_KEY, ("__1", "__2"))))

    match = (F.col(on[0]) == F.col("__1")) & (F.col(on[1]) == F.col("__2"))
    frequent = rows.join(F.broadcast(renamed(hot)), match)
    rest = rows.join(F.broadcast(renamed(hot.select(*_KEY))), match, "left_anti").join(renamed(table), match)
    return frequent.unionByName(rest).drop("__1", "__2")


def _end_digests(ends: DataFrame, chunk: int) -> DataFrame:
    """k1, k2, conv_id -> k1, k2, SHA-256 of the ids in order, comma-joined. Ids are packed in the order of their range
    partitions; one task then reads the packs of a node, as they come, into its hash."""
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def packed(frame: pd.DataFrame) -> pa.RecordBatch:
            k1, k2, ids = (frame[c].to_numpy() for c in ("k1", "k2", "conv_id"))
            starts = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))) if len(ids) else np.zeros(0, int)
            texts = ids.astype(str)
            cuts = [c for a, b in zip(starts, np.append(starts[1:], len(ids))) for c in range(a, b, chunk)]
            lists = [",".join(texts[a: min(b, a + chunk)]) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
            return pa.RecordBatch.from_arrays([pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(ids[cuts]), pa.array(lists, pa.string())],
                                              names=["k1", "k2", "first", "ids"])

        for batch in batches:
            held.append(batch.to_pandas())
            if sum(map(len, held)) >= 4 * chunk:
                yield packed(pd.concat(held))
                held = []
        if held:
            yield packed(pd.concat(held))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed = None, hashlib.sha256()
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if (k1, k2) == key:
                    hashed.update(b",")
                else:
                    if key is not None:
                        done.append((*key, hashed.hexdigest()))
                    key, hashed = (k1, k2), hashlib.sha256()
                hashed.update(ids.encode())
            yield _digests(done)
        if key is not None:
            yield _digests([(*key, hashed.hexdigest())])

    def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                          names=["k1", "k2", "ends_sha256"])

    ranged = ends.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    packs = ranged.mapInArrow(pack, "k1 long, k2 long, first long, ids string")
    return packs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, settings: Trie = Trie()) -> DataFrame:
    """One row per distinct prefix: conv_id (the least conversation that starts with it), depth, parent_conv_id (the parent's,
    null at the root), n_convs, n_children, n_leaves and saved_tokens over the subtree, ends_sha256.

    ``rows``: conv_id, part, place, a, b, size, length, as :func:`with_length` makes them; a conversation without turns is one row at
    place 0. No conversations, no rows: there is no root then either.
    """
    prefixes = settle(_prefixes(rows))
    is_end = F.col("depth") == F.col("length")
    nodes = settle(prefixes.groupBy(*_KEY).agg(
        F.min("conv_id").alias("chain"), F.max("depth").alias("depth"), F.max("u1").alias("u1"), F.max("u2").alias("u2"), F.max("size").alias("size"),
        F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight")))
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    hot = settle(nodes.where(F.col("n_convs") * _HOT >= max(total, 1)))
    children = nodes.where("u1 IS NOT NULL").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    parents = (df.select(*_KEY, F.col("chain").alias("parent")) for df in (nodes, hot))
    linked = _look_up(counted.where("u1 IS NOT NULL"), _UP, *parents).unionByName(
        counted.where("u1 IS NULL").withColumn("parent", F.lit(None).cast("long")))
    root = nodes.where("depth = 0").agg(F.min("chain")).first()[0]
    whole = settle(linked.select(*_KEY, "chain", "depth", "parent", "weight", "n_convs", "n_children", F.lit(root).cast("long").alias("tree"),
                                 F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                                 ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")))

    def paths() -> DataFrame:
        chains = whole.select(F.col("chain").alias("conv_id")).distinct()
        named = whole.select(*_KEY, F.col("chain").alias("owner"), F.col("parent").alias("above"))
        frequent = whole.where(F.col("n_convs") * _HOT >= max(total, 1)).select(*_KEY, F.col("chain").alias("owner"), F.col("parent").alias("above"))
        return _look_up(prefixes.select("conv_id", "depth", *_KEY).join(chains, "conv_id", "left_semi"), _KEY, named, frequent).select(
            F.col("conv_id").alias("chain"), "depth", "owner", "above")

    sums = rollup(whole, paths, ["n_leaves", "saved_tokens"], piece=settings.piece)
    digests = _end_digests(prefixes.where(is_end).select(*_KEY, "conv_id"), settings.chunk)
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.drop("n_leaves", "saved_tokens").join(sums, ["chain", "depth"]).join(digests, _KEY, "left").select(
        F.col("chain").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def trie_report(conversations: DataFrame, settings: Trie = Trie()) -> DataFrame:
    """The trie of conversations that share the first turns of every hundredth."""
    return prefix_trie(with_shared_head(numbered(conversations)), settings)
