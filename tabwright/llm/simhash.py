"""Near duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has 64 bits. Give each bit position a non-zero vector of r + 1 bits (r: the
radius). For every non-zero v of r + 1 bits there is one mask, of the positions whose vector
has an odd inner product with v. Up to r differing positions span at most r dimensions, so
some v is orthogonal to all of them: the two fingerprints agree on that mask. Hence every pair
within the radius meets in one of the 2^(r+1) - 1 tables, whatever the data; for radius 4 there
are 31 tables with keys of about 32 bits.

Copies fall together before any pairing: the tables hold distinct fingerprints. A table's
bucket yields the edges of a spanning forest of its links, not all pairs. A bucket of more than
``block`` fingerprints is cut into blocks by hash, and every pair of blocks is a group of its
own; so no group is larger than two blocks and no link is lost.

Near copies by shingles (drop_near_copies): two texts whose five-word shingles agree to 0.8 differ in about
nine bits of a fingerprint of shingles, as every changed word changes five of them, but in about three bits of one of
their distinct words. So candidates come from word fingerprints within 7 bits, by masks in two levels: of two halves
of the bits one has at most half of the differing ones, and covering masks over that half find those. In each
bucket the links of a minimum spanning forest are proposed, short ones first, and those of each fingerprint to
its nearest others, not all pairs. Each proposed link is verified on the whole sets of shingle hashes of its two texts; the connected
components of verified links are the groups. Pairs that these left in two groups become rows only if a bound on what their sets
share allows a link: each set has a parity sketch, bit h of which says whether an odd number of its hashes is h modulo the number of
bits, and two sets differ in at least as many hashes as their sketches differ in bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.components import connected
from tabwright.llm.words import byte_texts, fresh
from tabwright.session import settle

BITS = 64


@dataclass(frozen=True)
class SimHash:
    """``shingle``: words of a shingle. ``radius``: most differing bits of a link.
    ``block``: fingerprints that are compared in one group (two blocks at most)."""

    shingle: int = 4
    radius: int = 4
    block: int = 1024


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash over XXH64 (seed 42) of the shingles of a text's words, A-Z lower-cased."""
    words = (text or b"").lower().split()  # at \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    width = min(shingle, len(words))
    n = len(words) - width + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65_536):
        to = min(n, at + 65_536)
        hashed = [xxhash.xxh64_intdigest(joined[a:b], 42)
                  for a, b in zip(starts[at:to].tolist(), ends[at + width - 1: to + width - 1].tolist())]
        octets = np.array(hashed, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, *, text: str = "text", settings: SimHash = SimHash()) -> tuple[DataFrame, str]:
    """The documents without their text, and the fingerprint as a long (its bits, signed) in a
    column whose name is returned."""
    (name,) = fresh(docs, "fp")
    rest = [c for c in docs.columns if c != text]
    width = settings.shingle

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, width) for t in byte_texts(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(found, pa.int64())],
                                             names=[*rest, name])

    schema = docs.select(*rest, F.lit(None).cast("long").alias(name)).schema
    return docs.select(*rest, text).mapInArrow(work, schema), name


def covering_masks(radius: int) -> list[int]:
    """The masks; any two numbers of 64 bits that differ in at most ``radius`` agree under one."""
    top = (1 << (radius + 1)) - 1
    vectors = [1 + i % top for i in range(BITS)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, top + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def forest(bucket: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Edges (least member, member) of the components that links make of a bucket."""
    rest = np.unique(bucket)
    roots: list[int] = []
    members: list[int] = []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        open_ = [root]
        while open_ and len(rest):
            near = np.bitwise_count((rest ^ open_.pop()).view(np.uint64)) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                open_.extend(found)
                roots.extend([int(root)] * len(found))
                members.extend(found.tolist())
    return roots, members


def links(distinct: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that connect all that are
    within the radius of each other, directly or through others."""
    radius, block = settings.radius, settings.block
    tables = distinct.select("fp", F.explode(F.array(*(
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask))) for i, mask in enumerate(covering_masks(radius))
    ))).alias("key"))
    shared = tables.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block)
    mine = F.pmod(F.xxhash64("fp", F.lit("block")), blocks)
    # block i meets every block j in the group (smaller, larger); Spark takes the exploded rows for no larger than the table
    grouped = (
        tables.hint("merge").join(shared, "key")
        .select("key", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("j"))
        .groupBy("key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )

    def span(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            column = batch.column(0)
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                x, y = forest(values[lo:hi], radius)
                a += x
                b += y
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return grouped.mapInArrow(span, "a long, b long").distinct()


def near_duplicates(prints: DataFrame, *, order: list[str], fp: str = "fp",
                    settings: SimHash = SimHash()) -> tuple[DataFrame, str]:
    """The rows of a stored table of fingerprints with, in a column whose name is returned, the
    least row of their group: a struct of ``order``, nulls last.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; groups are the
    connected components. Rows with one fingerprint form a group even without any link.
    """
    least = F.min(F.struct(*(x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))))).alias("least")
    distinct = settle(prints.groupBy(F.col(fp).alias("fp")).agg(least))
    roots = connected(settle(links(distinct, settings)))
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    best = grouped.groupBy("root").agg(F.min("least").alias("best"))
    named = settle(grouped.join(best, "root").select("fp", "best"))
    (name,) = fresh(prints, "group_least")
    named = named.select(F.col("fp").alias("__named_fp"), F.struct(*(F.col(f"best.{c}").alias(c) for c in order)).alias(name))
    out = prints.join(named, prints[fp] == named["__named_fp"]).drop("__named_fp")
    return out, name


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def group_report(docs: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id of its group).

    Null and empty texts have the fingerprint zero. A row without a doc_id belongs to a group as
    any other; component_id is null only if no row of the group has one. Repeated rows stay.
    """
    prints, fp = fingerprints(docs.select("doc_id", "text"), settings=settings)
    groups, least = near_duplicates(settle(prints), order=["doc_id"], fp=fp, settings=settings)
    return groups.select("doc_id", hex_digits(F.col(fp)).alias("fingerprint"),
                         F.col(least)["doc_id"].alias("component_id"))


def drop_near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text",
                         settings: SimHash = SimHash()) -> DataFrame:
    """One document of each group, the one with the least id (null ids last; of rows with one
    id, the one with the least text hash, and one of equal rows). Columns as they came."""
    key, digest = fresh(docs, "dedup_id", "dedup_text")
    keyed = docs.withColumns({
        key: F.coalesce(F.col(id_column).cast("string"), F.lit("")),
        digest: F.xxhash64(F.col(text), F.col(text).isNull()),
    })
    prints, fp = fingerprints(keyed.select(F.col(id_column).alias("id"), F.col(key).alias("k"),
                                           F.col(digest).alias("h"), F.col(text).alias("text")), settings=settings)
    prints = settle(prints)
    groups, least = near_duplicates(prints, order=["id", "h"], fp=fp, settings=settings)
    first = groups.select(F.coalesce(F.col(least)["id"].cast("string"), F.lit("")).alias("k"),
                          F.col(least)["h"].alias("h")).distinct()
    first = settle(first)
    kept = keyed.join(first, (keyed[key] == first["k"]) & (keyed[digest] == first["h"]), "left_semi")
    return kept.dropDuplicates([key, digest]).select(*docs.columns)


@dataclass(frozen=True)
class NearCopies:
    """``shingle`` and ``similarity``: what makes a near copy. ``radius``: most differing bits of a candidate's word fingerprint.
    ``parts``: pieces of the fingerprint whose masks cover their share of the radius. ``nearest``: others of its bucket that a
    text is held against besides the spanning forest. ``block``: fingerprints compared in one group (two blocks at most)."""

    shingle: int = 5
    similarity: float = 0.8
    radius: int = 7
    parts: int = 2
    nearest: int = 4
    block: int = 1024


def word_print(words: list[bytes]) -> int:
    """SimHash over XXH64 (seed 42) of the distinct words; 0 without words."""
    if not words:
        return 0
    hashed = np.array([xxhash.xxh64_intdigest(w, 42) for w in set(words)], "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.unpackbits(hashed, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashed), bitorder="little").tobytes(), "little", signed=True)


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the shingles; of fewer words the one shingle is all of them."""
    if not words:
        return np.zeros(0, np.uint32)
    width = min(width, len(words))
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(b" ".join(words[i: i + width]), 42) for i in range(len(words) - width + 1)), np.uint32))


#: Bits of a sketch: four for a shingle, rounded up to a power of two, within these limits (as exponents).
_LEAST_SKETCH, _MOST_SKETCH = 6, 13
#: Pairs whose sketches are held against each other at once.
_PAIRS = 16_384


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the hashes that fall on each bit, as bytes. The upper half exclusive-or the lower one is the sketch of half the size."""
    k = min(_MOST_SKETCH, max(_LEAST_SKETCH, (4 * len(hashes) - 1).bit_length()))
    counts = np.bincount(hashes & np.uint32((1 << k) - 1), minlength=1 << k)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def difference(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, sketches: list[bytes], least: float) -> np.ndarray:
    """For pairs (x, y) of sets the bits that their sketches differ in, as a share of the most hashes that sets may differ in which
    agree to ``least``: (1 - least) / (1 + least) of the sum of their sizes. Above 1, and infinite by the sizes alone, there is no link."""
    small, large = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
    out = np.where(small >= least * large, 0.0, np.inf)
    wide = np.array([len(b) for b in sketches])
    level = np.minimum(wide[x], wide[y])
    for w in np.unique(level[out == 0]):
        pairs = np.flatnonzero((out == 0) & (level == w))
        held, place = np.unique(np.concatenate([x[pairs], y[pairs]]), return_inverse=True)
        folded = np.array([np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, w // 8), axis=0) for i in held])
        left, right = place[:len(pairs)], place[len(pairs):]
        for at in range(0, len(pairs), _PAIRS):
            some = slice(at, at + _PAIRS)
            apart = np.bitwise_count(folded[left[some]] ^ folded[right[some]]).sum(1, dtype=np.int64)
            out[pairs[some]] = apart / ((1 - least) / (1 + least) * (small + large)[pairs[some]] + 1e-6)
    return out


def joining(x: np.ndarray, y: np.ndarray, rank: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Places of the pairs (x, y) that make a spanning forest of the parts, lowest ranks first; ``part`` then names the trees."""
    chosen = []
    live = np.argsort(rank, kind="stable")
    while True:
        p, q = part[x[live]], part[y[live]]
        live, p, q = live[p != q], p[p != q], q[p != q]
        if not len(live):
            return np.array(chosen, np.int64)
        best = np.full(int(part.max()) + 1, len(live))
        for side in (p, q):
            np.minimum.at(best, side, np.arange(len(live)))
        for i in np.unique(best[best < len(live)]).tolist():  # the best one of each tree; as ranks are in order there is no ring
            chosen.append(live[i])
            one, other = part[x[live[i]]], part[y[live[i]]]
            part[part == other] = one


def two_level_masks(radius: int, parts: int) -> list[int]:
    """Masks; any two numbers of 64 bits that differ in at most ``radius`` agree under one. A part that holds at most
    ``radius // parts`` differing bits exists, and its masks cover so many as in :mod:`tabwright.llm.simhash`."""
    own = radius // parts
    top = (1 << (own + 1)) - 1
    out = []
    for part in range(parts):
        places = range(part * BITS // parts, (part + 1) * BITS // parts)
        vectors = {i: 1 + n % top for n, i in enumerate(places)}
        out += [sum(1 << i for i, m in vectors.items() if (m & v).bit_count() & 1) for v in range(1, top + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def shortest_links(bucket: np.ndarray, radius: int, nearest: int = 0) -> tuple[list[int], list[int]]:
    """Edges of a minimum spanning forest of the links that a bucket's distinct numbers have within the radius, and the
    links of each to its ``nearest`` others."""
    rest = np.unique(bucket)
    a: list[int] = []
    b: list[int] = []
    for at in range(0, len(rest), 256) if nearest else ():
        far = np.bitwise_count((rest[at: at + 256, None] ^ rest).view(np.uint64)).astype(np.int64)
        far[np.arange(len(far)), at + np.arange(len(far))] = BITS + 1
        some = np.argsort(far, axis=1, kind="stable")[:, :nearest]
        i, j = np.nonzero(np.take_along_axis(far, some, 1) <= radius)
        a += rest[at + i].tolist()
        b += rest[some[i, j]].tolist()
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        near = np.bitwise_count((rest ^ root).view(np.uint64)).astype(np.int64)  # of the tree to each that is left
        by = np.full(len(rest), root)
        while len(rest):
            i = int(near.argmin())
            if near[i] > radius:
                break  # the tree is complete
            new = rest[i]
            a.append(int(by[i]))
            b.append(int(new))
            keep = np.arange(len(rest)) != i
            rest, near, by = rest[keep], near[keep], by[keep]
            distance = np.bitwise_count((rest ^ new).view(np.uint64)).astype(np.int64)
            closer = distance < near
            near[closer], by[closer] = distance[closer], new
    return a, b


def candidate_links(distinct: DataFrame, settings: NearCopies) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, column ``fp``."""
    radius = settings.radius
    tables = distinct.select("fp", F.explode(F.array(*(
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask))) for i, mask in enumerate(two_level_masks(radius, settings.parts))))).alias("key"))
    shared = tables.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / settings.block)
    mine = F.pmod(F.xxhash64("fp", F.lit("block")), blocks)
    # block i meets every block j in the group (smaller, larger); Spark takes the exploded rows for no larger than the table
    grouped = (tables.hint("merge").join(shared, "key")
               .select("key", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("j"))
               .groupBy("key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).agg(F.collect_list("fp").alias("members"))
               .where(F.size("members") > 1).select("members"))

    def span(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            column = batch.column(0)
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                if hi - lo == 2:  # most buckets
                    x, y = int(values[lo]), int(values[lo + 1])
                    if x != y and ((x ^ y) & ((1 << BITS) - 1)).bit_count() <= radius:
                        a.append(min(x, y))
                        b.append(max(x, y))
                    continue
                x, y = shortest_links(values[lo:hi], radius, settings.nearest)
                a += map(min, x, y)
                b += map(max, x, y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return grouped.mapInArrow(span, "a long, b long").distinct()


def unjoined_links(nodes: DataFrame, between: DataFrame, roots: DataFrame, sets: DataFrame, settings: NearCopies, *, few: bool = False) -> DataFrame:
    """All pairs (a, b) of nodes of different groups whose fingerprints differ in at most ``radius`` bits and whose sketches allow
    a link.

    Only a fingerprint of ``between``, or one of several nodes, has such a pair, as each bucket gave a forest of its links; ``sets``
    holds them. Of these nodes only buckets with two groups or more are looked at, in groups of two blocks as by
    :func:`candidate_links`. A pair is given by the first bucket it meets in. ``few``: of each such group only pairs that make a spanning
    forest of its parts, those first whose sketches differ least; none at all only if there is no pair.
    """
    radius, least = settings.radius, settings.similarity
    near = between.select(F.explode(F.array("a", "b")).alias("fp")).unionByName(nodes.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")).distinct()
    named = settle(nodes.select("node", "fp").join(near.hint("merge"), "fp").join(roots, "node", "left").join(sets.select("node", "size", "sketch"), "node").select(
        "node", "fp", F.coalesce("root", "node").alias("root"), "size", "sketch"))
    masks = two_level_masks(radius, settings.parts)
    tables = named.select("node", "fp", "root", "size", "sketch", F.explode(F.array(*(
        F.struct(F.lit(i).alias("mask"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask))).alias("key")) for i, mask in enumerate(masks)))).alias("at")).select(
        "node", "fp", "root", "size", "sketch", "at.mask", "at.key")
    shared = tables.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("mask", "key", "n")
    blocks = F.ceil(F.col("n") / settings.block)
    mine = F.pmod(F.xxhash64("node", F.lit("block")), blocks)
    grouped = (tables.hint("merge").join(shared, ["mask", "key"])  # as in candidate_links
               .select("mask", "key", "node", "fp", "root", "size", "sketch", mine.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("j"))
               .groupBy("mask", "key", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"))
               .agg(F.collect_list(F.struct("fp", "node", "root", "i", "size", "sketch")).alias("m"))
               .select("m.fp", "m.node", "m.root", "m.i", "m.size", "m.sketch", "mask", (F.col("low") < F.col("high")).alias("two")))

    def span(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(0).offsets.to_numpy()
            parts = [batch.column(c).values.to_numpy() for c in range(5)]
            sketches = batch.column(5).values
            for lo, hi, mask, two in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(6).to_pylist(), batch.column(7).to_pylist()):
                fp, node, root, block, size = (p[lo:hi] for p in parts)
                held = sketches[lo:hi].to_pylist()
                part = np.unique(root, return_inverse=True)[1]
                for at in range(0, len(fp), 256):
                    some = slice(at, at + 256)
                    apart = (root[some, None] != root) & (node[some, None] < node)
                    if two:  # pairs of one block meet in its own group
                        apart &= block[some, None] != block
                    x, y = np.nonzero(apart & (np.bitwise_count((fp[some, None] ^ fp).view(np.uint64)) <= radius))
                    x += at
                    for earlier in masks[:mask]:
                        new = ((fp[x] ^ fp[y]) & np.int64(earlier)) != 0
                        x, y = x[new], y[new]
                    if few:
                        new = part[x] != part[y]
                        x, y = x[new], y[new]
                    if len(x):
                        share = difference(x, y, size, held, least)
                        ok = np.flatnonzero(share <= 1)
                        if few:
                            ok = ok[joining(x[ok], y[ok], share[ok], part)]
                        x, y = x[ok], y[ok]
                        yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], names=["a", "b"])

    return grouped.mapInArrow(span, "a long, b long").distinct()


def drop_near_copies(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", settings: NearCopies = NearCopies()) -> DataFrame:
    """One document of each group, the one with the least id (null ids last; of rows with one id, the one
    with the least text hash, and one of equal rows). Columns as they came.

    Groups are joined by all links of similar texts whose word fingerprints differ in at most ``radius`` bits: a forest of the
    shortest ones is verified first, then every pair that this left in two groups, but for those that the sets' sketches exclude.

    Equal words are copies, whatever blanks and cases of A-Z are between them. Null and empty texts, and texts of blanks, are copies of
    each other. A text of fewer than five words is a shingle of its own.
    """
    key, digest = fresh(docs, "dedup_id", "dedup_text")
    keyed = docs.withColumns({key: F.coalesce(F.col(id_column).cast("string"), F.lit("")), digest: F.xxhash64(F.col(text), F.col(text).isNull())})

    def prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, nodes = [], []
            for t in byte_texts(batch.column(3)):
                words = (t or b"").lower().split()  # at \x20 and \x09-\x0D
                fps.append(word_print(words))
                nodes.append(int.from_bytes(xxhash.xxh64_digest(b" ".join(words), 7), "little", signed=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(fps, pa.int64()), pa.array(nodes, pa.int64())],
                                             names=["id", "k", "h", "fp", "node"])

    shape = keyed.select(F.col(id_column).alias("id"), F.col(key).alias("k"), F.col(digest).alias("h"), F.lit(0).cast("long").alias("fp"),
                         F.lit(0).cast("long").alias("node")).schema
    rows = settle(keyed.select(F.col(id_column).alias("id"), F.col(key).alias("k"), F.col(digest).alias("h"), F.col(text).alias("text")).mapInArrow(prints, shape))
    nodes = settle(rows.groupBy("node").agg(F.min("fp").alias("fp"), F.min(F.struct("k", "h")).alias("one"),
                                            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h")).alias("least")))
    heads = settle(nodes.groupBy("fp").agg(F.min("node").alias("head")))
    between = settle(candidate_links(heads, settings))
    # the texts of one fingerprint are held against the first of them, the firsts of linked fingerprints against each other
    inside = nodes.join(heads, "fp").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    across = between.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("head_a")), "a").join(
        heads.select(F.col("fp").alias("b"), F.col("head").alias("head_b")), "b").select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    proposed = settle(inside.unionByName(across))
    sets = _sets(keyed, key, digest, text, nodes, proposed, settings)
    verified = settle(_verified(sets, proposed, settings))
    # what the first links did not join is held against all others within the radius: first a few links, which join most, then all
    roots = connected(verified)
    for few in (True, False):
        missed = settle(unjoined_links(nodes, between, roots, sets, settings, few=few))
        if missed.isEmpty():
            break
        verified = settle(verified.unionByName(_verified(sets, missed, settings)))
        roots = connected(verified)
    grouped = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    first = settle(grouped.groupBy("root").agg(F.min("least").alias("best")).select(
        F.coalesce(F.col("best.id").cast("string"), F.lit("")).alias("k"), F.col("best.h").alias("h")).distinct())
    kept = keyed.join(first, (keyed[key] == first["k"]) & (keyed[digest] == first["h"]), "left_semi")
    return kept.dropDuplicates([key, digest]).select(*docs.columns)


def _sets(keyed: DataFrame, key: str, digest: str, text: str, nodes: DataFrame, proposed: DataFrame, settings: NearCopies) -> DataFrame:
    """Of each node that has a link its shingle set, the size of that and its sketch, stored. One row of its text gives them."""
    linked = proposed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes.join(linked.hint("merge"), "node", "left_semi").select("node", F.col("one.k").alias("k"), F.col("one.h").alias("h"))
    width = settings.shingle

    def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set((t or b"").lower().split(), width) for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64()),
                                              pa.array([sketch(x).tobytes() for x in sets], pa.binary())], names=["node", "set", "size", "sketch"])

    found = keyed.select(F.col(key).alias("__k"), F.col(digest).alias("__h"), F.col(text).alias("__text")).join(
        wanted, (F.col("__k") == F.col("k")) & (F.col("__h") == F.col("h"))).dropDuplicates(["node"]).select("node", "__text")
    return settle(found.mapInArrow(shingles, "node long, set binary, size long, sketch binary"))


def _verified(sets: DataFrame, proposed: DataFrame, settings: NearCopies) -> DataFrame:
    """The proposed links whose texts' shingle sets are similar enough."""
    least = settings.similarity

    def similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
                shorter, longer = sorted((len(x), len(y)))
                if shorter < least * longer:  # the sets cannot agree so far
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    pairs = proposed.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b").select("a", "b", "set_a", "set_b")
    return pairs.mapInArrow(similar, "a long, b long")
