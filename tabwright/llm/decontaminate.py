"""Benchmark decontamination: a broadcast hash set of n-gram windows of the test items.

The windows of all items are a Spark table. It is collected in parts of at most about
``part_windows`` rows (window, item), so what is broadcast has a bound that does not grow
with the benchmark; each part is one narrow pass over the documents, and a usual benchmark is
one part. Where there are more, the documents are written between the passes, so that a task and the
driver hold one part at a time. Documents are never shuffled.

In a pass, every word of a text gets a hash from its first and last eight bytes and its
length, windows get a rolling combination, and a bitmap of the part's window hashes leaves
few candidates. Those are verified word by word, so hash collisions change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.words import bounds, byte_texts, fresh, words_of
from tabwright.session import release, settle

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ROLL = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Decontamination:
    """``width``: words of a window. ``part_windows``: rows (window, item) broadcast at once."""

    width: int = 10
    part_windows: int = 500_000


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word; equal words have equal numbers."""
    padded = np.frombuffer(b"\0" * 8 + data + b"\0" * 8, np.uint8)
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    size = ends - starts
    unused = (8 - np.minimum(size, 8)).astype(np.uint64) * np.uint64(8)
    head = np.ascontiguousarray(eight[starts + 8]).view("<u8")[:, 0] << unused
    tail = np.ascontiguousarray(eight[ends]).view("<u8")[:, 0] >> unused
    mixed = (head ^ (tail * _ROLL) ^ size.astype(np.uint64)) * _MIX
    return (mixed ^ (mixed >> np.uint64(29))) * _ROLL


def window_hashes(hashed: np.ndarray, width: int) -> np.ndarray:
    """One number for each run of ``width`` words."""
    n = len(hashed) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    for j in range(width if n > 0 else 0):
        total = total * _ROLL + hashed[j: j + n]
    return (total ^ (total >> np.uint64(31))) * _MIX


def benchmark_windows(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """Rows (item string, words int, window binary), distinct. An item of fewer than ``width``
    words is one window; an item without words has none; a null id is the item ``null``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                words = words_of((data or b"").lower())
                size = min(width, len(words))
                for at in range(0, len(words) - size + 1 if size else 0, 65_536):
                    some = [b" ".join(words[i: i + size])
                            for i in range(at, min(at + 65_536, len(words) - size + 1))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some), pa.string()),
                         pa.array([size] * len(some), pa.int32()), pa.array(some, pa.binary())],
                        ["item", "words", "window"])

    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")), F.col(text))
    return rows.mapInArrow(cut, "item string, words int, window binary").distinct()


class WindowSet:
    """The windows of one part, for look-up by the windows of a text."""

    def __init__(self, rows: list[Row]):
        self.items: dict[bytes, list[str]] = {}
        by_width: dict[int, list[bytes]] = {}
        for row in rows:
            window = bytes(row["window"])
            if window not in self.items:
                by_width.setdefault(row["words"], []).append(window)
            self.items.setdefault(window, []).append(row["item"])
        self.tables = []
        for width, windows in sorted(by_width.items()):
            bits = min(24, max(12, (16 * len(windows)).bit_length()))
            known = np.sort(np.array([
                window_hashes(word_hashes(w, *bounds(w)), width)[0] for w in windows], np.uint64))
            near = np.zeros(1 << bits, bool)
            near[(known >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.tables.append((width, np.uint64(64 - bits), near, known))

    def hits(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, bytes]]:
        """(first word, past-the-end word, window) of every occurrence in a lower-cased text."""
        found: list[tuple[int, int, bytes]] = []
        hashed = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        for width, shift, near, known in self.tables:
            mine = window_hashes(hashed, width)
            likely = np.flatnonzero(near[(mine >> shift).astype(np.int64)])
            if len(likely):
                at = np.minimum(np.searchsorted(known, mine[likely]), len(known) - 1)
                likely = likely[known[at] == mine[likely]]
            for i in likely.tolist():
                window = b" ".join(data[starts[j]: ends[j]] for j in range(i, i + width))
                if window in self.items:
                    found.append((i, i + width, window))
        return found


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
    item_text: str = "text", settings: Decontamination = Decontamination(),
) -> tuple[DataFrame, tuple[str, str, str]]:
    """The documents with three more columns, whose names are returned too:
    number of words (long), hit runs of words (array of first and past-the-end word, merged and
    ascending) and the ids of the items with occurring windows (array of distinct strings).

    Null and empty texts have no words and no hits; an empty benchmark hits nothing. Every row
    is judged on its own, so repeated rows and ids do no harm. A document column of one of the
    names used makes the new column take another name.
    """
    spark = docs.sparkSession
    windows = settle(benchmark_windows(benchmark, item, item_text, settings.width))
    parts = max(1, -(-windows.count() // settings.part_windows))
    n_words, runs, items = fresh(docs, "n_words", "hit_runs", "hit_items")
    out = docs.withColumns({
        n_words: F.lit(None).cast("long"), runs: F.array().cast("array<struct<first:int,past:int>>"),
        items: F.array().cast("array<string>"),
    })
    schema = T.StructType(out.schema.fields)
    place = {name: i for i, name in enumerate(out.columns)}
    shared, stored = None, None
    for part in range(parts):
        if shared is not None:  # one part at a time: end the pass before, then drop its set
            before = stored
            out = stored = settle(out)
            shared.destroy()
            if before is not None:
                release(before)
        rows = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == part).collect()
        shared = spark.sparkContext.broadcast(WindowSet(rows))

        def scan(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                counts, all_runs, all_items = [], [], []
                before = zip(batch.column(place[runs]).to_pylist(), batch.column(place[items]).to_pylist())
                for data, (old, names) in zip(byte_texts(batch.column(place[text])), before):
                    data = (data or b"").lower()
                    starts, ends = bounds(data)
                    found = known.hits(data, starts, ends)
                    counts.append(len(starts))
                    if found:
                        old = _merged([(r["first"], r["past"]) for r in old] + [h[:2] for h in found])
                        names = sorted({*names, *(x for h in found for x in known.items[h[2]])})
                    all_runs.append(old)
                    all_items.append(names)
                columns = list(batch.columns)
                for name, values in ((n_words, counts), (runs, all_runs), (items, all_items)):
                    columns[place[name]] = pa.array(values, batch.schema.field(place[name]).type)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        out = out.mapInArrow(scan, schema)
    return out, (n_words, runs, items)


def _merged(runs: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for first, past in sorted(runs):
        if out and first <= out[-1]["past"]:
            out[-1]["past"] = max(out[-1]["past"], past)
        else:
            out.append({"first": first, "past": past})
    return out


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, (n_words, runs, items) = find_contamination(docs.select("doc_id", "text"), benchmark, **options)
    return found.select(
        "doc_id", F.col(n_words).alias("n_words"),
        F.aggregate(runs, F.lit(0).cast("long"), lambda s, r: s + r["past"] - r["first"]).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (F.size(runs) > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a benchmark window; columns as they came."""
    found, (_, runs, _) = find_contamination(docs, benchmark, **options)
    return found.where(F.size(runs) == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents with every hit run of words cut out of the text, from the first word's
    start to the last word's end. All other characters stay as they are."""
    found, (_, runs, _) = find_contamination(docs, benchmark, text=text, **options)
    columns, at = docs.columns, docs.columns.index(text)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for data, hit in zip(byte_texts(batch.column(at)), batch.column(runs).to_pylist()):
                if hit:
                    starts, ends = bounds(data.lower())
                    edges = [0, *(int(x) for r in hit for x in (starts[r["first"]], ends[r["past"] - 1])), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                texts.append(None if data is None else data.decode())
            arrays = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return found.mapInArrow(cut, T.StructType(docs.schema.fields))

