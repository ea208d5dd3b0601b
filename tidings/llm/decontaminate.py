"""Benchmark decontamination by greedy string tiling.

The words (lower case, punctuation apart) of every whole document are hashed,
and every window of ``MIN_MATCH`` words gets a Karp-Rabin hash. Windows that a
test item holds too are the seeds. For each document and item with seeds, the
longest common run of unmarked words is marked as a tile, again and again,
until no run of ``MIN_MATCH`` words is left; as tiles may stand anywhere,
passages in another order are found. A document is contaminated if the tiles
cover ``COVERAGE`` or more of an item's words.

Items shorter than ``MIN_MATCH`` words match as a whole. The test items are
dealt into blocks of about ``BLOCK_CHARS`` characters (an item is in one block)
and tasks write each block's seeds as sorted arrays to the shared folder.
Tasks that scan documents, in one pass, map these files (``HELD`` blocks at a
time); neither items nor seeds pass through the driver or a closure. Equal
windows are kept as runs along diagonals, ``PAIRS`` at a time, never all pairs.

Defined cases: null and empty texts or items match nothing; rows with one
doc_id are scored one by one; equal items all match; empty tables give no rows
or no matches; columns of any other name are passed through or not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .files import load, qualified, save
from .hashing import gram_hashes, word_hashes

MIN_MATCH = 5
COVERAGE = 0.8
BLOCK_CHARS = 8_000_000
BATCH_CHARS = 4_000_000
PAIRS = 500_000          # pairs of equal windows looked at together
HELD = 4                 # blocks a task keeps mapped
# fixed values: the ASCII punctuation that separates words, as blanks do
PUNCTUATION = str.maketrans(dict.fromkeys("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", " "))


def normal(text: str | None) -> str:
    return text.lower().translate(PUNCTUATION) if text else ""


class Seeds:
    """The windows of a block of test items, as sorted hash arrays."""

    ARRAYS = {"keys": np.uint64, "item": np.int64, "place": np.int64}

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        self.words, self.at = word_hashes([normal(t) for _, t in items])
        self.ids = np.array([i for i, _ in items], np.int64)
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        lengths = defaultdict(list)
        for k, n in enumerate(np.diff(self.at).tolist()):
            if n:
                lengths[min(MIN_MATCH, n)].append(k)
        for n, ks in lengths.items():
            grams = [gram_hashes(self.words[self.at[k]:self.at[k + 1]], n) for k in ks]
            keys = np.concatenate(grams)
            item = np.repeat(np.array(ks, np.int64), [len(g) for g in grams])
            place = np.concatenate([np.arange(len(g)) for g in grams])
            order = np.argsort(keys, kind="stable")
            self._add(n, keys[order], item[order], place[order])

    def _add(self, n: int, keys: np.ndarray, item: np.ndarray, place: np.ndarray) -> None:
        mask = np.zeros(1 << 16, dtype=bool)
        mask[keys & np.uint64(0xFFFF)] = True
        self.by_length[n] = keys, item, place, mask

    def save(self, folder: str, block: int) -> None:
        """As files of the shared folder; a block without words has none."""
        if self.by_length:
            save(folder, f"{block}-ids", self.ids)
            save(folder, f"{block}-at", self.at)
        for n, arrays in self.by_length.items():
            for (name, kind), array in zip(self.ARRAYS.items(), arrays[:3], strict=True):
                save(folder, f"{block}-{n}-{name}", array.astype(kind))

    @classmethod
    def load(cls, folder: str, block: int, lengths: tuple[int, ...]) -> Seeds:
        out = cls.__new__(cls)
        out.ids, out.at, out.by_length = load(folder, f"{block}-ids", np.int64), load(folder, f"{block}-at", np.int64), {}
        for n in lengths:
            out._add(n, *(load(folder, f"{block}-{n}-{name}", kind) for name, kind in cls.ARRAYS.items()))
        return out

    def runs(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows (text, item, place in the item minus place in the text, place in the text, equal windows in a
        row): the longest runs of equal windows, sorted."""
        found = [np.zeros((0, 5), np.int64)]
        for n, (keys, item, place, mask) in self.by_length.items():
            grams = gram_hashes(hashes, n)
            cand = np.flatnonzero(mask[grams & np.uint64(0xFFFF)])
            lo, hi = np.searchsorted(keys, grams[cand], "left"), np.searchsorted(keys, grams[cand], "right")
            text = np.searchsorted(at, cand, "right") - 1
            real = (hi > lo) & (cand + n <= at[text + 1])      # windows that run over a text's end go
            cand, lo, hi, text = cand[real], lo[real], hi[real], text[real]
            ends = np.cumsum(hi - lo)
            first = 0
            while first < len(cand):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
                sizes = (hi - lo)[first:last]
                pair = np.repeat(lo[first:last] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
                t, p = np.repeat(text[first:last], sizes), np.repeat((cand - at[text])[first:last], sizes)
                found.append(_joined(np.stack([t, item[pair], place[pair] - p, p, np.ones_like(p)], axis=1)))
                first = last
        return _joined(np.concatenate(found))


def _joined(runs: np.ndarray) -> np.ndarray:
    """Runs of one diagonal that follow each other as one; sorted."""
    runs = runs[np.lexsort(runs[:, 3::-1].T)]
    if len(runs) < 2:
        return runs
    new = np.concatenate(([True], (runs[1:, :3] != runs[:-1, :3]).any(1) | (runs[1:, 3] != runs[:-1, 3] + runs[:-1, 4])))
    out = runs[new]
    out[:, 4] = np.add.reduceat(runs[:, 4], np.flatnonzero(new))
    return out


def tiles(found: list[tuple[int, int, int]], n: int, n_item: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of one item on one text, from their runs (place in the text, place in the item,
    words): (place in the text, place in the item, length), longest first."""
    runs = [(-size, p, q) for p, q, size in found]
    heapq.heapify(runs)
    in_text, in_item, open_words, out = set(), np.zeros(n_item, dtype=bool), n_item, []
    while runs and open_words:
        size, p, q = heapq.heappop(runs)
        size = -size
        free = ~in_item[q:q + size]
        if in_text:
            free &= np.fromiter((p + j not in in_text for j in range(size)), bool, size)
        if free.all():
            in_text.update(range(p, p + size))
            in_item[q:q + size] = True
            open_words -= size
            out.append((p, q, size))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for j, k in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):      # the unmarked parts that are still long enough
            if k - j >= n:
                heapq.heappush(runs, (-(k - j), p + j, q + j))
    return out


def cover(texts: list[str | None], *seeds: Seeds | Callable[[], Seeds]) -> list[list[tuple[int, float]]]:
    """For each text, (item id, covered share of its words) of every item with a tile."""
    out: list[list[tuple[int, float]]] = [[] for _ in texts]
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < BATCH_CHARS):
            size += len(texts[hi] or "")
            hi += 1
        hashes, at = word_hashes([normal(t) for t in texts[lo:hi]])
        for block in seeds:
            s = block() if callable(block) else block
            runs = s.runs(hashes, at)
            cuts = np.flatnonzero((runs[1:, :2] != runs[:-1, :2]).any(1)) + 1
            for rows in np.split(runs, cuts) if len(runs) else []:
                t, k = rows[0, :2].tolist()
                total = int(s.at[k + 1] - s.at[k])
                n = min(MIN_MATCH, total)
                done = sum(x[2] for x in tiles([(p, p + d, c + n - 1) for d, p, c in rows[:, 2:].tolist()], n, total))
                if done:
                    out[lo + t].append((int(s.ids[k]), done / total))
        lo = hi
    return out


@lru_cache(HELD)
def _block(folder: str, block: int, lengths: tuple[int, ...]) -> Seeds:
    return Seeds.load(folder, block, lengths)


def seed_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> list[Callable[[], Seeds]]:
    """Writes the seeds of all items to the shared folder, a task for each block, and gives what loads the blocks."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    n = (items.agg(F.sum(F.length("text"))).first()[0] or 0) // chars + 1
    folder = qualified(spark, scratch_path(spark, "seeds"))

    def build(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        seeds = Seeds(sorted(zip(table.column("item_id").to_pylist(), table.column("text").to_pylist(), strict=True)))
        seeds.save(folder, block)
        return pa.table({"block": pa.array([block], pa.int64()), "lengths": pa.array([sorted(seeds.by_length)], pa.list_(pa.int64()))})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    built = dealt.groupBy("block").applyInArrow(build, "block long, lengths array<long>").filter("size(lengths) > 0").collect()
    return [partial(_block, folder, r["block"], tuple(r["lengths"])) for r in sorted(built)]


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Per row of docs: doc_id, contaminated, n_items, max_coverage, item_ids
    (the items covered to the share ``coverage`` or more, ascending)."""
    blocks = seed_blocks(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = cover(b.column("text").to_pylist(), *blocks)
            items = [sorted({i for i, c in f if c >= coverage}) for f in found]
            most = [max([0.0, *(c for _, c in f)]) for f in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(items, pa.list_(pa.int64())), pa.array(most, pa.float64())],
                                             ["doc_id", "item_ids", "max_coverage"])

    d = docs.selectExpr("cast(doc_id AS long) doc_id", "text").mapInArrow(run, "doc_id long, item_ids array<long>, max_coverage double")
    return d.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"),
                    "max_coverage", "item_ids")


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs, all columns as they are, that no item covers."""
    text, blocks = docs.columns.index("text"), seed_blocks(benchmark)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = cover(b.column(text).to_pylist(), *blocks)
            yield b.filter(pa.array([all(c < coverage for _, c in f) for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
