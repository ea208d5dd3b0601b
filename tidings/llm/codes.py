"""Vector compression to product codes, nearest entries by slices and bitmasks.

Vectors become integers and are cut into ``PARTS`` parts; each part gets a
codebook of up to ``ENTRIES`` entries, moved by ``ROUNDS`` rounds of assignment
and averaging. All distances are integers, so results do not depend on order.

The nearest entry is found by ``Slices``. The entries' coordinates are sorted
in every dimension, and each rank carries a bitmask of all entries of lower
rank. For a part of a vector an initial radius is the distance to the best of a
few entries (its neighbours in each dimension). No entry within that radius
leaves the slice [x - r, x + r] of any dimension; two prefix masks give a
slice's entries, and the masks of all dimensions, ANDed as uint64 words, give
the candidates. Their distances are then computed, in ascending index, so ties
go to the lower one.

The rows are written once; each round is a pass in Arrow batches that emits
sums per entry of one task, and a grouped sum. The codebooks (``ENTRIES``
vectors) are all that is collected and sent to tasks.

Defined cases: a null or empty vector, or one with null or non-finite
components, is dropped. The length is that of the first kept vector (by
vec_id, null last, then by content); vectors of another length have no parts to
compare and are dropped as well. Parts differ in length by one if 4 does not divide it. Components beyond
2**26 after scaling count as 2**26, so distances stay whole 64-bit numbers.
With fewer than 256 vectors there are fewer entries; unused entries stay. Rows
with one vec_id are coded one by one; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 2**26
ROWS = 4096          # vectors worked on at once: bounds the masks and differences in memory

Codebooks = list[np.ndarray]       # per part, entries x dimensions, int64


class Slices:
    """Exact nearest entries of one codebook."""

    def __init__(self, book: np.ndarray) -> None:
        self.book = np.ascontiguousarray(book, dtype=np.int64)
        n = len(self.book)
        self.order = np.argsort(self.book, axis=0, kind="stable").T              # dims x entries
        self.sorted = np.take_along_axis(self.book.T, self.order, axis=1)
        rank = np.argsort(self.order, axis=1)                                    # dims x entries
        bits = rank[:, None, :] < np.arange(n + 1)[None, :, None]                # [d, k]: the k entries of lowest rank
        packed = np.packbits(bits, axis=2, bitorder="little")
        packed = np.pad(packed, ((0, 0), (0, 0), (0, -packed.shape[2] % 8)))
        self.below = np.ascontiguousarray(packed).view("<u8")                    # dims x (entries + 1) x words

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.book[entry]) ** 2).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Squared distance to the best of the entries next to x in some dimension: no nearest entry is farther."""
        best = None
        for d in range(self.book.shape[1]):
            near = self.order[d][np.minimum(np.searchsorted(self.sorted[d], x[:, d]), len(self.book) - 1)]
            far = self.distance(x, near)
            best = far if best is None else np.minimum(best, far)
        return best

    def candidates(self, x: np.ndarray, within: np.ndarray) -> np.ndarray:
        """rows x entries, true where the entry lies in the slices of all dimensions around x (squared radius)."""
        r = np.ceil(np.sqrt(within.astype(np.float64))).astype(np.int64) + 1     # never too small
        masks = None
        for d in range(self.book.shape[1]):
            lo = np.searchsorted(self.sorted[d], x[:, d] - r, side="left")
            hi = np.searchsorted(self.sorted[d], x[:, d] + r, side="right")
            inside = self.below[d][hi] & ~self.below[d][lo]
            masks = inside if masks is None else masks & inside
        return np.unpackbits(masks.view(np.uint8), axis=1, count=len(self.book), bitorder="little").view(bool)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of x."""
        best, entry = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        found = np.ascontiguousarray(self.candidates(x, self.radius(x)).T)
        for k in range(len(self.book)):
            rows = np.flatnonzero(found[k])
            far = self.distance(x[rows], k)
            less = far < best[rows]
            best[rows[less]], entry[rows[less]] = far[less], k
        return entry, best


def whole(vector: Column) -> Column:
    """The integers of a vector; null if it is null, empty or holds a component that is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    top = float(LARGEST)
    return F.when(good & (F.size(vector) > 0), F.transform(
        x, lambda v: F.floor(F.greatest(F.least(v * F.lit(float(SCALE)), F.lit(top)), F.lit(-top))).cast("long")))


def cut(dims: int) -> list[slice]:
    """The parts of a vector of so many dimensions."""
    edges = np.cumsum([0, *[len(p) for p in np.array_split(np.arange(dims), PARTS)]]).tolist()
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            block = b.slice(at, ROWS)
            yield block, _matrix(block.column("_x"))


def train(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> Codebooks:
    """The codebooks of rows (vec_id, _x), after ``rounds`` moves."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "_x").limit(entries).select("_x").collect()
    if not first:
        return []
    start = np.array([r["_x"] for r in first], dtype=np.int64)
    parts = cut(start.shape[1])
    books = [start[:, p] for p in parts]
    width = max(b.shape[1] for b in books)
    for _ in range(rounds):
        def sums(batches: Iterator[pa.RecordBatch], books: Codebooks = books) -> Iterator[pa.RecordBatch]:
            search = [Slices(b) if b.shape[1] else None for b in books]
            total = np.zeros((PARTS, len(books[0]), width), np.int64)
            count = np.zeros((PARTS, len(books[0])), np.int64)
            for _, x in _blocks(batches):
                for k, (part, of) in enumerate(zip(parts, search, strict=True)):
                    if of:
                        own = x[:, part]
                        entry, _ = of.nearest(own)
                        np.add.at(total[k, :, :own.shape[1]], entry, own)
                        np.add.at(count[k], entry, 1)
            k, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(e, pa.int32()), pa.array(count[k, e]),
                 pa.array(list(total[k, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

        partial = rows.select("_x").mapInArrow(sums, "part int, entry int, n long, total array<long>")
        moved = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[d]).alias(f"s{d}") for d in range(width)])
        books = [b.copy() for b in books]
        for r in moved.collect():                      # at most PARTS x entries rows
            book = books[r["part"]]
            book[r["entry"]] = [r[f"s{d}"] // r["n"] for d in range(book.shape[1])]
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Per row of rows (vec_id, label, _x): vec_id, label, codes (one byte a part), error."""
    schema = "vec_id long, label long, codes binary, error long"
    if not books:
        return rows.sparkSession.createDataFrame([], schema)
    parts = cut(sum(b.shape[1] for b in books))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(b) if b.shape[1] else None for b in books]
        for block, x in _blocks(batches):
            codes, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
            for k, (part, of) in enumerate(zip(parts, search, strict=True)):
                if of:
                    entry, far = of.nearest(x[:, part])
                    codes[:, k] = entry
                    error += far
            raw = pa.Array.from_buffers(pa.binary(PARTS), len(x), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"), raw.cast(pa.binary()), pa.array(error)],
                                             ["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(work, schema)


def digest(books: Codebooks) -> str:
    numbers = [str(v) for b in books for v in b.reshape(-1).tolist()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(vectors: DataFrame) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, codes, error of every kept vector; the codebooks). ``vectors``: vec_id, embedding, label."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          whole(F.col("embedding")).alias("_x")).filter("_x IS NOT NULL")
    rows = written(rows, "vectors")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "_x").select(F.size("_x").alias("n")).first()
    if first:
        rows = rows.filter(F.size("_x") == first["n"])
    books = train(rows)
    return encode(rows, books), books


def decode(codes: np.ndarray, books: Codebooks) -> np.ndarray:
    """The vectors of integers that codes (rows x parts) stand for."""
    return np.concatenate([b[codes[:, k]] for k, b in enumerate(books)], axis=1)
