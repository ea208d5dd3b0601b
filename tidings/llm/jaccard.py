"""N-gram Jaccard join over group-count vectors.

A document is the set of its distinct word shingles. Two link when
``DENOMINATOR * |A & B| >= NUMERATOR * |A | B|``. The steps:

1. Equal sets are one node (by a 128-bit sum of their hashes); its least
   document stands for it from here on.
2. Shingles that ``COMMON`` of the documents or more hold say little: two texts
   with one license line are no candidates. They are counted first and left out
   of the blocks (which are correct for any list of shingles to leave out). The
   other shingles of a set are hashed into groups, and the groups into blocks.
   Sets that link differ in at most r shingles, where r follows from the size,
   so of r + 1 + spare blocks spare + 1 at least have equal content. Every set
   emits a key for each of its blocks, and sets of one size class that share
   spare + 1 keys are candidates. Sizes near a class border emit keys for both
   classes. Keys are sorted in ``PARTS`` shuffles, one after the other, so that
   the disk holds a part of them, and never written; a stream over them
   gives the pairs of sets that share a key, whose keys are counted. A key of
   more than ``PAIRED`` sets gives no pairs but is noted as hot: hot keys that
   two sets may share, the fewer of either, count as shared, and what two sets
   share in hot keys alone is found among the sets with spare + 1 of them, each
   linked to the least of its key. So no link is lost, and sets that hold one
   passage, of which some blocks agree by chance, do not hang together.
3. Candidates that hang together through keys form a bundle (connected
   components). A bundle's sets meet in one task; a
   bundle of more than ``CHUNK`` shingles is cut into chunks by hash, and every
   two chunks meet in a task of their own, so a task's memory is bounded.
4. In a task the group counts of the sets are points of an R-tree. The sum of
   the coordinate minima of a set and a node's upper corner bounds the overlap
   with every set below the node; what that cannot rule out is verified on the
   hash sets. Sets already linked through others are not compared again, so a
   group of copies costs one verification for each member, and a task gives one
   link for each set instead of all pairs.
5. Components of all links.

Defined cases: null and empty texts and texts without words have an empty set
and link with nothing, equal ones included; fewer words than a shingle are one
shingle; of rows with one doc_id each is a document of its own;
a row without a doc_id has no component; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .hashing import gram_hashes, mix, word_hashes

SHINGLE = 3
NUMERATOR, DENOMINATOR = 90, 100
CHUNK = 1_000_000        # shingles of one chunk
LEAF = 16                # points of an R-tree leaf, and children of a node
SPARE = 1                # blocks beyond r + 1, at least
COMMON = 1 / 1000        # share of the documents that hold a common shingle, at least
COMBINED = 2_000_000     # keys combined at once in a task
PAIRED = 8               # sets of a key that are paired, at most; a key of more is a hot one
PARTS = 2                # shuffles that the keys are dealt to, by their hash; each reads the documents again
CLASS = np.uint64(255)   # the bits of a key that hold its size class
SKETCH = "doc_id long, n_shingles long, f1 long, f2 long"
SET = ["f1", "f2", "n_shingles"]


class Sizes:
    """Size classes and the differences they allow, for one threshold.

    ``share``: further spare blocks, for each difference. A lower threshold has
    fewer shingles a block (about 4 at 0.8), so more blocks are empty.
    """

    def __init__(self, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, limit: int = 1 << 40,
                 share: float = 0.0) -> None:
        self.num, self.den, self.share = numerator, denominator, share
        self.least = -(-numerator // (denominator - numerator))     # smaller sets link only if equal
        self.starts = [self.least]
        while self.starts[-1] < limit:
            last = self.starts[-1]
            wide = last * denominator // numerator + 1                # the largest partner of the class before, and one
            self.starts.append(max(wide, -(-last * 5 // 4)))

    def classes(self, n: int) -> list[int]:
        """Own class, and the one below if a partner may be in it."""
        if n < self.least:
            return []
        k = int(np.searchsorted(self.starts, n, "right")) - 1
        low = -(-n * self.num // self.den)          # the smallest partner
        return [k, k - 1] if k and low < self.starts[k] else [k]

    def differences(self, k: int) -> int:
        """Most shingles in which a set of class k and a partner as large or larger differ."""
        return (self.starts[k + 1] - 1) * (self.den - self.num) // self.num

    def spare(self, k: int) -> int:
        """Blocks of class k beyond its differences and one."""
        return SPARE + math.ceil(self.differences(k) * self.share)

    def shared(self) -> list[int]:
        """By class: the keys that two sets which link share, at least."""
        return [self.spare(k) + 1 for k in range(len(self.starts) - 1)]


def keys_of(shingles: np.ndarray, sizes: Sizes, common: np.ndarray | None = None) -> np.ndarray:
    """The block keys of a set of hashes, those in ``common`` (sorted) left out of the blocks; the last bits hold the class.

    With r differences and r + 1 + spare blocks, spare + 1 blocks agree, empty ones among them.
    """
    out, n = [], len(shingles)
    if common is not None and len(common) and n >= sizes.least:
        shingles = shingles[common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] != shingles]
    high = shingles >> np.uint64(32)
    for k in sizes.classes(n):
        m = sizes.differences(k) + 1 + sizes.spare(k)
        block = (high * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        count = np.bincount(block, minlength=m)
        total = np.zeros(m, np.uint64)
        np.add.at(total, block, shingles)
        key = mix(total * np.uint64(0x9E3779B97F4A7C15) + np.arange(m, dtype=np.uint64) * np.uint64(0x100000001B3)
                  + np.uint64(k) + (count.astype(np.uint64) << np.uint64(48)))
        out.append(key & ~CLASS | np.uint64(k))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, at = word_hashes(texts)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = min(size, hi - lo)
        grams = gram_hashes(hashes[lo:hi], n) if n else hashes[:0]
        if 0 < n < size:
            grams = mix(grams + np.uint64(n))       # shorter sequences are no shingles of others
        out.append(np.unique(grams))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _slices(b: pa.RecordBatch, size: int = 1000) -> Iterator[pa.RecordBatch]:
    for lo in range(0, b.num_rows, size):
        yield b.slice(lo, size)


def names_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of hashes that name each set."""
    return tuple(np.array([int(h(s).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64) for h in (lambda s: s, mix))


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, size of its set, the sums that name the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole):
                sets = shingle_sets(b.column("text").to_pylist(), shingle)
                f1, f2 = names_of(sets)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2)],
                                                 ["doc_id", "n_shingles", "f1", "f2"])

    return docs.selectExpr("cast(doc_id AS long) doc_id", "text").mapInArrow(run, SKETCH)


def _combined(keys: list[np.ndarray], sets: list[int]) -> pa.RecordBatch:
    """(key, node, hot): each key once with each of its sets. A key of too many sets is named in ``hot`` by rows that
    any task may read; one row without a set stands for them where the key is read."""
    key, node = np.concatenate(keys).view(np.int64), np.repeat(np.array(sets, np.int64), [len(k) for k in keys])
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
    key, node = key[new], node[new]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    many = np.diff(np.append(starts, len(key))) > PAIRED
    hot, marks = np.repeat(many, np.diff(np.append(starts, len(key)))), key[starts[many]]
    spread = mix((key[hot] ^ mix(node[hot].view(np.uint64)).view(np.int64)).view(np.uint64)).view(np.int64)
    n = (len(key) - int(hot.sum()), int(hot.sum()), len(marks))
    kind = np.repeat([0, 1, 2], n)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((key[~hot], spread, marks))), pa.array(np.concatenate((node[~hot], node[hot], marks)), mask=kind == 2),
         pa.array(np.concatenate((key[~hot], key[hot], marks)), mask=kind != 1)], ["key", "node", "hot"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, kind) of the rows of ``_combined``, sorted by key and set: two sets that share a key, with its class;
    a set and a hot key it has, with the complement of the class."""
    key, node, marks = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)     # of the last key so far
    open_key = None                         # the last key, if it is hot
    for b in itertools.chain(batches, [None]):
        named = [np.zeros(0, np.int64)] * 2
        if b is not None:
            known, own = b.column("hot").is_valid().to_numpy(zero_copy_only=False), b.column("node")
            named = [own.filter(b.column("hot").is_valid()).to_numpy(), b.column("hot").drop_null().to_numpy()]
            key = np.concatenate((key, b.column("key").to_numpy()[~known]))
            marks = np.concatenate((marks, own.is_null().to_numpy(zero_copy_only=False)[~known]))
            node = np.concatenate((node, own.fill_null(0).to_numpy()[~known]))
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | marks[1:] | marks[:-1]))[:len(key)]
        key, node, marks = key[new], node[new], marks[new]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[:len(key)])
        sizes = np.diff(np.append(starts, len(key)))
        many = (sizes > PAIRED) | (np.logical_or.reduceat(marks, starts) if len(starts) else np.zeros(0, bool)) | (key[starts] == open_key)
        held = b is not None and len(starts) > 0 and not many[-1]
        open_key = int(key[-1]) if len(starts) and many[-1] else None if len(starts) else open_key
        end = starts[-1] if held else len(key)
        hot = np.repeat(many, sizes)
        told = np.flatnonzero(hot & ~marks)
        group = np.repeat(np.arange(len(starts)), sizes)
        cold = np.flatnonzero(~hot[:end])
        i, j = [], []
        for d in range(1, PAIRED):
            at = np.flatnonzero(group[cold[d:]] == group[cold[:-d]])
            i.append(cold[at])
            j.append(cold[at + d])
        i, j = np.concatenate(i), np.concatenate(j)
        classes = lambda keys: (keys & 255).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((node[i], node[told], named[0]))), pa.array(np.concatenate((node[j], key[told], named[1]))),
             pa.array(np.concatenate((classes(key[i]), ~classes(key[told]), ~classes(named[1]))))], ["a", "b", "kind"])
        key, node, marks = key[end:], node[end:], marks[end:]


def common_shingles(docs: DataFrame, sizes: Sizes, shingle: int = SHINGLE, share: float = COMMON) -> np.ndarray:
    """The hashes of shingles that about ``share`` of the documents or more hold, sorted.

    Tasks count in portions of documents and send what half that share of a portion holds (twice at least), so a
    portion sends 2 / share times a set's average size at most, and so many are the sums that are collected. The
    list only steers how candidates are found, not which links there are.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(sets: list[np.ndarray]) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(sets), return_counts=True)
            often = n >= max(2, share * len(sets) / 2)
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *values[often].view(np.int64).tolist()], pa.int64()), pa.array([len(sets), *n[often].tolist()], pa.int64())], ["shingle", "n"])

        sets, held = [], 0
        for whole in batches:
            for b in _slices(whole):
                sets += [s for s in shingle_sets(b.column("text").to_pylist(), shingle) if len(s) >= sizes.least]
                held = sum(map(len, sets))
                if held > COMBINED:
                    yield send(sets)
                    sets, held = [], 0
        if sets:
            yield send(sets)

    sums = docs.select("text").mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    sums = written(sums, "jaccard-common")
    total = sums.filter("shingle IS NULL").agg(F.sum("n")).first()[0] or 0
    found = sums.filter((F.col("n") >= max(2, share * total)) & F.col("shingle").isNotNull()).select("shingle").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def candidates(docs: DataFrame, sizes: Sizes, shingle: int = SHINGLE, share: float = COMMON) -> DataFrame:
    """(a, b): links of sets, named by the first of their sums, that join all sets which may link."""
    common = common_shingles(docs, sizes, shingle, share)

    def keyed(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        keys, names, held = [np.zeros(0, np.uint64)], [0], 0
        for whole in batches:
            for b in _slices(whole):
                found = shingle_sets(b.column("text").to_pylist(), shingle)
                own = [k[(k >> np.uint64(8)) % np.uint64(PARTS) == part] for k in (keys_of(s, sizes, common) for s in found)]
                keys += own
                names += names_of(found)[0].tolist()
                held += sum(map(len, own))
                if held > COMBINED:
                    yield _combined(keys, names)
                    keys, names, held = keys[:1], names[:1], 0
        if held:
            yield _combined(keys, names)

    rows = docs.filter("doc_id IS NOT NULL").select("text")
    met = None
    for part in range(PARTS):
        keys = rows.mapInArrow(lambda batches, part=part: keyed(batches, part), "key long, node long, hot long")
        found = keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_met, "a long, b long, kind int")
        found = written(found, "jaccard-met")
        met = found if met is None else met.union(found)
    least = F.get(F.array(*[F.lit(n) for n in sizes.shared()]), F.col("kind"))
    pairs = met.filter("kind >= 0").groupBy("a", "b", "kind").agg(F.count(F.lit(1)).alias("n"))
    pairs = written(pairs.select("a", "b", "kind", (least - F.col("n")).alias("lacks")), "jaccard-pairs")
    hot = written(met.filter("kind < 0").selectExpr("a AS node", "b AS key", "~kind AS kind").distinct(), "jaccard-hot")
    many = written(hot.groupBy("node", "kind").agg(F.count(F.lit(1)).alias("hot")), "jaccard-many")
    near = pairs.filter("lacks > 0")
    for c in ("a", "b"):
        near = near.join(many.withColumnRenamed("node", c), [c, "kind"]).filter("hot >= lacks").drop("hot")
    strong = written(hot.join(many.filter(F.col("hot") >= least), ["node", "kind"]).select("key", "node"), "jaccard-strong")
    first = written(strong.groupBy("key").agg(F.min("node").alias("first")), "jaccard-first")
    stars = strong.join(first, "key").select(F.col("node").alias("a"), F.col("first").alias("b"))
    return pairs.filter("lacks <= 0").select("a", "b").union(near.select("a", "b")).union(stars)


class CountTree:
    """R-tree over group-count points, packed by splitting on the widest coordinate."""

    def __init__(self, points: np.ndarray) -> None:
        order: list[np.ndarray] = []

        def split(rows: np.ndarray) -> None:
            if len(rows) <= LEAF:
                order.append(rows)
                return
            part = points[rows]
            rows = rows[np.argsort(part[:, int(np.argmax(part.max(0) - part.min(0)))], kind="stable")]
            half = -(-len(rows) // (2 * LEAF)) * LEAF
            split(rows[:half])
            split(rows[half:])

        split(np.argsort(points.sum(1), kind="stable"))
        self.leaves = order
        self.points = points
        level = np.array([points[r].max(0) for r in order])
        self.levels = [level]
        while len(level) > 1:
            level = np.array([level[k:k + LEAF].max(0) for k in range(0, len(level), LEAF)])
            self.levels.append(level)

    def reach(self, q: np.ndarray, need: int) -> np.ndarray:
        """The points whose sum of coordinate minima with q is ``need`` or more."""
        nodes = np.arange(len(self.levels[-1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            nodes = nodes[np.minimum(level[nodes], q).sum(1, dtype=np.int64) >= need]
            if depth:
                below = len(self.levels[depth - 1])
                nodes = np.concatenate([np.arange(k * LEAF, min(below, (k + 1) * LEAF)) for k in nodes] or [nodes])
        rows = np.concatenate([self.leaves[k] for k in nodes] or [nodes]).astype(np.int64)
        return rows[np.minimum(self.points[rows], q).sum(1, dtype=np.int64) >= need]


def group_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The points: how many shingles of each set fall into each hash group."""
    width = int(np.median([len(s) for s in sets]))
    groups = 1 << min(9, max(5, width.bit_length()))
    out = np.zeros((len(sets), groups), np.uint32)
    for k, s in enumerate(sets):
        out[k] = np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return out


def linked(sets: list[np.ndarray], sizes: Sizes) -> np.ndarray:
    """A label for each set; sets joined by links have the same one."""
    label = np.arange(len(sets))
    n = np.array([len(s) for s in sets])
    tree = CountTree(group_counts(sets))
    for q in range(len(sets)):
        least = -(-n[q] * sizes.num // sizes.den)
        need = -(-sizes.num * (n[q] + least) // (sizes.num + sizes.den))     # of the smallest partner
        cand = tree.reach(tree.points[q], need)
        cand = cand[(label[cand] != label[q]) & (n[cand] >= least) & (n[cand] * sizes.num <= n[q] * sizes.den)]
        # by overlap bound, the closest first
        cand = cand[np.argsort(-np.minimum(tree.points[cand], tree.points[q]).sum(1, dtype=np.int64), kind="stable")]
        while len(cand):
            c, cand = cand[0], cand[1:]
            both = int(np.isin(sets[q], sets[c], assume_unique=True).sum()) if n[q] < 40 else \
                len(np.intersect1d(sets[q], sets[c], assume_unique=True))
            if sizes.den * both >= sizes.num * (n[q] + n[c] - both):
                label[label == label[c]] = label[q]
                cand = cand[label[cand] != label[q]]
    return label


def nodes_of(sketch: DataFrame) -> DataFrame:
    """(f1, f2, n_shingles, first, node) of each set that is not empty: its least document and its node.

    The node is that document's id; where rows with one doc_id begin several sets, all but one of these
    get a hash far below the ids instead.
    """
    sets = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*SET).agg(F.min("doc_id").alias("first"))
    sets = written(sets, "jaccard-sets")
    several = sets.groupBy("first").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*SET)).alias("_keeps")).filter("_n > 1").drop("_n")
    other = F.lit(-(1 << 62)) - F.pmod(F.xxhash64("first", *SET), F.lit(1 << 61))
    node = F.when(F.col("_keeps").isNull() | (F.col("_keeps") == F.struct(*SET)), F.col("first")).otherwise(other)
    return written(sets.join(several, "first", "left").select(*SET, "first", node.alias("node")), "jaccard-nodes")


def links(docs: DataFrame, nodes: DataFrame, sizes: Sizes, chunk: int = CHUNK, shingle: int = SHINGLE) -> DataFrame:
    """(a, b): links between nodes, one for each set at most in each task, that join the same nodes as all links do."""
    bundles = components(candidates(docs, sizes, shingle)).select(F.col("node").alias("f1"), F.col("component").alias("bundle"))
    members = written(nodes.filter(F.col("n_shingles") >= sizes.least).join(bundles, "f1"), "jaccard-members")
    cut = members.groupBy("bundle").agg(F.sum("n_shingles").alias("total"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    cut = written(cut.select("bundle", "total", F.ceil(F.col("total") / chunk).alias("chunks")), "jaccard-bundles")
    total = cut.agg(F.sum("total")).first()[0] or 0
    tasks = max(1, -(-total // chunk))
    members = members.join(cut, "bundle").withColumn("part", F.pmod(F.xxhash64("node"), "chunks"))
    # two chunks meet in the task (i, j), i < j; whole bundles share tasks
    own = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    meets = F.transform(F.filter(own, lambda j: j != F.col("part")),
                        lambda j: F.xxhash64("bundle", F.least("part", j), F.greatest("part", j)))
    alone = F.array(F.pmod(F.xxhash64("bundle"), F.lit(tasks)))
    members = members.select(F.col("first").alias("doc_id"), "f1", "f2", "node", "bundle",
                             F.when(F.col("chunks") > 1, meets).otherwise(alone).alias("tasks"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole):
                found = shingle_sets(b.column("text").to_pylist(), shingle)
                f1, f2 = names_of(found)          # of rows with one doc_id, the one that holds the set
                own = np.flatnonzero((f1 == b.column("f1").to_numpy()) & (f2 == b.column("f2").to_numpy()))
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(own)) for c in ("node", "bundle", "tasks")),
                                                  _lists([found[k] for k in own])], ["node", "bundle", "tasks", "shingles"])

    def join(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, bundle = table.column("node").to_numpy(), table.column("bundle").to_numpy()
        column = table.column("shingles").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        values, ends = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
        order = np.lexsort((node, bundle))
        order = order[np.concatenate(([True], np.diff(node[order]) != 0))]          # repeated rows
        a, b = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(bundle[order])) + 1):
            label = linked([values[ends[k]:ends[k + 1]] for k in rows], sizes)
            first: dict[int, int] = {}
            for k, name in zip(node[rows].tolist(), label.tolist(), strict=True):
                if first.setdefault(name, k) != k:
                    a.append(k)
                    b.append(first[name])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # members grow with the documents, so they are never broadcast
    texts = docs.selectExpr("cast(doc_id AS long) doc_id", "text").join(members.hint("merge"), "doc_id")
    found = texts.mapInArrow(sets, "node long, bundle long, tasks array<long>, shingles array<long>")
    found = found.select("node", "bundle", "shingles", F.explode("tasks").alias("task"))
    return found.groupBy("task").applyInArrow(join, "a long, b long")


def _classes(docs: DataFrame, sizes: Sizes, chunk: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The sketch of each row, and of each set that is not empty: its least document, its class and the class's least document."""
    sketch = written(sketches(docs, shingle), "jaccard-sketch")
    nodes = nodes_of(sketch)
    whole = components(links(docs, nodes, sizes, chunk, shingle))
    classes = nodes.join(whole, "node", "left").select(*SET, "first", F.coalesce("component", "node").alias("class"))
    return sketch, written(classes, "jaccard-classes")


def join_classes(docs: DataFrame, sizes: Sizes | None = None, chunk: int = CHUNK, shingle: int = SHINGLE) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the least doc_id that links reach)."""
    sketch, classes = _classes(docs, sizes or Sizes(), chunk, shingle)
    least = classes.groupBy("class").agg(F.min("first").alias("least"))
    sets = written(classes.join(least, "class").select(*SET, "least"), "jaccard-least")
    reach = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return sketch.join(sets, SET, "left").select("doc_id", "n_shingles", reach.alias("component_id"))


def deduplicated(docs: DataFrame, sizes: Sizes | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs, all columns as they are, that stand first in their class, by doc_id; of rows with one
    doc_id and equal sets, one stays. Rows without an id cannot be told apart by it, so each stays."""
    _, classes = _classes(docs, sizes or Sizes(), CHUNK, shingle)
    keep = classes.groupBy("class").agg(F.min(F.struct("first", *SET)).alias("k")).select(
        *[F.col(f"k.{c}").alias(f"_{c}") for c in ("first", *SET)], F.lit(True).alias("_keeps"))

    def named(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            parts = [shingle_sets(t.iloc[k:k + 1000].tolist(), shingle) for k in range(0, len(t), 1000)]
            cols = [(*names_of(p), np.array([len(s) for s in p], np.int64)) for p in parts]
            yield pd.DataFrame({c: np.concatenate([x[k] for x in cols] or [np.zeros(0, np.int64)]) for k, c in enumerate(SET)})

    names = [f"_column_{k}" for k in range(len(docs.columns))]
    doc_id, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    rows = docs.toDF(*names).withColumn("_set", F.pandas_udf(named, "f1 long, f2 long, n_shingles long")(text))
    rows = rows.select(*names, *[F.col(f"_set.{c}").alias(f"_{c}") for c in SET], F.col(doc_id).cast("long").alias("_first"),
                       F.when(F.col(doc_id).isNull(), F.monotonically_increasing_id()).alias("_alone"))
    key = ["_first", *[f"_{c}" for c in SET]]
    rest = rows.join(keep, key, "left").filter("_keeps OR _n_shingles = 0 OR _first IS NULL").dropDuplicates([*key, "_alone"])
    return rest.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
