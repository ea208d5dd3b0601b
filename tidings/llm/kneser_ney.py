"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Files in the shared folder, all arrays in order of key, each cut into shards:

* ``uni-*``: sorted 64-bit word hashes and their counts. A word's id is its
  place over all shards.
* ``bi-*``: sorted keys ``context id << 32 | word id`` and their counts, with
  ``ctx-*`` (for each context: total, and how many words follow it once, twice,
  three times or more) beside them.
* ``cont-*``: for each word id the number of distinct contexts before it.

Counting is one grouped sum for words and one for pairs. A task counts its own
pairs first and sends them as packed sorted arrays to the shard of their key
range. Ranges are cut so that a shard gets about ``SHARD_TOKENS`` tokens: a
context with more than that (a very frequent word, or the start of a text) is
cut by ranges of the following word, and the totals of its parts are added up
on the driver, one row for each part. Scoring tasks map the files into memory
and look up the sorted distinct words and pairs of a batch, so what a task
holds is its batch; the pages of the model belong to the file cache.

p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) * p(w); p(w) the same over the
counts of contexts, down to 1 / (V + 1) for every word, unknown ones included.

Defined cases: null and empty texts are one end token; rows with one doc_id are
trained on and scored one by one; without training rows every probability is 1
(N = V = 0); an empty table gives no rows; further columns are not read. The
vocabulary may have up to 2**32 - 2 words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written
from .files import load, save
from .hashing import word_hashes

BATCH_CHARS = 8_000_000
SHARD_TOKENS = 2_000_000
SHARD_WORDS = 1_000_000
END = np.uint64(0x5DEECE66D1234567)       # the hash of the end of a text
CONTEXT = np.dtype([("c", "<u8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4")])


@dataclass
class Model:
    """What is small: where the shards begin, and totals. Goes to every task."""
    folder: str
    words: int = 0                     # V
    tokens: int = 0                    # N
    uni: list[tuple[int, int, str]] = field(default_factory=list)      # (first hash, first id, name)
    bounds: list[int] = field(default_factory=list)                    # first key of each pair shard
    stored: list[int] = field(default_factory=list)                    # pair shards that exist
    hot: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)
    cont: list[int] = field(default_factory=list)                      # first id of each cont shard
    pair_discount: tuple[float, ...] = (0.5, 1.0, 1.5)
    word_discount: tuple[float, ...] = (0.5, 1.0, 1.5)
    contexts: int = 0                  # distinct pairs
    rest: float = 1.0                  # probability left for the uniform level


def _ranges(queries: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, lo, hi): sorted queries[lo:hi] belong to the shard."""
    cuts = np.concatenate(([0], np.searchsorted(queries, firsts[1:]), [len(queries)]))
    for k in range(len(firsts)):
        if cuts[k + 1] > cuts[k]:
            yield k, int(cuts[k]), int(cuts[k + 1])


def _find(keys: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, queries)
    inside = np.minimum(at, len(keys) - 1)
    return inside, (keys[inside] == queries) & (at < len(keys))


class Reader:
    """Lookups in a model's mapped files."""

    def __init__(self, model: Model) -> None:
        self.m, self.open = model, {}

    def file(self, name: str, kind) -> np.ndarray:
        if name not in self.open:
            self.open[name] = load(self.m.folder, name, kind)
        return self.open[name]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids or -1, counts) of sorted distinct word hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if self.m.uni:
            firsts = np.array([u[0] for u in self.m.uni], np.uint64)
            firsts[0] = 0
            for k, lo, hi in _ranges(hashes, firsts):
                _, base, name = self.m.uni[k]
                at, found = _find(self.file(f"uni-{name}.keys", "<u8"), hashes[lo:hi])
                ids[lo:hi] = np.where(found, at + base, -1)
                counts[lo:hi] = np.where(found, self.file(f"uni-{name}.counts", "<i8")[at], 0)
        return ids, counts

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pair keys."""
        out = np.zeros(len(keys), np.int64)
        stored = set(self.m.stored)
        for k, lo, hi in _ranges(keys, np.array(self.m.bounds, np.uint64)):
            if k in stored:
                at, found = _find(self.file(f"bi-{k}.keys", "<u8"), keys[lo:hi])
                out[lo:hi] = np.where(found, self.file(f"bi-{k}.counts", "<u4")[at], 0)
        return out

    def context(self, ids: np.ndarray) -> np.ndarray:
        """Totals of sorted distinct context ids."""
        out = np.zeros(len(ids), CONTEXT)
        stored = set(self.m.stored)
        for k, lo, hi in _ranges(ids.astype(np.uint64) << np.uint64(32), np.array(self.m.bounds, np.uint64)):
            first = self.m.bounds[k] >> 32
            if k in stored and first not in self.m.hot:
                out[lo:hi] = self.file(f"ctx-{k}", CONTEXT)[ids[lo:hi] - first]
        for i, totals in self.m.hot.items():
            at = int(np.searchsorted(ids, i))
            if at < len(ids) and ids[at] == i:
                out[at] = totals
        return out

    def before(self, ids: np.ndarray) -> np.ndarray:
        """How many distinct contexts stand before each of sorted distinct words."""
        out = np.zeros(len(ids), np.int64)
        for k, lo, hi in _ranges(ids, np.array(self.m.cont, np.int64)):
            out[lo:hi] = self.file(f"cont-{k}", "<u4")[ids[lo:hi] - self.m.cont[k]]
        return out


# counting ------------------------------------------------------------------

def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, an end after each text; where each text's tokens begin)."""
    hashes, at = word_hashes(texts)
    return np.insert(hashes, at[1:], END), at + np.arange(len(at))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(doc ids, texts), about BATCH_CHARS characters at a time."""
    docs, texts, size = [], [], 0
    for b in batches:
        for doc, text in zip(b.column("doc_id"), b.column("text"), strict=True):
            text = text.as_py()
            docs.append(doc.as_py())
            texts.append(text)
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def _planes(a: np.ndarray) -> bytes:
    """An array's bytes, all first bytes first; they compress well in a shuffle."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_words(train: DataFrame, model: Model) -> list[int]:
    """Writes the word shards; gives the ids of frequent words with their counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _batches(batches):
            keys, counts = np.unique(_tokens(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "n"])

    words = train.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    words = written(words, "lm-words")
    total = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    model.words, model.tokens = total[0], total[1] or 0
    if model.words >= 2**32 - 1:
        raise ValueError("a vocabulary of 2**32 words or more has no 32-bit ids")
    folder = model.folder

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("h").to_numpy().view(np.uint64), b.column("n").to_numpy()) for b in batches if b.num_rows]
        if got:
            keys, counts = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
            name = f"{int(keys[0]):016x}"
            save(folder, f"uni-{name}.keys", keys)
            save(folder, f"uni-{name}.counts", counts.astype("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(keys)], pa.int64())], ["name", "n"])

    # the order of unsigned hashes
    rank = F.col("h").bitwiseXOR(F.lit(-2**63).cast("long"))
    dealt = words.repartitionByRange(model.words // SHARD_WORDS + 1, rank).sortWithinPartitions(rank)
    shards = sorted((r["name"], r["n"]) for r in dealt.mapInArrow(store, "name string, n long").collect())
    base = 0
    for name, n in shards:
        model.uni.append((int(name, 16), base, name))
        base += n
    # at most 4 * tokens / SHARD_TOKENS words are this frequent
    return [(np.uint64(r["h"] & (2**64 - 1)), r["n"]) for r in words.filter(F.col("n") > SHARD_TOKENS / 4).collect()]


def _pair_keys(reader: Reader, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """(context ids, word ids, word counts, text starts); the context of a
    first token is id V, unknown words are -1."""
    tokens, starts = _tokens(texts)
    known, back = np.unique(tokens, return_inverse=True)
    ids, counts = reader.ids(known)
    word, count = ids[back], counts[back]
    context = np.concatenate(([0], word[:-1]))
    context[starts[:-1]] = reader.m.words
    return context, word, count, starts


def _bounds(model: Model, frequent: list[tuple[int, int]], texts: int) -> None:
    """First keys of the pair shards, and which contexts are cut."""
    shards = model.tokens // SHARD_TOKENS + 1
    bounds = {(k * (model.words + 1) // shards) << 32 for k in range(shards)}
    order = sorted(frequent)
    ids = Reader(model).ids(np.array([h for h, _ in order], np.uint64))[0].tolist() if order else []
    for i, n in [*zip(ids, [n for _, n in order], strict=True), (model.words, texts)]:
        if n > SHARD_TOKENS / 4:
            parts = 4 * n // SHARD_TOKENS + 1
            bounds |= {(i << 32) + k * (model.words + 1) // parts for k in range(parts)} | {(i + 1) << 32}
            model.hot[i] = (0, 0, 0, 0)
    model.bounds = sorted(b for b in bounds if b < (model.words + 1) << 32)


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many counts are 1, 2, 3 and 4."""
    if not n[0] or not n[1]:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    out = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else (k + 1) / 2 for k in range(3)]
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(out))


def _spectrum(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def _count_pairs(train: DataFrame, model: Model) -> None:
    model_now = Model(**vars(model))
    cont_shards = model.words // SHARD_WORDS + 1
    model.cont = [k * model.words // cont_shards for k in range(cont_shards)]
    cont, folder = np.array(model.cont, np.int64), model.folder
    bounds, hot = np.array(model.bounds, np.uint64), set(model.hot)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model_now)
        for _, texts in _batches(batches):
            context, word, _, _ = _pair_keys(reader, texts)
            keys, counts = np.unique(context.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64), return_counts=True)
            rows = [(k, _planes(np.diff(keys[lo:hi], prepend=bounds[k])), _planes(counts[lo:hi].astype("<u4")))
                    for k, lo, hi in _ranges(keys, bounds)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["shard", "keys", "counts"])

    def store(table: pa.Table) -> pa.Table:
        k = table.column("shard")[0].as_py()
        keys = np.concatenate([np.cumsum(_unplanes(x.as_py(), "<u8"), dtype=np.uint64) + bounds[k] for x in table.column("keys")])
        counts = np.concatenate([_unplanes(x.as_py(), "<u4") for x in table.column("counts")]).astype(np.int64)
        keys, counts = _counted(keys, counts)
        save(folder, f"bi-{k}.keys", keys.astype("<u8"))
        save(folder, f"bi-{k}.counts", counts.astype("<u4"))
        first = int(bounds[k]) >> 32
        context = (keys >> np.uint64(32)).astype(np.int64) - first
        end = (int(bounds[k + 1]) >> 32) if k + 1 < len(bounds) else model_now.words + 1
        totals = np.zeros(1 if first in hot else end - first, CONTEXT)
        totals["c"] = np.bincount(context, counts, len(totals)).astype(np.int64)
        for name, which in (("n1", counts == 1), ("n2", counts == 2), ("n3", counts > 2)):
            totals[name] = np.bincount(context[which], minlength=len(totals))
        if first not in hot:
            save(folder, f"ctx-{k}", totals)
        words, before = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        out = [{"part": p, "shard": None, "words": _planes(np.diff(words[lo:hi], prepend=cont[p]).astype("<u4")),
                "before": _planes(before[lo:hi].astype("<u4"))} for p, lo, hi in _ranges(words, cont)]
        out.append({"shard": k, "hot": first if first in hot else None, "pairs": len(keys), "n": _spectrum(counts),
                    "totals": [int(x) for x in totals[0]] if first in hot else None})
        return pa.Table.from_pylist(out, schema=SENT)

    sent = train.mapInArrow(send, "shard int, keys binary, counts binary").groupBy("shard").applyInArrow(
        store, "part int, words binary, before binary, shard int, hot long, pairs long, n array<long>, totals array<long>")
    sent = written(sent, "lm-pairs")
    spectrum = [0] * 4
    for r in sent.filter("shard IS NOT NULL").select("shard", "hot", "pairs", "n", "totals").collect():   # a row for each shard
        model.stored.append(r["shard"])
        model.contexts += r["pairs"]
        spectrum = [a + b for a, b in zip(spectrum, r["n"], strict=True)]
        if r["hot"] is not None:
            model.hot[r["hot"]] = tuple(a + b for a, b in zip(model.hot[r["hot"]], r["totals"], strict=True))
    model.pair_discount = _discounts(spectrum)

    def add_up(table: pa.Table) -> pa.Table:
        p = table.column("part")[0].as_py()
        end = int(cont[p + 1]) if p + 1 < len(cont) else model_now.words
        total = np.zeros(end - int(cont[p]), np.int64)
        for words, before in zip(table.column("words"), table.column("before"), strict=True):
            total[np.cumsum(_unplanes(words.as_py(), "<u4"), dtype=np.int64)] += _unplanes(before.as_py(), "<u4")
        save(folder, f"cont-{p}", total.astype("<u4"))
        return pa.table({"n": pa.array([_spectrum(total)], pa.list_(pa.int64())), "types": pa.array([int((total > 0).sum())], pa.int64())})

    parts = sent.filter("part IS NOT NULL").select("part", "words", "before")
    found = parts.groupBy("part").applyInArrow(add_up, "n array<long>, types long").collect()                # a row for each part
    spectrum = [sum(r["n"][k] for r in found) for k in range(4)]
    d = model.word_discount = _discounts(spectrum)
    types = sum(r["types"] for r in found)
    if model.contexts:
        model.rest = (d[0] * spectrum[0] + d[1] * spectrum[1] + d[2] * (types - spectrum[0] - spectrum[1])) / model.contexts


SENT = pa.schema([("part", pa.int32()), ("words", pa.binary()), ("before", pa.binary()), ("shard", pa.int32()), ("hot", pa.int64()),
                  ("pairs", pa.int64()), ("n", pa.list_(pa.int64())), ("totals", pa.list_(pa.int64()))])


def train(docs: DataFrame) -> Model:
    """Counts the texts of docs (doc_id, text) into a model in the shared folder."""
    model = Model(scratch_path(docs.sparkSession, "lm"))
    rows = docs.selectExpr("cast(doc_id AS long) doc_id", "text")
    frequent = _count_words(rows, model)
    if model.tokens:
        _bounds(model, frequent, rows.count())
        _count_pairs(rows, model)
    return model


# scoring -------------------------------------------------------------------

def _discount(counts: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def score_texts(reader: Reader, texts: list[str | None]) -> Iterator[tuple[int, int, float, float]]:
    """(tokens, known tokens, base score, model score) of each text."""
    m = reader.m
    context, word, count, starts = _pair_keys(reader, texts)
    known = word >= 0
    base = np.log10((count + 1) / (m.tokens + m.words + 1))
    p = np.full(len(word), m.rest / (m.words + 1))
    if m.contexts:
        ids, back = np.unique(word[known], return_inverse=True)
        before = reader.before(ids)
        p[known] += ((before - _discount(before, m.word_discount)) / m.contexts)[back]
        seen = np.flatnonzero(context >= 0)
        ids, back = np.unique(context[seen], return_inverse=True)
        totals = reader.context(ids)
        weight = m.pair_discount[0] * totals["n1"] + m.pair_discount[1] * totals["n2"] + m.pair_discount[2] * totals["n3"]
        total = totals["c"].astype(np.float64)
        used = total[back] > 0
        seen, back = seen[used], back[used]
        p[seen] *= weight[back] / total[back]
        both = known[seen]
        seen, back = seen[both], back[both]
        keys, again = np.unique(context[seen].astype(np.uint64) << np.uint64(32) | word[seen].astype(np.uint64), return_inverse=True)
        c = reader.pairs(keys)[again]
        p[seen] += np.where(c > 0, c - _discount(c, m.pair_discount), 0.0) / total[back]
    p = np.log10(p)
    if len(texts):
        at = starts[:-1]
        yield from zip(np.diff(starts).tolist(), np.add.reduceat(known.astype(np.int64), at).tolist(),
                       np.add.reduceat(base, at).tolist(), np.add.reduceat(p, at).tolist(), strict=True)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the text), perplexity."""
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for ids, texts in _batches(batches):
            cols = zip(*score_texts(reader, texts), strict=True)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names)

    rows = docs.selectExpr("cast(doc_id AS long) doc_id", "text")
    out = rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumns({"train_tokens": F.lit(model.tokens).cast("long"),
                            "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))})
