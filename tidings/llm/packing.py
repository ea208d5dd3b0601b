"""Token-ID / binary output: tokenize, then pack by best-fit decreasing.

Each task streams its documents through the tokenizer and packs them in
windows of about ``WINDOW_TOKENS`` tokens: pieces in order of falling length,
each into the open row with the least room that still holds it, found in a
segment tree over capacities. Documents longer than a row are cut into pieces
of a full row and a rest; every piece keeps its document and its offset in it,
so the ids of every document can be put together again. No shuffle is needed,
a task holds one window, and a task that runs again gives the same rows.

A row of the result (``write_matrices`` writes them as binary files): ``ids`` (little-endian uint16, or uint32 for larger
vocabularies; ``seq_len`` of them, padded at the end), ``cu_seqlens``
(cumulative segment lengths, from 0), ``positions`` (as ``ids``; they start
again at 0 in every segment and in the padding), ``doc_ids`` and ``offsets`` of the segments.

Defined cases: null and empty texts have no tokens and no segment; a null
doc_id stays null; rows with one doc_id are separate segments at the same
offsets; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import settings, written
from .files import appended, load, load_bytes, qualified

SEQ_LEN = 2048
WINDOW_TOKENS = 1_000_000
CACHE_WORDS = 200_000
PIECE_ROWS = 512         # rows written or read at once
BATCH_BYTES = 4 << 20    # of packed rows between the executor and Python
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pattern that the public byte-level vocabulary splits text by
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = ("row_id string, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, "
          "doc_ids array<long>, offsets array<long>")
ARROW = pa.schema([("row_id", pa.string()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary()),
                   ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64()))])

_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> token ids, for a rank file of byte-level BPE. One for each worker process.

    A blank between two solid characters always begins a token, so such words
    are encoded apart from each other. The words of a text that are not known
    yet are encoded in one call and told apart by the tokens that begin with a
    blank. Words are kept in two generations, the older one dropped when the
    newer is full. A text with other white space than single
    blanks and line ends between words is encoded whole. The ids are the same.
    """
    if path in _ENCODERS:
        return _ENCODERS[path]
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    begins = np.zeros(max(ranks.values()) + 1, dtype=bool)
    begins[[r for t, r in ranks.items() if t[:1] == b" "]] = True
    known: dict[str, bytes] = {}       # of a word: the ids of a blank and the word
    older: dict[str, bytes] = {}
    loose = re.compile(r"\s\s|^\s|\s$")

    def raw(text: str) -> np.ndarray:
        return np.array(bpe.encode_ordinary(text), dtype=np.uint32)

    def learn(words: list[str]) -> None:
        new = []
        for w in words:
            ids = older.get(w)
            if ids is None:
                new.append(w)
            else:
                known[w] = ids
        if new:
            ids = raw(" " + " ".join(new))
            cuts = np.append(np.flatnonzero(begins[ids]), len(ids)).tolist()
            data = memoryview(ids.tobytes())
            for w, lo, hi in zip(new, cuts[:-1], cuts[1:], strict=True):
                known[w] = bytes(data[4 * lo:4 * hi])

    def encode(text: str) -> np.ndarray:
        nonlocal known, older
        first, blank, rest = text.partition(" ")
        if not blank or loose.search(text):
            return raw(text)
        words = rest.split(" ")
        missing = [w for w in set(words) if w not in known]
        if missing:
            learn(missing)
        ids = np.frombuffer(raw(first).tobytes() + b"".join(map(known.__getitem__, words)), dtype=np.uint32)
        if len(known) > CACHE_WORDS:
            known, older = {}, known
        return ids

    encode.largest = max(ranks.values())
    _ENCODERS[path] = encode
    return encode


class Rooms:
    """Segment tree over capacities 0..size: the least one >= n that some row has."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def least(self, n: int) -> int | None:
        node = self.leaves + n
        if self.count[node]:
            return n
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.count[2 * node])
                return node - self.leaves
            node >>= 1
        return None


def best_fit(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Rows of piece numbers, packed by best-fit decreasing."""
    rooms, by_room, rows = Rooms(seq_len), {}, []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = rooms.least(lengths[k])
        if room is None:
            row, room = len(rows), seq_len
            rows.append([])
        else:
            row = by_room[room].pop()
            rooms.add(room, -1)
        rows[row].append(k)
        left = room - lengths[k]
        if left:
            by_room.setdefault(left, []).append(row)
            rooms.add(left, 1)
    return rows


def _rows(pieces: list[tuple], seq_len: int, kind: type, pad: int, prefix: str) -> pa.RecordBatch:
    out = []
    for n, row in enumerate(best_fit([len(p[2]) for p in pieces], seq_len)):
        parts = [pieces[k] for k in row]
        sizes = [len(p[2]) for p in parts]
        total = sum(sizes)
        ids = np.full(seq_len, pad, dtype=kind)
        ids[:total] = np.concatenate([p[2] for p in parts])
        places = np.concatenate([np.arange(k, dtype=kind) for k in (*sizes, seq_len - total)])
        out.append({"row_id": f"{prefix}-{n}", "n_tokens": total, "ids": ids.tobytes(), "positions": places.tobytes(),
                    "cu_seqlens": [0, *np.cumsum(sizes).tolist()],
                    "doc_ids": [p[0] for p in parts], "offsets": [p[1] for p in parts]})
    return pa.RecordBatch.from_pylist(out, schema=ARROW)


def _pack_batches(batches: Iterator[pa.RecordBatch], seq_len: int, tokenizer: str, id_bytes: int, pad: int,
                  window_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encode, pieces, held, window, kind = encoder(tokenizer), [], 0, 0, f"<u{id_bytes}"
    if encode.largest >= 1 << 8 * id_bytes:
        raise ValueError(f"ids up to {encode.largest} do not fit into {id_bytes} bytes")
    part = TaskContext.get().partitionId()
    for b in batches:
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            ids = encode(text or "").astype(kind)
            for at in range(0, len(ids), seq_len):
                piece = ids[at:at + seq_len]
                pieces.append((doc, at, piece))
                held += len(piece)
                if held >= window_tokens:
                    yield _rows(pieces, seq_len, kind, pad, f"{part}-{window}")
                    pieces, held, window = [], 0, window + 1
    if pieces:
        yield _rows(pieces, seq_len, kind, pad, f"{part}-{window}")


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, tokenizer: str = TOKENIZER, id_bytes: int = 2, pad: int = 0,
         window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """Packed rows of token ids of all documents. A vocabulary that does not fit into ``id_bytes`` (2 or 4) is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_batches(batches, seq_len, tokenizer, id_bytes, pad, window_tokens)

    return docs.selectExpr("cast(doc_id AS long) doc_id", "text").mapInArrow(run, SCHEMA)


def unpacked(packed: DataFrame, id_bytes: int = 2) -> DataFrame:
    """(doc_id, offset, ids) of every segment: the way back from packed rows."""
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, offsets, ids = [], [], []
            for r in b.to_pylist():
                row = np.frombuffer(r["ids"], dtype=kind)
                for k, (doc, at) in enumerate(zip(r["doc_ids"], r["offsets"], strict=True)):
                    docs.append(doc)
                    offsets.append(at)
                    ids.append(row[r["cu_seqlens"][k]:r["cu_seqlens"][k + 1]].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(offsets, pa.int64()),
                                              pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "offset", "ids"])

    return packed.mapInArrow(run, "doc_id long, offset long, ids array<int>")


#: the files of a block of rows, and their numbers
FILES = {"cu": "<i4", "segments": "<i8", "docs": "<i8", "known": "u1", "offsets": "<i8"}


def write_matrices(packed: DataFrame, path: str, rows: int = 8192) -> DataFrame:
    """Writes the rows as raw binary files of the shared folder ``path``, up to
    ``rows`` rows in each: ``<name>.ids`` and ``<name>.positions`` (matrices of
    rows x seq_len), ``<name>.cu`` (int32: the cumulative segment lengths of all
    rows, one after another), ``<name>.segments`` (int64: how many each row
    has), ``<name>.docs``, ``<name>.known`` and ``<name>.offsets`` (int64, uint8, int64: the
    document of each segment, whether it has an id, and the offset). Gives one row for each name (name, n_rows);
    names follow partition and place, so a task that runs again replaces its own files. A task holds ``PIECE_ROWS`` rows
    and a batch, not a block."""
    path = qualified(packed.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def pieces() -> Iterator[tuple[int, pa.RecordBatch]]:
            n = 0
            for b in batches:
                while b.num_rows:
                    piece = b.slice(0, min(PIECE_ROWS, rows - n % rows))
                    yield n // rows, piece
                    n, b = n + piece.num_rows, b.slice(piece.num_rows)

        for k, block in groupby(pieces(), key=lambda p: p[0]):
            name, n = f"part-{TaskContext.get().partitionId():05d}-{k:05d}", 0
            with ExitStack() as files:
                put = {of: files.enter_context(appended(path, f"{name}.{of}")) for of in ("ids", "positions", *FILES)}
                for _, piece in block:
                    n += piece.num_rows
                    for of in ("ids", "positions"):
                        put[of](b"".join(piece.column(of).to_pylist()))
                    docs = piece.column("doc_ids")
                    parts = {"cu": piece.column("cu_seqlens").flatten(), "segments": docs.value_lengths(),
                             "docs": docs.flatten().fill_null(0), "known": docs.flatten().is_valid().cast(pa.uint8()),
                             "offsets": piece.column("offsets").flatten()}
                    for of, kind in FILES.items():
                        put[of](np.asarray(parts[of].to_numpy(zero_copy_only=False), kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["name", "n_rows"])

    # packed rows are wide: by their number alone, a task would hold a batch of 10000 in the executor and in Python
    with settings(packed.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        return written(packed.mapInArrow(run, "name string, n_rows long"), "packed-files")


def read_matrices(files: DataFrame, path: str, tasks: int = 4096) -> DataFrame:
    """The packed rows that ``write_matrices`` wrote (its result and path), one file or more in each of up to ``tasks`` tasks."""
    path = qualified(files.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, n in zip(b.column("name").to_pylist(), b.column("n_rows").to_pylist(), strict=True):
                cu, segments, docs, known, offsets = (load(path, f"{name}.{of}", kind) for of, kind in FILES.items())
                edge = np.concatenate(([0], np.cumsum(segments)))
                ends = np.cumsum(segments + 1)
                lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values) for at, values in (
                    (np.concatenate(([0], ends)), pa.array(cu)), (edge, pa.array(docs, mask=known == 0)), (edge, pa.array(offsets)))]
                row_ids, totals = pa.array([f"{name}-{k}" for k in range(n)]), pa.array(cu[ends - 1].astype(np.int32))
                for lo in range(0, n, PIECE_ROWS):
                    size, raw = min(PIECE_ROWS, n - lo), []
                    for of in ("ids", "positions"):
                        data = load_bytes(path, f"{name}.{of}", (lo, lo + size, n))
                        at = np.linspace(0, len(data), size + 1).astype(np.int32)
                        raw.append(pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)]))
                    yield pa.RecordBatch.from_arrays([row_ids.slice(lo, size), totals.slice(lo, size), *raw,
                                                      *(x.slice(lo, size) for x in lists)], schema=ARROW)

    count = files.count()
    return files.repartition(max(1, min(count, tasks)), "name").mapInArrow(run, SCHEMA)
