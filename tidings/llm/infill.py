"""Fill-in-middle transformation with a sparse exception index.

Every whole text is cut into tokens ``[A-Za-z]+|[^A-Za-z]`` and, by hashes of
its id, into prefix, middle and suffix at two token borders. The pieces are
marked with sentinels and put in prefix-suffix-middle or suffix-prefix-middle
order; some texts stay plain.

Cuts are found in the UTF-8 bytes of an Arrow batch, where a character of one
byte needs no record. ``Exceptions`` holds only the characters of two bytes or
more: their byte positions and the excess bytes up to each. A binary search in
it turns byte cuts into code-point cuts and back; between two exceptions the
two differ by a constant, so ASCII spans are plain arithmetic.

Defined cases: a null text counts as empty, an empty text is plain; a text
that holds a sentinel is plain; a null id is hashed as the text ''; rows with
one doc_id are cut alike where their texts are; an empty table gives no rows; further columns
are not read. One text is one Arrow value, so its size is bounded by 2 GB.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the sentinels
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINEL = re.compile(b"<[PSM]>")
RATE = 90        # of 100 texts, those that are cut
SPM = 20         # of 100 texts that are cut, those with the suffix first
SEED = "1"

SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, "
          "output string")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Exceptions:
    """The characters of several bytes in a UTF-8 buffer."""

    def __init__(self, buf: np.ndarray) -> None:
        self.bytes = np.flatnonzero(buf >= 0xC0)
        lead = buf[self.bytes]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(excess)))       # excess[k]: bytes beyond one, of the first k
        self.points = self.bytes - self.excess[:-1]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code-point positions of byte positions (starts of characters)."""
        return at - self.excess[np.searchsorted(self.bytes, at)]

    def to_bytes(self, at: np.ndarray) -> np.ndarray:
        """Byte positions of code-point positions."""
        return at + self.excess[np.searchsorted(self.points, at)]


def token_starts(buf: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Byte positions at which a token begins; a token never spans two texts."""
    letter = _LETTER[buf]
    starts = (buf & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[firsts[firsts < len(buf)]] = True
    return np.flatnonzero(starts)


def _cut(b: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    text = b.column("_text").cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    whole = memoryview(data)[ends[0]:ends[-1]] if data is not None else memoryview(b"")
    buf = np.frombuffer(whole, np.uint8)
    lo, hi = ends[:-1] - ends[0], ends[1:] - ends[0]

    starts = token_starts(buf, lo)
    first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    n = last - first
    h = [b.column(f"_h{k}").to_numpy() for k in (1, 2, 3, 4)]
    cuts = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), axis=0)
    # a cut of k tokens is where token k begins, or the end of the text
    at = np.where(cuts < n, np.append(starts, len(buf))[np.minimum(first + cuts, last)], hi)

    known = Exceptions(buf)
    zero, one, two = (known.to_points(x) for x in (lo, at[0], at[1]))
    marked = np.zeros(len(n), dtype=bool)
    for m in SENTINEL.finditer(whole):
        k = int(np.searchsorted(hi, m.start(), side="right"))
        marked[k] |= m.end() <= hi[k]
    plain = (hi == lo) | marked | (h[2] % 100 >= rate)
    turned = h[3] % 100 < spm

    out = []
    for a, x, y, z, p, s in zip(lo.tolist(), at[0].tolist(), at[1].tolist(), hi.tolist(), plain.tolist(), turned.tolist(), strict=True):
        if p:
            out.append(whole[a:z])
        elif s:
            out.append(b"".join((SUFFIX, whole[y:z], PREFIX, whole[a:x], MIDDLE, whole[x:y])))
        else:
            out.append(b"".join((PREFIX, whole[a:x], SUFFIX, whole[y:z], MIDDLE, whole[x:y])))
    form = np.where(plain, "plain", np.where(turned, "spm", "psm"))
    numbers = [pa.array(v, pa.int64(), mask=plain) for v in (one - zero, two - one, at[0] - lo, at[1] - at[0])]
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *numbers,
         pa.array(out, pa.binary()).cast(pa.string())],
        [x.split()[0] for x in SCHEMA.split(", ")])


def infill(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Per row of docs: doc_id, n (tokens), form (plain, psm, spm), the lengths of prefix and middle in characters
    and bytes (null if plain), and the text as it is laid out (output)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"_h{k + 1}") for k in range(4)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"), *draws)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _cut(b, rate, spm)

    return rows.mapInArrow(cut, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``infill`` laid out. No sentinel can arise between pieces: each begins with a character that
    it holds nowhere else and ends with another."""
    piece = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(piece[1], piece[3], piece[2]))
            .when(form == "spm", F.concat(piece[2], piece[3], piece[1])).otherwise(output))
