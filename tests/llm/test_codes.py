"""Vector codes against a brute-force nearest entry and plain rounds."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.llm import codes
from tidings.llm.queries import QUERIES


def plain(rows):
    """(code, error) per row and the books, by all distances; rows: (vec_id, list of floats), kept ones."""
    x = np.array([[int(np.floor(1024 * np.float64(np.float32(v)))) for v in r[1]] for r in sorted(rows, key=lambda r: r[0])], dtype=object)
    step = x.shape[1] // 4
    out, books = [], []
    for p in range(4):
        part = x[:, p * step:(p + 1) * step].astype(np.int64)
        book = part[:256].copy()

        def nearest(part=part):
            far = ((part[:, None] - book[None]) ** 2).sum(2)  # noqa: B023
            return far.argmin(1), far.min(1)

        for _ in range(4):
            near, _ = nearest()
            for e in set(near.tolist()):
                own = part[near == e]
                book[e] = [int(s) // len(own) for s in own.sum(0)]
        out.append(nearest())
        books.append(book)
    return [("".join(f"{out[p][0][k]:02x}" for p in range(4)), sum(int(out[p][1][k]) for p in range(4))) for k in range(len(x))], books


@pytest.mark.parametrize(("seed", "spread"), [(1, 3), (2, 40), (3, 2000)])
def test_slices_find_the_nearest_entry(seed, spread):
    rng = np.random.default_rng(seed)
    book = rng.integers(-spread, spread, (int(rng.integers(1, 257)), 5))
    book[len(book) // 2:] = book[:len(book) - len(book) // 2]          # equal entries: the lower index wins
    x = np.concatenate((rng.integers(-2 * spread, 2 * spread, (500, 5)), book))
    far = ((x[:, None] - book[None]) ** 2).sum(2)
    entry, best = codes.Slices(book).nearest(x)
    assert (entry == far.argmin(1)).all() and (best == far.min(1)).all()


def test_candidates_are_the_entries_in_all_slices():
    rng = np.random.default_rng(9)
    book, x = rng.integers(-50, 50, (200, 3)), rng.integers(-50, 50, (100, 3))
    within = rng.integers(0, 900, 100)
    got = codes.Slices(book).candidates(x, within)
    r = np.ceil(np.sqrt(within)).astype(int) + 1
    assert (got == (np.abs(x[:, None] - book[None]) <= r[:, None, None]).all(2)).all()
    assert got.mean() < 0.5


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(size=8)], int(rng.integers(3)) if i % 5 else None) for i in rng.permutation(700)]
    rows += [(9000 + k, rows[0][1], 1) for k in range(300)]           # one vector holds a third of the rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    coded, books = codes.compress(df)
    want, own = plain([(r[0], r[1]) for r in rows])
    got = {r.vec_id: (r.codes.hex(), r.error) for r in coded.collect()}
    assert [got[k] for k in sorted(got)] == want and all((a == b).all() for a, b in zip(books, own, strict=True))
    assert codes.digest(books) == hashlib.sha256(",".join(str(v) for b in own for v in b.reshape(-1)).encode()).hexdigest()
    one = coded.orderBy("vec_id").first()
    back = codes.decode(np.frombuffer(one.codes, np.uint8)[None], books)[0]
    x = np.floor(1024 * np.array(next(r[1] for r in rows if r[0] == one.vec_id)))
    assert ((back - x) ** 2).sum() == one.error


def test_small_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -0.001, 1.0, 2.0], 7, 1), (1, [0.5, 0.25, -0.001, 1.0, 2.0], None, 1), (None, [0.0] * 5, None, 1), (2, None, 7, 1),
            (3, [], 7, 1), (4, [nan, 0.0, 0.0, 0.0, 0.0], 7, 1), (5, [inf, 0.0, 0.0, 0.0, 0.0], 7, 1), (6, [None, 0.0, 0.0, 0.0, 0.0], 7, 1),
            (7, [1.0, 2.0], 7, 1), (8, [3e38] * 5, 7, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, codes int")
    coded, books = codes.compress(df)
    assert [b.shape for b in books] == [(4, 2), (4, 1), (4, 1), (4, 1)]
    # the first of two equal entries takes their rows, the other stays
    got = sorted(((r.vec_id or 0), r.codes.hex(), r.error) for r in coded.collect())
    assert got == [(0, "03030303", 0), (1, "00000000", 0), (1, "00000000", 0), (8, "02020202", 0)]
    assert coded.filter(F.col("vec_id") == 8).count() == 1
    none, books = codes.compress(df.limit(0))
    assert none.count() == 0 and books == [] and none.columns == coded.columns


def test_fewer_dimensions_than_parts(spark):
    df = spark.createDataFrame([(k, [float(k)], 0) for k in range(300)], "vec_id long, embedding array<double>, label int")
    coded, books = codes.compress(df)
    assert coded.count() == 300 and books[0].shape == (256, 1) and books[3].shape == (256, 0)


def test_query_sums_errors_by_label(spark):
    sf = "/root/testdata/sf0.001"
    labels = {r.vec_id: r.label for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label").collect()}
    rows = QUERIES["op11_vector_codes"](spark, sf).collect()
    assert len(rows) == len(labels) and len({r.codebooks_sha256 for r in rows}) == 1
    for r in rows:
        assert r.label_error == sum(o.error for o in rows if labels[o.vec_id] == labels[r.vec_id])
