"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns, for every operator of the package."""

import pytest

from tidings.llm import chat, decontaminate, files, jaccard, kneser_ney, linededup, mixing, packing, quality, rules, secrets
from tidings.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, size long, taken long, place long, words string, key string, failed string"
EXTRA = (1, 2, 3, "x", "y", "z")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def rows(*docs):
    return [(d[0], d[1], "en", d[2] if len(d) > 2 else "s", *EXTRA[:3], *EXTRA[3:]) for d in docs]


DOCS = rows((1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven eight nine ten eleven"),
            (5, "one two three four five six seven eight nine ten eleven"), (4, "one two three four five six seven eight nine ten eleven"),
            (6, LONG, None), (None, "some words without an id", None), (7, "é\U0001f600 ß", "é"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1), (6, 1), (None, 0), (7, None)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "eight nine ten eleven"), (2, None), (3, ""), (4, "ONE two, three four five"), (4, "nothing")], "item_id long, text string")


def test_secrets(docs, none):
    got = secrets.scan(docs).collect()
    assert len(got) == len(DOCS) and all(r.spans is not None for r in got)
    assert secrets.scan(none).count() == 0


def test_quality(spark, docs, none, labels):
    score = quality.fit(docs, labels)
    got = quality.scored(docs, score).collect()
    assert len(got) == len(DOCS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.accepted(docs, score).columns == docs.columns
    one_class = quality.fit(docs, labels.filter("quality = 1"))
    assert {r.score for r in quality.scored(docs, one_class).collect()} == {5 / 6}     # four rows of label 1
    assert quality.scored(none, quality.fit(none, labels.limit(0))).count() == 0


def test_jaccard(docs, none):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_classes(docs).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 9, 4), (5, 9, 4), (7, 1, 7), (None, 3, None)} <= got
    assert jaccard.join_classes(docs).count() == len(DOCS)
    kept = sorted((r.doc_id or 0) for r in jaccard.deduplicated(docs).collect())
    assert kept == [0, 1, 2, 3, 4, 6, 7] and jaccard.deduplicated(docs).columns == docs.columns
    assert jaccard.deduplicated(none).count() == 0
    assert jaccard.join_classes(none).count() == 0


def test_rules(docs, none):
    book = {r.doc_id: r for r in rules.ledger(docs).collect()}
    assert (book[1].n_words, book[1].failed) == (0, 1) and book[6].n_words == 60_000
    assert book[7].word_chars == 3 and book[4].failed == 0
    assert rules.ledger(none).count() == 0


def test_packing(docs, none):
    back = {}
    for r in sorted(packing.unpacked(packing.pack(docs, seq_len=128)).collect(), key=lambda r: (r.doc_id or 0, r.offset)):
        back.setdefault(r.doc_id, []).append((r.offset, len(r.ids)))
    assert set(back) == {3, 4, 5, 6, 7, None}                       # white space has tokens too
    assert [o for o, _ in back[4]] == [0, 0]                       # a repeated row is another segment
    assert all(o == 128 * k for k, (o, _) in enumerate(back[6]))   # an overlong one is cut, nothing lost
    assert packing.pack(none).count() == 0


def test_matrices_keep_ids_and_missing_ids(spark, docs, none):
    path = scratch_path(spark, "small-matrices")
    packed = packing.pack(docs, seq_len=128).drop("row_id")
    back = packing.read_matrices(packing.write_matrices(packed, path, rows=50), path).drop("row_id")
    assert sorted(map(str, back.collect())) == sorted(map(str, packed.collect())) and back.columns == packed.columns
    assert packing.read_matrices(packing.write_matrices(packing.pack(none), path + "-none"), path + "-none").count() == 0


def test_ids_that_do_not_fit_are_an_error(spark, docs, monkeypatch):
    monkeypatch.setattr(packing.encoder(packing.TOKENIZER), "largest", 70_000)
    with pytest.raises(ValueError, match="2 bytes"):
        next(packing._pack_batches(iter([]), packing.SEQ_LEN, packing.TOKENIZER, 2, 0, packing.WINDOW_TOKENS))


def test_paths_without_a_scheme_lie_in_the_default_file_system(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    old = hadoop.get("fs.defaultFS")
    try:
        hadoop.set("fs.defaultFS", "viewfs://cluster/")
        hadoop.set("fs.viewfs.mounttable.cluster.link./x", "file:///tmp")
        assert files.qualified(spark, "/x/y") == "viewfs://cluster/x/y"
        assert files._local(files.qualified(spark, "/x/y")) is None
    finally:
        hadoop.set("fs.defaultFS", old or "file:///")
    assert files._local(files.qualified(spark, "/x/y")) == "/x/y"


def test_kneser_ney(docs, none):
    model = kneser_ney.train(docs)
    got = kneser_ney.score(docs, model).collect()
    assert len(got) == len(DOCS) and all(r.score <= 0 for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    empty = kneser_ney.train(none)
    assert all(r.score == r.base_score == 0 and r.n_known == 0 for r in kneser_ney.score(docs, empty).collect())
    assert kneser_ney.score(none, empty).count() == 0


def test_mixing(docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(DOCS) and all(0 <= r.taken <= 3 * r.size for r in got)
    assert {r.source for r in got} == {"s", "é", None}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.filter("text IS NULL OR text = ''").count() == 0
    assert mixing.mix(none).count() == 0
    assert mixing.mix(docs.filter("doc_id < 4")).agg({"target": "sum"}).first()[0] == 0


def test_chat(spark):
    turns = spark.createDataFrame([(1, 1, "user", None, 5), (1, 2, None, "<\\|im_end|>", 5), (1, 2, "assistant", "", 5),
                                   (None, 0, "assistant", "a\n<|im_start|>", 5), (None, None, "a\nb\\", "<|<|", 5)],
                                  "conv_id long, turn long, role string, text string, n_turns long")
    got = {r.conv_id: chat.parse_chatml(r.formatted) for r in chat.format_chats(turns).collect()}
    assert got == {1: [("user", ""), ("", "<\\|im_end|>"), ("assistant", "")],
                   None: [("a\nb\\", "<|<|"), ("assistant", "a\n<|im_start|>")]}
    assert chat.digests(chat.format_chats(turns.limit(0))).count() == 0


def test_decontaminate(docs, none, bench):
    got = {(r.doc_id, tuple(r.item_ids)) for r in decontaminate.matches(docs, bench).collect()}
    assert {(4, (1, 4)), (5, (1, 4)), (1, ()), (2, ()), (None, ())} <= got
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.filter("doc_id IN (4, 5)").count() == 0 and kept.count() == len(DOCS) - 3
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(DOCS)
    assert decontaminate.matches(none, bench).count() == 0


def test_linededup(docs, none):
    got = sorted(((r.doc_id or 0, r.n_lines, r.n_equal) for r in linededup.report(docs).collect()))
    assert got == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 0), (4, 2, 0), (5, 1, 1), (6, 1, 0), (7, 1, 0)]
    assert linededup.deduplicated(docs).columns == docs.columns and linededup.deduplicated(docs).count() == len(DOCS)
    assert linededup.report(none).count() == 0


def test_jaccard_decides_row_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    docs = spark.createDataFrame([(1, a, 7), (2, a, 7), (2, b, 7), (3, c, 7), (3, d, 7), (3, d, 7), (4, d + " more", 7), (None, c, 7), (None, c, 7), (5, "", 7), (5, None, 7)],
                                 "doc_id long, text string, _alone int")
    kept = sorted((r.doc_id or 0, r.text or "") for r in jaccard.deduplicated(docs).collect())
    assert kept == sorted([(1, a), (2, b), (3, c), (3, d), (0, c), (0, c), (5, "")])
    assert jaccard.deduplicated(docs).columns == docs.columns and {r._alone for r in jaccard.deduplicated(docs).collect()} == {7}
    got = sorted((r.doc_id or 0, r.component_id or 0, r.n_shingles) for r in jaccard.join_classes(docs).collect())
    assert got == [(0, 0, 28), (0, 0, 28), (1, 1, 28), (2, 1, 28), (2, 2, 28), (3, 3, 28), (3, 3, 28), (3, 3, 28), (4, 3, 29), (5, 5, 0), (5, 5, 0)]


def test_lines_of_rows_with_one_id_are_judged_by_their_texts(spark):
    docs = spark.createDataFrame([(1, "a copied line\nfirst own line", 5), (2, "second own line\na copied line", 5), (2, "third own line\nfourth own line", 5),
                                  (2, "third own line\nfourth own line", 5)], "doc_id long, text string, _id int")
    got = linededup.deduplicated(docs)
    assert got.columns == ["doc_id", "text", "_id"]
    assert sorted((r.doc_id, r.text, r._id) for r in got.collect()) == sorted([
        (1, "a copied line\nfirst own line", 5), (2, "second own line", 5), (2, "third own line\nfourth own line", 5), (2, "third own line\nfourth own line", 5)])


def test_written_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    from tidings.llm.common import written

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        return {x for x in blocks.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}

    before, name = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    back = written(counts, "no-shuffle-files")
    assert not shuffles() - before and back.count() == 7 and counts.count() == 7
    assert spark.conf.get(name) == setting


def test_packed_rows_pass_in_small_batches(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} " * 300) for i in range(60)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(packing, "PIECE_ROWS", 3)
    monkeypatch.setattr(packing, "BATCH_BYTES", 1 << 14)
    packed = packing.pack(docs, 512).cache()
    at = f"{tmp_path}/m"
    back = packing.read_matrices(packing.write_matrices(packed, at, rows=20), at)
    plain = lambda df: sorted(tuple(bytes(x) if isinstance(x, bytearray) else str(x) for x in r) for r in df.drop("row_id").collect())
    assert plain(back) == plain(packed) and packed.count() > 40
    with open(f"{at}/part-00000-00000.ids", "rb") as f:
        assert packing.load_bytes(at, "part-00000-00000.ids", (1, 2, 20)) == f.read()[1024:2048]
