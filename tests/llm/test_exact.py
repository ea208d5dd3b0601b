"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidings.llm import chat, decontaminate, jaccard, kneser_ney, linededup, mixing, packing, rules, secrets
from tidings.llm.files import load, save
from tidings.llm.hashing import word_hashes
from tidings.llm.queries import QUERIES
from tidings.session import scratch_path

SF = "/root/testdata/sf0.001"
TOKENIZER = packing.TOKENIZER


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def words(text):
    return (text or "").encode().lower().split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \t\n\x0b\x1c\x85", max_size=30)), max_size=6))
def test_word_hashes_tell_words_apart(docs):
    hashes, at = word_hashes(docs)
    names = {}
    for k, d in enumerate(docs):
        own = words(d)
        assert at[k + 1] - at[k] == len(own)
        for w, h in zip(own, hashes[at[k]:at[k + 1]].tolist(), strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"word{k}" for k in range(500)) + " " + "x" * 300
    whole = word_hashes([text, None, text])
    monkeypatch.setattr("tidings.llm.hashing.SEGMENT", 64)
    parts = word_hashes([text, None, text])
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


# 1 -------------------------------------------------------------------------

def test_secret_scan_matches_the_patterns(spark, texts):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in QUERIES["op1_secret_scan"](spark, SF).collect():
        t, spans = texts[r.doc_id], []
        spans += [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


@pytest.mark.parametrize(("text", "found"), [
    ('db_pwd = "hJ8kQz2mPx91"', ["hJ8kQz2mPx91"]),
    ("client_secret => 'Zx81kQpL0aa'", ["Zx81kQpL0aa"]),
    ('part = "hJ8kQz2m"\nDB_PASSPHRASE = part + "Px91vv"', ["hJ8kQz2m", "Px91vv"]),
    ('config["auth_credentials"] = "aB3dE5gH7jK9"', ["aB3dE5gH7jK9"]),
    ("db:\n  pwd: q8Zk2Lm9Xr4T\n", ["q8Zk2Lm9Xr4T"]),
    ('pwd: str = "aB3dE5gH7jK9"', ["aB3dE5gH7jK9"]),
    ('pwd_path = "aB3dE5gH7jK9"', []), ('pwd = "changeme-please1"', []), ("the pwd: worthless words here", []),
    ('pwd == "aB3dE5gH7jK9"', []), ('colour = "aB3dE5gH7jK9"', []), ("pwd = os.environ", []),
])
def test_lexed_assignments(text, found):
    assert [text[a:b] for a, b, kind in secrets.spans_of(text) if kind == "lexed"] == found


def test_adversarial_texts_take_linear_time():
    import time

    doubled = 'token_part = "aB3dE5gH"\n' + "token_part = token_part + token_part\n" * 3000
    chained = 'token_0 = "aB3dE5gH"\n' + "".join(f'token_{k} = token_{k - 1} + "x{k}Q"\n' for k in range(1, 4000))
    many = "".join(f"password = 'aB3dE5gH7jK{k}'\ndb_pwd = 'zY9xW8vU7t{k}'\n" for k in range(8000))
    for text, least in ((doubled, 1), (chained, 4000), (many, 16000), ("a" * 500_000 + "_password = 'aB3dE5gH7jK9'", 1), ('"' * 300_000 + "pwd", 0)):
        start = time.time()
        assert len(secrets.spans_of(text)) >= least and time.time() - start < 8


def test_long_names_and_appended_literals():
    text = "n" * 300 + "_pwd = 'aB3dE5gH7jK9'"
    assert [text[a:b] for a, b, _ in secrets.lexed_spans(text)] == ["aB3dE5gH7jK9"]
    text = "part_pwd = 'aB3'\npart_pwd += 'dE5gH7jK9'"
    assert [text[a:b] for a, b, _ in secrets.lexed_spans(text)] == ["aB3", "dE5gH7jK9"]


# 2 -------------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op2_quality_classifier"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in seen) >= 0.97 * len(seen) and {q for _, q in seen} == {0, 1}


# 3 -------------------------------------------------------------------------

def brute_classes(docs, size=3, num=90, den=100):
    sets = {}
    for d, t in docs.items():
        w = words(t)
        n = min(size, len(w))
        sets[d] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    best = {d: d for d in docs}

    def find(x):
        return x if best[x] == x else find(best[x])

    for a, b in itertools.combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            best[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def near_copies(seed, families=12, most=14):
    rng, docs = random.Random(seed), {}
    vocabulary = [f"v{k}" for k in range(400)]
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 4, 9, 11, 12, 14, 25, 60, 150, 400]))
        for _ in range(rng.randint(1, most)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, max(1, len(own) // 30)])):
                at = rng.randrange(len(own))
                own[at:at + rng.choice([0, 1, 1])] = rng.choices(vocabulary, k=rng.choice([0, 1, 1]))
                own = own or ["x"]
            docs[len(docs)] = rng.choice([" ", "\n"]).join(own)
    return docs


@pytest.mark.parametrize(("seed", "chunk"), [(1, jaccard.CHUNK), (2, jaccard.CHUNK), (3, 300)])
def test_jaccard_classes_equal_all_pairs(spark, seed, chunk):
    docs = near_copies(seed)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_classes(df, chunk=chunk).collect()}
    assert got == brute_classes(docs)


def test_jaccard_on_the_table(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_jaccard_join"](spark, SF).collect()}
    assert got == brute_classes(texts)


def test_sets_that_link_share_a_key():
    sizes, rng = jaccard.Sizes(), np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        gone, new = int(rng.integers(0, n // 9 + 1)), int(rng.integers(0, n // 9 + 1))
        b = np.concatenate((a[gone:], rng.integers(0, 2**64, new, dtype=np.uint64)))
        both = n - gone
        if len(b) and 100 * both >= 90 * (n + len(b) - both) and (gone or new):
            assert set(jaccard.keys_of(np.unique(a), sizes).tolist()) & set(jaccard.keys_of(np.unique(b), sizes).tolist())


def test_sets_that_link_share_a_key_whatever_is_left_out():
    rng = np.random.default_rng(8)
    for sizes, share in ((jaccard.Sizes(), 10), (jaccard.Sizes(80, 100, share=1 / 8), 5)):
        pool = np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64))
        for _ in range(400):
            common = np.sort(rng.choice(pool, int(rng.integers(0, 300)), replace=False))
            a = np.unique(np.concatenate((rng.choice(pool, int(rng.integers(1, 200)), replace=False), rng.integers(0, 2**64, int(rng.integers(0, 200)), dtype=np.uint64))))
            gone = rng.permutation(len(a))[int(rng.integers(0, len(a) // share + 1)):]
            b = np.unique(np.concatenate((a[gone], rng.choice(pool, int(rng.integers(0, len(a) // share + 1)), replace=False))))
            both = len(np.intersect1d(a, b))
            if sizes.den * both >= sizes.num * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert set(jaccard.keys_of(a, sizes, common).tolist()) & set(jaccard.keys_of(b, sizes, common).tolist())


def test_common_shingles_are_those_of_many_documents(spark):
    docs = [(k, " ".join(f"d{k}x{j}" for j in range(20)) + " one license line for all of us here" * (k % 4 == 0)) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    want = np.unique(np.concatenate(jaccard.shingle_sets(["one license line for all of us here"])))
    found = jaccard.common_shingles(df, jaccard.Sizes(), share=0.1)
    assert set(want.tolist()) <= set(found.tolist()) and len(found) == len(want)
    assert len(jaccard.common_shingles(df.limit(0), jaccard.Sizes())) == 0


def test_rtree_reaches_every_point_within_the_bound():
    points = np.random.default_rng(3).integers(0, 9, (300, 32)).astype(np.uint32)
    tree = jaccard.CountTree(points)
    for q in points[:20]:
        sums = np.minimum(points, q).sum(1)
        for need in (60, 90, 110):
            assert sorted(tree.reach(q, need).tolist()) == np.flatnonzero(sums >= need).tolist()


# 4 -------------------------------------------------------------------------

def test_ablations_count_masks(spark):
    book = rules.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    masks = [r.failed for r in book.collect()]
    for r in rules.ablations(book).collect():
        bit = 1 << list(rules.rules()).index(r["rule"])
        assert (r.n_failed, r.n_only, r.n_passed) == (sum(bool(m & bit) for m in masks), masks.count(bit), masks.count(0))


# 5 -------------------------------------------------------------------------

def test_packing_round_trip(spark, texts):
    encode = packing.encoder(TOKENIZER)
    rows = QUERIES["op5_token_packing"](spark, SF)
    back = defaultdict(dict)
    for r in packing.unpacked(rows).collect():
        back[r.doc_id][r.offset] = r.ids
    for d, t in texts.items():
        assert sum((ids for _, ids in sorted(back[d].items())), []) == encode(t).tolist()
    for r in rows.collect():
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == packing.SEQ_LEN and r.cu_seqlens[-1] == r.n_tokens
        assert np.flatnonzero(places == 0).tolist() == [c for c in r.cu_seqlens if c < packing.SEQ_LEN]


def test_matrices_on_disk(spark):
    path = scratch_path(spark, "matrices")
    packed = QUERIES["op5_token_packing"](spark, SF)
    files = packing.write_matrices(packed, path, rows=7).collect()
    want = sorted((r.ids, r.positions, tuple(r.cu_seqlens)) for r in packed.collect())
    got = []
    for f in files:
        ids, places = (load(path, f"{f.name}.{x}", "<u2").reshape(f.n_rows, packing.SEQ_LEN) for x in ("ids", "positions"))
        cu, segments = load(path, f"{f.name}.cu", "<i4"), load(path, f"{f.name}.segments", "<i8")
        cuts = np.split(cu, np.cumsum(segments + 1)[:-1])
        got += [(a.tobytes(), b.tobytes(), tuple(c.tolist())) for a, b, c in zip(ids, places, cuts, strict=True)]
    assert sorted(got) == want


def test_files_through_a_file_system_give_the_same(tmp_path):
    a = np.arange(5, dtype="<u8")
    save(str(tmp_path), "x", a)
    assert (load(f"file://{tmp_path}", "x", "<u8") == a).all()
    import tidings.llm.files as files
    local, files._local = files._local, lambda path: None       # as where the folder is not mounted
    try:
        save(f"file://{tmp_path}", "y", a)
        assert (load(f"file://{tmp_path}", "y", "<u8") == a).all() and (load(f"file://{tmp_path}", "x", "<u8") == a).all()
    finally:
        files._local = local


def test_words_encoded_one_by_one_give_the_same_ids(texts):
    import base64

    import tiktoken

    with open(TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    whole = tiktoken.Encoding("test", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = packing.encoder(TOKENIZER)
    odd = ["", " ", "a  b", "\n\na\n", "it's 'so' don't  ", "a\nb \nc", "x 's 'll y", "a b  c", "1 2,3 $4", "\x1c a b", "a \x85b"]
    for t in [*texts.values(), *odd]:
        assert encode(t).tolist() == whole.encode_ordinary(t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=40))
def test_best_fit_is_best_fit_decreasing(lengths):
    bins = []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(room, b) for b, (room, _) in enumerate(bins) if room >= lengths[k]]
        if fits:
            bins[min(fits)[1]] = (min(fits)[0] - lengths[k], None)
        else:
            bins.append((32 - lengths[k], None))
    got = packing.best_fit(lengths, 32)
    assert sorted(sum(got, [])) == list(range(len(lengths))) and all(sum(lengths[k] for k in row) <= 32 for row in got)
    assert sorted(32 - sum(lengths[k] for k in row) for row in got) == sorted(room for room, _ in bins)


# 6 -------------------------------------------------------------------------

def discounts(counts):
    n = Counter(counts)
    y = n[1] / (n[1] + 2 * n[2])
    return [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]


@pytest.mark.parametrize("shard", [kneser_ney.SHARD_TOKENS, 4000])
def test_kneser_ney_equals_its_definition(spark, texts, monkeypatch, shard):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", shard)         # small: frequent contexts are cut
    monkeypatch.setattr(kneser_ney, "SHARD_WORDS", 5000)
    said = {d: [*words(t), "end"] for d, t in texts.items()}
    seen = [t for d, t in said.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    once, pairs = Counter(w for t in seen for w in t), Counter(p for t in seen for p in zip(["start", *t], t, strict=False))
    n, v = sum(once.values()), len(once)
    before, total, rest = Counter(w for _, w in pairs), Counter(), Counter()
    d2, d1 = discounts(pairs.values()), discounts(before.values())
    for (a, _), c in pairs.items():
        total[a] += c
        rest[a] += d2[min(c, 3)]
    low = sum(d1[min(c, 3)] for c in before.values()) / len(pairs)

    def p(a, w):
        one = (before[w] - d1[min(before[w], 3)]) / len(pairs) + low / (v + 1) if w in before else low / (v + 1)
        c = pairs.get((a, w), 0)
        return (max(c - d2[min(c, 3)], 0) + rest[a] * one) / total[a] if total[a] else one

    assert math.isclose(sum(p(b"the", w) for w in once) + p(b"the", "?"), 1, rel_tol=1e-9)
    for r in QUERIES["op6_lm_score"](spark, SF).collect():
        t = said[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in once for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((once[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(a, w)) for a, w in zip(["start", *t], t, strict=False)), rel_tol=1e-9)


# 7 -------------------------------------------------------------------------

def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(4)
    rows = [(g, k, rng.choice([0, 1, 1, 5, 40, 700, rng.randrange(10_000)]), seats) for g, seats in enumerate([0, 1, 17, 500]) for k in range(30)]
    got = mixing.apportion(spark.createDataFrame(rows, "g int, k int, votes long, seats long"), ["g"], "votes", "seats", ["g", "k"])
    got = {(r.g, r.k): r.quota for r in got.collect()}
    for g, seats in enumerate([0, 1, 17, 500]):
        held = {k: 0 for k in range(30)}
        queue = [(-v, k) for gg, k, v, _ in rows if gg == g and v]
        heapq.heapify(queue)
        for _ in range(seats):
            _, k = heapq.heappop(queue)
            held[k] += 1
            heapq.heappush(queue, (-rows[g * 30 + k][2] / (2 * held[k] + 1), k))
        assert {k: got[g, k] for k in range(30)} == held


def test_mix_meets_its_targets(spark, texts):
    rows = QUERIES["op7_source_mix"](spark, SF).collect()
    assert rows and sorted(rows) == sorted(QUERIES["op7_source_mix"](spark, SF).collect())
    assert all(r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 3 * r.size for r in rows)
    size, taken, target = Counter(), Counter(), {r.source: r.target for r in rows}
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
    weights, full = {s: k % 3 + 1 for k, s in enumerate(sorted(size))}, set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        more = {s for s, w in weights.items() if w * level > 3 * size[s]}
        if more == full:
            break
        full = more
    for s in size:
        assert math.isclose(target[s], min(weights[s] * level, 3 * size[s]), rel_tol=1e-9) and abs(taken[s] - target[s]) <= 2


# 8 -------------------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\n", "<|im_end|>"]), st.text(alphabet="<|\\\nim_endst>a", max_size=20)), max_size=6))
def test_chat_round_trip(turns):
    messages = [{"role": r, "content": t} for r, t in turns]
    out, spans, loss, rewritten = chat.render(messages, chat.chatml)
    assert chat.parse_chatml(out) == turns and not rewritten
    assert [out[a:b] for a, b in spans] == [chat.chatml([m]) for m in messages]
    assert [chat.unescape(out[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def test_long_chats_and_templates_that_look_back():
    turns = [{"role": ("user", "assistant")[k % 2], "content": f"t{k}"} for k in range(100)]
    for template in (chat.chatml, lambda ms: "<s>" + chat.chatml(ms), lambda ms: "".join(f"{k}:{m['content']};" for k, m in enumerate(ms))):
        out, spans, loss, rewritten = chat.render(turns, template)
        assert out == template(turns) and not rewritten and spans[0][0] == 0 and spans[-1][1] == len(out)
        assert all(a[1] == b[0] for a, b in itertools.pairwise(spans))
        assert [out[a:b] for a, b in loss] == [f"t{k}" for k in range(1, 100, 2)]


def test_history_rewriting_is_reported():
    def forgetful(messages):            # drops thoughts of all but the last turn
        return "".join(f"[{m['content'] if k == len(messages) - 1 else m['content'].split('#')[-1]}]" for k, m in enumerate(messages))

    turns = [{"role": "assistant", "content": c} for c in ("plain", "thought#said", "again")]
    assert chat.render(turns, forgetful)[3] == [2]


def test_late_rewrites_of_long_chats_are_reported():
    turns = [{"role": ("user", "assistant")[k % 2], "content": f"why{k}#t{k}" if k == 30 else f"t{k}"} for k in range(100)]

    def say(messages, bare=()):
        return "".join(f"[{m['content'].split('#')[-1] if k in bare else m['content']}]" for k, m in enumerate(messages))

    def last_forty(messages):
        return say(messages[-40:])

    def bare_after_three(messages):
        return say(messages, range(len(messages) - 3))

    def user_first(messages):
        if messages[0]["role"] != "user":
            raise ValueError("the first message is a user's")
        return say(messages)

    out, _, _, rewritten = chat.render(turns, last_forty)
    assert out == last_forty(turns) and rewritten == list(range(40, 100))
    out, _, _, rewritten = chat.render(turns, bare_after_three)
    assert out == bare_after_three(turns) and rewritten == [33]
    out, _, loss, rewritten = chat.render(turns, user_first)
    assert out == say(turns) and not rewritten and [out[a:b] for a, b in loss] == [m["content"] for m in turns[1::2]]


# 9 -------------------------------------------------------------------------

def tiling(text, item, least=5):
    """Greedy string tiling by its definition."""
    free_t, free_i, covered = [True] * len(text), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(text)):
            for q in range(len(item)):
                k = 0
                while p + k < len(text) and q + k < len(item) and text[p + k] == item[q + k] and free_t[p + k] and free_i[q + k]:
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        k, p, q = best
        if k < least:
            return covered
        free_t[p:p + k], free_i[q:q + k] = [False] * k, [False] * k
        covered += k


def test_tiles_cover_what_greedy_tiling_covers():
    rng = random.Random(8)
    for _ in range(40):
        item = [f"i{rng.randrange(30)}" for _ in range(rng.randint(5, 30))]
        cut = rng.randrange(len(item))
        text = [f"x{k}" for k in range(rng.randint(0, 9))] + item[cut:] + ["mid"] * rng.randint(0, 2) + item[:cut] + item[:8]
        seeds = decontaminate.Seeds([(7, " ".join(item))])
        got = decontaminate.cover([" ".join(text)], seeds)[0]
        want = tiling(text, item)
        assert got == ([(7, want / len(item))] if want else [])


def test_decontamination_finds_reordered_passages_and_leaves_others(spark, texts):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    plain = {i: " ".join(re.findall(r"\w+", t.lower())) for i, t in bench.items()}
    for r in QUERIES["op9_decontamination"](spark, SF).collect():
        own = " " + " ".join(re.findall(r"\w+", texts[r.doc_id].lower())) + " "
        held = [i for i, t in plain.items() if f" {t} " in own]
        assert set(held) <= set(r.item_ids) and (held or not r.contaminated)
    item = bench[0].split()
    turned = " ".join(["Before."] + item[10:] + ["and", "then"] + item[:10])
    assert decontaminate.cover([turned], decontaminate.Seeds([(0, bench[0])]))[0][0][1] >= 0.8


def test_benchmarks_in_blocks_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(decontaminate.matches(docs, bench).collect())
    kept = sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 4000)
    assert sorted(decontaminate.matches(docs, bench).collect()) == whole and any(r.contaminated for r in whole)
    assert kept == [r.doc_id for r in whole if not r.contaminated]
    assert kept == sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect())


# 10 ------------------------------------------------------------------------

def within_one(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def test_line_dedup_equals_all_pairs(spark):
    rng, docs = random.Random(2), {}
    base = [[f"w{rng.randrange(6)}" for _ in range(rng.randint(1, 9))] for _ in range(12)]
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(line) + 1)
                line[at:at + rng.randint(0, 1)] = [f"w{rng.randrange(6)}"] * rng.randint(0, 1)
            lines.append(" ".join(line) + " " * rng.randint(0, 1))
        docs[d] = "\n".join(lines)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.dropped for r in linededup.report(df).collect()}
    earlier, want = [], {}
    for d in sorted(docs):
        want[d] = []
        for k, line in enumerate(docs[d].split("\n")):
            own = line.split()
            if own:
                if any(within_one(own, e) for e in earlier):
                    want[d].append(k)
                earlier.append(own)
    assert got == want and sum(map(len, want.values())) > 20
    out = {r.doc_id: r.text for r in linededup.deduplicated(df).collect()}
    assert out == {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[d]) for d, t in docs.items()}


def test_repeated_words_are_runs_and_not_pairs():
    """10 000 times one word against an item of 400: 3.9 million equal windows, in bounded memory."""
    import tracemalloc
    seeds = decontaminate.Seeds([(0, "a " * 400), (1, "a " * 300 + "b c d e f")])
    tracemalloc.start()
    found = decontaminate.cover(["a " * 10_000], seeds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(0, 1.0), (1, 300 / 305)]] and peak < 100_000_000


def test_runs_over_portions_are_joined(monkeypatch):
    rng = random.Random(5)
    for _ in range(60):
        item, text = ([rng.choice("ab") for _ in range(rng.randrange(1, 30))] for _ in range(2))
        seeds = decontaminate.Seeds([(0, " ".join(item))])
        hashes, at = word_hashes([" ".join(text)])
        whole = seeds.runs(hashes, at).tolist()
        monkeypatch.setattr(decontaminate, "PAIRS", 3)
        assert seeds.runs(hashes, at).tolist() == whole
        monkeypatch.undo()
        n = min(5, len(item))
        pairs = {(p, q) for p in range(len(text) - n + 1) for q in range(len(item) - n + 1) if text[p:p + n] == item[q:q + n]}
        assert {(p + j, p + d + j) for _, _, d, p, c in whole for j in range(c)} == pairs
        assert sum(r[4] for r in whole) == len(pairs)


def test_seeds_in_many_blocks_find_the_same(spark):
    items = spark.createDataFrame([(k, f"the item number {k} has its own eight words") for k in range(40)] + [(40, ""), (41, None), (42, " . ")],
                                  "item_id long, text string")
    texts = [f"x y the item number {k} has its own eight words z" for k in range(0, 40, 3)] + [None, "", "nothing here"]
    blocks = decontaminate.seed_blocks(items, chars=200)
    one = decontaminate.seed_blocks(items)
    assert len(blocks) > 3 and len(one) == 1
    got = [sorted(f) for f in decontaminate.cover(texts, *blocks)]
    assert got == [sorted(f) for f in decontaminate.cover(texts, *one)]
    assert [[i for i, c in f if c >= 0.8] for f in got[:3]] == [[0], [3], [6]] and got[-3:] == [[], [], []]


def test_more_shards_than_blocks_still_meet_the_targets(spark):
    """64 blocks asked for, 256 shards: the blocks grow with the shards, and the least source gets its share."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 9 AS int)) AS text",
                                        "CASE WHEN id < 3 THEN 'a' WHEN id % 3 = 0 THEN 'b' ELSE 'c' END AS source")
    rows = mixing.mix(docs, blocks=64, shard_docs=16).collect()
    total = sum(r["size"] for r in rows)
    block = max(1, min(total // 64, total // (64 * 251)))
    for source in "abc":
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= block
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    assert sum(1 for r in rows if r["taken"]) > 2000


def test_mixed_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(k, "a b c d", "s", f"r{k}", k) for k in range(20)],
                                 "doc_id long, text string, source string, _row string, _taken long")
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["_row"], r["_taken"]) for r in got.collect()} == {(k, f"r{k}", k) for k in range(20)}
