"""Spelling variants, certified packing and ranked search against brute force, with the odd cases of their docstrings."""

import itertools
import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators import ROWS, found, frame

from tessera.llm import ball_search, repacking, spelling
from tessera.llm.frames import ship
from tessera.llm.queries import QUERIES
from tessera.llm.tokens import vocabulary

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# ---- 11 spelling variants

def near(a, b):
    """Whether two different words differ by one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows, shortest, least, dominance, noise):
    """word -> (form, root, n, n_near, form_n)."""
    n = Counter()
    for d, x in rows:
        for w in re.findall("[a-zÀ-ÿ]+", brute.lower(x)):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if noise and h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= shortest
    n = {w: c for w, c in n.items() if c >= least}
    around = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w, vs in around.items():
        v = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = v if v is not None and n[v] >= dominance * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(around[w]), n.get(form[w])) for w in n}


def test_variants_match_brute_force(spark, docs):
    for settings_ in ((7, 2, 10, 31), (4, 1, 2, 5), (4, 2, 2, None)):
        got = found(spelling.variant_forms(docs, *settings_), "word")
        assert got == variants(ROWS, *settings_)
    assert any(v[0] and v[1] != v[0] for v in variants(ROWS, 4, 1, 2, 5).values())  # chains are in the data


def test_variants_odd_cases(spark, empty):
    rows = [(None, "Abcdefgh abcdefgh"), (None, None), (3, ""), (3, "abcdefgh ABCDEFG abcdefgxh"), (3, "abcdefgh ABCDEFG abcdefgxh"),
            (4, "12 34"), (5, "Éclairage éclairage Éclairage")]  # only A-Z change case
    got = found(spelling.variant_forms(frame(spark, rows), least=1, noise=31), "word")
    assert got == variants(rows, 7, 1, 10, 31) and "Éclairage" in got and "éclairage" in got
    assert spelling.variant_forms(empty).count() == 0


def test_words_of_long_texts():
    text = ("some words Éclair " * 100 + "x" * 3000 + " end").encode()
    for size in (1, 7, 100, 5000):
        assert Counter(w for s in spelling.segments(text, size) for w in re.findall("[a-zÀ-ÿ]+", s)) \
            == Counter(re.findall("[a-zÀ-ÿ]+", brute.lower(text.decode())))


def test_near_pairs_find_every_edit(spark):
    words = ["".join(w) for k in (1, 2, 3, 4, 5) for w in itertools.product("ab", repeat=k)] \
        + ["".join(w) for w in itertools.product("aé", repeat=7)]
    words = sorted(set(words))
    got = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    assert sorted(tuple(sorted((r.a, r.b))) for r in got) \
        == sorted((a, b) for a, b in itertools.combinations(words, 2) if near(a, b))


# ---- 12 certified packing

def check_packing(rows, got, capacity, name="word_bpe_49k.json", end=0):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    want = Counter()
    for d, x in rows:
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4")
        for i, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want[d, i, s, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) <= capacity
    return len(bins)


def test_packing_certified(spark, docs):
    for capacity, part in ((64, 10), (64, 5000), (300, 3)):  # many partitions that exchange, and one
        got = repacking.pack(docs, capacity, part=part).collect()
        bins = check_packing(ROWS, got, capacity)
        assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
        counts = np.bincount([r.length for r in got], minlength=capacity + 1)
        full, counts[capacity] = counts[capacity], 0
        assert bins <= repacking.lower_bound(counts, capacity) + full + 2
        assert all(r.part_bins >= r.lower_bound for r in got if r.round is not None)
    alone = {(r.round, r.part) for r in got if r.round is not None}
    assert len(alone) > 2 and max(r for r, _ in alone) >= 1


def test_packing_odd_cases(spark, empty):
    rows = [(None, "one two"), (None, None), (7, ""), (7, ""), (7, "three"), (7, "four " * 200), (8, "<|startoftext|> é 世界")]
    assert check_packing(rows, repacking.pack(frame(spark, rows), 16).collect(), 16) > 12
    assert repacking.pack(empty).count() == 0


def test_packing_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_best_fit"](spark, SF_SMALL).collect()
    counts = np.bincount([r.length for r in got], minlength=2049)
    full, counts[2048] = counts[2048], 0
    assert check_packing(rows, got, 2048) <= repacking.lower_bound(counts, 2048) + full + 1


def one_by_one(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        b = min((b for b in bins if capacity - sum(b) >= x), key=lambda b: capacity - sum(b), default=None)
        if b is None:
            bins.append(b := [])
        b.append(x)
    return sorted(sum(b) for b in bins)


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c - 1), max_size=60))))
def test_best_fit_in_bulk_is_best_fit(case):
    capacity, lengths = case
    of, where, used = repacking.place_all(np.array(lengths, np.int64), capacity)
    assert sorted(np.bincount(of, lengths, used).astype(int).tolist()) == one_by_one(lengths, capacity)


def least_bins(lengths, capacity):
    """The least number of bins, by trying all ways."""
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in sorted({x for x in bins if x + lengths[i] <= capacity}):
            rest = list(bins)
            rest[rest.index(b)] += lengths[i]
            go(i + 1, rest)
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.integers(2, 24).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c - 1), max_size=8))))
def test_bound_is_below_the_optimum(case):
    capacity, lengths = case
    bound = repacking.lower_bound(np.bincount(np.array(lengths, np.int64), minlength=capacity + 1), capacity)
    assert bound <= least_bins(sorted(lengths, reverse=True), capacity)


def test_bound_sees_more_than_the_sum():
    counts = np.zeros(101, np.int64)
    counts[51] = 10
    assert repacking.lower_bound(counts, 100) == 10  # the sum alone gives 6
    counts[:] = 0
    counts[34] = 9
    assert repacking.lower_bound(counts, 100) == 5


# ---- 13 ranked search

def ranked(rows, items, top=10):
    """item_id -> [(doc_id, score)]."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    texts = [(d, Counter(term.findall(brute.lower(x)))) for d, x in rows]
    texts = [(d, c) for d, c in texts if c]
    n, total, df = len(texts), sum(sum(c.values()) for _, c in texts), Counter(t for _, c in texts for t in c)
    asked = {}
    for i, x in items:
        asked.setdefault(i, set()).update(term.findall(brute.lower(x)))
    out = {}
    for i, q in asked.items():
        scores = []
        for d, c in texts:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in q if t in c)
            scores.append((-s, math.inf if d is None else d))
        best = sorted(x for x in scores if x[0] < 0)[:top]
        if best:
            out[i] = [(None if d == math.inf else d, -s) for s, d in best]
    return out


def by_item(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


@pytest.fixture(scope="module")
def items(spark):
    texts = [x for _, x in ROWS if x and len(x) > 40]
    rows = [(i, x[:200]) for i, x in enumerate(texts[:25])] + [(100, ROWS[20][1])]
    return rows, spark.createDataFrame([(i, x, "z") for i, x in rows], "item_id long, text string, score string")


def test_search_matches_brute_force(spark, docs, items):
    rows, table = items
    want = ranked(ROWS, rows)
    assert by_item(ball_search.rank(docs, table)) == want
    assert by_item(ball_search.rank(docs, table, block=7)) == want  # several blocks of items
    assert by_item(ball_search.rank(docs, table, top=3)) == ranked(ROWS, rows, 3)


def test_search_odd_cases(spark, empty, items):
    rows = [(None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (4, "ALPHA, beta"), (6, None), (7, ""), (8, " ;: "),
            (9, "gamma " * 50), (10, "été 42")]
    asked = [(1, "alpha"), (1, "gamma"), (2, None), (3, ""), (None, "été"), (4, "delta"), (5, "beta beta alpha"), (5, "beta")]
    table = spark.createDataFrame(asked, "item_id long, text string")
    assert by_item(ball_search.rank(frame(spark, rows), table)) == ranked(rows, asked)
    assert by_item(ball_search.rank(frame(spark, rows), table, top=2)) == ranked(rows, asked, 2)
    assert ball_search.rank(empty, table).count() == 0
    assert ball_search.rank(frame(spark, rows), table.limit(0)).count() == 0


def some_tree(seed, n=400, terms=60, leaf=8):
    rng = np.random.default_rng(seed)
    rows = [np.sort(rng.choice(terms, rng.integers(1, 12), replace=False)) for _ in range(n)]
    rows[n // 2:n // 2 + 60] = [rows[0]] * 60  # copies
    values = [rng.integers(1, 10 ** 10, len(r)) for r in rows]
    values[n // 2:n // 2 + 60] = [values[0]] * 60
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    ids = rng.permutation(n).astype(np.int64)
    dense = np.zeros((n, terms), np.int64)
    for i, (r, v) in enumerate(zip(rows, values)):
        dense[i, r] = v
    return ball_search.BallTree(ids, ptr, np.concatenate(rows), np.concatenate(values), leaf), ids, dense, rng


def test_tree_is_exact_and_bounds_hold():
    for seed in range(5):
        tree, ids, dense, rng = some_tree(seed)
        at = {d: i for i, d in enumerate(ids.tolist())}
        for _ in range(20):
            q = np.sort(rng.choice(60, rng.integers(1, 10), replace=False))
            scores = dense[:, q].sum(axis=1)
            compact = np.searchsorted(tree.vocabulary, q)
            for x, (i, j) in enumerate(zip(tree.first, tree.end)):
                assert max(scores[at[d]] for d in tree.ids[i:j].tolist()) <= tree.bound(slice(x, x + 1), compact)[0]
                ball = int(tree.centre[x][compact].sum()) + math.sqrt(len(q)) * tree.radius[x]
                assert max(scores[at[d]] for d in tree.ids[i:j].tolist()) <= ball
            best = []
            tree.search(q, best, 1, 10)
            want = sorted((-s, d) for s, d in zip(scores.tolist(), ids.tolist()) if s > 0)[:10]
            assert sorted((-s, -d) for s, d in best) == want
            again = []
            tree.search(q, again, min(s for s, _ in best), 10)  # a floor leaves out no result
            assert sorted(again) == sorted(best)


def test_tree_prunes():
    """Documents in clusters of their own words: an item's search stays in its cluster."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(20, 8, replace=False)) + 20 * (i % 25) for i in range(2000)]
    ptr = np.arange(2001) * 8
    tree = ball_search.BallTree(np.arange(2000), ptr, np.concatenate(rows), np.full(16000, 1000), 16)
    tree.search(np.arange(40, 60), [], 1, 10)
    assert tree.scored < 200


def test_norms_beyond_64_bits():
    big = ball_search.Scale(10 ** 11, 10 ** 14, np.array([5]))
    assert big.norms(np.array([10 ** 9])).tolist() == [10 + 90 * 10 ** 9 * 10 ** 11 // 10 ** 14]


def test_vocabulary_finds_its_terms():
    v = ball_search.Vocabulary(np.array([5, 9, 1 << 63], np.uint64))
    at, term = v.find(np.array([9, 5 + (1 << 16), 5, 1 << 63, 7], np.uint64))
    assert at.tolist() == [0, 2, 3] and term.tolist() == [1, 0, 2]


def test_session_settings(spark):
    ship(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 64 << 20


def test_buckets_grow_with_the_input(spark, tmp_path, monkeypatch):
    from tessera.llm import exchange, frames
    for n in (1, 8):
        spark.range(20_000 * n).selectExpr("id", "sha2(string(id), 256) AS text").write.parquet(str(tmp_path / str(n)))
    small, large = (spark.read.parquet(str(tmp_path / str(n))) for n in (1, 8))
    assert exchange.buckets_for(small) == exchange.buckets_for(large) == 2 * 32  # far below a bucket's bytes
    monkeypatch.setattr(exchange, "BUCKET_BYTES", frames.plan_bytes(small) // 100)
    assert 90 <= exchange.buckets_for(small) <= 110 and 700 <= exchange.buckets_for(large) <= 900
    assert frames.plan_bytes(large) / exchange.buckets_for(large) <= exchange.BUCKET_BYTES


def test_results_with_many_buckets(spark, docs, monkeypatch):
    """The same results with a few dozen buckets and with thousands."""
    from tessera.llm import bwt_dedup, exchange, minmax_dedup, recompression
    want = brute.near(ROWS, 3, 85), brute.passages(ROWS), brute.byte_repeats(ROWS)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 1000)
    assert found(minmax_dedup.near_duplicates(docs, 3, 85).drop("_row")) == want[0]
    got = recompression.cut_repeats(docs), bwt_dedup.cut_repeats(docs)
    for df, w in zip(got, want[1:]):
        rows = found(df.select("doc_id", *[c for c in df.columns if c.startswith("n_")]))
        assert {d: v for d, v in rows.items()} == {d: v[:len(next(iter(rows.values())))] for d, v in w.items()}
