"""Every corpus operator against its brute-force version, with the odd cases of its docstring."""

import math
import os
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import bloom_lm, bwt_dedup, decontaminate, html_extract, line_runs, minmax_dedup, packing
from tessera.llm import quality_forest, recompression, token_output
from tessera.llm.tokens import encoder, vocabulary

ROWS = brute.corpus()
#: Extra columns whose names an operator might use itself.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, tag int, node string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(d, x, "en", "s", len(x or ""), "r", 1, "n", 2) for d, x in rows], SCHEMA) \
        .repartition(3)


def found(df, key="doc_id"):
    return {r[key]: tuple(r[c] for c in df.columns if c != key) for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """A NULL id, a repeated row and an id with two texts."""
    return frame(spark, [(None, ROWS[40][1]), (None, None), (40, ROWS[40][1]), (40, ROWS[40][1]), (41, "one two three " * 20),
                         (41, "four five six " * 30), (42, ROWS[40][1])])


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# ---- 1 token output

def expected_ids(rows, name, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    return {d: np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for d, x in rows}


def test_token_file_round_trip(spark, docs, tmp_path):
    for size in (50, 1 << 18):  # many segments, one segment
        path = str(tmp_path / f"ids-{size}")
        token_output.write_ids(docs, path, segment_ids=size)
        got, at = found(token_output.read_ids(spark, path)), 0
        for d, ids in sorted(expected_ids(ROWS, "word_bpe_49k.json", 2).items()):
            assert got[d] == (at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
            at += len(ids)


def test_token_file_odd_cases(spark, odd, empty, tmp_path):
    token_output.write_ids(odd, str(tmp_path / "odd"))
    got = token_output.read_ids(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 40, 40, 41, 41, 42]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    token_output.write_ids(empty, str(tmp_path / "empty"))
    assert token_output.read_ids(spark, str(tmp_path / "empty")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=300))
def test_elias_fano(values):
    values = np.sort(np.array(values, np.uint64))
    ef, _ = token_output.EliasFano.from_bytes(token_output.EliasFano.of(values).to_bytes())
    assert ef.values().tolist() == values.tolist()
    assert [ef.select(i) for i in range(len(values))] == values.tolist()


def test_pieces_encode_like_whole_texts():
    texts = ["", " ", "a  b \n\n c\t\tl'été it's I'M  ", "日本語 text́ x", "x<|endoftext|> y", "\x1f odd\x85 ab cd",
             "don't '' '''s 12 3,4 -- ... \r\n"]
    for name, kind, end in (("word_bpe_49k.json", "word", 2), ("byte_bpe_50k.json", "byte", 0)):
        enc = encoder(vocabulary(name), kind)
        want = expected_ids(enumerate(texts), name, end)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts, end)] == [want[i].tolist() for i in range(len(texts))]


# ---- 2 html

def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("source,text", [
    ("", ""), ("plain &amp; text", "plain & text"),
    (page("<nav><ul><li>Menu</ul></nav><article><h1>Ti<b>t</b>le</h1><p>One<br>two<p>three &lt;4&gt; &eacute;</article><footer>F</footer>"),
     "Title One two three <4> é"),
    (page("<article>a<script>var t='</p>';if(a<b){}</script><style>p{}</style>b<!-- c --> d<form>no<input></form></article>"), "ab d"),
    (page("<main>text<div class='cookie-notice'>no</div><section id=comments><p>no</p></section> end</main>"), "text end"),
    (page("<header>no</header><div><p>body text</p></div><aside>no</aside><div class='ad'>no</div>"), "body text"),
    (page("<article><p>cut off <a href='x"), "cut off"), ("<p>unclosed <b>bold<p>next", "unclosed bold next"),
    ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"), (page("<article>x</article><article>y</article>"), "x y"),
])
def test_page_text(source, text):
    assert html_extract.Page(source).text() == text


def test_site_templates_are_deleted(spark):
    rows = [(i, f"https://a.example/{i}", page(f"<div><p>Buy now</p></div><p>own text {i}</p><div>Terms apply</div>")) for i in range(12)]
    rows += [(100 + i, "https://b.example/x", page("<p>Same article</p>")) for i in range(12)]  # copies are no template
    rows += [(200, "https://a.example/z", None), (201, None, page("<p>no host</p>")), (None, "", "x")]
    got = found(html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert all(got[i] == (f"https://a.example/{i}", f"own text {i}", len(f"own text {i}")) for i in range(12))
    assert all(got[100 + i][1] == "Same article" for i in range(12))
    assert got[200][1:] == ("", 0) and got[201][1] == "no host" and got[None][1] == "x"


@pytest.mark.parametrize("limit,per_salt", [(1 << 20, 20_000), (0, 50)])
def test_rotating_templates_without_names(spark, monkeypatch, limit, per_salt):
    """Each of the 20 boxes and 30 closing lines of a large host is on 3 to 5 % of its pages."""
    monkeypatch.setattr(html_extract, "PAGES_PER_SALT", per_salt)

    def body(i):
        return (f"<div class=x{i % 20}><p>Box {i % 20} offers</p></div><p>own text {i}</p>"
                f"<p>shared by three {i // 3}</p><section>Closing line {i % 30}</section>")

    rows = [(i, f"https://large.example/{i}", page(body(i))) for i in range(300)]
    rows += [(1000 + i, f"https://large.example/m{i}", page(f"<article><h1>Title {i % 5}</h1><p>article {i}</p></article>"))
             for i in range(100)]  # headings inside of articles are no template
    rows += [(2000 + i, f"https://small.example/{i}", page(f"<p>Box 1 offers</p><p>small {i}</p>")) for i in range(3)]
    got = found(html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), limit), "page_id")
    assert all(got[i][1] == f"own text {i} shared by three {i // 3}" for i in range(300))
    assert all(got[1000 + i][1] == f"Title {i % 5} article {i}" for i in range(100))
    assert all(got[2000 + i][1] == f"Box 1 offers small {i}" for i in range(3))


def test_templates_leave_articles_alone_without_the_main_element(spark):
    """The pages with ``article`` and ``main`` renamed: the templates found then cost no article text."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = found(html_extract.extract(pages), "page_id")
    stripped = pages.withColumn("html", F.regexp_replace("html", r"<(/?)(article|main)\b", "<$1div"))
    got = found(html_extract.extract(stripped), "page_id")
    assert sum(got[k] == v for k, v in want.items()) >= 0.99 * len(want)
    assert all(len(got[k][1]) >= 0.95 * len(v[1]) for k, v in want.items())


def test_revised_articles_are_one_page(spark):
    """Twelve revisions of an article in unnamed elements keep their text; a box on four different articles goes."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    base = [[words[rng.integers(400)] for _ in range(40)] for _ in range(6)]

    def revision(i):
        texts = [list(p) for p in base]
        texts[i % 6][i] = f"changed{i}"
        return "<div class=body>" + "".join(f"<div class=s{j}>{' '.join(p)}</div>" for j, p in enumerate(texts)) + "</div>"

    def other(i):
        return "<div class=body>" + " ".join(words[rng.integers(400)] for _ in range(60)) + "</div>"

    rows = [(i, f"https://r.example/{i}", page(revision(i))) for i in range(12)]
    rows += [(100 + i, f"https://r.example/o{i}", page(other(i) + "<div class=x>Ten offers today</div>")) for i in range(4)]
    got = found(html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert all(len(got[i][1].split()) == 240 for i in range(12))
    assert all("offers" not in got[100 + i][1] and len(got[100 + i][1].split()) == 60 for i in range(4))


def test_template_counts_match_brute_force(spark):
    """Templates of the given pages, with the labels of the articles as they are, counted again in plain Python."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    host = F.regexp_extract("url", "//([^/?#:]+)", 1)
    rows = pages.select("html", F.xxhash64(host).alias("_host"), F.xxhash64(host, "html").alias("_page"))
    read = html_extract.subtree_hashes(rows).distinct().cache()
    label = found(html_extract.article_labels(read), "_page")
    seen, articles = {}, {}
    for r in read.collect():
        articles.setdefault(r._host, set()).add(label[r._page])
        for inside, hashes in ((False, r.outer), (True, r.inner)):
            for h in hashes:
                seen.setdefault((r._host, inside, h), set()).add(label[r._page])
    want = {k for k, v in seen.items() if (len(v) >= max(10, 0.5 * len(articles[k[0]])) if k[1] else len(v) >= 2)}
    got = {(r._host, r.inside, r.subtree) for r in html_extract.site_templates(read, min_pages=2).collect()}
    assert got == want and got


def test_html_odd_cases(spark):
    schema = "page_id long, url string, html string, _page string, _host string, inside int, subtree string, label string"
    rows = [(1, "https://a.example/", page("<p>same</p>"), "a", "b", 1, "c", "d")] * 3 + [(1, None, None, None, None, None, None, None)]
    long = "<article><p>" + "word &amp; " * 400_000 + "</p></article>"  # beyond a chunk
    got = html_extract.extract(spark.createDataFrame([*rows, (2, "https://a.example/", long, "", "", 1, "", "")], schema))
    assert sorted((r.page_id, r.text[:6], r.n_chars) for r in got.collect()) \
        == [(1, "", 0), (1, "same", 4), (1, "same", 4), (1, "same", 4), (2, "word &", 400_000 * 7 - 1)]
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert html_extract.extract(spark.createDataFrame([], schema)).count() == 0


# ---- 3 near duplicates

@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, k, percent):
    got = found(minmax_dedup.near_duplicates(docs, k, percent).drop("_row"))
    assert got == brute.near(ROWS, k, percent)


def test_near_duplicates_across_blocks(docs):
    assert found(minmax_dedup.near_duplicates(docs, 3, 85, block=3).drop("_row")) == brute.near(ROWS, 3, 85)


def test_near_duplicates_odd_cases(odd, empty):
    got = minmax_dedup.near_duplicates(odd, 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(40, 40)] * 2 + [(41, 41)] * 2 + [(42, 40)]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert minmax_dedup.near_duplicates(empty).count() == 0
    assert minmax_dedup.keep_one(odd, 3, 85).columns == odd.columns


# ---- 4 and 7 repeats

def test_passages(docs):
    got = found(recompression.cut_repeats(docs).select("doc_id", "n_words", "n_removed", "text"))
    assert {d: (a, b, brute.sha(t)) for d, (a, b, t) in got.items()} == brute.passages(ROWS)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "dd", "e"]), max_size=40), min_size=2, max_size=4))
def test_equal_windows_have_equal_zones(texts):
    """Windows with equal words lie in zones of one key, at one distance from the anchor."""
    keys, _, of, start, m = recompression.window_zones([" ".join(t).encode() for t in texts], 6)
    seen, n = {}, 0
    for k, i, s, length in zip(keys.tolist(), of.tolist(), start.tolist(), m.tolist()):
        for w in range(s, s + length):
            assert seen.setdefault(tuple(texts[i][w:w + 6]), k) == k
            n += 1
    assert n == sum(max(len(t) - 5, 0) for t in texts)


def test_byte_repeats(docs):
    got = found(bwt_dedup.cut_repeats(docs).select("doc_id", "n_bytes", "n_removed", "removed", "kept"))
    assert {d: (a, b, len(r), brute.sha(bytes(x))) for d, (a, b, r, x) in got.items()} == brute.byte_repeats(ROWS)


def test_hot_anchors_are_compared_by_window(docs, monkeypatch):
    whole = bwt_dedup.Z.repeats_and_asked
    monkeypatch.setattr(bwt_dedup.Z, "repeats_and_asked", lambda *a, **b: whole(*a, **b, hot=1))
    test_byte_repeats(docs)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=3, max_size=24).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=8),
       st.integers(2, 9))
def test_interval_expansion(fragments, k):
    fragments = [f for f in fragments if len(f) >= k]
    if not fragments:
        return
    n = len(fragments)
    f, w = bwt_dedup.repeated_windows(fragments, np.arange(n), np.zeros(n, np.int64),
                                      np.array([len(x) - k + 1 for x in fragments]), k)
    seen, want = set(), set()
    for i, x in enumerate(fragments):
        for a in range(len(x) - k + 1):
            want |= {(i, a)} & ({(i, a)} if x[a:a + k] in seen else set())
            seen.add(x[a:a + k])
    assert set(zip(f.tolist(), w.tolist())) == want


def test_repeats_odd_cases(odd, empty):
    got = sorted(((r.doc_id or 0), r.n_removed) for r in recompression.cut_repeats(odd).collect())
    words = len(brute.WORD.findall(ROWS[40][1]))
    assert got == [(0, 0), (0, 0), (40, 0), (40, 0), (41, 0), (41, 0), (42, words if words >= 13 else 0)]
    assert recompression.cut_repeats(empty).count() == 0 and bwt_dedup.cut_repeats(empty).count() == 0
    assert sum(r.n_removed for r in bwt_dedup.cut_repeats(odd).collect() if r.doc_id is None) == 0


@pytest.mark.parametrize("hot", [5000, 1])
def test_a_row_given_twice_keeps_its_bytes(spark, monkeypatch, hot):
    whole = bwt_dedup.Z.repeats_and_asked
    monkeypatch.setattr(bwt_dedup.Z, "repeats_and_asked", lambda *a, **b: whole(*a, **b, hot=hot))
    twice = ROWS[6:40]  # with repeats in themselves, of each other and of rows given once
    got = bwt_dedup.cut_repeats(frame(spark, ROWS + twice)).select("doc_id", "n_bytes", "n_removed", "removed", "kept").collect()
    want = brute.byte_repeats(ROWS)
    assert sorted((r[0], r[1], r[2], len(r[3]), brute.sha(bytes(r[4]))) for r in got) == \
        sorted((d, *want[d]) for d, _ in ROWS + twice)


def test_zones_are_sent_for_many_batches_at_once():
    """A task sends a row a bucket for all zones it gathers, not for each batch, whose number times that of the buckets grows as the square."""
    texts = [t or "" for _, t in ROWS]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()), "text": [t], "_row": pa.array([i], pa.int64())})
               for i, t in enumerate(texts)]
    n, zones = 16, bwt_dedup.Z
    sent = list(zones.zone_rows(iter(batches), bwt_dedup.window_zones, True, n))
    assert sum(b.num_rows for b in sent) <= 2 * n < len(texts)
    z = zones.unpack(pa.Table.from_batches(sent), 1)
    each = [zones.unpack(pa.Table.from_batches(zones.zone_rows(iter([b]), bwt_dedup.window_zones, True, n)), 1)
            for b in batches if len(b.column("text")[0].as_py().encode()) >= bwt_dedup.LENGTH]
    _, want = zones.settle(zones.join(each), True)
    assert sorted(z["fragments"].tolist()) == sorted(want["fragments"].tolist())


@pytest.mark.parametrize("n", [3000, 2_200_000])  # the larger has ranks and places that do not fit in one number
def test_suffixes_are_in_order(n):
    rng = np.random.default_rng(5)
    text = rng.integers(1, 4, n).astype(np.int16)
    text[n // 2:n // 2 + 500] = text[:500]
    text[-1] = 0
    order = bwt_dedup.suffix_order(text, 100)
    assert (np.sort(order) == np.arange(n)).all()
    whole = bytes(text.astype(np.uint8))
    some = np.arange(0, n - 1, max(1, n // 20_000))
    assert all(whole[i:i + 100] <= whole[j:j + 100] for i, j in zip(order[some].tolist(), order[some + 1].tolist()))


def test_intervals_of_any_size_part_the_suffixes(monkeypatch):
    """Single suffixes, small and large intervals: cut where the common prefix is shorter than the length asked for."""
    rng = np.random.default_rng(6)
    text = np.append(rng.integers(1, 3, 4000), 0).astype(np.int16)
    text[3000:3300] = text[:300]
    order = bwt_dedup.suffix_order(text, 64)
    whole = bytes(text.astype(np.uint8))
    want = [True, *[whole[i:i + 20] != whole[j:j + 20] for i, j in zip(order[:-1].tolist(), order[1:].tolist())]]
    for small in (1, 48, 1000):
        monkeypatch.setattr(bwt_dedup, "SMALL", small)
        assert bwt_dedup.parted(text, order, 20).tolist() == want


# ---- 5 language model

def test_language_model(docs):
    model, n = bloom_lm.train(docs)
    one = found(bloom_lm.score(docs, model, n))
    many = found(bloom_lm.score(docs, model, n, limit=1000))  # the model in many groups
    for d, want in brute.base_scores(ROWS).items():
        assert one[d][:4] == want[:4] and one[d][4] == pytest.approx(want[4], abs=1e-6)
        assert many[d][:4] == one[d][:4] and many[d][4:] == pytest.approx(one[d][4:], abs=1e-9)
        assert one[d][5] < 0
    assert sum(x[5] for x in one.values()) > sum(x[4] for x in one.values())


def a_group(tmp_path, **parts):
    """A model of one bucket."""
    sizes = {k: np.array([len(parts.get(k, b""))]) for k in bloom_lm._PARTS}
    group = bloom_lm.Group(0, 1, 1, sizes, str(tmp_path / "group"))
    group.put(0, **parts)
    return group


def test_filter_levels_are_never_too_low(tmp_path):
    """Every pair is found with its level or a higher one, whatever its number of probes, and hardly any other pair is."""
    rng = np.random.default_rng(2)
    pairs = rng.integers(1 << 63, size=50_000).astype(np.uint64)
    counts, probes = rng.integers(1, 200, size=50_000), rng.integers(4, 8, size=50_000).astype(np.uint8)
    levels = bloom_lm.levels_of(counts)
    assert (bloom_lm.expected(levels) <= counts).all() and (bloom_lm.expected(levels) > counts / 1.5).all()
    items = bloom_lm.mix(pairs ^ bloom_lm._PAIR)
    group = a_group(tmp_path, pairs=bloom_lm.build_strong(items, probes), levels=bloom_lm.build(items[levels > 1], levels[levels > 1], 2))
    _, got = group.level(pairs, probes)
    assert (got >= levels).all() and (got == levels).mean() > 0.98
    others = rng.integers(1 << 63, size=1_000_000).astype(np.uint64)
    for k in (1, 3, 5):
        _, other = group.level(others, np.full(len(others), k, np.uint8))
        assert (other > 0).mean() < 2.0 ** (-3.4 * k) + 5e-6  # each probe passes about one in 2 ** 4


def test_sketch_counts_distinct_words():
    rng = np.random.default_rng(3)
    for n in (10, 1000, 50_000, 1_000_000):
        words = rng.integers(1 << 63, size=n).astype(np.uint64)
        half = np.maximum(bloom_lm.sketch_of(words[:n // 2 + 5]), bloom_lm.sketch_of(words[n // 3:]))
        assert abs(bloom_lm.distinct(half) - n) < 0.12 * n + 1


@pytest.mark.parametrize("at", ["0.001", "0.01"])
def test_probabilities_sum_to_one(spark, at):
    """After words of every frequency the probabilities of all words, and of an unknown one, sum to about 1."""
    texts = spark.read.parquet(f"/root/testdata/sf{at}/documents.parquet")
    model, n = bloom_lm.train(texts)
    n_train, n_words = map(int, model.agg(F.sum("tokens"), F.sum("n_words")).first())
    (group, last), = bloom_lm.groups(model, n)
    words, counts = np.array(group.parts["words"]), np.array(group.parts["counts"]).astype(np.int64)
    words, counts = words[words != bloom_lm._BEGIN], counts[words != bloom_lm._BEGIN]
    assert last and len(words) == n_words and counts.sum() == n_train
    rng, sums = np.random.default_rng(3), []
    order = np.argsort(counts, kind="stable")
    for v in [*order[rng.integers(len(order), size=80)], *order[-20:]]:
        state = {k: np.zeros(n_words, t) for k, t in bloom_lm._STATE.items()}
        bloom_lm._look(group, words, np.full(n_words, words[v]), state)
        _, p = bloom_lm.probability(counts, state["context"], state["pair"], state["follow"], n_train, n_words)
        follow = max(1, min(int(state["follow"][0]), counts[v]))
        sums.append(p.sum() + follow / (n_train + n_words + 1) / (counts[v] + follow))
    assert max(sums) <= 1.05 and min(sums) > 0.6 and np.mean(sums) > 0.9


def test_score_is_near_the_exact_model(docs):
    """Against Witten-Bell with exact counts, per token."""
    got = found(bloom_lm.score(docs, *bloom_lm.train(docs)))
    off = {d: (got[d][5] - want) / got[d][1] for d, want in brute.pair_scores(ROWS).items()}
    assert all(v[5] <= 0 for v in got.values())
    assert max(map(abs, off.values())) < math.log10(1.5) and abs(np.mean(list(off.values()))) < 0.03  # a level spans a factor of 1.5


def test_language_model_odd_cases(odd, empty):
    model, n = bloom_lm.train(odd)
    assert bloom_lm.score(odd, model, n).count() == 7
    model, n = bloom_lm.train(empty)
    assert bloom_lm.score(empty, model, n).count() == 0
    got = bloom_lm.score(odd, model, n).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in got)


def test_large_model_keeps_no_copies_of_the_texts(spark, docs):
    """A model of many groups leaves its result alone in the shared folder: the texts are not written for each group."""
    shared = spark.conf.get("spark.checkpoint.dir")
    model, n = bloom_lm.train(docs)
    before = set(os.listdir(shared))
    out = bloom_lm.score(docs, model, n, limit=1000)
    assert len(set(os.listdir(shared)) - before) == 1 and out.count() == len(ROWS)


def test_questions_with_odd_rows(odd, empty):
    """Broadcast and exchange agree on null texts, null ids and copies, with a model and without."""
    for model, n in (bloom_lm.train(odd), bloom_lm.train(empty)):
        key = lambda r: tuple(str(x) for x in r)
        want, got = (sorted(bloom_lm.score(odd, model, n, limit=k).collect(), key=key) for k in (1 << 30, -1))
        assert [r[:5] for r in got] == [r[:5] for r in want] and len(got) == 7
        assert [r[6] for r in got] == pytest.approx([r[6] for r in want])
        assert bloom_lm.score(empty, model, n, limit=-1).count() == 0


def test_questions_in_small_bundles(spark, docs, monkeypatch):
    """Bundles, answers and results cut into small pieces change nothing."""
    model, n = bloom_lm.train(docs)
    want = found(bloom_lm.score(docs, model, n))
    ids, held = [r[0] for r in ROWS], [False] * len(ROWS)
    texts = [(t or "").encode() for _, t in ROWS]
    monkeypatch.setattr(bloom_lm, "SMALL_CHUNK", 50)
    monkeypatch.setattr(bloom_lm, "PIECE", 20)
    sizes = np.array([len(t) for t in texts])
    tokens, first = bloom_lm.bundle_tokens(sizes.tobytes(), pa.compress(b"".join(texts), "zstd", asbytes=True))
    whole, before, at = bloom_lm.token_stream(texts)
    assert (tokens == whole).all() and (first == at).all()
    q = bloom_lm.Questions(tokens, first, n)
    assert (q.words[q.word] == tokens).all() and (q.words[q.ahead] == before).all()
    assert (q.words[q.lead[q.pair]] == before).all() and (q.low[q.pair] == (tokens >> np.uint64(32))).all()
    asked, parts = q.rows(7), {r.bucket: r.asDict() for r in model.collect()}
    answers = [bloom_lm._answered(bloom_lm.Group.of(b, n, {k: parts.get(b, {}).get(k) for k in bloom_lm._PARTS}),
                                  pa.Table.from_batches([asked.slice(i, 1)])) for i, b in enumerate(asked.column("bucket").to_pylist())]
    known = {c: np.frombuffer(b"".join(pa.concat_tables(answers).column(c).to_pylist()), t) for c, t in bloom_lm._ANSWERS.items()}
    n_train, n_words = map(int, model.agg(F.sum("tokens"), F.sum("n_words")).first())
    state = {"pair": known["pairs"][q.pair], "count": known["counts"][q.word], "context": known["counts"][q.ahead],
             "follow": known["follow"][q.ahead]}
    got = bloom_lm.scored(pa.array(ids), pa.array(held), first, state, n_train, n_words).to_pylist()
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][1:4]
        assert r["score"] == pytest.approx(want[r["doc_id"]][5], abs=1e-9)


def test_shuffles_are_removed_with_their_query(spark):
    """What a query has sent is gone when its result is written."""
    from tessera.llm.frames import shuffles_removed, staged

    blocks = lambda: str(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                         .getAllBlocks().mkString(" ")).count("shuffle_")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), blocks()
    with shuffles_removed(spark):
        out = staged(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "removed")
    assert blocks() <= before and out.count() == 100 and spark.conf.get(key, None) == was


# ---- 6 packing

def check_pieces(rows, got, window):
    want = expected_ids(rows, "byte_bpe_50k.json", 0)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(want)
    for d, ids in want.items():
        pieces, at = sorted(by_doc[d], key=lambda r: r.start), 0
        for r in pieces:
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes()) and r.ids == ids[at:at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        short += end < window
    assert short <= 1 and sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window", [32, 1024])
def test_packing(docs, window):
    check_pieces(ROWS, packing.pack(docs, window).collect(), window)


def test_packing_one_length(spark):
    rows = [(i, "a b c d e f g") for i in range(100)]
    check_pieces(rows, packing.pack(frame(spark, rows), 12).collect(), 12)


ODD = [(None, ROWS[40][1]), (None, None), (40, ROWS[40][1]), (40, ROWS[40][1]), (41, "one two three " * 20),
       (41, "four five six " * 30), (42, ROWS[40][1])]


def test_packing_odd_cases(odd, empty):
    """Every token of every row is in as many pieces as there are such rows, and each piece has its row's ids."""
    got = packing.pack(odd, 16).collect()
    wanted = {}
    for d, x in ODD:
        ids = expected_ids([(d, x)], "byte_bpe_50k.json", 0)[d]
        wanted.setdefault((d, len(ids)), []).append(ids)
    assert len(wanted) == 6  # no two different texts of an id are equally long
    for (d, n), copies in wanted.items():
        times = np.zeros(n, int)
        for r in got:
            if (r.doc_id, r.doc_tokens) == (d, n):
                times[r.start:r.start + r.length] += 1
                part = copies[0][r.start:r.start + r.length]
                assert r.ids == part.tobytes() and r.ids_crc32 == zlib.crc32(part.tobytes())
        assert (times == len(copies)).all()
    assert sum(r.length for r in got) == sum(n * len(c) for (_, n), c in wanted.items())
    ends = {}
    for r in got:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in ends.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist() and sum(n for _, n in parts) <= 16
    assert sum(sum(n for _, n in parts) < 16 for parts in ends.values()) <= 1
    assert packing.pack(empty, 16).count() == 0


def test_packing_places_most_tails_by_least_squares(spark):
    for at, share in (("0.001", 0.75), ("0.01", 0.85), ("0.1", 0.95)):
        texts = [(i, r.text) for i, r in enumerate(spark.read.parquet(f"/root/testdata/sf{at}/documents.parquet").select("text").collect())]
        enc = encoder(vocabulary("byte_bpe_50k.json"), "byte")
        sizes = np.array([len(x) // enc.dtype.itemsize for x in enc.encode([t or "" for _, t in texts], 0)])
        histogram = np.bincount(sizes % 1024, minlength=1024)
        histogram[0] = 0
        assert packing.Plan(histogram, 1024, 0).placed.sum() >= share * histogram.sum()


def test_least_squares_fits_a_solvable_histogram():
    histogram = np.zeros(100, np.int64)
    histogram[[30, 70, 50, 25]] = [40, 40, 10, 20]
    combos = packing.combinations(np.flatnonzero(histogram), 100)
    x = packing.repeat_counts(combos, histogram, 3000)
    used = np.bincount(combos.ravel(), np.repeat(x, 3), 100)[1:]
    assert (x >= 0).all() and np.abs(used - histogram[1:]).max() < 1


# ---- 8 line dedup

def lines_expected(rows):
    def key(line):
        return brute.lower(line.strip("\x20\t\n\x0b\x0c\r"))
    owner = {}
    for d, x in rows:
        for line in (x or "").split("\n"):
            owner[key(line)] = min(d, owner.get(key(line), d))
    out = {}
    for d, x in rows:
        lines = (x or "").split("\n")
        kept = [y for y in lines if len(key(y)) < 10 or owner[key(y)] == d]
        out[d] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup(docs, batches, fanout):
    got = found(line_runs.dedup_lines(docs, batches, fanout).select("doc_id", "text", "_n_lines", "_n_dropped"))
    assert got == lines_expected(ROWS)


def test_line_dedup_odd_cases(odd, empty):
    got = line_runs.dedup_lines(odd).collect()
    assert len(got) == 7 and all(r._n_dropped == 0 for r in got if r.doc_id in (None, 40, 41))
    assert line_runs.dedup_lines(empty).columns[:9] == empty.columns and line_runs.dedup_lines(empty).count() == 0


def test_lines_held_by_a_row_without_id(spark):
    """The line of a NULL row goes from the second of two documents in later batches; the NULL rows keep theirs."""
    line = "a line that several documents hold"
    rows = [(i, f"own line of document {i}") for i in range(40)] + [(50, f"{line}\nfifty"), (51, f"{line}\nfifty-one")]
    nulls = [(None, line), (None, f"{line}\n{line}")]
    got = line_runs.dedup_lines(frame(spark, rows + nulls)).select("doc_id", "text", "_n_lines", "_n_dropped").collect()
    assert {r[0]: tuple(r[1:]) for r in got if r[0] is not None} == lines_expected(rows)
    assert sorted(tuple(r[1:]) for r in got if r[0] is None) == [(line, 1, 0), (f"{line}\n{line}", 2, 0)]


# ---- 9 quality rules

def test_rule_counts(docs):
    got = found(quality_forest.rule_statistics(docs).select("doc_id", *quality_forest._COUNTS))
    assert got == {d: brute.rules(x)[:5] for d, x in ROWS}


def test_forest_finds_anomalies():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0, 1, (2000, 4)), rng.normal(8, 1, (40, 4))
    rows = np.concatenate([good, bad])
    a = quality_forest.Forest(rows, 100, 256, 1).score(rows)
    assert np.quantile(a[2000:], 0.1) > np.quantile(a[:2000], 0.99)


def test_quality_verdicts(spark):
    good = [(i, " ".join(f"word{(i * 7 + j) % 90}" for j in range(60))) for i in range(300)]
    bad = [(1000 + i, " ".join(f"w#%{j}$$&&" for j in range(i, i + 40))) for i in range(20)]
    labels = spark.createDataFrame([(d, 1) for d, _ in good[:200]] + [(d, 0) for d, _ in bad[::2]], "doc_id long, quality int")
    docs = frame(spark, good + bad + [(5000, None), (5001, "too short")])
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_forest.judge(docs, labels).collect()}
    assert all(got[d][1] for d, _ in good) and not any(got[d][1] for d, _ in bad)
    assert got[5000] == got[5001] == (True, False)
    kept = quality_forest.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, v in got.items() if v[1]}


def test_quality_odd_cases(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_forest.judge(odd, none).count() == 7 and quality_forest.judge(empty, none).count() == 0
    assert all(r.kept == (not r.base_failed) for r in quality_forest.judge(odd, none).collect())  # no labels: base rule only


# ---- 10 decontamination

ITEMS = [(0, ROWS[9][1][200:420]), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "one two"), (3, None),
         (4, ""), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]


def test_leaks(spark):
    text = "so Alpha, beta gamma; delta epsilon zeta eta -- theta iota kappa end"
    changed = "we say " + " ".join(f"w{i}" for i in range(30)) + " and so on"
    rows = ROWS + [(900, text), (901, changed.replace("w15", "xx")), (902, "alpha beta gamma other words here now")]
    items = ITEMS + [(7, " ".join(f"w{i}" for i in range(30)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.similarity)
           for r in decontaminate.contaminated(frame(spark, rows), benchmark).collect()}
    want = brute.leaks(rows, items)
    assert got == want and (900, 1) in got and (902, 1) not in got
    kept = decontaminate.decontaminate(frame(spark, rows), benchmark)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert kept.schema == frame(spark, rows).schema


def test_leaks_short_documents_and_repeated_shingles(spark):
    """Documents of fewer words than an item, and texts whose shingles repeat (where the fingerprint bound does not hold)."""
    item = " ".join(f"v{i}" for i in range(60))
    w = item.split()
    chant = " ".join(["da"] * 6 + [f"x{i}" for i in range(60)] + ["da"] * 6)
    rows = [(1, item), (2, " ".join(w[:-2])), (3, " ".join(w[5:])), (4, " ".join(w[:40])), (5, " ".join(w[:50])), (6, "v1 v2"),
            (7, chant.replace("x15", "y")), (8, "da " * 40), (9, " ".join(w[3:] + ["z"] * 200)), (10, "one two")]
    items = [(0, item), (1, chant), (2, "da " * 30), (3, "one two three four five six"), (4, "one two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.similarity)
           for r in decontaminate.contaminated(frame(spark, rows), benchmark).collect()}
    want = brute.leaks(rows, items)
    assert got == want and {(2, 0), (3, 0), (5, 0), (7, 1), (8, 2), (10, 4)} <= set(got) and (4, 0) not in got


def test_leaks_query(spark):
    from tessera.llm.queries import QUERIES
    at = "/root/testdata/sf0.001"
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{at}/{t}.parquet").select(c, "text").collect()]
                   for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, at).collect()}
    assert got == set(brute.leaks(rows, items)) and got


def test_hamming_index_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    items = decontaminate.Items(9, list(range(40)), [rng.integers(1 << 63, size=9).astype(np.uint64) for _ in range(40)])
    flips = np.zeros((500, decontaminate.BITS), np.uint8)
    for f in flips:
        f[rng.choice(decontaminate.BITS, rng.integers(0, 120), replace=False)] = 1
    prints = items.prints[np.arange(500) % 40] ^ np.packbits(flips, axis=1).view(np.uint32)
    w, i, d = items.candidates(prints, np.zeros(500, bool))
    bits = np.unpackbits((prints[:, None] ^ items.prints[None]).view(np.uint8).reshape(500, 40, -1), axis=2).sum(axis=2)
    assert set(zip(w.tolist(), i.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(bits <= items.radius))))
    assert (d == bits[w, i]).all()


def test_blocks_are_selective_and_lose_nothing_at_the_similarity():
    rng = np.random.default_rng(5)
    items = decontaminate.Items(30, list(range(300)), [rng.integers(1 << 63, size=30).astype(np.uint64) for _ in range(300)])
    other = np.concatenate([decontaminate.fingerprint(decontaminate.bit_signs(rng.integers(1 << 63, size=26).astype(np.uint64))
                                                      .sum(axis=0, dtype=np.int32, keepdims=True)) for _ in range(300)])
    passed = np.zeros((300, 300), bool)
    for b in range(decontaminate.BLOCKS):
        passed |= np.bitwise_count(other[:, b, None] ^ items.prints[None, :, b]) <= items.radius // decontaminate.BLOCKS
    assert passed.mean() < 0.015  # even numbers of shingles; 0.97 % with odd ones
    missed = 0
    for _ in range(2000):  # pairs at the threshold: 8 of 9 shingles shared
        n = int(rng.integers(9, 60))
        m = int(np.ceil(16 * n / 18 - 1e-9))
        g = rng.integers(1 << 63, size=2 * n - m).astype(np.uint64)
        a, b = (decontaminate.fingerprint(decontaminate.bit_signs(x).sum(axis=0, dtype=np.int32, keepdims=True))
                for x in (g[:n], np.concatenate([g[:m], g[n:]])))
        missed += int(np.bitwise_count(a ^ b).sum()) > items.radius
    assert missed == 0


def test_leaks_odd_cases(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(odd, none).count() == 0
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contaminated(empty, some).count() == 0
    assert decontaminate.decontaminate(odd, none).count() == 7
