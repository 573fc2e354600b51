"""Corpus operators on small tables: against SQL, brute force, and the edges of input."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, kneser_ney, log_bilinear, mixing, packing, queries, snapshots, token_files, url_rules
from gleaner.llm.line_rules import LineLimits, apply_line_rules
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_words long, shard string"
EDGES = [
    (1, None, "en", "a", 7, "x"), (2, "", None, None, 7, "x"), (3, "one two three", "en", "a", 7, "x"),
    (3, "one two three", "en", "a", 7, "x"), (None, "Tie tie\n tie", "de", None, 7, "x"),
    (5, "long word " * 20_000, "en", "b", 7, "x"), (6, "ünï cödé ✓ 日本", "fr", "b", None, None),
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, con, name):
    assert compare(spark, con, name, queries.QUERIES[name], queries.SQL[name], SF) is None


def operators(spark, edges):
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "two three"), (2, None), (2, ""), (None, "cödé")], "item_id long, text string")
    return {
        "mix": (lambda d: mixing.plan_mix(d), 0),
        "quality": (lambda d: kneser_ney.score_quality(d, labels), 0),
        "shards": (lambda d: packing.assign_shards(d), 0),
        "lines": (lambda d: apply_line_rules(d), 0),
        "benchmark": (lambda d: decontaminate.benchmark_hits(d, items, block_chars=8), 0),
        "scores": (lambda d: log_bilinear.score_texts(d, log_bilinear.LblSettings(outputs=3)), 0),
    }


@pytest.mark.parametrize("name", ["mix", "quality", "shards", "lines", "benchmark", "scores"])
def test_edges_of_input(spark, edges, name):
    """Nulls, empty and long texts, repeated rows, clashing names, and an empty table."""
    run, _ = operators(spark, edges)[name]
    got = run(edges)
    assert got.count() == len(EDGES) and len(set(got.columns)) == len(got.columns)
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 2, 3, 3, 5, 6]
    assert run(edges.limit(0)).count() == 0


def test_two_benchmark_blocks_find_the_same(spark, edges):
    run, _ = operators(spark, edges)["benchmark"]
    got = {r.doc_id: (r.n_hit, r["items"]) for r in run(edges).collect()}
    assert got[3] == (2, ["1"]) and got[6] == (1, [""]) and got[1] == (0, [])


def test_wu_manber_against_brute_force():
    r = np.random.default_rng(1)
    for m in (1, 2, 3, 10):
        patterns = np.unique(r.integers(1, 4, (30, m)).astype(np.int32), axis=0)
        seq = r.integers(0, 4, 3000).astype(np.int32)
        start, which = decontaminate.Searcher(patterns).search(seq)
        want = {(i, k) for i in range(len(seq) - m + 1) for k, p in enumerate(patterns) if (seq[i : i + m] == p).all()}
        assert set(zip(start.tolist(), which.tolist())) == want and len(start) == len(want)


def test_blocks_of_ids_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 127, 128, 129, 5000):
        for ids in (r.zipf(1.3, n) % 50257, np.full(n, 9), r.integers(0, 2**32, n), np.where(r.random(n) < 0.02, 2**32 - 1, 5)):
            ids = ids.astype(np.uint32)
            assert (token_files.unpack(*token_files.pack(ids), n) == ids).all()


def test_token_files(spark, tmp_path):
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    texts = ["a  b", "a   b", "\n  x", " x", "x ", "   ", "\n \nb", "a \nb", "<|endoftext|> a", "it's 'll don 't", "é ñ 1 22",
             "a " * 300, "z" * 500 + " y", "a\u0085 b", "日本 語", None, "", "half ½ x² ª", "two  ", "line\n ", "x  <|endoftext|>  y", "and, and,and and!? and.'s and,",
             "w,\u00a0x .\n, ğ, a\x1c b", "a. " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "same id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "t"), vocabulary, segment_ids=100)
    got = token_files.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    t = Tokenizer.from_file(vocabulary)
    want = Counter((d, tuple(t.encode(x, add_special_tokens=False).ids if x else ()) + (2,)) for d, x in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert got[-1].start == sum(len(ids) for _, ids in want.elements()) - got[-1].n_tokens
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: -1 if d is None else d)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens


def test_token_files_of_other_tokenizers_and_tables(spark, tmp_path):
    path = pytest.importorskip("public_tokenizers").path
    from tokenizers import Tokenizer

    texts = ["and, two  words", "A  b\n c", "", None, "x" * 5000 + " y", "é, ñ.", "low lower lowest"]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, part int, before string")
    assert token_files.parts_at_spaces(open(path("byte_bpe_50k.json"), encoding="utf-8").read())
    other = path("word_bpe_49k.json")
    assert not token_files.parts_at_spaces(open(other, encoding="utf-8").read())
    token_files.write_tokens(docs, str(tmp_path / "o"), other, end_id=7)
    got = token_files.read_tokens(spark, str(tmp_path / "o")).orderBy("doc_id").collect()
    t = Tokenizer.from_file(other)
    assert [r.ids for r in got] == [[*(t.encode(x, add_special_tokens=False).ids if x else []), 7] for x in texts]
    token_files.write_tokens(docs.limit(0), str(tmp_path / "e"), other)
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


def plain_best_fit(sizes, capacity, shards=None):
    left = [capacity] * (shards or 0)
    out = []
    for s in sorted(sizes, reverse=True):
        fits = [(x, b) for b, x in enumerate(left) if x >= s]
        if fits:
            b = min(fits)[1]
        elif shards:
            b = max((x, b) for b, x in enumerate(left))[1]
        else:
            left.append(capacity)
            b = len(left) - 1
        left[b] -= s
        out.append(s)
    return left


@pytest.mark.parametrize("shards", [None, 4])
def test_runs_are_best_fit_decreasing(shards):
    sizes = np.random.default_rng(2).integers(1, 60, 300).tolist()
    counts = Counter(sizes)
    runs = packing.best_fit([(s, n, s * n) for s, n in counts.items()], 200 if shards is None else -(-sum(sizes) // 4), shards)
    left = Counter()
    for s, a, b, shard in runs:
        left[shard] += s * (b - a)
    want = plain_best_fit(sizes, 200 if shards is None else -(-sum(sizes) // 4), shards)
    capacity = 200 if shards is None else -(-sum(sizes) // 4)
    assert sorted(left.values()) == sorted(capacity - x for x in want)
    assert sum(b - a for _, a, b, _ in runs) == 300


def test_sharding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.assign_shards(docs).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    largest = got.groupby("text")["size"].sum().max()
    assert sizes.max() - sizes.min() <= largest and set(got["shard"]) == set(range(8))
    assert got.groupby("text")["shard"].nunique().max() == 1
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert all(zlib.crc32(t.encode()) == c and len(t.encode()) + 1 == s for t, c, s in zip(got["text"], got["text_crc32"], got["size"]))


def test_no_shard_exceeds_its_capacity(spark):
    rows = [(i, f"{i:04d}" + "x" * (8995 + 3 * (i % 2))) for i in range(40)]  # 9,000 and 9,003 bytes are one class
    got = packing.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), None, capacity=18_003)
    sizes = got.groupBy("shard").agg(F.sum("size")).collect()
    assert max(r[1] for r in sizes) <= 18_003 and sum(r[1] for r in sizes) == 20 * (9_000 + 9_003)


def test_kneser_ney_sums_to_one(spark):
    texts = spark.createDataFrame([("a b a c",), ("a b b",), ("c a b",)], "text string")
    model = kneser_ney.train(texts, 2)
    words = [*(w for w in model.vocabulary if w != b"\x02" and w != b"\x03"), b"nobody"]
    for context in ([], ["a"], ["a", "b"], ["zzz", "b"]):
        n, whole = model.log_probs([" ".join([*context, w.decode()]) for w in words])
        # with the end instead of a word; the token behind is the end again, so take both out
        total = 0.0
        for w in words:
            seq = " ".join([*context, w.decode()])
            total += math.exp(step(model, seq, len(context)))
        total += math.exp(step(model, " ".join(context), len(context)))
        assert abs(total + start_mass(model, context) - 1) < 1e-4


def step(model, text, place):
    """Log-probability of the token at ``place`` of a text."""
    words = text.split()
    full = model.log_probs([" ".join(words)])[1][0]
    return full if place == 0 and not words else token_logs(model, words)[place]


def token_logs(model, words):
    ids = [model.vocabulary[b"\x02"]] * 2 + [model.vocabulary.get(w.encode(), 0) for w in words] + [model.vocabulary[b"\x03"]]
    seq = np.array(ids)
    h, known = model.hashes[seq], seq > 0
    pair = model.pairs.join(kneser_ney.gram_keys(h[:-1], h[1:]), known[:-1] & known[1:], [0.0, 1.0])
    triple = model.triples.join(kneser_ney.gram_keys(h[:-2], h[1:-1], h[2:]), known[:-2] & known[1:-1] & known[2:], [0.0])
    two = pair[1:, 0] + model.weight[seq[1:-1]] * model.base[seq[2:]]
    return np.log(triple[:, 0] + pair[:-1, 1] * two)


def start_mass(model, context):
    """The start symbol is in the vocabulary, and is never predicted but for its even share."""
    full = token_logs(model, [*context, "\x02"])
    return math.exp(full[len(context)])


def test_quality_finds_junk_and_keeps_clean(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = kneser_ney.score_quality(docs, labels).join(labels, "doc_id").toPandas()
    clean = got[(got["quality"] == 1) & (got["toxic"] == 0)]
    assert clean["kept"].mean() > 0.97 and got[got["quality"] == 0]["kept"].mean() < 0.3


def test_scores_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = log_bilinear.score_texts(docs, log_bilinear.LblSettings(outputs=300)).collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in got}
    words = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in got}
    counts = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in got:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == held[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words[r.doc_id]), sum(w in counts for w in words[r.doc_id]), n)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_log_bilinear_short_cuts_change_no_number():
    r = np.random.default_rng(1)
    model = log_bilinear.Lbl(np.sort(r.zipf(1.2, 3_000).clip(max=10**9).astype(float))[::-1] + 0.5, log_bilinear.LblSettings())
    draw = np.concatenate([r.random(5_000), model._steps, np.nextafter(model._steps, 0), [1 - 2**-53]]).reshape(-1, 1)
    assert np.array_equal(model._place(draw), np.searchsorted(model._steps, draw, side="right"))
    for at in ([0], [0, 1], [0, 0], [0, 1, 1, 2, 2, 2, 5], [0, 0, 3, 4, 4], np.sort(r.integers(0, 50, 400))):
        first = np.flatnonzero(np.diff(at, prepend=-1))
        values = r.standard_normal((len(at), 5)).astype(np.float32)
        assert np.array_equal(log_bilinear._sums(values, first), np.add.reduceat(values, first, axis=0))
    for size in (0.1, 5.0, 50.0):  # within the bound, within reach, and beyond a float
        h, v = r.standard_normal((200, 17)) * size, r.standard_normal((30, 17)) * size
        got = log_bilinear._log_sums(h.astype(np.float32), v.astype(np.float32))
        assert got == pytest.approx(np.logaddexp.reduce(h @ v.T, axis=1), rel=1e-3)


def test_log_bilinear_is_normalised_and_learns():
    """Over words of several classes, the class of other words and the end; a word that follows another gains."""
    settings = log_bilinear.LblSettings(width=4, batch=64)
    model = log_bilinear.Lbl(np.array([40, 30, 20, 10, 9, 8, 7, 5, 3, 6.5]), settings)
    assert (model.sizes > 1).any() and model.sizes.sum() == 10
    every = np.arange(10)
    before = model.log_probs(every, np.full(10, 3), np.full(10, 0))
    assert np.exp(before) == pytest.approx(model.prior, rel=0.9)
    r = np.random.default_rng(0)
    texts = [np.ravel([(x, 7) if x == 3 else (x, r.integers(0, 3)) for x in r.integers(0, 9, 30)]) for _ in range(200)]
    model.fit(iter(texts), (1,), chunk=1000)
    for a, b in ((0, 1), (10, 10), (1, 4), (3, 0)):
        assert np.exp(model.log_probs(every, np.full(10, a), np.full(10, b))).sum() == pytest.approx(1, abs=1e-5)
    after = model.log_probs(every, np.full(10, 3), np.full(10, 0))
    assert after[7] > before[7] + 1 and after.argmax() == 7


def test_scores_do_not_depend_on_partitions(spark):
    """Several groups and rounds, dealt by a hash: one partition or nine give the same scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    settings = log_bilinear.LblSettings(outputs=500, rounds=2, group_tokens=2_000)
    runs = [
        {r.doc_id: r.score for r in log_bilinear.score_texts(docs.repartition(n), settings, keep_text=False).collect()}
        for n in (1, 9)
    ]
    assert runs[0] == pytest.approx(runs[1], rel=1e-6)


def test_words_of_texts_are_those_of_the_contract():
    texts = [None, "", " \t ", " A b\x0bB\x1fx\r\n", "\u00a0Ü é\u2003É ", "x" * 50 + " y"] * 3
    got = []
    for distinct, codes, lengths in log_bilinear.words_of(texts, most=20):
        got += [[distinct[c] for c in part] for part in np.split(codes, np.cumsum(lengths)[:-1])]
    plain = [re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    assert got == [[w.encode() for w in words] for words in plain]


def test_averaging_over_many_groups_is_the_weighted_mean():
    """Sums of groups met in two steps equal those met in one; no touch, no weight."""
    r = np.random.default_rng(3)
    touches, rows = r.integers(0, 5, (130, 4)).astype(np.float64), r.random((130, 4, 3)).astype(np.float32)
    parts = pd.DataFrame({
        "block": 0, "part": range(130), "touches": [t.tobytes() for t in touches],
        "sums": [(t[:, None] * x).astype(np.float32).tobytes() for t, x in zip(touches, rows)],
    })
    some = pd.concat([log_bilinear._add(g) for _, g in parts.groupby(parts["part"] // log_bilinear.FAN)])
    got = log_bilinear._add(some)
    weight = np.frombuffer(got["touches"].iloc[0], np.float64)
    mean = np.frombuffer(got["sums"].iloc[0], np.float32).reshape(4, 3) / weight[:, None]
    assert weight.tolist() == touches.sum(axis=0).tolist()
    assert mean == pytest.approx((touches[:, :, None] * rows).sum(axis=0) / touches.sum(axis=0)[:, None], rel=1e-4)


def test_line_rules_remove_and_reject(spark):
    rows = [(i, "Common  LINE here\n" + " ".join(f"w{i}x{j}" for j in range(25 if i % 2 else 2)), "h") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in apply_line_rules(docs, LineLimits(max_docs=5, min_doc_words=3)).collect()}
    assert got[1].kept and not got[2].kept and got[1].common_words == 3 and got[1].cleaned == rows[1][1].split("\n")[1]


@pytest.mark.parametrize("host_rows", [60, 3_000])
def test_the_limit_of_lines_is_the_same_in_a_large_host(spark, host_rows):
    """A host with a third of all rows: 21 documents make a line common there too, 20 do not."""
    own = " ".join(f"w{j}" for j in range(30))
    rows = [(i, f"{own} {i}\n" + ("shared by more" if i < 21 else "shared by less" if i < 41 else f"own {i}"), "hot") for i in range(host_rows)]
    rows += [(i, f"{own} {i}", f"h{i % 50}") for i in range(host_rows, 3 * host_rows)]
    got = apply_line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    assert {r.doc_id for r in got if r.n_common_lines} == set(range(21)) and all(r.kept for r in got)


def test_snapshots(spark):
    rows = [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "b", "c"), (3, 0, "u", "a"), (3, 1, "b", "c"), (4, 0, "u", "z"),
            (None, 0, "u", "z"), (5, 0, None, None), (6, 0, "u", "a"), (6, 0, "u", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in snapshots.collapse(turns).collect()}
    assert got.pop(2) == (2, 2, "<|u|>\na\n<|b|>\nc") and got.pop(6)[:2] == (2, 1) and got.pop(5) == (1, 1, "<||>\n")
    assert list(got.values()) == [(1, 2, "<|u|>\nz")]
    assert snapshots.collapse(turns.limit(0)).count() == 0


def test_hot_conversations_are_spread(spark):
    """One conversation and the turns without id hold most rows; names of helper columns clash."""
    rows = [(c, t, "u", f"{c} {t}") for c in (1, None) for t in range(120)] + [(2, t, "u", f"1 {t}") for t in range(60)]
    rows += [(c, t, "b", "x" * c) for c in range(3, 40) for t in range(3)] + [(3, 3, "b", "long " * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "turn AS pos", "role AS key", "1 AS l0")
    plain = {tuple(r) for r in snapshots.collapse(turns, 50).collect()}
    assert {tuple(r) for r in snapshots.collapse(turns, 50, min_rows=20, join_rows=20).collect()} == plain
    got = {(r[0], r[1]): r[4] for r in plain}
    for c in (1, None):
        assert "\n".join(got[c, p] for p in range(3)) == "\n".join(f"<|u|>\n{c} {t}" for t in range(120))
    assert (2, 0) not in got and got[3, 0].endswith("long " * 50_000) and len(got) == 6 + 37


def test_urls(spark):
    rules = spark.createDataFrame([("b.org", "/", "block"), ("org", "/x", "allow"), ("org", "/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    rows = [(1, "http://A.b.org/x?y", "p"), (2, None, "p"), (3, "x", "p"), (4, "s://borg/", "p"), (5, "h://b.org", "p"), (5, "h://b.org", "p"), (6, "h://c.org/xy", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, path string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules).collect()]
    assert sorted(got) == [(1, "a.b.org", "/x", "b.org/", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
                           (4, "borg", "/", None, "allow"), (5, "b.org", "", None, "allow"), (5, "b.org", "", None, "allow"), (6, "c.org", "/xy", "org/x", "allow")]
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0 and url_rules.judge_urls(pages, rules.limit(0)).count() == 7


def test_mix_order_and_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    places = [r.position for r in mixing.mix(docs).select("position").collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    planned = mixing.plan_mix(docs).groupBy("source").agg(F.sum("taken"), F.first("target"), F.max("size")).collect()
    assert all(abs(r[1] - r[2]) <= r[3] for r in planned)
    for knots in mixing.SCHEDULES:
        got = [r[0] for r in spark.range(11).select(mixing._invert(F.col("id") / 10, knots)).collect()]
        for share, t in zip(range(11), got):
            xs = np.linspace(0, t, 2001)
            assert np.trapezoid(np.interp(xs, *zip(*knots)), xs) == pytest.approx(share / 10, abs=1e-6)


def test_rows_of_one_id_have_a_fixed_order(spark):
    texts = ["a b c d", "aaaaaaa", "a b ccc", "aa aaaa"]  # of one length, of other counts of words
    plans = []
    for rows in (texts, texts[::-1]):
        docs = spark.createDataFrame([(1, t, "s") for t in rows], "doc_id long, text string, source string").coalesce(1)
        plans.append({r.text: r.positions for r in mixing.plan_mix(docs).collect()})
    assert plans[0] == plans[1]


def test_a_model_of_more_text_is_sharded_and_counts_all_of_it(spark, edges, monkeypatch):
    monkeypatch.setattr(kneser_ney.sharded, "SLICE_CHARS", 60_000)
    monkeypatch.setattr(kneser_ney.sharded, "BUCKET_GRAMS", 3_000)
    monkeypatch.setattr(kneser_ney.sharded, "PACK_BYTES", 50_000)
    own, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = own.select(F.col("doc_id") + 100, "text", "lang").toDF("doc_id", "text", "lang").unionByName(edges.select("doc_id", "text", "lang"))
    labels = labels.select(F.col("doc_id") + 100, "quality", "toxic").toDF("doc_id", "quality", "toxic")
    labels = labels.unionByName(spark.createDataFrame([(i, 1, None) for i in (1, 2, 3, 5, 6)], "doc_id long, quality int, toxic int"))
    names = ["doc_id", "text", "lang", "n_tokens", "log_prob", "threshold", "kept"]

    def scored(chars):
        got = kneser_ney.score_quality(docs, labels, kneser_ney.QualityModel(train_chars=chars)).select(names).toPandas()
        return got.sort_values(["doc_id", "text", "lang"]).reset_index(drop=True)

    whole, shards = scored(10**9), scored(1)
    assert len(whole) == docs.count()
    pd.testing.assert_frame_equal(whole, shards, rtol=1e-5)


def test_only_its_own_scratch_tables_are_dropped(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "given"))
    given, tables = spark.read.parquet(str(tmp_path / "given")), kneser_ney.sharded._Tables(spark)
    with pytest.raises(KeyError):
        tables.drop(given)
    with pytest.raises(ValueError):
        kneser_ney.sharded._delete(spark, str(tmp_path / "given"))
    tables.drop(tables.add(given, "own"))
    assert given.count() == 3
