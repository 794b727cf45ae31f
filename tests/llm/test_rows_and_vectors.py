"""Sharding, top-k search, packing and language-model scoring against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowtable.llm import ngram_bloom, packing, sharding, topk, wordcodes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, None, "s", None, 7, 0.5) for i, t in enumerate(texts)], DOCS)


# -- sharding

@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 1000])
def test_ring_is_even_and_slots_are_gapless(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), F.lit(1).alias("shard"))
    rows = sharding.shard_rows(df, ["k"], shards=16).collect()
    per = Counter(r["shard"] for r in rows)
    assert sorted(r["k"] for r in rows) == list(range(n))
    assert not n or max(per.values()) - min(per.get(s, 0) for s in range(16)) <= 1
    for s in per:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(per[s]))


def test_repeated_and_null_keys_are_dealt_out(spark):
    df = spark.createDataFrame([(1,)] * 700 + [(None,)] * 300, "k long")
    per = Counter(r["shard"] for r in sharding.shard_rows(df, ["k"], shards=4).collect())
    assert per == {0: 250, 1: 250, 2: 250, 3: 250}


def test_slack_keeps_most_rows_in_place_when_a_shard_joins(spark):
    df = spark.range(4000).select(F.col("id").alias("k"))
    before = {r["k"]: r["shard"] for r in sharding.shard_rows(df, ["k"], shards=8, load=1.25).collect()}
    after = {r["k"]: r["shard"] for r in sharding.shard_rows(df, ["k"], shards=9, load=1.25).collect()}
    assert max(Counter(after.values()).values()) <= -(-5 * 4000 // (4 * 9))
    moved = sum(before[k] != after[k] for k in before)
    assert 4000 / 9 * 0.5 < moved < 4000 * 0.35


def test_full_shards_pass_rows_on_clockwise():
    nodes = [(2, 0), (5, 1), (9, 2)]
    runs = sharding.place_cells({1: 5, 4: 1, 8: 0}, nodes, [3, 3, 3])
    assert runs == [(1, 0, 3, 0, 0), (4, 0, 1, 1, 0), (1, 3, 5, 1, 1)]


# -- top-k

def brute_top_k(rows, queries, k):
    out = []
    for qid, q in queries:
        best = sorted(((-sum(int(a) * int(b) for a, b in zip(q, v)), i) for i, v in rows if i != qid))[:k]
        out += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("spread,scale", [(5, 1), (2000, 1), (10, 10**8)])
def test_top_k_equals_brute_force(spark, spread, scale):
    rng = np.random.default_rng(1)
    rows = [(i, [int(x) * scale for x in rng.integers(-spread, spread + 1, 6)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # ties
    df = spark.createDataFrame(rows, "id long, v array<bigint>")
    got = topk.top_k(df, "id", F.col("v"), F.col("id") % 100 == 0, k=7, block_vectors=64, block_queries=3)
    queries = [r for r in rows if r[0] % 100 == 0]
    assert sorted(tuple(r) for r in got.collect()) == brute_top_k(rows, queries, 7)


def test_vectors_that_take_no_part(spark, tmp_path):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, None], 1), (2, None, 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
            (5, [0.25, -0.0001], 1), (5, [0.25, -0.0001], 1), (None, [9.0, 9.0], 1), (6, [], 1), (100, [2.0, 2.0], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in topk.op2_va_topk(spark, str(tmp_path)).collect())
    ints = {0: [1024, 512], 5: [256, -1], 6: [0, 0], 100: [2048, 2048]}
    assert got == brute_top_k(list(ints.items()), [(0, ints[0]), (100, ints[100])], 10)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, v array<bigint>")
    assert topk.top_k(empty, "id", F.col("v"), F.lit(True)).collect() == []


# -- packing

def test_words_before_punctuation_are_coded_once():
    path = public_tokenizers.path("word_bpe_49k.json")
    codes, tokenizer = wordcodes.WordCodes(path), Tokenizer.from_file(path)
    letters = wordcodes.LETTERS
    texts = ["word word, word. Word!? (word) word's, x1, é, née née, \u00c9t\u00e9. ...", None, "a,b,c,, <|endoftext|>, word<|, WORD<|> A,",
             "\u0130, ﬁne, n\u0303o, \u0958a a\u0958 \u212b\u212b, ªº µm σας ΣΑΣ. 漢字, 漢字", letters + "! " + " ".join(letters), "",
             " ".join(x + y + z for x in letters for y in letters[::7] for z in ("", ".", "$$$"))]
    got = list(codes.encode(pa.array(texts)))
    assert [x.tolist() for x in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert {b"word", b",", b"."} <= codes.words.keys() and not {b"word,", b"word."} & codes.words.keys()
    assert codes.bare is not codes.tokenizer


TEXTS = ["", None, "  ", "One fine day, it's 12:30!", "<|endoftext|> <|STARTOFTEXT|> x", "İstanbul ﬁne ét x y\x1cz 漢字",
         "Wörter, die: wiederkehren.", "a " * 9000, "tail piece here " * 900, "'s 'T re've"]


def check_pieces(rows, texts, window):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for t in texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    assert sum(want.values()) == len(by_doc)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("window,shard", [(4096, 1 << 21), (64, 200)])
def test_each_id_lies_in_one_piece_and_nothing_is_padded(spark, window, shard):
    got = packing.pack_documents(docs_of(spark, TEXTS), public_tokenizers.path("word_bpe_49k.json"), window, shard)
    check_pieces(got.collect(), TEXTS, window)


def test_repeated_rows_and_no_rows_are_packed(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    two = docs_of(spark, ["same text"]).union(docs_of(spark, ["same text"]))
    assert packing.pack_documents(two, path).agg(F.sum("length")).first()[0] == 6
    assert packing.pack_documents(docs_of(spark, []), path).collect() == []


def test_neighbours_share_a_window():
    rng = np.random.default_rng(0)
    topics = [rng.integers(1000 * t, 1000 * t + 60, 30).astype(np.uint16) for t in range(8) for _ in range(4)]
    order = rng.permutation(len(topics))
    df = np.bincount(np.concatenate([np.unique(t) for t in topics]), minlength=1 << 16)
    idf = np.log1p((len(topics) - df + 0.5) / (df + 0.5)).astype(np.float32)
    windows = list(packing.pack_shard([topics[i] for i in order], idf, 30.0, 120))
    assert all(len({int(order[d]) // 4 for d, _, _ in w}) == 1 for w in windows)


def test_power_cuts_lose_nothing():
    cuts = list(packing.power_cuts([(0, 5, 40), (1, 0, 100), (2, 7, 9)]))
    assert [sum(hi - lo for _, lo, hi in c) for c in cuts] == [128, 8, 1]
    assert sorted(x for c in cuts for d, lo, hi in c for x in [(d, i) for i in range(lo, hi)]) == sorted(
        [(0, i) for i in range(5, 40)] + [(1, i) for i in range(100)] + [(2, i) for i in range(7, 9)])


# -- language-model scoring

LM_TEXTS = ["the cat sat on the mat", "The CAT sat", "", None, "the\tcat\nran \x0b on", "dog " * 300, "unknown words only here", "the cat sat on the mat"] * 3


def exact_scores(texts, training, order):
    words = [(t or "").encode().lower().split() + [b""] for t in texts]

    def grams(ws, n):
        padded = [None] * (n - 1) + ws
        return [tuple(padded[i:i + n]) for i in range(len(ws))]

    count = Counter(g for ws, learn in zip(words, training) if learn for n in range(1, order + 1) for g in grams(ws, n))
    n_tokens = sum(c for g, c in count.items() if len(g) == 1)
    v = sum(1 for g in count if len(g) == 1)
    for n in range(1, order):
        count[(None,) * n] = sum(training)  # texts begin with start marks

    def level(c):
        return 1 + math.floor(math.log(c) / math.log(ngram_bloom.BASE) + 1e-9) if c else 0

    def low(c):
        return math.ceil(ngram_bloom.BASE ** (level(c) - 1) - 1e-9) if c else 0

    def high(c):
        return max(math.ceil(ngram_bloom.BASE ** level(c) - 1e-9) - 1, 1) if c else 0
    out = []
    for ws in words:
        base = [math.log10((count[(w,)] + 1) / (n_tokens + v + 1)) for w in ws]
        p = [10 ** b for b in base]
        for n in range(2, order + 1):
            prior = ngram_bloom.PRIORS[min(n - 2, 1)]
            for i, g in enumerate(grams(ws, n)):
                evidence, context = low(count[g]), count[g[:-1]] if n == 2 else high(count[g[:-1]])
                p[i] = (evidence + prior * p[i]) / (max(context, evidence) + prior)
        out.append((len(ws), sum(count[(w,)] > 0 for w in ws), n_tokens, sum(base), sum(map(math.log10, p))))
    return out


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("rounds", [1, 3])
def test_scores_equal_exact_counts_with_a_large_filter(spark, rounds, order, monkeypatch):
    monkeypatch.setattr(ngram_bloom, "BLOCK_TOKENS", 100)
    training = [i % 4 != 1 for i in range(len(LM_TEXTS))]
    bits = 200_000 if rounds == 1 else 3 * 32 * (1 << 18) // 600
    df = docs_of(spark, LM_TEXTS).repartition(2)
    got = ngram_bloom.score_documents(df, F.col("doc_id") % 4 != 1, order, bits_a_token=bits, round_bytes=1 << 20 if rounds > 1 else 1 << 28)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == len(LM_TEXTS)
    for i, want in enumerate(exact_scores(LM_TEXTS, training, order)):
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["held_out"] == (not training[i])
        assert r["base_score"] == pytest.approx(want[3]) and r["score"] == pytest.approx(want[4])


def test_the_query_learns_trigrams(spark, tmp_path):
    texts = ["a b c", "x b d"] * 400 + ["a b c", "x b c"]  # both end in "b c"; only "a b c" is known
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["score"] for r in ngram_bloom.op4_bloom_lm(spark, str(tmp_path)).collect()}
    by_pairs = {r["doc_id"]: r["score"] for r in ngram_bloom.score_documents(
        spark.read.parquet(str(tmp_path / "documents.parquet")), F.crc32(F.col("doc_id").cast("string")) % 7 != 2, 2).collect()}
    assert by_pairs[800] == pytest.approx(by_pairs[801], abs=0.1)
    assert got[800] > got[801] + 0.5


def test_no_machine_holds_the_filter(spark, monkeypatch):
    def whole(self, value):
        raise AssertionError("the filter is sent whole to every worker")

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", whole)
    training = [i % 4 != 1 for i in range(len(LM_TEXTS))]
    got = ngram_bloom.score_documents(docs_of(spark, LM_TEXTS), F.col("doc_id") % 4 != 1, 3, bits_a_token=200_000)
    rows = {r["doc_id"]: r["score"] for r in got.collect()}
    assert [rows[i] for i in range(len(LM_TEXTS))] == pytest.approx([x[4] for x in exact_scores(LM_TEXTS, training, 3)])


def test_a_part_is_probed_for_all_ngrams_routed_to_it():
    rng = np.random.default_rng(5)
    segments, rows, counts = 2 * ngram_bloom.PART_SEGMENTS, [], Counter()
    for block in range(3):
        for size in (2, 3):
            h = np.unique(rng.integers(0, 40_000, 3000, dtype=np.uint64) << np.uint64(49) | np.uint64(size << 20))
            n = rng.integers(0, 3, len(h))  # 0: in held-out texts alone
            counts.update(dict(zip(h.tolist(), n.tolist())))
            rows += [(p, size, block, h[s], n[s]) for p, s in ngram_bloom._slices(h, segments, ngram_bloom.PART_SEGMENTS)]
    rows.sort(key=lambda r: r[0])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64()))]
        + [pa.array([ngram_bloom.squeeze_sorted(r[3]) for r in rows]), pa.array([ngram_bloom.squeeze(r[4]) for r in rows])],
        ["part", "size", "block", "h", "n"])
    got = {}
    for b in ngram_bloom._fill_and_probe(segments)(iter([batch])):
        got.update({(r["part"], r["size"], r["block"]): ngram_bloom.unsqueeze(r["found"]) for r in b.to_pylist()})
    assert len(got) == len(rows) == 12
    held = np.concatenate([got[r[:3]] for r in rows])
    count = np.array([counts[x] for r in rows for x in r[3].tolist()])
    want = ngram_bloom._levels(count)
    assert (held >= want).all() and (held > want).mean() < 0.01 and (want == 0).any()


def test_scores_without_training_or_rows(spark):
    none = ngram_bloom.score_documents(docs_of(spark, ["a b"]), F.lit(False)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in none] == [(3, 0, 0, 0.0)]
    assert ngram_bloom.score_documents(docs_of(spark, []), F.lit(True)).collect() == []


@pytest.mark.parametrize("together", [(1, 1), (40, 3), (1 << 20, 1 << 17)])
def test_tokens_are_the_words_between_white_space(together, monkeypatch):
    monkeypatch.setattr(ngram_bloom, "SPLIT_BYTES", together[0])
    monkeypatch.setattr(ngram_bloom, "SPLIT_WORDS", together[1])
    edges = ["q" * n for n in (1, 7, 8, 9, 63, 64, 65, 100, 101)]  # around the bytes mixed in at a time
    texts = [None, "", " \t", "  A b\tC\x0bd\x0c e\r\n", "\u00dcn\u00ef \u00c9c\x1cole\u00a0z", " ".join(edges).upper(), "a b " * 500, *edges, "z"]
    want = [(t or "").encode().lower().split() + [b""] for t in texts]
    got = [x.tolist() for x in ngram_bloom.text_tokens(pa.array(texts, pa.string()))]
    assert [len(x) for x in got] == [len(x) for x in want]
    pairs = {(w, h) for ws, hs in zip(want, got) for w, h in zip(ws, hs)}
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    assert list(ngram_bloom.text_tokens(pa.array([], pa.string()))) == []


def test_filter_never_underestimates_and_seldom_overestimates():
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 32, 20_000, dtype=np.uint64))
    count = rng.integers(1, 400, len(h))
    bits = np.frombuffer(ngram_bloom.fill_segment(h[:600], count[:600]), np.uint8)
    held = ngram_bloom.probe(bits, 0, 1, h[:600])
    assert (held >= ngram_bloom._levels(count[:600])).all()
    absent = ngram_bloom.probe(bits, 0, 1, h[600:])
    assert (absent > 0).mean() < 0.08


def test_squeezed_numbers_come_back():
    x = np.sort(np.random.default_rng(0).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (ngram_bloom.unsqueeze(ngram_bloom.squeeze(x)) == x).all()
    assert (ngram_bloom.unsqueeze_sorted(ngram_bloom.squeeze_sorted(x)) == x).all()
    assert len(ngram_bloom.unsqueeze(ngram_bloom.squeeze(x[:0]))) == 0
