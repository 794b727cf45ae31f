"""Token counts, piece codec, near duplicates, language ID, quality rules and HTML against brute force."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from flowtable.llm import htmltext, langid, minhash, rules
from flowtable.llm.components import components
from flowtable.llm.piece_codec import decode_ids, encode_texts, op5_piece_codec
from flowtable.llm.token_counts import count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


# -- token counts and codec

@pytest.fixture(scope="module")
def unigram():
    """A public library's unigram tokenizer over the same pieces and scores."""
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    t = Tokenizer(models.Unigram([(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())], unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


PIECE_TEXTS = ["", None, "a", " ", "  two  spaces ", "line\nbreak\ttab", "漢字 и кириллица 😀😀", "x" * 3000, "ing " * 2000, "\x00\x01", "Ünïcödé-text, done."]


def test_ids_and_counts_equal_the_library_and_decode_back(spark, unigram):
    texts = PIECE_TEXTS + [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens_x int").repartition(3)
    want = [unigram.encode(" " + t).ids if t else [] for t in texts]
    coded = encode_texts(df, MODEL)
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == dict(enumerate(want))
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, MODEL).collect()} == {i: len(w) for i, w in enumerate(want)}
    assert {r["doc_id"]: r["text"] for r in decode_ids(coded, MODEL).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_round_trip_of_all_documents(spark):
    rows = op5_piece_codec(spark, SMALL).agg(F.count("*"), F.count_if("round_trip")).first()
    assert rows[0] == rows[1] > 0


def test_marks_in_a_text_are_spaces_and_no_rows_give_none(spark):
    df = spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    assert decode_ids(encode_texts(df, MODEL), MODEL).first()["text"] == "a b"
    assert encode_texts(df.limit(0), MODEL).count() == 0 == count_tokens(df.limit(0), MODEL).count()


# -- near duplicates

def test_clashing_and_odd_columns_pass_through_counts_and_codec(spark):
    df = spark.createDataFrame([("a b", 7, [1], {"x y": 2}, "t"), (None, None, None, None, None)],
                               "text string, N_Tokens long, ids array<int>, `a.b` struct<`x y`:int>, `q``t` string")
    counted = count_tokens(df, MODEL)
    assert counted.columns == ["ids", "a.b", "q`t", "n_tokens"]
    assert [r["n_tokens"] for r in counted.collect()] == [len(r["ids"]) for r in encode_texts(df, MODEL).collect()]
    coded = encode_texts(df, MODEL)
    assert coded.columns == ["N_Tokens", "a.b", "q`t", "ids"] and coded.first()["a.b"]["x y"] == 2
    back = decode_ids(coded.drop("q`t").withColumn("text", F.lit("old")), MODEL)
    assert [r["text"] for r in back.collect()] == ["a b", ""] and back.columns == ["N_Tokens", "a.b", "text"]


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = {k: lo if v == hi else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [0, 1])
def test_groups_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for g in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 120]))]
        texts += [edited(rng, base, rng.randrange(0, 8)) for _ in range(14)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    texts += [edited(rng, base, rng.randrange(0, 7)) for _ in range(70)]  # a larger group
    texts += [" ".join([rng.choice(vocabulary) for _ in range(20)] + passage) for _ in range(20)]
    texts += ["", None, "  \n", "one", "ONE", "one two", "One\tTwo"] + [texts[3]] * 5 + [texts[3].upper()]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, component_id int, rep string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("n", [2, 5, 60])
def test_the_match_threshold_holds_in_groups_of_every_size(n):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.sort(np.append(base, x)) for x in rng.integers(0, 1 << 63, n, dtype=np.uint64)]
    one = np.zeros(n, dtype=int)
    assert len(minhash.link_group(sets, one, 75)) == n - 1
    assert minhash.link_group(sets, one, 75, matches=minhash.COORDINATES + 1) == []


def test_blocks_of_a_large_group_meet(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, edited(rng, base, rng.randrange(0, 6))) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_shared_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(7, "a b c d e f"), (7, "other words entirely here now"), (9, "a b c d e f"), (None, "a b c d e f"),
                                (None, "nobody else says this at all")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["kept"]) for r in minhash.near_duplicates(df).collect()))
    assert got == [(-1, 2, -1, True), (-1, 2, 7, False), (7, 1, 7, True), (7, 2, 7, True), (9, 2, 7, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_chain_a_star_and_no_links(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(99, 130), (130, 129), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 99 for i in range(99, 131)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    import flowtable.llm.components as module

    rounds, materialize = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: rounds.append(name) or materialize(df, name))
    chain = spark.range(1000).selectExpr("id AS a", "id + 1 AS b")  # ascending
    assert {tuple(r)[1] for r in components(chain).collect()} == {0}
    assert rounds.count("small") <= 12


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(7, 400 + i) for i in range(60)] + [(None, 3)]
    label = {n: n for e in edges for n in e if n is not None}
    for _ in label:
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    linked = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in label.items() if n in linked}


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    same = []
    for _ in range(200):
        x = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        y = np.concatenate([x[:343], rng.integers(0, 1 << 63, 57, dtype=np.uint64)])  # similarity 0.75
        same.append((minhash.signature(np.sort(x)) == minhash.signature(np.sort(y))).sum())
    assert min(same) >= minhash.MATCHES
    assert abs(np.mean(same) - minhash.COORDINATES * 0.75 ** minhash.ROWS) < 1


# -- language ID

def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.lit(1)).withColumn("row", F.lit("x"))
    model = langid.train(docs.where(~langid.held_out_rows()))
    asked = docs.where(langid.held_out_rows())
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 + 34 = ?!"), (-4, "the and of " * 200_000)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r for r in langid.identify(asked.unionByName(extra, allowMissingColumns=True), model).collect()}
    true = {r["doc_id"]: r["lang"] for r in asked.select("doc_id", "lang").collect()}
    assert np.mean([got[i]["lang_pred"] == true[i] for i in true]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[-i]["lang_pred"] for i in (1, 2, 3, 4)] == ["und", "und", "und", "en"]


def test_margins_are_the_same_alone_in_a_batch_and_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(langid.FEATURES, 3)).astype(np.float32)
    texts = ["Straße nach Köln", "", "é" * 50, "a b c d " * 40, "x"]
    together, some = langid.margins_of(texts, weights)
    for i, t in enumerate(texts):
        found = langid.features(t)
        want = np.zeros(3) if found is None else found[1] @ weights[found[0]]
        assert np.allclose(langid.margins_of([t], weights)[0][0], together[i], atol=1e-4)
        assert np.allclose(want, together[i], atol=1e-4) and some[i] == (found is not None)
    monkeypatch.setattr(langid, "CHUNK", 16)
    assert np.allclose(langid.margins_of(texts, weights)[0], together, atol=1e-4)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, None, "hello")], "doc_id long, lang string, text string")
    assert langid.train(df) is None
    assert langid.identify(df, None).first()["lang_pred"] == "und"
    assert langid.identify(df.limit(0), None).count() == 0
    one = langid.train(spark.createDataFrame([("xx", "hello you"), ("xx", "good day")], "lang string, text string"))
    assert langid.identify(df, one).first()["lang_pred"] == "xx"


def test_copies_are_one_text_of_the_sample(spark, monkeypatch):
    rows = [(lang, f"{word} {'xyz'[i % 3]}{chr(97 + i // 3)}") for lang, word in (("aa", "uno"), ("bb", "dos")) for i in range(40)]
    rows += [("aa", rows[i][1]) for i in range(40) for _ in range(50)]
    learned = []
    monkeypatch.setattr(langid, "fit", lambda found: learned.extend(found))
    langid.train(spark.createDataFrame(rows, "lang string, text string"), sample_rows=30)
    assert [sum(r[0] == lang for r in learned) for lang in ("aa", "bb")] == [30, 30]
    assert len({(r[0], r[1].tobytes(), r[2].tobytes()) for r in learned}) == 60


def test_no_language_is_left_out(spark, monkeypatch):
    learned = []
    monkeypatch.setattr(langid, "fit", lambda found: learned.extend(found))
    langid.train(spark.range(700).selectExpr("concat('l', id) AS lang", "concat('text ', id) AS text"))
    assert len({r[0] for r in learned}) == 700


def test_families_are_told_apart_first():
    assert langid.family("de") == langid.family("en-GB") != langid.family("fr") == langid.family("es")
    assert langid.family("tlh") == "tlh"


# -- quality rules

def brute_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    covered = {j for found in places.values() if len(found) > 1 for i in found for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_brute_force(spark):
    rng = random.Random(0)
    texts = [None, "", " \n\t", "a", "same\nsame\nsame\n\n", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 9, "x " * 8, "😀 é #*$%&|<>\x0b\x0cz\x85q"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 120))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").select("doc_id", "text")
    got = {r["doc_id"]: tuple(r[c] for c in STATISTICS) for r in rules.with_statistics(df, F.col("doc_id")).collect()}
    assert got == {i: brute_statistics(t) for i, t in enumerate(texts)}


def test_a_list_is_learned_and_decides(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(5))
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(word() + ("$$$" if bad else "") for _ in range(60))
        rows.append((i, text, True))
        labels.append((i, 0 if bad else 1, None))
    rows += [(1000, None, False), (1000, "few words", False), (None, " ".join(word() for _ in range(50)), True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    marks = spark.createDataFrame(labels + [(None, 0, 1), (5, None, 1), (99999, 0, 1)], "doc_id long, quality int, n_words int")
    got = rules.quality_verdicts(docs, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["row"]["doc_id"]
        want = (i is None) or (i < 1000 and i % 4 != 0)
        assert r["kept"] == want and r["base_failed"] == (i == 1000)
    no_labels = rules.quality_verdicts(docs, marks.limit(0))
    assert no_labels.where("kept").count() == 401
    assert rules.quality_verdicts(docs.limit(0), marks).count() == 0


def test_rules_are_ordered_and_need_precision():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.8) | ((x["b"] < 0.3) & (x["a"] < 0.2))
    part = np.arange(3000) % 3 != 2
    found = rules.learn_decision_list(x, bad, part)
    hit = np.zeros(3000, dtype=bool)
    for rule in found:
        hit |= rules._cover(rule, x, 3000)
    assert (hit == bad).mean() > 0.97 and len(found) >= 2
    assert rules.learn_decision_list(x, rng.random(3000) < 0.1, part) == []


# -- HTML

def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


CASES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    (page("<nav><a>menu</a></nav><article><h1>T</h1><p>one  two\n three<p><b>four</b>ty<br>five</article><footer>f"), "T\none two three\nfourty five"),
    (page("<header>h</header><main><p>x &lt;b&gt; &#233;</p><!-- c --><aside>side</aside><form><p>in</p></form><p>y</main>"), "x <b> é\ny"),
    (page("<article><p>a</p><div class='ad'>buy</div><div id=comments><p>nice!</p></div><ul><li>i<li>j</ul><table><tr><td>c1<td>c2</table>"), "a\ni\nj\nc1\nc2"),
    (page("<div class='cookie-notice'>ok?</div><div id='content'><p>body text of the page</p></div><div class=sidebar>s</div>"), "body text of the page"),
    (page("<article><p>broken <a href='x>link</a> <i>still"), "broken link still"),
    ("<article><p>cut off in a tag <b", "cut off in a tag <b"),
    (page("<article><script>if (a < b) document.write('<p>no</p>')</script><p hidden>no</p><div style='display: none'>no</div><p>yes 1 < 2</p></article>"), "yes 1 < 2"),
]


def test_main_text_of_pages(spark):
    rows = [(i, f"http://h{i}.example/x", h, "t") for i, (h, _) in enumerate(CASES)]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: t for i, (_, t) in enumerate(CASES)}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def blocks_of(source):
    return [t for t in htmltext.text_without(htmltext.read_page(source), set()).split("\n") if t]


@pytest.mark.parametrize("source", [
    "<html class='no-js hidden-nav'><body><p>text</p></body></html>",
    "<html><body class='has-sidebar'><p>text</p></body></html>",
    "<html><body class='has-sidebar' id=menu><div class='content'><p>text</p></div></body></html>",
    "<html><body><main class='content with-sidebar'><p>text</p></main></body></html>",
    "<html class='cookie'><body class='footer'><main id='widget'><article><p>text</p></article></main></body></html>",
])
def test_body_html_and_main_are_content_whatever_their_classes(source):
    assert blocks_of(source) == ["text"]


def test_inline_chrome_words_still_count():
    assert blocks_of("<article><p>a <span class='ad'>b</span></p></article>") == ["a b"]
    assert blocks_of("<article><div class='ad'><p>b</p></div><p>a</p></article>") == ["a"]


@pytest.mark.parametrize("head", ["<title-bar>t</title-bar>", "<object-view>t</object-view>", "<select-box>t</select-box>", "<svg-icon>t</svg-icon>"])
def test_text_of_and_behind_names_that_begin_like_raw_ones(head):
    assert blocks_of(f"<body><article><p>a</p>{head}<p>b</p></article></body>") == ["a", "t", "b"]


@pytest.mark.parametrize("empty", ["<svg/>", "<svg />", "<svg class='i' data-x='>'/>", "<SVG width='1' />", "<math/>", "<math display='block' />",
                                   "<svg>x</svg>", "<svg a='/'>x</svg>", "<svg viewBox='0'><path d='M0'/><text>x</text></svg>"])
def test_text_behind_svg_and_math(empty):
    assert " ".join(blocks_of(f"<body><article><p>a {empty} b</p><p>c</p></article></body>")) == "a b c"


def test_formulas_are_text_of_their_paragraph():
    formula = "<math><mrow><mi>x</mi><mo>=</mo><mspace width='1em'/><mn>2</mn></mrow></math>"
    assert blocks_of(f"<body><article><p>let {formula} hold</p><p>c</p></article></body>") == ["let x=2 hold", "c"]


def test_site_templates_go_and_copies_do_not_count(spark):
    rows = []
    for i in range(8):
        rows.append((i, f"https://site.example/{i}?q#a", page(f"<div><p>site slogan</p></div><div><p>text {i} of its own</p><p>more {i}</p></div>")))
    for i in range(8, 16):  # copies of one page: nothing recurs across different pages
        rows.append((i, "http://copies.example/a", page("<div><p>the same page</p></div>")))
    rows.append((16, None, page("<div><p>site slogan</p></div>")))
    rows.append((16, None, page("<div><p>site slogan</p></div>")))
    quoted = "<p>a passage that all articles quote</p><div><p>share this</p></div>"
    rows += [(20 + i, "http://news.example/", page(f"<article><p>own {i}</p>{quoted}</article>")) for i in range(6)]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows)
    assert text[3] == "text 3 of its own\nmore 3" and text[9] == "the same page" and text[16] == "site slogan"
    assert text[22] == "own 2\na passage that all articles quote"
    assert htmltext.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("n", [20, 400])
def test_templates_go_at_every_host_size(spark, n):
    extra = {**dict.fromkeys(range(9), "<div><p>sidebar</p></div><p>quoted</p>"), 9: "<div><p>sidebar</p></div><p>quoted</p>",
             10: "<p>rare</p>", 11: "<p>rare</p>", 12: "<p>rare</p>"}
    rows = [(i, "http://site.example/", page(f"<div><p>own {i}</p></div>" + extra.get(i, ""))) for i in range(n)]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == n and text[n - 1] == f"own {n - 1}"
    assert text[3] == "own 3" and text[11] == "own 11\nrare"  # prose needs more pages than a container


def test_pages_are_counted_exactly(spark):
    rows = [("h", i, [None, 1 if i < 10 else None, 2 if i < 9 else None, 3 if i < 3 else None, 4 if i < 2 else None], [1, 2]) for i in range(40)]
    parsed = spark.createDataFrame(rows + rows[:20], "host string, page long, digests array<bigint>, prose array<int>")
    assert sorted(map(tuple, htmltext.site_templates(parsed, 3, 10).collect())) == [("h", 1), ("h", 3)]


@pytest.mark.parametrize("source, want", [
    ("<article class='post related'><p>text</p></article>", ["text"]),
    ("<div class='content ad-free'><p>text</p></div>", ["text"]),
    ("<article><h2 id='social-change'>Social change</h2><p class='notice'>Take notice.</p></article>", ["Social change", "Take notice."]),
    ("<article><p>a</p><div class='ad-slot left'>buy</div><div id='site-comments'><p>nice</p></div></article>", ["a"]),
    ("<article><p>a</p><article class='comment'><p>reply</p></article><p>b</p></article>", ["a", "b"]),
    ("<article><p>a</p><select><option>x<p>b</p><div>c</div></article>", ["a", "b", "c"]),
    ("<article><p>a <object data='x'>b</p><p>c</p></article>", ["a b", "c"]),
    ("<div class='widget'><p>all the text that this page has</p></div><div>x</div>", ["all the text that this page has", "x"]),
    ("<form><article><p>a</p><form><p>in</p></form></article></form>", ["a"]),
    ("<div class=related><article><p>teaser</p></article></div><article><p>a</p></article>", ["a"]),
])
def test_names_are_a_prior_that_loses_no_article(source, want):
    assert blocks_of(f"<html><body>{source}</body></html>") == want


def test_a_recurring_subtree_goes_although_markup_calls_it_the_article(spark):
    """Counts decide first: a teaser that a site repeats as its ``article`` is not the text of its pages."""
    rows = [(i, "http://site.example/", page(f"<article><p>Read our news</p></article><div><p>own text {i}</p></div>")) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    # by markup alone all pages are copies of one text: nothing recurs across different pages
    assert {r["text"] for r in htmltext.main_text(df).collect()} == {"Read our news"}
    rows = [(i, "http://site.example/", page(f"<article><p>own text {i}</p></article><article><div><p>Read our news</p></div></article>"))
            for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in htmltext.main_text(df).collect()} == {f"own text {i}" for i in range(5)}
    assert {r["text"] for r in htmltext.main_text(df, min_pages=10**9).collect()} == {f"own text {i}\nRead our news" for i in range(5)}


@pytest.mark.parametrize("source", [
    "<div>" * 50_000 + "end", "<div>x" * 50_000, "<b>" * 50_000 + "<div>x</div>y" * 20_000, "<div>" * 50_000 + "</section>" * 50_000 + "x",
    "<p><b>x" * 50_000, "<ul><li>" * 30_000 + "x", "<select>" * 20_000 + "<p>x" * 20_000, "<" * 200_000, "</p>" * 100_000 + "x"])
def test_broken_pages_take_linear_time(source):
    began = time.process_time()
    assert htmltext.text_without(htmltext.read_page(source), set())
    assert time.process_time() - began < 8


def test_hosts():
    assert [htmltext.host_of(u) for u in (None, "", "HTTP://A.b/c", "https://u:p@x.y?z", "x.y/z", "//x#a")] == ["", "", "a.b", "x.y", "x.y", ""]
