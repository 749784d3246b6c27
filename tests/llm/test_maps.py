"""Operators that work text by text: benchmark windows, BPE, main text, languages, toxicity, URLs."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from graphloom.llm import byte_bpe, html_text, kernel, language_id, toxicity, url_filter, wu_manber

DOCS = "doc_id bigint, text string"


# Benchmark windows ----------------------------------------------------------------------------------
def item_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(texts, items, n=10):
    out = []
    for t in texts:
        w, hit, found = item_words(t), set(), set()
        for i, x in items:
            p = item_words(x)
            m = min(n, len(p))
            windows = {tuple(p[j : j + m]) for j in range(len(p) - m + 1)} if m else set()
            for j in range(len(w) - m + 1):
                if m and tuple(w[j : j + m]) in windows:
                    hit |= set(range(j, j + m))
                    found.add(str(i))
        out.append((len(w), len(hit), sorted(found)))
    return out


def hit_fixture():
    r = random.Random(5)
    vocabulary = ["a", "b", "c", "dé", "E1", "f_g", "h"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 2, 4, 9, 10, 11, 25])))) for i in range(12)] + [(50, ""), (51, None), (7, "a b c")]
    texts = [r.choice([", ", " "]).join(r.choices(vocabulary, k=r.randint(0, 60))) for _ in range(150)]
    texts += [x for _, x in items] + ["x " * 5000 + items[2][1], None, ""]
    return items, texts


def test_windows_against_brute_force(spark, monkeypatch):
    items, texts = hit_fixture()
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).selectExpr("*", "'clash' AS wm").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_hits(texts, items)
    for block_bytes, all_bytes in ((wu_manber.BLOCK_BYTES, wu_manber.BENCHMARK_BYTES), (1, wu_manber.BENCHMARK_BYTES), (1, 0)):
        monkeypatch.setattr(wu_manber, "BENCHMARK_BYTES", all_bytes)
        got = wu_manber.hits(docs, bench, 10, block_bytes).collect()
        assert {r["doc_id"]: (r["wm"]["n_words"], r["wm"]["n_hit"], r["wm"]["items"]) for r in got} == dict(enumerate(want))
    clean = wu_manber.decontaminate(docs.drop("wm"), bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, x in enumerate(want) if not x[1]}
    assert clean.columns == ["doc_id", "text"]


def test_full_suffix_buckets_are_searched_by_halves():
    r = np.random.default_rng(7)
    patterns = np.unique(np.concatenate([r.integers(0, 50, (60_000, 8)), np.full((60_000, 2), 7)], axis=1).astype(np.uint64), axis=0)
    words = r.integers(0, 50, 200_000).astype(np.uint64)
    words[9::10] = words[8::10] = 7  # one ending throughout
    at = r.integers(0, len(words) // 10, 500) * 10
    for x, p in zip(at, r.integers(0, len(patterns), 500), strict=True):
        words[x : x + 10] = patterns[p]
    begun = time.monotonic()
    ends, which = wu_manber.Searcher(patterns).find(words, np.array([0, len(words)]))
    assert time.monotonic() - begun < 10
    known = {tuple(p): i for i, p in enumerate(patterns.tolist())}
    windows = np.lib.stride_tricks.sliding_window_view(words, 10).tolist()
    assert dict(zip(ends.tolist(), which.tolist(), strict=True)) == {i + 9: known[tuple(w)] for i, w in enumerate(windows) if tuple(w) in known}


def test_long_texts_give_what_short_ones_do(monkeypatch):
    """A chunk size far below the texts' changes nothing: hashes, windows, languages; rates but for marks at the cuts."""
    r = random.Random(4)
    text = " ".join("".join(r.choices("abcdé", k=r.randint(1, 9))) for _ in range(4000)) + " " + "x" * 9000
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = kernel.word_bounds(data, np.array([0, len(data)]), kernel.NOT_SPACE)
    whole, model = kernel.word_hashes(data, starts, ends), language_id.Model(["a", "b"], np.zeros(2), np.random.default_rng(1).normal(size=(language_id.BINS, 2)))
    rates, predicted = toxicity.features(data, np.array([0, len(data)]), toxicity._EMPTY), model.predict([text, "b", text])
    tok = byte_bpe.Tokenizer(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    ids = tok.encode_batch([text, "b"])
    for name, value in (("CHUNK", 4096),):
        monkeypatch.setattr(kernel, name, value)
    monkeypatch.setattr(language_id, "_BATCH", 1000)
    monkeypatch.setattr(byte_bpe, "LONG", 100)
    monkeypatch.setattr(byte_bpe, "QUERY_ROWS", 700)
    assert (kernel.word_hashes(data, starts, ends) == whole).all()
    cuts = list(kernel.pieces(data, kernel.ALNUM, 4096))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(data) and all(a < b <= a + 4096 for a, b in cuts) and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:], strict=False))
    again = model.predict([text, "b", text])
    assert again[0] == predicted[0] and np.allclose(again[1], predicted[1])
    assert np.allclose(toxicity.features(data, np.array([0, len(data)]), toxicity._EMPTY), rates, rtol=0.01)
    assert tok.encode_batch([text, "b"]) == ids and tok.decode_batch(ids) == [text.encode(), b"b"]


def test_windows_of_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], "item_id bigint, text string")
    assert wu_manber.hits(docs, bench).first()["wm"]["n_hit"] == 0
    assert wu_manber.hits(docs.limit(0), bench).count() == 0


# BPE ------------------------------------------------------------------------------------------------
def test_bpe_is_the_librarys(spark, monkeypatch):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    texts = ["", None, "Hello, world's end  \n\n x", "z" * 5000, "日本語 🎉 <|endoftext|> naïve", " \t " * 50] + ["".join(r.choices("abcdefgh etaoin'12 \n", k=r.randint(1, 400))) for _ in range(150)]
    texts += ["".join(r.choices("etaoins", k=700))]
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 60)
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {x["doc_id"]: bytes(x["ids"]) for x in byte_bpe.encode(df, ranks, public_tokenizers.PATTERN).collect()}
    assert got == {i: np.array(own.encode_ordinary(t or ""), "<u4").tobytes() for i, t in enumerate(texts)}
    tok = byte_bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    assert [b.decode() for b in tok.decode_batch([got[i] for i in range(len(texts))])] == [t or "" for t in texts]
    assert byte_bpe.encode(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_a_very_long_word_takes_seconds():
    tok = byte_bpe.Tokenizer(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tok.ranks, special_tokens={})
    r = random.Random(3)
    for word in ("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=300_000)), "lorem" * 60_000, "é中" * 40_000):
        begun = time.monotonic()
        assert tok.encode_batch([word])[0] == np.array(library.encode(word), "<u4").tobytes()
        assert time.monotonic() - begun < 30


def test_bpe_long_pieces_take_the_same_merges():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tok = byte_bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    r = random.Random(9)
    pieces = ["".join(r.choices("ethan", k=n)).encode() for n in (2, 9, 40, 64)]
    assert tok._merge(pieces, True) == tok._merge(pieces, False)


# Main text ------------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="cookie-banner">We use cookies</div><!-- c --><div class="ad">Buy <b>now</b></div>
<article><header><h1>Head &amp;  line</h1></header><p>First <b>para<i>graph</i></b> with&nbsp;text.<br>More<p>Short.</p><aside>Aside</aside>
<ul><li>One</li><li>Two</li></ul><div class="share">Share</div><section class="comments"><p>A reader says a lot of things here</p></section></article>
<form>Mail <input></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_an_article():
    assert html_text.extract(PAGE) == "Head & line\nFirst paragraph with text. More\nShort.\nOne\nTwo"


def test_main_text_without_landmarks():
    body = "A paragraph with a good many words in it, as articles have, so that its ratio is high. " * 3
    page = f'<body><ul class=menu><li><a href=x>Home</a></ul><div id=wrap><div class=post><h2>Title</h2><p>{body}<p>Brief.<p>{body}</div><div class=sidebar><p>{body}</div></div><div><a href=1>x1</a> <a href=2>x2</a></div>'
    one = " ".join(body.split())
    assert html_text.extract(page) == f"Title\n{one}\nBrief.\n{one}"


def test_main_text_odd_input(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no tags"), (4, "u", "<![[[ x <p>a</p>"), (5, "u", "<div>" * 3000 + "deep"), (None, "u", "<p>x"), (6, "u", "<p>a&lt;b &#233;</p")]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' AS text")).collect()
    found = {r["page_id"]: r["text"] for r in got}
    assert found[1] == found[2] == "" and found[3] == "no tags" and found[4].endswith("a") and found[5] == "deep" and found[None] == "x" and found[6] == "a<b é"
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


BODY = "A paragraph with a good many words in it, as articles have, so that its ratio is high. " * 3


@pytest.mark.parametrize(
    "open_",
    ['main class="no-sidebar"', 'div class="content with-sidebar"', 'article class="post has-share"', 'article class="post no-comments"', 'article class="review reviews"', 'article id="post-related"',
     'article class="post category-reviews"', 'div class="page has-comments"', 'div class="widget"', 'section class="promoted"'],
)
def test_main_text_of_articles_with_everyday_names(open_):
    end = open_.split()[0]
    aside = f'<div class="sidebar">some text beside it</div><div class="comments-area"><p>{BODY * 3}</div><div class="ad-slot">buy</div><footer>f</footer>'
    got = html_text.extract(f"<body><nav><a href=1>Home</a></nav><{open_}><h1>T</h1><p>{BODY}<p>Short.</{end}>{aside}")
    assert got == f"T\n{BODY.strip()}\nShort."


def test_main_text_without_lists_of_links():
    links = "".join(f"<li><a href={i}>other page {i}</a>" for i in range(9))
    got = html_text.extract(f'<main><h1>T</h1><p>{BODY}<p>{BODY} <a href=1>a link</a><ul>{links}</ul></main>')
    assert "a link" in got and "other page 8" not in got


def naive_extract(blocks):
    """Main text of a page that was built of (kind, text) blocks."""
    return "\n".join(" ".join(text.split()) for kind, text in blocks if kind in ("h", "p", "li") and text.split())


def test_main_text_against_how_pages_were_built():
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    aside = {
        "nav": lambda t: f"<nav><ul><li><a href=x>{t}</a></ul></nav>", "ad": lambda t: f'<div class="ad">{t}</div>', "footer": lambda t: f"<footer>{t}</footer>", "script": lambda t: f"<script>{t}</script>",
        "side": lambda t: f'<aside>{t}</aside>', "cookie": lambda t: f'<div id="cookie-notice">{t}</div>', "form": lambda t: f"<form>{t}<input></form>", "said": lambda t: f'<ol class="comments"><li>{t}</ol>',
    }
    for _ in range(200):
        article = [("h", say(5))] + [(r.choice(["p", "p", "p", "li"]), say(r.randint(1, 60))) for _ in range(r.randint(3, 12))]
        inner = "".join({"h": f"<h1>{t}</h1>", "p": f"<p>{t}" + r.choice(["", "</p>"]), "li": f"<ul><li>{t}</ul>"}[k] for k, t in article)
        before, after = ("".join(aside[k](say(r.randint(1, 9))) for k in r.sample(sorted(aside), r.randint(0, 5))) for _ in range(2))
        assert html_text.extract(f"<html><head><title>{say(3)}</title></head><body>{before}<article>{inner}</article>{after}</body></html>") == naive_extract(article)


@pytest.mark.parametrize("count", [1, 2, 50, 51, 400])
def test_html_comment_left_open(count):
    """It runs to the page's end, however many others open in it."""
    assert html_text.extract(f"<main><h1>T</h1><p>{BODY}<p>{BODY} " + "<!-- x <p>tail, with a few words in it " * count) == f"T\n{BODY.strip()}\n{BODY.strip()}"


@pytest.mark.parametrize("count", [1, 60])
@pytest.mark.parametrize("piece", ["<!-->", "<!--->", "<!-- x --!>", "<!-- x -->", "<!---->", "<title>on <!-- signs</title>", "<textarea><!-- </textarea>", "<noscript><!-- x</noscript>", '<script>"<!--"</script>', '<b title="<!--"></b>'])
def test_html_comment_that_ends_or_does_not_open(piece, count):
    assert html_text.extract(f"<main><h1>T</h1>{piece * count}<p>{BODY}<p>{BODY}</main>") == f"T\n{BODY.strip()}\n{BODY.strip()}"


def test_html_many_comments_in_raw_text():
    html_text.extract("<textarea>" + "<!--" * 100000)  # in linear time


@pytest.mark.parametrize("html", ["<b><i>" * 30000 + "x" + "</u>" * 60000, "<b>" * 30000 + "<p>x" * 30000, "<a" * 100000, "<!--" * 100000, "<a href='" * 50000, "<div>" * 100000 + "x" + "</p>" * 100000])
def test_main_text_of_malformed_pages_takes_seconds(html):
    begun = time.monotonic()
    html_text.extract(html)
    assert time.monotonic() - begun < 10


# Languages and toxicity -----------------------------------------------------------------------------
def speech(r, letters, n=40):
    return " ".join("".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(n))


def test_languages_on_held_out_texts(spark):
    r = random.Random(4)
    alphabets = {"aa": "abcdeaa", "bb": "defghee", "cc": "ñéîghaa"}
    rows = [(i, speech(r, alphabets[g]), g) for i, g in enumerate(r.choices(list(alphabets), k=400))] + [(900, None, "aa"), (901, "abc", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(df.where("doc_id % 5 <> 0 or doc_id >= 900"))
    held = df.where("doc_id % 5 = 0 and doc_id < 900")
    got = {x["doc_id"]: x for x in language_id.predict(held, model).collect()}
    right = [got[i]["lang_pred"] == g for i, _, g in rows[:400] if i % 5 == 0]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= x["score"] <= 1 for x in got.values())


def test_languages_of_odd_texts(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "abc"), (5, "İ" * 50)], DOCS)
    model = language_id.fit(spark.createDataFrame([(1, "abc abd", "x"), (2, "zzz zyz", "y")], "doc_id bigint, text string, lang string"))
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[None] == "x" and got[5] in "xy"
    nothing = language_id.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing).collect()} == {"und"}


def toxic_rows(n=600, seed=6):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(r.randint(20, 80))]
        bad = r.random() < 0.15
        if bad:
            for _ in range(r.randint(1, 4)):
                words.insert(r.randrange(len(words)), r.choice(["vilxx", "vilyy", "qqbad" + r.choice("abc") * 2]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out_texts(spark):
    rows = toxic_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(df.where("doc_id % 5 <> 0").select("doc_id", "text"), df.where("doc_id % 5 <> 0").select("doc_id", "toxic"))
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(df.where("doc_id % 5 = 0"), model).collect()}
    right = [(got[i] >= 0.5) == bool(t) for i, _, t in rows if i % 5 == 0]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= s <= 1 for s in got.values())


def test_toxicity_of_odd_texts_and_tables(spark):
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "!!" * 9000, "c")], DOCS + ", score string")
    none = toxicity.fit(odd.select("doc_id", "text"), spark.createDataFrame([], "doc_id bigint, toxic int"))
    got = toxicity.score(odd, none, "score")
    assert got.columns == ["doc_id", "text", "score"] and got.count() == 4 and {r["score"] for r in got.collect()} == {0.0}
    df = spark.createDataFrame(toxic_rows(200), "doc_id bigint, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert all(0 <= r["toxicity"] <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_isotonic_never_falls():
    r = np.random.default_rng(2)
    raw = r.normal(size=300)
    x, y = toxicity.isotonic(raw, (r.random(300) < 1 / (1 + np.exp(-2 * raw))).astype(float))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all() and 0 <= y.min() and y.max() <= 1


# URLs -----------------------------------------------------------------------------------------------
def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else "allow")


def test_url_rules_against_brute_force(spark, monkeypatch):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de"), ("allow", "org", "/fr/"), ("allow", "a.org", "/"), ("block", "a.org", "/"), ("block", "x.y.example.com", "")]
    r = random.Random(3)
    urls = [f"{r.choice(['http', 'HTTPS', ''])}{r.choice(['://', '://', ':/'])}{r.choice(['', 'www.', 'X.y.', 'not'])}{r.choice(['example.net', 'Example.com', 'a.org', 'net', 'org', ''])}{r.choice(['', '/', '/en/a', '/de', '/design?x#y', '/fr/', '?q=/en/', '#/en/'])}" for _ in range(200)]
    urls += [None, "", "://", "://net/", "a://b://net/", "http://é.net/ü", "http://net/" + "x" * 20000]
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    frame = url_filter.rules_frame(spark, [*rules, ("block", None, "/"), ("block", "net", None)])
    for limit in (url_filter.BROADCAST_RULES, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, frame).collect()}
        assert got == {i: judged(u, rules) for i, u in enumerate(urls)}


def test_urls_of_very_many_labels(spark):
    host = "a." * 200_000 + "example.net"
    rows = [(1, f"http://{host}/en/x"), (2, f"http://{host}/fr"), (3, "http://" + "." * 100_000), (4, "x://..net/")]
    begun = time.monotonic()
    rules = url_filter.rules_frame(spark, [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "", "/")])
    got = {r["page_id"]: r["rule"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert got == {1: "example.net/en/", 2: "net/", 3: None, 4: "net/"}
    assert time.monotonic() - begun < 20


def test_url_rows_repeat_and_tables_may_be_empty(spark):
    pages = spark.createDataFrame([(1, "http://net/"), (1, "http://net/"), (None, "http://net/"), (1, None)], "page_id bigint, url string")
    rules = url_filter.rules_frame(spark, [("block", "net", "/")])
    got = sorted((r["page_id"] or 0, r["verdict"]) for r in url_filter.judge(pages, rules).collect())
    assert got == [(0, "block"), (1, "allow"), (1, "block"), (1, "block")]
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, rules.limit(0), "block").collect()} == {"block"}


# Brute force ----------------------------------------------------------------------------------------
def naive_rates(text, odds, person):
    """The features of a text by plain Python; odds: of terms (word, or beginning with its length)."""
    raw = (text or "").encode()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    spans = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]
    words = [lower[a:b] for a, b in spans]
    whole = [odds.get((0, w), 0.0) for w in words]
    begin = [max([0.0, *(odds.get((n, w[:n]), 0.0) for n in toxicity.BEGINNINGS if len(w) > n)]) for w in words]
    best = [max(a, b) for a, b in zip(whole, begin, strict=True)]
    you = [w in person for w in words]
    near = sum(o > 0 and any(you[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, o in enumerate(best))
    n, hits, size = max(len(words), 1), sum(o > 0 for o in best), max(len(raw), 1)
    upper = [65 <= b <= 90 for b in raw]
    letter = [u or 97 <= b <= 122 or b >= 128 for u, b in zip(upper, raw, strict=True)]
    digit = [48 <= b <= 57 for b in raw]
    inner = [0 < i < len(raw) - 1 and letter[i - 1] and letter[i + 1] for i in range(len(raw))]
    return [
        np.log1p(len(words)), sum(o > 0 for o in whole) / n, sum(o > 0 for o in begin) / n, max([0.0, *best]), sum(best) / n, np.log1p(hits), near / max(hits, 1), sum(you) / n,
        sum(upper) / max(sum(letter), 1), sum(b - a > 1 and all(upper[a:b]) for a, b in spans) / n, sum(b in b"!?" for b in raw) / size,
        sum(not letter[i] and not digit[i] and b > 32 for i, b in enumerate(raw)) / size, sum(digit) / size, sum(x and b in b"*@$#" for x, b in zip(inner, raw, strict=True)) / n,
        sum(x and d for x, d in zip(inner, digit, strict=True)) / n,
    ]


def test_toxicity_rates_against_plain_python():
    r = random.Random(12)
    vocabulary = ["you", "your", "idiot", "IDIOT", "id1ot", "f*ol", "good", "Tag", "dé", "moron", "x", "!!!", "2024", "..."]
    texts = ["", "...", "you"] + [r.choice([" ", ", "]).join(r.choices(vocabulary, k=r.randint(1, 40))) for _ in range(120)]
    terms = {(0, b"idiot"): 2.0, (0, b"moron"): 1.5, (0, b"id1ot"): 0.7, **{(n, b"moron"[:n]): 0.5 + n / 10 for n in toxicity.BEGINNINGS if n <= 5}}
    data, offs = kernel.string_buffers(pa.array([w.decode() + "z" * (n > 0) for n, w in terms]))  # a beginning is of longer words
    sums = kernel.prefix_sums(data)
    hashes = np.concatenate([toxicity._terms(sums, offs[i : i + 1], offs[i + 1 : i + 2], n)[0] for i, (n, _) in enumerate(terms)])
    lexicon = toxicity.Lexicon(hashes, np.array(list(terms.values())))
    person = {w.encode() for w in toxicity.SECOND_PERSON}
    data, offs = kernel.string_buffers(pa.array(texts))
    assert np.allclose(toxicity.features(data, offs, lexicon), [naive_rates(t, terms, person) for t in texts])


def test_trees_against_exhaustive_splits():
    """A tree's first split is the best of all cuts at its quantiles, and rows are walked as by hand."""
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(300, 4)), 2)
    y = ((x[:, 1] > 0.4) ^ (r.random(300) < 0.1)).astype(float)
    trees = toxicity.Trees(rounds=2, depth=2).fit(x, y)
    p = y.mean()
    grad, hess = y - p, np.full(300, p * (1 - p))
    best = max(
        ((grad[low].sum() ** 2 / (hess[low].sum() + 1) + grad[~low].sum() ** 2 / (hess[~low].sum() + 1)), j, cut)
        for j in range(4)
        for cut in np.unique(np.quantile(x[:, j], np.linspace(0, 1, trees.bins + 1)[1:-1]))
        for low in [x[:, j] <= cut]
        if trees.least <= low.sum() <= 300 - trees.least
    )
    assert trees.trees[0][0][:2] == (best[1], best[2])

    def walk(nodes, row, at=0):
        j, cut, left, right = nodes[at]
        return cut if j < 0 else walk(nodes, row, left if row[j] <= cut else right)

    assert np.allclose(trees.raw(x), [trees.base + sum(walk(t, row) for t in trees.trees) for row in x])


def naive_grams(text):
    out = []
    code = [c if c.isalpha() else " " for c in f" {text.lower()} "]
    for a, b in zip(code, code[1:], strict=False):
        if a != " " or b != " ":
            out.append(a + b)
    out += [a + b + c for a, b, c in zip(code, code[1:], code[2:], strict=False) if b != " "]
    return out


def test_languages_against_plain_counts(spark):
    r = random.Random(13)
    alphabets = {"en": "abcdefgh etaoin", "de": "äöüß nrstei", "xx": "klmnopq aei"}
    rows = [(i, speech(r, alphabets[lang], r.randint(1, 15)), lang) for i, lang in enumerate(r.choices(sorted(alphabets), k=90))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    model = language_id.fit(df)
    counts = {lang: {} for lang in alphabets}
    for _, text, lang in rows:
        for g in naive_grams(text):
            counts[lang][g] = counts[lang].get(g, 0) + 1
    new = ["", "123", *(speech(r, alphabets[r.choice(sorted(alphabets))], 6) for _ in range(60))]
    got = model.predict(new)
    for text, lang, score in zip(new, *got, strict=True):
        grams = naive_grams(text)
        if not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        total = {x: np.log(sum(lang == x for *_, lang in rows) / len(rows)) for x in counts}
        weight = min(1.0, language_id.EVIDENCE / len(grams))
        for x, own in counts.items():
            size = sum(own.values()) + language_id.ALPHA * language_id.BINS
            total[x] += sum(np.log((own.get(g, 0) + language_id.ALPHA) / size) for g in grams)
        assert lang == max(sorted(total), key=total.get)
        share = np.exp([(v - total[lang]) * weight for v in total.values()])
        assert abs(score - 1 / share.sum()) < 0.02
