"""Language ID, chat formatting, page extraction and fingerprints against plain versions."""

import hashlib
import html as references
import json
import math
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendwatch.llm import chat, langid, parsing, wrappers
from spendwatch.llm.common import text_bytes

ODD = [(1, None), (2, ""), (3, "123 456 !?"), (4, "é"), (5, "the " * 20_000), (6, "same"), (6, "same"), (None, "no id")]


# Language ID

def plain_bits(counts, order, data):
    """Code length by partial matching with exclusion, byte by byte, from counts[context][byte]."""
    bits = 0.0
    for i, byte in enumerate(data):
        p, excluded = 1.0, set()
        for size in range(min(order, i), -1, -1):
            follow = counts.get(data[i - size:i])
            if not follow:
                continue
            left = {b: n for b, n in follow.items() if b not in excluded}
            kinds, total = len(left), sum(left.values())
            if total + kinds == 0:
                excluded |= set(follow)
                continue
            if byte in left:
                p *= left[byte] / (total + kinds)
                break
            p *= kinds / (total + kinds)
            excluded |= set(follow)
        else:
            p *= 1 / (256 - len(excluded))
        bits -= math.log2(p)
    return bits


def test_code_lengths_match_a_plain_version(spark):
    rows = [("abracadabra é cadabra", "x"), ("hocus pocus abra", "x"), ("zzz top zap abra", "y")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), order=3)
    assert model.languages == ["x", "y"]
    texts = ["abracadabra", "zap hocus é", "ÿ new", "", "aab"]
    lengths = langid.code_lengths(model, *text_bytes(pa.array(texts)))
    for lang, column in zip(model.languages, lengths.T):
        counts = {}
        for text, own in rows:
            data = text.encode()
            if own == lang:
                for i in range(len(data)):
                    for size in range(min(3, i) + 1):
                        counts.setdefault(data[i - size:i], Counter())[data[i]] += 1
        for text, bits in zip(texts, column):
            assert bits == pytest.approx(plain_bits(counts, 3, text.encode()), rel=1e-4, abs=1e-4)


def test_probabilities_of_a_context_sum_to_one(spark):
    model = langid.train(spark.createDataFrame([("abcabcabdxyzé", "x")], "text string, lang string"))
    unseen = 256 - (model.bits.shape[1] - 1)
    p = np.exp2(-model.bits[:, :, 0].astype(float))
    sums = p[:, :-1].sum(axis=1) + unseen * p[:, -1]
    assert np.allclose(sums, 1, atol=1e-5)


def test_held_out_accuracy(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string")
    model = langid.train(docs.where("doc_id % 3 != 0"))
    rows = langid.predict(docs.where("doc_id % 3 = 0"), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.bits_per_byte < 6.5 for r in rows)


def test_many_languages_keep_their_trees(spark):
    rng, rows = np.random.default_rng(5), []
    for lang in range(30):
        words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(40)]
        rows += [(f"l{lang:02}", " ".join(rng.choice(words, 200)), i == 0) for i in range(8)]
    docs = spark.createDataFrame([(a, b, bool(c)) for a, b, c in rows], "lang string, text string, held boolean").coalesce(2)

    def judged(kept):
        model = langid.train(docs.where("not held").where(kept), table_bytes=120_000)
        return {r.lang: r for r in langid.predict(docs.where("held").where("lang < 'l04'"), model).collect()}

    few, many = judged("lang < 'l04'"), judged("true")
    assert all(r.lang_pred == lang for lang, r in many.items())
    for lang, r in many.items():
        assert r.bits_per_byte == pytest.approx(few[lang].bits_per_byte, rel=0.02)


def test_language_of_odd_rows(table_of, spark):
    model = langid.train(spark.createDataFrame([("the cat", "en"), ("el gato", "es"), (None, "en"), ("x", None), ("", "fr")],
                                               "text string, lang string"))
    rows = langid.predict(table_of(ODD), model).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert by_id[1].score == 0 and by_id[1].bits_per_byte is None
    assert by_id[4].lang_pred in model.languages and by_id[5].lang_pred == "en"
    nothing = langid.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in langid.predict(table_of(ODD), nothing).collect()} == {"und"}
    assert langid.predict(table_of([]), model).collect() == []


# Chat

CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "[NEXT]", "[ROLE]", "[/ROLE]", "[\\INST]", "<\\\\/s>", "[", "<", "\\", "[/INST"]


def test_chat_round_trip(spark):
    turns, n = [], 0
    for a in CONTROL:
        for b in CONTROL:
            turns += [(n, 0, "user", a), (n, 1, "user", b + a), (n, 2, "assistant", a + b), (n, 3, "assistant", ""),
                      (n, 4, a, b), (n, 5, "assistant", "x" + b)]
            n += 1
    turns += [(None, 1, "user", "no id"), (-1, 0, None, None), (-1, None, "assistant", "first"), (-2, 0, "user", "twice"),
              (-2, 0, "user", "twice"), (-3, 0, "assistant", "long é" * 50_000), (-3, 1, "user", "a\nb")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    done = chat.read_turns(chat.format_conversations(df)).withColumn(
        "loss", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).collect()
    want = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert len(done) == len(want)
    for row in done:
        assert [(t.role, t.text) for t in row.turns] == want[row.conv_id]
        assert row.loss == "".join(t for r, t in want[row.conv_id] if r == "assistant")


def test_chat_merges_neighbours(spark):
    df = spark.createDataFrame([(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "tool", "d")],
                               "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(df).first()
    assert row.formatted == "[INST]a[NEXT]b[/INST]<s>c</s>[ROLE]tool[/ROLE]d</s>"
    assert [(s.start, s.length) for s in row.loss_spans] == [(24, 1)]
    assert chat.format_conversations(df.limit(0)).collect() == []


# Pages

def test_wrapper_folds_optional_and_repeated_groups():
    a = wrappers.page_wrapper("<body><h1>A</h1><p>x</p><p>y</p><div>Same</div></body>")
    b = wrappers.page_wrapper("<body><h1>B</h1><p>z</p><hr><div>Same</div></body>")
    assert wrappers.expression(wrappers.align(a, b)) == (
        '<body><h1>#</h1>(<p>#</p>)+(<hr></hr>)?<div>"Same"</div></body>')


def test_main_text_of_a_page():
    page = """<html><head><title>t</title><style>a{}</style></head><body class="page"><header>Top</header>
    <nav><ul><li>Home</li></ul></nav><main id=main><h1>Big  &amp; <i>sm</i>all</h1><p>One<br>two<p>Three &#233;&nbsp;x
    <script>var a = "<p>no</p>";</script><div class="ad-box">Buy</div><form>Mail</form><ul><li>a<li>b</ul>
    <!-- <p>hidden</p> --><div id='user_comments'><article>First!</article></div></main><aside>Side</aside>
    <footer>Bottom</footer>"""
    wrapper = wrappers.page_wrapper(page)
    assert wrappers.main_text(page, wrapper, 1) == "Big & small One two Three é x a b"


def test_pages_without_article_use_the_wrapper(spark):
    pages = [(i, "http://a.example/x", f"<body><div class=top>Brand</div><div class=c><h2>Title {i}</h2><p>{w * 30}</p>"
              f"<p>{w * 20}</p></div><div>Brand again</div></body>") for i, w in enumerate(["ab ", "cd ", "ef ", "gh "])]
    rows = {r.page_id: r.text for r in wrappers.extract(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, w in enumerate(["ab ", "cd ", "ef ", "gh "]):
        assert rows[i] == f"Title {i} {(w * 30).strip()} {(w * 20).strip()}"


def test_odd_pages(table_of):
    pages = [(1, None, None), (2, "x", ""), (3, "http://h/", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000),
             (4, "http://h/", "a < b <article>1 < 2 & 3 &lt; 4</article"), (5, "http://h/", "<article>same</article>"),
             (5, "http://h/", "<article>same</article>"), (None, "http://h/", "<p>no id"), (6, "http://h/", "<" * 1000)]
    df = table_of(pages, "page_id long, url string, html string")
    rows = wrappers.extract(df).collect()
    assert len(rows) == len(pages)
    texts = {r.page_id: r.text for r in rows}
    assert texts[1] == texts[2] == ""
    assert texts[3] == "deep" and texts[5] == "same" and texts[4].startswith("1 < 2 & 3 < 4")
    assert wrappers.extract(df.limit(0)).collect() == []


def extracted(spark, pages):
    rows = [(i, "http://a.example/x", page) for i, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    return [texts[i] for i in range(len(pages))]


def test_templates_of_one_host(spark):
    words = [f"w{i} " * 30 for i in range(12)]
    pages = [f"<body><div class=top>Brand</div><article><p>{w}</p></article></body>" if i % 3 == 0 else
             f"<body><div class=top>Brand</div><div class=content><h2>T{i}</h2><p>{w}</p></div></body>"
             for i, w in enumerate(words)]
    assert extracted(spark, pages) == [w.strip() if i % 3 == 0 else f"T{i} {w.strip()}" for i, w in enumerate(words)]


def test_texts_of_few_pages_are_not_fixed(spark):
    words = [f"w{i} " * 30 for i in range(12)]
    pages = [f"<body><div class=top>Brand</div><div class=day>Day {i}</div><div class=c><p>{w}</p><p>{w}</p>"
             f"<div>Read the rules</div></div></body>" for i, w in enumerate(words)]
    want = [f"{w}{w}".strip() for w in words]
    pages[3] = pages[3].replace("<p>", "<h2 id=intro>Lone title</h2><p>", 1)
    want[3] = f"Lone title {want[3]}"
    pages[4] = pages[4].replace("</p><p>", "</p><blockquote>Lone quote</blockquote><p>")
    want[4] = f"{words[4]}Lone quote {words[4]}".strip()
    pages += [pages[5]] * 5 + ["<p>no article here",
                               "<body><div class=day>Day 99</div><section>Quite another layout</section></body>"]
    want += [want[5]] * 5 + ["no article here", "Quite another layout"]
    assert extracted(spark, pages) == want
    # Copies of one page tell nothing about what is fixed.
    assert extracted(spark, ["<body><h1>Title</h1><div><p>One</p><p>Two</p></div></body>"] * 5) == ["Title One Two"] * 5


@pytest.mark.parametrize("place", ["article", "div"])
def test_long_and_inner_fixed_texts(spark, place):
    legal = "All rights in these words are ours. " * 10
    pages = [f"<body><{place}><div>Terms apply</div><h2>Title {i}</h2><p>{f'w{i} ' * 90}</p><div>{legal}</div></{place}></body>"
             for i in range(6)]
    assert extracted(spark, pages) == [f"Title {i} {f'w{i} ' * 90}".strip() for i in range(6)]


def test_wrapper_size_follows_templates(spark):
    def pages(n):
        return [f"<body class='blog postid-{i}'><div id=top-{i} class=top>Brand</div><div id='post-{i}' class='post p{i}'>"
                f"<h2 id=t{i}>Title {i}</h2><p id=a{i}>{f'w{i} ' * 30}</p></div></body>" for i in range(n)]

    def wrapper(n):
        df = spark.createDataFrame([(i, "http://a.example/x", p) for i, p in enumerate(pages(n))],
                                   "page_id long, url string, html string").repartition(3)
        return json.loads(wrappers.infer_wrappers(wrappers._rows(df, "page_id", "url", "html")).first().wrapper)

    assert wrappers.expression(wrapper(60)) == wrappers.expression(wrapper(10)) == (
        '<body.blog><div.top>"Brand"</div><div.post><h2>#</h2><p>#</p></div></body>')
    assert extracted(spark, pages(20)) == [f"Title {i} {f'w{i} ' * 30}".strip() for i in range(20)]


def test_pages_match_a_plain_version(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    for row in df.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1]
        body = re.sub(r"</?b>", "", body)
        want = " ".join(references.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert texts[row.page_id] == want


def without_names(page):
    """The page with no name that tells what a region is: its wrapper alone can."""
    for name, letter in (("article", "c"), ("nav", "n"), ("footer", "f")):
        page = re.sub(rf"<{name}\b[^>]*>", f"<div class={letter}>", page).replace(f"</{name}>", "</div>")
    return page.replace('class="ad"', "class=x")


def plain_main_text(pages):
    """Main texts of a host's pages, inferred without wrappers: the element path with seven tenths of the letters of blocks
    that are not the same on half of the pages."""
    parsed = []
    for page in pages:
        blocks, path, text = [], [], ""
        for token in re.findall(r"<style.*?</style>|<script.*?</script>|<!.*?>|<[^>]*>|[^<]+", page, re.S):
            tag = re.match(r"<(/?)([a-z][a-z0-9]*)(?: class=(\w))?", token)
            if not token.startswith("<"):
                text += token
            elif tag and tag[2] == "br":
                text += " "
            elif tag and tag[2] not in ("b", "a", "style", "script", "meta"):
                blocks.append((tuple(path), " ".join(references.unescape(text).split())))
                text = ""
                if tag[1]:
                    del path[len(path) - 1 - path[::-1].index(tag[2] + (tag[3] or "")) if tag[2] != "div" else
                             max(i for i, x in enumerate(path) if x[:3] == "div"):]
                else:
                    if tag[2] == "p" and path[-1] == "p":
                        path.pop()
                    path.append(tag[2] + (tag[3] or ""))
        blocks.append((tuple(path), " ".join(references.unescape(text).split())))
        parsed.append([(p, t) for p, t in blocks if t and "head" not in p])
    seen = Counter(b for blocks in parsed for b in set(blocks))
    open_ = [[(p, t) for p, t in blocks if seen[p, t] * 2 <= len(pages)] for blocks in parsed]
    masses = Counter()
    for blocks in open_:
        for p, t in blocks:
            for i in range(len(p) + 1):
                masses[p[:i]] += len(t)
    best = max((p for p, n in masses.items() if n >= 0.7 * masses[()] and p[-1:] not in (("p",), ("h1",))), key=len)
    return [" ".join(t for p, t in blocks if p[:len(best)] == best) for blocks in open_]


def test_wrappers_alone_tell_the_main_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("host", wrappers._host("url"))
    hosts = {}
    for row in df.collect():
        hosts.setdefault(row.host, []).append((row.page_id, row.url, row.html))
    hosts = {h: rows for h, rows in hosts.items() if len(rows) >= 4}
    want, given, bare = {}, [], []
    for rows in hosts.values():
        pages = [without_names(page) for _, _, page in rows]
        want.update(zip((i for i, _, _ in rows), plain_main_text(pages)))
        bare += [(i, url, page) for (i, url, _), page in zip(rows, pages)]
        given += rows
    schema = "page_id long, url string, html string"
    texts = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(bare, schema)).collect()}
    assert texts == want and len(want) > 100
    named = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(given, schema)).collect()}
    assert texts == named
    for i, _, page in bare:
        assert wrappers.main_text(page, None, 0) != want[i]


def test_the_wrapper_outweighs_small_articles(spark):
    words = [f"w{i} " * 90 for i in range(8)]
    pages = [f"<body><article class=lead>Teaser {i}</article><div class=content><p>{w}</p><p>{w}</p></div></body>"
             for i, w in enumerate(words)]
    assert extracted(spark, pages) == [(w + w).strip() for w in words]
    assert wrappers.main_text(pages[0], None, 0) == "Teaser 0"
    pages = [p.replace("<p>", "<article>").replace("</p>", "</article>") for p in pages]
    assert extracted(spark, pages) == [(w + w).strip() for w in words]


def test_alignment_keeps_order_at_any_length():
    def items(labels):
        return [[x, "", []] for x in labels]

    a = items(["h", "p"] * 3000 + ["end"])
    b = items(["h", "p"] * 2500 + ["mid", "end"])
    whole = wrappers.align(a, b)
    assert len(whole) == len(a) + 1  # both are in it, in order, and nothing else
    for side in (a, b):
        left = iter(whole)
        assert all(any(x[0] == y[0] for y in left) for x in side)
    assert wrappers.align(whole, a) == whole and wrappers.align(whole, b) == whole
    # Pages that mix few labels leave a wrapper of bounded length.
    rng = np.random.default_rng(5)
    lengths, whole = [], items("abcde")
    for _ in range(600):
        whole = wrappers.align(whole, items(rng.choice(list("abcde"), 12).tolist()))
        lengths.append(len(whole))
    assert lengths[-1] <= 12 * 12 and lengths[-1] - lengths[299] <= 12


def test_salts_of_large_hosts(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "_SALT_BYTES", 2000)
    pages = [(i, f"http://{'hot' if i % 3 else i}.example/", f"<body><div class=top>Brand</div><div class=c><p>{f'w{i} ' * 30}</p>"
              "</div></body>") for i in range(120)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = wrappers._rows(df, "page_id", "url", "html")
    salts = {r.host: r.n for r in rows.groupBy("host").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts.pop("hot.example") > 4 and set(salts.values()) == {1}
    texts = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    assert len(texts) == 120
    assert all(texts[i] == f"w{i} " * 29 + f"w{i}" for i in range(120) if i % 3)


# Fingerprints

def test_equal_substrings_share_interior_phrases():
    rng = np.random.default_rng(3)
    shared = bytes(rng.integers(97, 117, 4000, dtype=np.uint8)).decode()
    a, b = "k" * 37 + "qwerty" + shared, shared + "other end"
    levels = parsing.phrases(*text_bytes(pa.array([a, b])))
    for names, at in levels[:4]:
        one, two = set(names[at[0]:at[1]].tolist()), set(names[at[1]:at[2]].tolist())
        assert len(one & two) >= min(len(one), len(two)) - 12


def test_labels_never_equal_their_neighbour():
    rng = np.random.default_rng(4)
    names = rng.integers(0, 4, 5000).astype(np.uint64)
    names = names[np.concatenate([[True], names[1:] != names[:-1]])]
    label = parsing._labels(names, np.zeros(1, np.int64))
    assert label.max() < 6 and (label[1:] != label[:-1]).all()


def test_fingerprints_of_edits(table_of):
    rows = [(1, "alpha beta gamma delta " * 40), (2, None), (3, "b"), (5, "same text here"), (5, "same text here"),
            (4, "é" * 9), (7, "long " * 40_000), (None, "no id, first of all"), (6, "")]
    df = table_of(rows)
    done = parsing.compare_with_edits(df).collect()
    assert len(done) == len(rows)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    want = {}
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        quarter = len(text) // 4
        changed = text[:len(text) - quarter] + following[:quarter]
        want.setdefault(i, []).append((len(text), hashlib.sha256(changed.encode()).hexdigest()))
    got = {}
    for r in done:
        got.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    own = {(r.doc_id, r.fingerprint) for r in parsing.fingerprints(df).collect()}
    assert {(r.doc_id, r.fingerprint) for r in done} == own
    assert parsing.compare_with_edits(df.limit(0)).collect() == []
    alone = parsing.compare_with_edits(table_of([(1, "abcdefgh")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1


def test_likeness_and_sketches_equal_plain_sets():
    rng = np.random.default_rng(5)
    for size in (1, 8, 64):
        for a, b in ((0, 0), (0, 3), (5, 5), (5, 64), (64, 64)):
            a, b = (np.unique(rng.integers(0, 90, n).astype(np.uint32))[:size] for n in (a, b))
            union = sorted({*a.tolist(), *b.tolist()})
            if max(len(a), len(b)) >= size:
                union = union[:size]
            j = len({*a.tolist()} & {*b.tolist()} & {*union}) / len(union) if len(a) and len(b) else float(len(a) == len(b))
            assert parsing.likeness(a, b, size) == 2 * j / (1 + j)
    texts = ["", "b", "same text here", "", "long " * 4000, bytes(rng.integers(97, 105, 9000, dtype=np.uint8)).decode()]
    levels = parsing.phrases(*text_bytes(pa.array(texts)))
    for i, found in enumerate(parsing._of_texts(texts)):
        few = levels[1][1][i + 1] - levels[1][1][i] < parsing.FEW
        names = {int(x) >> 32 for names, at in levels[0 if few else 1:] for x in names[at[i]:at[i + 1]]}
        assert found.tolist() == sorted(names)[:parsing.SIZE]


def test_choosing_the_smallest_names_costs_less_than_the_parse():
    rng = np.random.default_rng(6)
    data, offsets = rng.integers(97, 123, 2 << 20, dtype=np.uint8), np.linspace(0, 2 << 20, 1001).astype(np.int64)

    def seconds(work):
        spent = []
        for _ in range(3):
            began = time.process_time()
            work(data, offsets)
            spent.append(time.process_time() - began)
        return min(spent)

    assert seconds(parsing.sketches) < 1.8 * seconds(parsing.phrases)


def test_edits_stay_near(spark, documents):
    rows = parsing.compare_with_edits(spark.createDataFrame([d[:2] for d in documents], "doc_id long, text string")).collect()
    long = [r for r in rows if r.n_chars >= 400]
    assert np.mean([r.near_edited for r in long]) > 0.65
    assert np.mean([r.near_next for r in long]) < 0.15
