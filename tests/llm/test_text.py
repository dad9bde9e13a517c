"""URL rules, license scan, HTML text, toxicity and decontamination on awkward tables and against brute force."""

import random

import numpy as np
import pytest

from rillmark.llm.decontaminate import Matcher, decontaminate, drop_contaminated, myers, plain
from rillmark.llm.html_text import extract_text, main_text
from rillmark.llm.license_scan import NOTICES, PHRASES, RareIndex, license_scan, words_of
from rillmark.llm.toxicity import drop_toxic, features, fit_severity, toxicity, train
from rillmark.llm.url_filter import RULES, url_filter
from tests.llm.cases import awkward, documents, prose

RULE_SCHEMA = "host string, path string, verdict string"


def brute_url(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
        path = rest[:cut]
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_url_filter(spark):
    urls = [
        None, "", "no address", "http://A.Example.NET/en/x?y", "http://example.net/EN/", "https://net/", "https://net", "x://fakenet/",
        "http://b.org/fr/1#z", "http://b.org?q=/fr/", "https://example.com/de/#a://b.net/", "http://www.example.com/de", "http://é.net//?",
        "http://example.net/en/x", "http://example.net/en/x", "a://b://net/", "http://" + "s." * 300 + "net/" + "p" * 5000,
    ]
    pages = spark.createDataFrame([(k if k else None, u, 1, "x") for k, u in enumerate(urls)], "page_id bigint, url string, rule int, host string")
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    for size in (2_000_000, 1):
        got = url_filter(pages, rules, rules_per_block=size).collect()
        want = [(k if k else None, u, *brute_url(u, RULES)) for k, u in enumerate(urls)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_url_filter_no_rules_no_pages_and_both_verdicts(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    none = spark.createDataFrame([], RULE_SCHEMA)
    assert [r.verdict for r in url_filter(pages, none).collect()] == ["allow"]
    assert url_filter(pages.limit(0), none).count() == 0
    both = spark.createDataFrame([("b", "/", "allow"), ("B", "/", "block")], RULE_SCHEMA)
    assert [(r.rule, r.verdict) for r in url_filter(pages, both).collect()] == [("b/", "block")]


def brute_license(text):
    words = words_of((text or "").encode())
    phrases = {"cc-by": [b"cc", b"by"], "gpl": [b"general", b"public", b"license"], "reserved": [b"all", b"rights", b"reserved"]}
    places = [(k, label) for label, p in phrases.items() for k in range(len(words)) if words[k : k + len(p)] == p]
    at = [k for k, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in places}))


def test_license_scan(spark):
    rows = awkward() + [
        (50, "Licensed under CC BY-NC 4.0. cc-by cc by by"),
        (51, "All rights reserved. All\nRights; RESERVED all rights"),
        (52, "This work is licensed under the GNU General Public License, version 3.\n" + prose(3, 30)),
        (53, "Released under the MIT License."),
        (54, "released under license mit"),
        (55, "Licensed under the Apache License, Version 2.0."),
        (56, "ccby écc by 7cc by \u212Acc by"),
    ]
    got = {r.doc_id: r for r in license_scan(documents(spark, rows)).collect()}
    for i, t in rows:
        if i is not None:
            assert tuple(got[i])[1:6] == brute_license(t), i
            assert 0.0 <= got[i].score <= 1.0
            assert set(filter(None, got[i].base_labels.split(","))) <= set(got[i].labels.split(","))
    assert got[50].labels == "cc-by,cc-by-nc" and got[52].labels == "gpl,gpl-notice"
    assert got[53].labels == "mit" and got[54].labels == "" and got[55].labels == "apache"
    assert license_scan(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("notice", [n for n in NOTICES if len(n.text.split()) > 12], ids=lambda n: n.label)
def test_license_without_its_rarest_words(spark, notice):
    words = notice.text.split()
    must = {w for m in notice.mandatory for w in m.split()}
    changed = [w for w in dict.fromkeys(words) if w not in must][:3]
    df = {w.encode(): 40 if w in changed else 50 for w in words}
    text = " ".join("other" if w in changed else w for w in words)
    assert notice.label in RareIndex(PHRASES, NOTICES, df, 100, 3).scan(words_of(f"before {text}".encode()))[2]
    common = " ".join(w for w in words if w not in changed)
    rows = [(0, f"before {text} after")] + [(k, common) for k in range(1, 20)] + [(k, " ".join(changed)) for k in range(30, 36)]
    got = {r.doc_id: r.labels.split(",") for r in license_scan(documents(spark, rows)).collect()}
    assert notice.label in got[0]


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="wrap"><article><h1>A &amp; B</h1><p>First&nbsp;long   paragraph with
many words in it, and more<br>of them &lt;here&gt;.<p>Short.</p><div class="ad">Buy now</div><p><b>Bold <i>and</b> rest</p>
<ul><li>one<li>two</ul></article><aside>Side</aside></div><section id="comments"><p>Reader says a lot of words here, really a lot.</p></section>
<form><p>Your name</p></form><footer>&copy; me</footer>"""


def test_html_text():
    assert main_text(PAGE) == "A & B\nFirst long paragraph with many words in it, and more of them <here>.\nShort.\nBold and rest\none\ntwo"
    assert main_text("") == "" and main_text("<p>a<p>b") == "a\nb" and main_text("<nav>x</nav>") == ""
    assert main_text("<p>open &unknown; <b") is not None
    long = "<article>" + "<p>word &eacute;</p>" * 20_000 + "</article>"
    assert main_text(long).count("\n") == 19_999


def test_html_without_article():
    page = "<body><div class=menu><a>x</a></div><div id=c><h2>T</h2><p>Long text here that goes on and on.<p>ok</div><div class=comments><p>nice</div>"
    assert main_text(page) == "T\nLong text here that goes on and on.\nok"


@pytest.mark.parametrize("around", ["div class=has-sidebar", "div class='page no-comments'", "div class=with-ads", "section id=share-enabled",
                                    "div class=content-sidebar-wrap", "div class=overlay", "form id=aspnetForm"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_html_wrappers(around, inner):
    body = f"<{inner}><h1>Title</h1><p>{'Long text that goes on. ' * 20}</p><p>Short.</p><div class=ad>Buy</div></{inner}>"
    side = "<div class=sidebar><p>Other things to read</p></div><div id=comments><article><p>A reader says a lot of words.</p></article></div>"
    page = f"<body><nav><a>x</a></nav><{around}>{body}{side}</{around.split()[0]}><footer>me</footer>"
    assert main_text(page) == "Title\n" + ("Long text that goes on. " * 20).strip() + "\nShort."


def test_html_blocks_stay_outside():
    text = "Long text here that goes on and on, for a line or two."
    teaser = "<article><p>Something else that you may want to read today.</p></article>"
    assert main_text(f"<div id=c><p>{text}</p></div><aside>{teaser}</aside><div class=related>{teaser}</div>") == text
    assert main_text(f"<article><p>{text}</p><aside>{teaser}</aside></article>") == text
    comments = f"<div class=comments>{'<p>A reader has a lot to say about all this, really a lot.</p>' * 50}</div>"
    assert main_text(f"<div id=c><p>{text}</p></div>{comments}") == text == main_text(f"<article><p>{text}</p></article>{comments}")
    notice = f"<div class=cookie-notice><p>{'We use cookies, as all do. ' * 9}</p></div>"
    assert main_text(f"{notice}<article><p>{text}</p></article>") == text


def test_extract_text_table(spark):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (None, None, None, 2), (3, "v", "", 3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = sorted(map(repr, map(tuple, extract_text(pages).collect())))
    assert got == sorted(repr((i, u, main_text(h or ""), len(main_text(h or "")))) for i, u, h, _ in rows)
    assert extract_text(pages.limit(0)).count() == 0


def labelled(n, seed):
    rnd = random.Random(seed)
    bad = ["vile", "rotten", "foul", "nasty"]
    rows = []
    for k in range(n):
        toxic = rnd.random() < 0.2
        words = prose(seed * 100_000 + k, rnd.randint(20, 120)).split(" ")
        for _ in range(rnd.randint(2, 6) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_toxicity_held_out():
    rows, rest = labelled(600, 1), labelled(300, 2)
    rnd = random.Random(3)
    noisy = np.array([1 - t if rnd.random() < 0.03 else t for _, _, t in rows])
    model = fit_severity([np.array(features(t), dtype="<i4") for _, t, _ in rows], noisy)
    from rillmark.llm.toxicity import Scorer

    scorer = Scorer(model)
    above = [model.above(scorer.score(t)) for _, t, _ in rest]
    right = [(p[0] >= 0.5) == bool(y) for p, (_, _, y) in zip(above, rest)]
    assert np.mean(right) > 0.97
    assert all(p[0] >= p[1] for p in above) and list(model.thresholds) == sorted(model.thresholds)


def test_toxicity_on_held_out_labels():
    """Half of the given labels teach, the other half are foretold."""
    import pyarrow.parquet as pq

    from rillmark.llm.toxicity import Scorer, fit_tuned

    folder = "/root/testdata/sf0.1"
    docs, labels = (pq.read_table(f"{folder}/{n}.parquet").to_pydict() for n in ("documents", "labels"))
    toxic = dict(zip(labels["doc_id"], labels["toxic"]))
    rows = [(t, toxic[i]) for i, t in zip(docs["doc_id"], docs["text"]) if toxic.get(i) is not None]
    taught, held = rows[::2], rows[1::2]
    model = fit_tuned([np.array(features(t), dtype="<i4") for t, _ in taught], np.array([x for _, x in taught]))
    scorer = Scorer(model)
    called = np.array([model.above(scorer.score(t))[0] >= model.cut for t, _ in held])
    true = np.array([x for _, x in held]) == 1
    assert called[true].mean() >= 0.87 and (~called[~true]).mean() >= 0.97


def test_toxicity_tables(spark):
    rows = labelled(200, 4)
    docs = documents(spark, [(k, t) for k, t, _ in rows] + [(None, None), (900, ""), (900, "vile foul " + prose(1, 30)), (901, prose(2, 30_000))])
    labels = spark.createDataFrame([(k, t) for k, _, t in rows] + [(None, 1), (3, None), (5000, 1)], "doc_id bigint, toxic int")
    model = train(docs, labels)
    got = toxicity(docs, model)
    assert got.columns == ["doc_id", "severity", "p_toxic", "toxic"] and got.count() == 204
    left = drop_toxic(docs, model)
    assert left.columns == docs.columns
    assert left.count() == got.filter("NOT toxic").count()
    assert toxicity(docs.limit(0), model).count() == 0
    untold = train(docs, labels.limit(0))
    assert drop_toxic(docs, untold).count() == 204


def distance(a, b):
    """Least edit distance of a to any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers_and_matcher_against_table():
    rnd = random.Random(7)
    for _ in range(200):
        a = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 90)))
        b = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 120)))
        assert myers(a, b)[0] == distance(a, b)
    items = [(k, prose(500 + k, 25)) for k in range(8)] + [(90, "tiny one"), (91, ""), (92, None)]
    matcher = Matcher(items, 0.08, 25)
    for _ in range(150):
        k, text = rnd.choice(items[:8])
        chars = list(text)
        for _ in range(rnd.randint(0, 14)):
            at = rnd.randrange(len(chars))
            chars[at : at + 1] = rnd.choice([[], ["q"], [chars[at], "z"]])
        doc = prose(rnd.randint(0, 999), 20) + " " + "".join(chars) + " " + prose(rnd.randint(0, 999), 20)
        found = {i: d for i, d, *_ in matcher.find(doc)}
        want = {}
        for i, t in items[:8]:
            d = distance(plain(t), plain(doc))
            if d <= int(len(plain(t)) * 0.08):
                want[i] = d
        assert found == want
    assert [f[0] for f in matcher.find("Tiny, ONE!")] == [90] and matcher.find("a tiny one") == [] and matcher.find("") == []


def test_short_items_in_longer_texts():
    matcher = Matcher([(1, "Who wrote Faust?"), (2, "yes"), (3, "a longer item that is searched with errors as before")], 0.08, 25)
    assert matcher.find(prose(5, 40) + ": who wrote  FAUST, " + prose(6, 40)) == [(1, 0, 0, len(plain(prose(5, 40))) + 16)]
    assert matcher.find("Who wrote Faust") == [(1, 0, 0, 15)] and matcher.find("Yes!") == [(2, 0, 0, 3)]
    assert not matcher.find("anywho wrote faust") and not matcher.find("who wrote faustus") and not matcher.find("oh yes it is")


def test_decontaminate_tables(spark):
    item = prose(600, 30)
    rows = awkward() + [(70, prose(1, 5) + " " + item.upper().replace(" ", " ,\n") + " " + prose(2, 5)), (70, "clean"), (71, item[:60])]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(1, item, 5), (2, item, 5), (3, None, 5), (None, "x", 5), (4, "short", 5)], "item_id bigint, text string, doc_id int")
    for size in (8_000_000, 60):
        got = decontaminate(docs, items, block_chars=size).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(70, 1, 0), (70, 2, 0)]
        left = drop_contaminated(docs, items, block_chars=size)
        assert left.columns == docs.columns and left.count() == len(rows) - 1
    assert decontaminate(docs, items.limit(0)).count() == 0 and decontaminate(docs.limit(0), items).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ('<body><div class="comments"><p>I like it a lot and more</p></div></body>', ""),
        ('<div class="cookie-notice"><p>We use cookies here</p></div>', ""),
        ("<form><p>Your name please, and more</p></form>", ""),
        ('<body><div class="left-sidebar">' + "<p>side line of many words here</p>" * 6 + "</div><article><h1>Title</h1><p>One short.</p></article>", "Title\nOne short."),
        ('<form><header>Top</header><div class="x"><p>Body text of the page.</p></div><footer>f</footer></form>', "Body text of the page."),
        ('<div class="layout-sidebar"><nav>Menu</nav><div><p>Body text of the page.</p></div></div>', "Body text of the page."),
        ('<div class="comment-list"><article><p>I agree with the author.</p></article></div>', ""),
    ],
)
def test_what_never_comes_back(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("piece", ["<font><p>word word</p>", "<div>x ", "<b></i>y ", '<div class="ad">q ', "<span><li>a"])
def test_pages_are_read_in_linear_time(piece):
    import time

    def cost(n):
        start = time.process_time()
        main_text("<html><body>" + piece * n)
        return time.process_time() - start

    cost(1000)
    assert cost(40_000) < 30 * max(cost(4000), 0.02)
