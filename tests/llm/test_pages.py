"""Main text on hosts with fixed menus, copies, optional tags and odd names."""

import xxhash

from sqlyard.llm import pages

PAGES = "page_id long, url string, html string"


def words(*seed):
    """A few words that no other seed gives, without digits."""
    return " ".join("".join(chr(97 + int(d)) for d in str(xxhash.xxh64_intdigest(repr((*seed, i))) % 10**12)) for i in range(6))


def texts(spark, htmls, host="a.example"):
    rows = [(i, f"http://{host}/{i}", html) for i, html in enumerate(htmls)]
    return {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, PAGES)).collect()}


def test_repeated_parts_do_not_outvote_the_article(spark):
    menu = "<ul>" + "".join(f"<li>{words('menu', i)}</li>" for i in range(10)) + "</ul><div>All rights reserved</div><div><span>Read our rules</span></div>"
    for tag in ("div", "article"):
        own = {i: [words(tag, i, j) for j in range(3)] for i in range(60)}
        found = texts(spark, [f"<html><body>{menu}<{tag} class=text>" + "".join(f"<p>{t}</p>" for t in own[i]) + f"</{tag}></body></html>" for i in own])
        assert found == {i: "\n\n".join(own[i]) for i in own}


def test_names_take_no_article(spark):
    a, b, c, d, e = (words("name", i) for i in range(5))
    parts = f'<h2 id="related-work">{a}</h2><section id="search">{b}</section><p class="social-impact">{c}</p><div class="related">{d}</div>'
    htmls = [
        f"<body><article>{parts}</article></body>",
        f'<body><div class="content with-sidebar has-comments"><p>{e}</p><p>{e}</p>{parts}</div></body>',
        f'<body><div class="comments"><main>{parts}</main></div></body>',
        f'<body><div class="widget"><p>{a}</p><p>{b}</p></div><p>{c}</p></body>',
        f'<body><div class="ad">{d}</div><article><p>{a}</p></article><div id="comments">{b}</div></body>',
    ]
    found = {i: text for h, html in enumerate(htmls) for i, text in texts(spark, [""] * h + [html], f"h{h}.example").items() if i == h}
    assert found == {0: "\n\n".join([a, b, c, d]), 1: "\n\n".join([e, e, a, c]), 2: "\n\n".join([a, b, c, d]), 3: "\n\n".join([a, b, c]), 4: a}


def test_left_out_end_tags(spark):
    a, b, c = (words("tag", i) for i in range(3))
    htmls = [
        f"<html><head><title>x</title><body><p>{a}<p>{b}",
        f"<head><meta charset=utf-8><title>x</title><p>{a}<p>{b}",
        f"<head><title>x</title><style>p{{}}</style>{a}<hr>{b}",
        f"<title>x</title><ul><li><p>{a}<li><p>{b}</ul>",
        f"<head><script>1</script></head><table><thead><tr><th>{a}<tbody><tr><td>{b}<tr><td>{c}</table>",
    ]
    two = f"{a}\n\n{b}"
    assert texts(spark, htmls) == {0: two, 1: two, 2: two, 3: two, 4: f"{two}\n\n{c}"}
    assert [p for p, _, _ in pages.Blocks(htmls[4]).blocks] == ["table/thead/tr/th", "table/tbody/tr/td", "table/tbody/tr/td"]
    assert [p for p, _, _ in pages.Blocks(htmls[3]).blocks] == ["ul/li/p", "ul/li/p"]


def test_repeats_and_copies_of_articles_stay(spark):
    heads = [f"<article><h2>Summary</h2><p>{words('head', i)}</p></article>" for i in range(300)]
    copies = [f"<div class=text><h1>{words('copy')}</h1><p>{words('copied')}</p></div>"] * 300
    menu = "<nav><a href=/>Home</a></nav>"
    assert texts(spark, [menu + h for h in heads]) == {i: f"Summary\n\n{words('head', i)}" for i in range(300)}
    assert set(texts(spark, [menu + c for c in copies]).values()) == {f"{words('copy')}\n\n{words('copied')}"}


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "http://[", "<p>x y"), (None, "", ""), (3, "http://a", "<nav>menu</nav>")]
    found = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in pages.main_text(spark.createDataFrame(rows, PAGES)).collect()), key=repr)
    assert found == sorted([(1, None, "", 0), (2, "http://[", "x y", 3), (None, "", "", 0), (3, "http://a", "", 0)], key=repr)
    assert pages.main_text(spark.createDataFrame([], PAGES)).collect() == []


def site_of_sixty(inside="", outside="", lead=""):
    """Sixty pages of one host with own articles; what is put beside and inside them may use ``{i}`` in words."""
    own = {i: [words("own", i, j) for j in range(4)] for i in range(60)}

    def fill(part, i):
        return part.replace("{i}", words("fill", i))
    htmls = [f"<body>{lead}<article><h1>{own[i][0]}</h1><p>{own[i][1]}</p>{fill(inside, i)}<p>{own[i][2]}</p><p>{own[i][3]}</p></article>{fill(outside, i)}</body>" for i in own]
    return htmls, {i: "\n\n".join(own[i]) for i in own}


def test_comments_and_adverts_inside_the_article(spark):
    for part in ('<section class="comments"><p>{i}</p><p>so true {i}</p></section>', '<div class="ad">{i}</div>', '<div class="reader-comments"><p>{i}</p></div>',
                 '<div id="comment-list"><p>{i}</p></div>', "<p>Subscribe to our letter today</p>", '<div class="ad-slot">Buy now</div>', '<p class="newsletter">{i}</p>'):
        htmls, want = site_of_sixty(inside=part)
        assert texts(spark, htmls) == want, part


def test_names_of_several_words_outside(spark):
    htmls, want = site_of_sixty(outside='<div class="comment-list"><p>{i}</p></div><div id="ad_slot_3">{i}</div><div class="post-comments"><div>{i}</div></div>')
    assert texts(spark, htmls) == want


def test_one_page_of_a_host(spark):
    a, b, c = (words("one", i) for i in range(3))
    menu = "<ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/c>Contact us</a></ul>"
    plain = f"<body>{menu}<div class=text><p>{a}</p><p>{b}</p><p>{c} <a href=x>there</a></p></div><div>&copy; 2020 A house</div></body>"
    marked = f"<body>{menu}<h1>{a}</h1><main><p>{b}</p><p>{c}</p></main><div>All rights reserved</div></body>"
    for k, (html, want) in enumerate(((plain, f"{a}\n\n{b}\n\n{c} there"), (marked, f"{a}\n\n{b}\n\n{c}"))):
        assert texts(spark, [html], f"single{k}.example") == {0: want}


def test_hidden_and_inline_parts(spark):
    parts = {
        "<p>Hello <svg><title>x</title><path d=1 /></svg> world</p>": "Hello world", "<p>one<script>two</script> three</p>": "one three",
        "<p>a <span hidden>no</span>b <i style='display: none'>no</i><b aria-hidden=true>no</b>c</p>": "a b c", "<p>go <button>press</button>on</p>": "go on",
        "<p><ruby>漢<rt>kan</rt></ruby> <math><mi>x</mi></math> <my-part>own</my-part></p>": "漢kan x own", "<div hidden><p>no</p></div><p>yes</p>": "yes",
        "<p>a<template><p>no</p></template> b</p>": "a b", "<p>x <select><option>1<option>2</select> y</p>": "x y",
    }
    for html, want in parts.items():
        assert texts(spark, [html], "inline.example") == {0: want}, html


def test_deep_and_long_pages(spark):
    import time

    def seconds(n):
        html = "<div>word " * n + "</p></i>" * n
        start = time.perf_counter()
        page = pages.Blocks(html)
        page.priors()
        assert len(page.blocks) == n and max(len(p) for p, _, _ in page.blocks) < 200
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 16 * max(seconds(5_000), 0.02)
    deep, long = "<div>" * 10_000 + "deep", "<p>" + "many words " * 100_000
    found = texts(spark, [deep, long], "big.example")
    assert found[0] == "deep" and len(found[1]) == 1_099_999


def test_repeated_ids_and_other_columns(spark):
    rows = [(1, "http://a.example", f"<p>{words(i)}</p>", "x", 1.0) for i in range(3)]
    found = pages.main_text(spark.createDataFrame(rows, PAGES + ", path string, importance double"))
    assert sorted(r.text for r in found.collect()) == sorted(words(i) for i in range(3)) and found.columns == ["page_id", "url", "text", "n_chars"]
