"""Main text of pages: markup, character references, and repetition on a host."""

from __future__ import annotations

import numpy as np

from tests.llm.conftest import prose
from tidelog.llm.host_suffixes import LONG, main_text, prefix_names
from tidelog.llm.page_blocks import blocks_of


def article(html: str) -> str:
    return "\n".join(b.text for b in blocks_of(html) if b.inside and not b.furniture)


def test_article_without_the_rest_of_the_page():
    html = (
        "<!DOCTYPE html><head><title>t</title><style>p{}</style><script>var x = '</p><article>no</article>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><a href='/'>home</a></nav><div class='cookie-notice'>We use cookies</div>"
        "<article><header><h1>Title &amp; more</h1></header><p>One <b>bold</b>\n\t word&nbsp;here.<br><p>Two &lt;i&gt; &#233;&#x4e2d;<aside>side</aside>"
        "<form><input value='x'>form <button>go</button></form><ul><li>item<li>next</ul><div class='ad'>buy<div>now</div></div><!-- <p>gone</p> -->last"
        "<section id='comments'><article class='comment'><p>said</p></article></section></article><footer>&copy; f</footer>"
    )
    assert article(html) == "Title & more\nOne bold word here.\nTwo <i> é中\nitem\nnext\nlast"


def test_broken_markup():
    assert article("<article><p>a < b & c &amp d</p><p title='x>y'>e</p") == "a < b & c & d\ne"
    assert article("<nav>menu <article>text</article> more") == "text"
    assert article("<main><p class=ad>buy<p>text</main>") == "text"
    assert article("<article>a<!-- never closed <p>b</article>") == "a"
    assert [b.text for b in blocks_of("plain <3 text")] == ["plain <3 text"]
    assert blocks_of("") == []


def test_prefix_names_are_equal_for_equal_prefixes_only():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, 4000).astype(np.uint64)
    names = prefix_names(tokens, 8)
    by_text: dict[tuple, int] = {}
    for i, name in enumerate(names.tolist()):
        assert by_text.setdefault(tuple(tokens[i : i + 8].tolist()), name) == name
    assert len(set(by_text.values())) == len(by_text)
    assert len(prefix_names(tokens[:7], 8)) == 0


def test_repetition_settles_pages_without_a_container(spark):
    menu, notice = "Home News Sport Weather Travel Culture Science Opinion Jobs", "All rights reserved by the publishers of this site in every country"
    page = lambda text: f"<body><div>{menu}</div><div><p>{text}</p></div><div>{notice}</div></body>"
    rows = [(i, f"https://a.example/{i}", page(prose(i, 30))) for i in range(6)]
    rows += [(10, "https://b.example/x", page(prose(50, 30)))]  # alone on its host: nothing repeats
    rows += [(11, "https://c.example/1", page(prose(60, 30))), (12, "https://c.example/2", page(prose(60, 30)))]  # copies of each other
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert LONG <= len(menu.split())
    for i in range(6):
        assert got[i] == prose(i, 30)
    assert got[10] == f"{menu}\n{prose(50, 30)}\n{notice}"
    assert got[11] == got[12] == f"{menu}\n{prose(60, 30)}\n{notice}"


def test_near_copies_without_a_container_stay(spark):
    menu = "Home News Sport Weather Travel Culture Science Opinion Jobs"
    page = lambda text, *lines: f"<body><div>{menu}</div><div>{''.join(f'<p>{t}</p>' for t in (text, *lines))}</div></body>"
    same, other = prose(70, 80), prose(71, 80)
    rows = [(1, "https://a.example/1", page(same, "Updated on 3 May")), (2, "https://a.example/2", page(same, "Read 1204 times"))]
    rows += [(10 + i, "https://b.example/", page(prose(80 + i, 40))) for i in range(4)]
    rows += [(20 + i, "https://b.example/", page(other, f"By author {i} today", prose(90 + i, 9))) for i in range(3)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == f"{menu}\n{same}\nUpdated on 3 May" and got[2] == f"{menu}\n{same}\nRead 1204 times"
    for i in range(4):
        assert got[10 + i] == prose(80 + i, 40)
    for i in range(3):
        assert got[20 + i] == f"{other}\nBy author {i} today\n{prose(90 + i, 9)}"


def test_repeated_runs_are_cut_out_of_blocks(spark):
    notice = "All rights reserved by the publishers of this site in every country"
    rows = [(i, "https://a.example/", f"<p>{prose(110 + i, 30)} {notice} {prose(120 + i, 30)}</p><p>{notice}</p>") for i in range(4)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{prose(110 + i, 30)} {prose(120 + i, 30)}" for i in range(4)}


def test_copied_articles_stay(spark):
    html = f"<article><p>{prose(1, 200)}</p></article>"
    rows = [(i, "http://h/", html) for i in range(4)]
    assert {r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {prose(1, 200)}


def test_hard_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "x", "<p>t"), (3, "u", "<article></article>"), (3, "u", "<article></article>"), (4, "u", "<article>" + "<p>w " * 20_000), (5, "u", "<" * 3000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, row int, text int")
    got = main_text(docs).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == "" and by_id[None] == "t" and by_id[4] == "\n".join(["w"] * 20_000)
    assert main_text(docs.limit(0)).count() == 0


FOREIGN = {
    "<article><p>a</p><svg/><p>b</p></article>": "a\nb",
    "<article><p>a <svg><title>t</title><text>no</text></svg> c</p><p>b</p></article>": "a c\nb",
    "<article><p>a<math> x <p>b</p></article>": "a\nb",
    "<article><p>a</p><math><mi>x</mi></math><p>b</p></article>": "a\nb",
    "<article><p>a</p><iframe src=x><p>b</p></article>": "a\nb",
    "<article><p>a</p><iframe src=x><p>no</p></iframe><p>b</p></article>": "a\nb",
    "<article><p>a</p><template><p>no</p></template><p>b</p></article>": "a\nb",
    "<article><p>a</p><noscript><p>no</p></noscript><p>b</p></article>": "a\nb",
    "<article><svg viewBox='0'><g><path d='m'/></g></svg><h1>t</h1></article>": "t",
}


def test_foreign_and_raw_elements_take_no_article_text(spark):
    rows = [(i, f"https://h{i}.example/", html) for i, html in enumerate(FOREIGN)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {html: got[i] for i, html in enumerate(FOREIGN)} == FOREIGN


def test_names_that_begin_like_furniture_are_hints_inside_an_article(spark):
    own = ["<p class='share-price'>Up {i} percent</p>", "<h2 class='header-2'>Part {i}</h2>", "<div class='social-science'>Study {i}</div>"]
    links = "<div class='related-links'><a href=/a>First page</a> <a href=/b>Second page</a></div>"
    bar = "<div class='share-bar'>Send this to a friend</div>"
    whole = "<div class='share'>Tell all</div><div class='ad'>Buy {i}</div><div class='comments'>Nice {i}</div>"
    page = lambda i: f"<article><p>Start {i}</p>{''.join(own)}{links}{bar}{whole}<p>End {i}</p></article>".replace("{i}", str(i))
    rows = [(i, "https://a.example/", page(i)) for i in range(3)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Start {i}\nUp {i} percent\nPart {i}\nStudy {i}\nEnd {i}" for i in range(3)}
    alone = main_text(spark.createDataFrame([(1, "https://b.example/", "<article><p>x</p><div class='share-bar'>Send it</div></article>")], "page_id long, url string, html string"))
    assert alone.first().text == "x\nSend it"


def test_hinted_parts_are_cut_by_the_arrays_of_all_pages(spark):
    line = "Send this page to a friend or to all of them today"
    page = lambda i, part, foot="": f"<article><p>{prose(i, 30)}</p><div class='share-bar'>{part}</div></article><footer>{foot}</footer>"
    # On the first host another page has the line as furniture, on the second both have it with a number behind, on the last nobody else.
    rows = [(1, "https://a.example/", page(180, line)), (2, "https://a.example/", f"<article><p>{prose(181, 30)}</p></article><footer>{line}</footer>")]
    rows += [(10 + i, "https://b.example/", page(182 + i, f"{line} {'so many people did it before you ' * i}{i}")) for i in range(2)]
    rows += [(20, "https://c.example/", page(184, line))]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == prose(180, 30) and got[2] == prose(181, 30) and got[20] == f"{prose(184, 30)}\n{line}"
    assert got[10] == f"{prose(182, 30)}\n0" and got[11] == f"{prose(183, 30)}\nso many people did it before you 1"


def test_lines_of_articles_stay_where_they_are_furniture_elsewhere(spark):
    line = "Send this page to a friend or to all of them today"
    rows = [(i, "https://a.example/", f"<article><p>{prose(190 + i, 30)}</p><p>{line}</p></article><footer>{line}</footer>") for i in range(3)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{prose(190 + i, 30)}\n{line}" for i in range(3)}
