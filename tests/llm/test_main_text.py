import pytest

from conceptnorm.llm.main_text import extract, main_text, smoothed

LONG = "A paragraph of text that goes on for a while, as those of articles do, with all that it has to say."

PAGES = [
    (None, ""), ("", ""), ("plain  text\n only", "plain text only"), ("<p>a<b>b</b>c &lt;x &eacute;&#8211;&amp;amp;</p>", "abc <x é–&amp;"),
    ("<script>var t='</p>';</script><style>p{}</style><p>a<br>b", "a b"),
    (f"<nav><a>x</a></nav><article><h1>T</h1><p>{LONG}<p>Sh.<p><b>{LONG}<br><p>Is.</article><footer>c {LONG}</footer>", f"T {LONG} Sh. {LONG} Is."),
    (f"<header><h1>Site {LONG}</h1></header><div id=main><h2>T</h2><p>{LONG}</p><div class='Ad box'>{LONG}</div><p>S.</p><p>{LONG}</p>"
     f"<div class=commentList><p>{LONG}</p></div><form><p>{LONG}</p></form></div><aside>{LONG}</aside>", f"T {LONG} S. {LONG}"),
    (f"<main><p>{LONG}</p><div role=navigation>{LONG}</div><div hidden>{LONG}</div><p>ok</p></main><div>{LONG}</div>", f"{LONG} ok"),
    (f"<article><p>{LONG}</p></article><article class='comment'><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><section id='cookie-notice'>{LONG}</section><span class='advert'>{LONG}</span><p>end</p>", f"{LONG} end"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<article>" + "<p>word word</p>" * 20000 + "</article>", " ".join(["word word"] * 20000)),
]


@pytest.mark.parametrize("html,text", PAGES)
def test_pages(html, text):
    assert extract(html) == text


ITEMS = "".join(f"<li>{i} {LONG}</li>" for i in range(20))
LISTED = " ".join(f"{i} {LONG}" for i in range(20))


@pytest.mark.parametrize("html,text", [
    (f"<div><h2>T</h2><p>intro</p><ul>{ITEMS}</ul><p>end</p></div>", f"T intro {LISTED} end"),
    (f"<body><h2>T</h2><p>a</p><p>b</p><p>c</p><p>d</p><ol>{ITEMS}</ol><p>e</p><p>f</p><p>g</p><p>h</p></body>", f"T a b c d {LISTED} e f g h"),
    (f"<div><h2>T</h2><p>by X</p><p>a</p><p>b</p><blockquote>{'<p>' + LONG + '</p>'}{'<p>' + LONG + '</p>'}</blockquote><p>c</p><p>d</p><p>e</p></div>",
     f"T by X a b {LONG} {LONG} c d e"),
    (f"<div><h1>T</h1><p>a</p><p>b</p><section>{ITEMS}</section><p>c</p><p>d</p><p>e</p></div>", f"T a b {LISTED} c d e"),
    ("<div>" + f"<div>{f'<p>{LONG}</p>' * 13}</div><div>{f'<p>{LONG}</p>' * 7}</div>" + "</div>", " ".join([LONG] * 20)),
    (f"<div><p>a</p><p>b</p><p>c</p><p>{LONG * 9}</p><p>d</p><p>e</p><p>f</p></div>", f"a b c {LONG * 9} d e f"),
    (f"<article>{f'<p>{LONG}</p>' * 9}</article><div><p>a</p><p>b</p><p>c</p></div><article><p>x</p></article>", " ".join([LONG] * 9) + " x"),
    (f"<div><nav>{LONG}</nav><p>{LONG}</p><ul>{ITEMS}</ul></div><footer>{LONG}</footer>", f"{LONG} {LISTED}"),
])
def test_dominant_parts_do_not_drop_the_rest(html, text):
    assert extract(html) == text


def test_smoothing_keeps_a_constant():
    import numpy as np
    assert np.allclose(smoothed(np.full(9, 3.0)), 3.0) and len(smoothed(np.ones(2))) == 2


def test_rows(spark):
    rows = [(i, "u", h, "x") for i, (h, _) in enumerate(PAGES[:8])] + [(None, None, PAGES[5][0], "x"), (1, "u", "", "x")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text(d, extra=["url"]).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text"}
    by_html = dict(PAGES[:8])
    assert {(r["page_id"], r["text"]) for r in got} == {(i, by_html[h]) for i, _, h, _ in rows}
    assert main_text(d.limit(0)).collect() == []
