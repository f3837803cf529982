import html
import itertools
import re
import time

import numpy as np
import pytest

from framelark.llm import html_blocks, html_crf, html_pages

SF = "/root/testdata/sf0.01"
FLOOD = "The river rose for three days, and the town moved its market to the hill."
MAYOR = "Nobody had planned for so much water, said the mayor, who stood on the bridge."
SHOPS = "By Sunday the shops were open again."
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact us</a></li></ul></nav>'
FOOT = '<footer><p>&copy; 2024 Example Media. All rights reserved.</p></footer>'
SHAPES = {
    "h3 inside": (f"<html><body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><h3>What came next</h3><p>{MAYOR}</p></article>{FOOT}</body></html>", ["Flood", FLOOD, "What came next", MAYOR]),
    "h3 then last": (f"<article><h1>Flood</h1><p>{FLOOD}</p><h3>After</h3><p>{SHOPS}</p></article>", ["Flood", FLOOD, "After", SHOPS]),
    "ends h3": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><h4>Later</h4></article>{FOOT}", ["Flood", FLOOD, "Later"]),
    "table end": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><table><tr><th>Day<th>Level<tr><td>Monday<td>3 m</table></article>{FOOT}", ["Flood", FLOOD, "Day", "Level", "Monday", "3 m"]),
    "pre end": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><pre>level = 3\nprint(level)</pre></article>{FOOT}", ["Flood", FLOOD, "level = 3 print(level)"]),
    "ul end": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><ul><li>Monday</li><li>Tuesday</li></ul></article>{FOOT}", ["Flood", FLOOD, "Monday", "Tuesday"]),
    "dl end": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><dl><dt>Level<dd>How high it stands.</dl></article>{FOOT}", ["Flood", FLOOD, "Level", "How high it stands."]),
    "figure": (f"<body>{NAV}<article><h1>Flood</h1><figure><img src=x><figcaption>The old bridge on Monday.</figcaption></figure><p>{FLOOD}</p></article>{FOOT}", ["Flood", "The old bridge on Monday.", FLOOD]),
    "details": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><details><summary>More</summary><p>{MAYOR}</p></details></article>{FOOT}", ["Flood", FLOOD, "More", MAYOR]),
    "blockquote": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><blockquote><p>{MAYOR}</p></blockquote></article>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "no tags": (f"{FLOOD} {MAYOR}", [f"{FLOOD} {MAYOR}"]),
    "no tags short": ("Hello there", ["Hello there"]),
    "p only": (f"<p>{FLOOD}<p>{MAYOR}", [FLOOD, MAYOR]),
    "div two p": (f"<html><body><div><p>{FLOOD}</p><p>{MAYOR}</p></div></body></html>", [FLOOD, MAYOR]),
    "div.post short": (f'<html><body><div class=post><p>{SHOPS}</p></div></body></html>', [SHOPS]),
    "div.post nav": (f'<html><body>{NAV}<div class=post><p>{SHOPS}</p></div>{FOOT}</body></html>', [SHOPS]),
    "script unquoted": (f"<body><article><script src=https://x.com/>var a=1;</script><p>{FLOOD}</p></article>", [FLOOD]),
    "section": (f"<body>{NAV}<main><section><h2>One</h2><p>{FLOOD}</p></section><section><h2>Two</h2><p>{MAYOR}</p></section></main>{FOOT}", ["One", FLOOD, "Two", MAYOR]),
    "div self": (f"<body>{NAV}<article><h1>T</h1><div/><p>{FLOOD}</p></div></article>{FOOT}", ["T", FLOOD]),
    "data-id": (f'<body>{NAV}<article data-id="menu" title="hidden sidebar"><h1>T</h1><p title="hidden">{FLOOD}</p></article>{FOOT}', ["T", FLOOD]),
    "unclosed select": (f"<body><form><select><option>One<option>Two</form><article><h1>T</h1><p>{FLOOD}</p><p>{MAYOR}</p></article>{FOOT}", ["T", FLOOD, MAYOR]),
    "math": (f"<body>{NAV}<article><h1>T</h1><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be the level, which is what everybody saw that day.</p><p>{MAYOR}</p></article>{FOOT}", ["T", "Let x=2 be the level, which is what everybody saw that day.", MAYOR]),
    "div text br": (f"<html><body>{NAV}<div id=content>{FLOOD}<br><br>{MAYOR}</div>{FOOT}</body></html>", [f"{FLOOD} {MAYOR}"]),
    "nested div": (f"<html><body><div><div><div><h1>Flood</h1><p>{FLOOD}</p><p>{MAYOR}</p></div></div></div></body></html>", ["Flood", FLOOD, MAYOR]),
    "aside in article": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><aside class=related><h3>Read more</h3><ul><li><a href=1>Storm over the bay</a><li><a href=2>Rain</a></ul></aside><p>{MAYOR}</p></article>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "ad in article": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><div class=ad>Buy boats now, very cheap.</div><p>{MAYOR}</p></article>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "comments": (f"<body>{NAV}<article><h1>Flood</h1><p>{FLOOD}</p><p>{MAYOR}</p></article><section id=comments><h2>Comments</h2><article class=comment><p>I was there, and it was worse than that.</p></article><form><p>Leave a reply</p><textarea></textarea><button>Send</button></form></section>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "header site": (f"<body><header><h1>The Daily Example</h1><p>News since 1901</p></header>{NAV}<article><header><h1>Flood</h1></header><p>{FLOOD}</p><p>{MAYOR}</p></article>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "cookie": (f'<body><div class="cookie-banner"><p>We use cookies to improve your visit, please accept them.</p><button>OK</button></div><main><h1>Flood</h1><p>{FLOOD}</p><p>{MAYOR}</p></main>{FOOT}', ["Flood", FLOOD, MAYOR]),
    "p class intro": (f'<body>{NAV}<div class="entry-content"><p class="intro">{FLOOD}</p><p>{MAYOR}</p></div><aside><p>Follow us</p></aside>{FOOT}', [FLOOD, MAYOR]),
    "td layout": (f'<table><tr><td class=menu><a href=1>Home</a><br><a href=2>News</a></td><td class=content><h1>Flood</h1><p>{FLOOD}</p><p>{MAYOR}</p></td></tr></table>', ["Flood", FLOOD, MAYOR]),
    "one p article": (f"<html><body>{NAV}<article><p>{SHOPS}</p></article>{FOOT}</body></html>", [SHOPS]),
    "unclosed a": (f"<body><nav><a href=1>Home <a href=2>News</nav><article><h1>Flood</h1><p>{FLOOD}<p>{MAYOR}</article>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "entity split": (f"<article><p>Fish &am<b>p;</b> chips &lt;b&gt; &copy 2 &#8364;5&nbsp;x</p></article>", ["Fish &amp; chips <b> © 2 €5 x"]),
    "only chrome": (f"<body>{NAV}{FOOT}</body>", []),
    "empty": ("", []),
}


BODY, TEXT = f"<h1>Flood</h1><p>{FLOOD}</p><p>{MAYOR}</p>", ["Flood", FLOOD, MAYOR]
#: What once leaked or stands in no list, no named part, or under names in other languages.
SHAPES |= {
    "menu in a line": (f"<nav><a href=/>Home</a> <a href=/n>News</a></nav><div id=content>{BODY}</div>", TEXT),
    "menu before bare p": (f"<nav><a href=/>Home</a> <a href=/n>News</a></nav><p>{FLOOD}</p><p>{MAYOR}</p>", [FLOOD, MAYOR]),
    "header's own text": (f"<header>Site name</header><div class=body><p>{FLOOD}</p><p>{MAYOR}</p></div>", [FLOOD, MAYOR]),
    "layout table": (f"<table><tr><td><a href=1>Home</a> <a href=2>News</a></td></tr><tr><td>{BODY}</td></tr><tr><td>&copy; 2024 Example</td></tr></table>", TEXT),
    "layout table, side": (f"<table><tr><td><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></td><td>{BODY}</td></tr><tr><td>&copy; 2024 Example Media</td></tr></table>", TEXT),
    "German": (f"<div class=kopf>Tagblatt</div><div class=inhalt>{BODY}</div><div class=fuss>Impressum</div>", TEXT),
    "French": (f"<div class=entete>Le Jour</div><div id=contenu>{BODY}</div><div class=commentaires><p>J'y étais.</p></div><div class=pied>Contact</div>", TEXT),
    "Spanish": (f"<div class=cabecera>El Día</div><div class=contenido>{BODY}</div><div class=comentarios><p>Yo estuve allí.</p></div><div class=pie>Aviso legal</div>", TEXT),
    "teaser beside": (f'<main><article>{BODY}</article><article class="card teaser"><h3><a href=x>Storm over the bay</a></h3><p>Rain is on its way to the coast.</p></article></main>', TEXT),
    "teasers below": (f'<article>{BODY}</article><section class=grid><div class=tile><h3><a href=x>Storm over the bay</a></h3><p>Rain is on its way.</p></div><div class=tile><h3><a href=y>Snow on the hills</a></h3><p>Winter comes early.</p></div></section>', TEXT),
    "responses": (f"<article>{BODY}</article><div class=responses><div><b>Ann</b> 3 May 2024<p>I was there too.</p></div><div><b>Bob</b> 4 May 2024<p>It was worse in the valley, I think.</p></div></div>", TEXT),
    "reviews": (f"<div class=content>{BODY}</div><div id=reviews><div><h4>Ann</h4><p>I was there too.</p></div><div><h4>Bob</h4><p>It was worse in the valley.</p></div></div>", TEXT),
    "nameless comments": (f"<article>{BODY}</article><section><div><h5>Ann, 3 May 2024</h5><p>I was there too.</p></div><div><h5>Bob, 4 May 2024</h5><p>It was worse in the valley.</p></div></section>", TEXT),
    "form's label": (f"<div class=content>{BODY}<form><label>Your mail</label><input></form></div>", TEXT),
    "nameless menu": (f"<p><a href=1>Home</a> | <a href=2>News</a> | <a href=3>Sport</a></p>{BODY}", TEXT),
    "footer in a line": (f"<article>{BODY}</article><footer><a href=1>Imprint</a> | <a href=2>Privacy</a></footer>", TEXT),
    "a link in a paragraph stays": (f"{NAV}<article><h1>Flood</h1><p>{FLOOD} See <a href=1>the map</a> and <a href=2>the levels</a>.</p><p>{MAYOR}</p></article>{FOOT}", ["Flood", f"{FLOOD} See the map and the levels.", MAYOR]),
    "a date in a paragraph stays": (f"{NAV}<article><h1>Flood</h1><p>On 3 May 2024 the river rose, and the town moved its market.</p><p>{MAYOR}</p></article>{FOOT}", ["Flood", "On 3 May 2024 the river rose, and the town moved its market.", MAYOR]),
    "sections alike stay": (f"{NAV}<article><h1>Flood</h1><section><h2>Monday</h2><p>{FLOOD}</p></section><section><h2>Tuesday</h2><p>{MAYOR}</p></section><section><h2>Sunday</h2><p>{SHOPS}</p></section></article>{FOOT}", ["Flood", "Monday", FLOOD, "Tuesday", MAYOR, "Sunday", SHOPS]),
    "list of sentences stays": (f"{NAV}<div class=inhalt><h1>Flood</h1><ul><li>{FLOOD}</li><li>{MAYOR}</li></ul></div>{FOOT}", ["Flood", FLOOD, MAYOR]),
    "breadcrumbs": (f'<div class=breadcrumb><a href=1>Home</a> › <a href=2>News</a></div><div class=post>{BODY}</div>', TEXT),
    "side in Spanish": (f"{NAV}<div class=contenido>{BODY}</div><div class=lateral><h3>Popular</h3><p>Storm over the bay</p></div>{FOOT}", TEXT),
}


@pytest.mark.parametrize("name", list(SHAPES))
def test_shapes(name):
    page, want = SHAPES[name]
    assert html_crf.main_text(page, html_crf.trained()).split("\n") == (want or [""])


HOSTILE = {
    "tags that never end": "<a " * 350_000, "signs": "<" * 1_000_000, "deep": "<div>" * 200_000 + "x", "names": "".join(f"<div class=c{i}>" for i in range(60_000)) + "x",
    "items under a deep list item": "<ul><li><ul>" + "<div>" * 100_000 + "<li>" * 100_000, "quotes": '<a b="' * 170_000, "comments": "<!--" * 250_000, "titles": "<title>" * 140_000,
    "ends": "</p>" * 250_000, "unclosed in the line": "<b>" * 200_000 + "x" + "</b>" * 200_000, "paragraphs": "<p><b><div>" * 90_000, "number": "&#" + "9" * 1_000_000,
    "zeros": "&#" + "0" * 9_000 + "65;", "hex": "&#x" + "f" * 500_000, "attributes": "<a " + "x=1 " * 250_000 + ">t", "svg": "<svg>" + '<path d="M0"/>' * 70_000,
}


@pytest.mark.parametrize("name", list(HOSTILE))
def test_hostile_pages_take_linear_time(name):
    model = html_crf.trained()
    began = time.process_time()
    got = html_crf.main_text(HOSTILE[name], model)
    assert time.process_time() - began < 8  # the square of these sizes would take minutes
    if name == "zeros":
        assert got == "A"


def test_deep_pages_share_their_paths():
    one, two = (min(_seconds("<div class=a>" * n + "x") for _ in range(3)) for n in (8_000, 64_000))
    assert two < 8 * 4 * one


def _seconds(page):
    model, began = html_crf.trained(), time.process_time()
    html_crf.main_text(page, model)
    return time.process_time() - began


def texts(page):
    return [b.text for b in html_blocks.blocks(page)]


def test_tags_are_read_as_the_standard_says():
    assert texts("a<div/>b</div>c") == ["a", "b", "c"]  # a div doesn't close itself
    assert texts("<p a='>'>x<p b=\">\">y") == ["x", "y"]
    assert texts("<p>a<!-->b<!--x--!>c<!-- <p> -->d<?x>e<!y>f</ z>g") == ["abcdefg"]
    assert texts("a < b <3 <> x") == ["a < b <3 <> x"]
    assert texts("x<script>'</scripty>' <p></SCRIPT >y<style>z") == ["xy"]
    assert texts("<title>no<p>yes") == ["no", "yes"] and texts("<title>no</title>yes<p") == ["yes"]
    assert texts("<table><tr><td>1<td>2<tr><td><p>3</div>4</table>5") == ["1", "2", "34", "5"]
    assert texts("<ul><li>1<ul><li>2</ul>3<li>4</ul>") == ["1", "2", "3", "4"]
    assert texts("<p>a<span>b<div>c</span>d</div>e") == ["ab", "cd", "e"]
    assert texts("<x-y>a<p>b</x-y>c") == ["a", "bc"]
    assert [b.linked for b in html_blocks.blocks("<a href=x>ab<p>cd</a>ef<p>gh")] == [1.0, 0.5, 0.0]
    assert texts("<p>a&nbsp; \n b<br>c<wbr>d</p>") == ["a b cd"]


def test_pages(spark):
    rows = [
        (1, "u", "<html><head><title>T</title><script>var a='</p>';</script><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></ul></nav><div class='ad'>Buy now, cheap.</div><article><h1>A &amp; B</h1><p>First  <b>bold\n text<br>more.<p>Second&nbsp;one, with &lt;tags&gt;.<!-- no --></article><div id=comments><p>A reader says, hello there.</p></div><footer>All rights</footer></body></html>"),
        (2, None, None), (3, "u", ""), (3, "u", ""), (None, "u", "<p"), (5, "u", "<<<>>> & <a <b"), (6, "u", "<script>never closed"),
    ]
    got = html_crf.extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == "A & B\nFirst bold text more.\nSecond one, with <tags>."
    assert text[2] == text[3] == text[6] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_crf.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_labels_of_held_out_pages():
    rng, right, n = np.random.default_rng(77), 0, 0
    for _ in range(100):
        page, labels = html_pages.labelled_page(rng)
        found = html_crf.trained().decode(html_blocks.blocks(page))
        right += sum(a == b for a, b in zip(found, labels, strict=True))
        n += len(labels)
    assert right / n > 0.97


def test_viterbi_against_all_labelings():
    model = html_crf.trained()
    rng = np.random.default_rng(3)
    for _ in range(5):
        page = html_blocks.blocks(html_pages.labelled_page(rng)[0])[:9]
        score = [sum(model.weight.get(f, 0) for f in found) for found in html_crf.all_features(page)]

        def total(labels, score=score):
            return model.start[labels[0]] + sum(s for s, on in zip(score, labels, strict=True) if on) + sum(model.move[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=len(page)), key=total)
        assert total(tuple(map(int, model.decode(page)))) == pytest.approx(total(best))


def test_pages_of_the_test_data(spark):
    """The article of each page, cut out by hand."""
    for r in spark.read.parquet(f"{SF}/pages.parquet").limit(100).collect():
        body = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        lines = [re.sub("<[^>]*>", "", x) for x in re.split("</?(?:p|h1|br)>", body)]
        want = "\n".join(" ".join(html.unescape(x).split()) for x in lines if x.strip())
        assert html_crf.main_text(r["html"], html_crf.trained()) == want
