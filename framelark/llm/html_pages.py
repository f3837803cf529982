"""Made-up pages with labelled blocks, for training: no labels of real pages exist here. They vary what pages vary in: elements,
names, wrappers, what an article holds and ends with, what stands around it, and tags that are left out."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Names that pages give to their parts.
CONTENT_NAMES = "article-body content entry-content post post-content story main-content article entry text body-text page-content articleBody prose inhalt artikel beitrag artikeltext contenu texte corps contenido articulo cuerpo".split()
OTHER_NAMES = {
    "nav": "menu navbar nav main-menu breadcrumb breadcrumbs topnav pagination toc navigation menue hauptmenue navi", "header": "header masthead site-header topbar banner page-header branding kopf kopfzeile entete cabecera",
    "footer": "footer site-footer copyright colophon bottom page-footer fuss fusszeile impressum pied pie", "aside": "sidebar side-bar related widget rail recommended popular side trending seitenleiste randspalte colonne lateral",
    "div": "ad ads advert advertisement ad-slot sponsored promo banner-ad adsbygoogle commercial werbung anzeige publicite publicidad werbung anzeige", "notice": "cookie cookie-notice cookie-banner consent notice alert gdpr popup modal disclaimer hinweis datenschutz avis aviso",
    "form": "form newsletter subscribe signup login search search-form contact-form formular anmeldung suche recherche buscar", "comments": "comments comment comment-list discussion replies respond comment-body reply responses reviews feedback kommentare commentaires comentarios antworten meinungen",
    "share": "share social share-buttons tools meta-links tags social-links teilen partager compartir",
    "teaser": "card teaser preview tile read-next more-stories mehr weitere",
}
_SYLLABLES = "an er in on ti re th es la mo ka du ne so vi pra stu gel ber".split()
_HEADINGS = ["h2", "h3", "h4", "h5", "h6"]


class Maker:
    """Writes a page: add() puts a block down and notes whether it belongs to the article."""

    def __init__(self, rng: np.random.Generator):
        self.rng, self.parts, self.labels = rng, [], []
        self.loose = rng.random() < 0.3  # a page that leaves end tags of paragraphs and items out

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def pick(self, values: str | list[str]) -> str:
        values = values.split() if isinstance(values, str) else values
        return values[int(self.rng.integers(len(values)))]

    def words(self, low: int, high: int, end: str = "") -> str:
        n = int(np.exp(self.rng.uniform(np.log(low), np.log(high + 1))))  # short ones are common
        sizes = self.rng.integers(1, 4, n)
        drawn = iter(self.rng.integers(len(_SYLLABLES), size=int(sizes.sum())).tolist())
        return " ".join("".join(_SYLLABLES[next(drawn)] for _ in range(k)) for k in sizes.tolist()).capitalize() + end

    def sentence(self, low: int = 3, high: int = 40) -> str:
        text = self.words(low, high, "." if self.chance(0.8) else "")
        if self.chance(0.05):
            return text.replace(" ", f" {self.date()} ", 1)
        if self.chance(0.1):
            return text.replace(" ", self.pick([" | ", " » ", "%%% ", " 12 ", "!! ", " &amp; "]))
        return text.replace(" ", ", ", 1) if self.chance(0.5) else text

    def inner(self, text: str) -> str:
        """text with markup that stands in the line."""
        first, space, rest = text.partition(" ")
        kind = self.rng.random()
        if kind < 0.08:
            return f"<b>{first}{space}{rest}<br>"
        if kind < 0.16:
            return f'{first}{space}<a href="#">{rest[: len(rest) // 4]}</a>{rest[len(rest) // 4 :]}'
        if kind < 0.22:
            return f"<em>{first}</em>{space}<span>{rest}</span>"
        if kind < 0.25:
            return f"{first}<br>{space}{rest}"
        return text

    def add(self, tag: str, text: str, content: bool, link: bool = False, close: bool = True, attr: str = "") -> None:
        text = f'<a href="#">{text}</a>' if link else text
        open_ended = self.loose and tag in ("p", "li", "td", "tr", "dt", "dd") and close
        self.parts.append((f"<{tag}{attr}>" if tag else "") + text + (f"</{tag}>" if tag and not (open_ended and self.chance(0.7)) else ""))
        self.labels.append(content)

    def attribute(self, names: str | list[str]) -> str:
        kind = self.rng.random()
        name = self.pick(names) + ("" if self.chance(0.7) else f" x{self.rng.integers(9)}")
        return "" if kind < 0.2 else f' class="{name}"' if kind < 0.65 else f' id="{name}"' if kind < 0.85 else f" data-id=7 class='{name}'"

    def inside(self, tag: str, attr: str, body: Callable[[], None]) -> None:
        self.parts.append(f"<{tag}{attr}>" if tag else "")
        body()
        self.parts.append(f"</{tag}>" if tag else "")

    def date(self) -> str:
        a, b, c = int(self.rng.integers(1, 13)), int(self.rng.integers(1, 28)), int(self.rng.integers(1999, 2026))
        return self.pick([f"{b} May {c}", f"{b}.{a}.{c}", f"{c}-{a:02}-{b:02}", f"{a} hours ago", f"vor {a} Tagen", f"il y a {a} jours", f"June {b}, {c}"])

    def line_of_links(self, low: int = 2, high: int = 7) -> None:
        """Links that stand in one line, as one block."""
        links = [f'<a href="#">{self.words(1, 3)}</a>' for _ in range(self.rng.integers(low, high))]
        self.add("", self.pick([" ", " | ", " &middot; ", "\n", ", ", "&nbsp;"]).join(links), False)

    def teasers(self) -> None:
        """Boxes that lead to other articles."""
        tag, names = self.pick("article article div li section"), self.attribute(OTHER_NAMES["teaser"])
        names = names or f' class="{self.pick(OTHER_NAMES["teaser"])} x{self.rng.integers(9)}"'
        head, more = self.pick("h2 h3 h3 h4"), self.chance(0.4)
        for _ in range(self.rng.integers(1, 5)):
            self.parts.append(f"<{tag}{names}>")
            self.add(head, self.words(2, 9), False, self.chance(0.8), close=False)
            if self.chance(0.8):
                self.add("p", self.sentence(3, 25), False, close=False)
            if more:
                self.add(self.pick("p div"), self.words(1, 3), False, True, close=False)
            self.parts.append(f"</{tag}>")

    def table(self, content: bool) -> None:
        self.parts.append("<table>")
        if self.chance(0.3):
            self.add("caption", self.words(1, 6), content)
        for i in range(self.rng.integers(1, 4)):
            self.parts.append("<tr>")
            for _ in range(self.rng.integers(1, 4)):
                self.add("th" if i == 0 and self.chance(0.4) else "td", self.words(1, 4) if self.chance(0.7) else self.sentence(1, 20), content, close=False)
            self.parts.append("</tr>")
        self.parts.append("</table>")

    def links(self, low: int, high: int, content: bool = False, tag: str = "li") -> None:
        self.parts.append("<ul>" if tag == "li" else "")
        for _ in range(self.rng.integers(low, high)):
            self.add(tag, self.words(1, 5), content, True)
        self.parts.append("</ul>" if tag == "li" else "")

    def form(self) -> None:
        if self.chance(0.4):  # the form's own text
            self.add("", f"<label>{self.words(1, 4)}</label>" if self.chance(0.7) else self.words(1, 5), False)
            self.parts.append("<input name=x>")
            if self.chance(0.5):
                self.add("p", f"<label>{self.words(1, 4)}</label> <input>", False)
        elif self.chance(0.7):
            self.add(self.pick("p h3 h2 div"), self.words(1, 8), False)
        if self.chance(0.3):
            self.parts.append("<select>")
            for _ in range(self.rng.integers(1, 4)):
                self.add("option", self.words(1, 2), False)
            self.parts.append("</select>")
        self.parts.append('<input type="text"><textarea>Some text</textarea>')
        self.add("button", self.words(1, 2), False)

    def comments(self, nameless: bool = False) -> None:
        if self.chance(0.3 if nameless else 0.6):
            self.add(self.pick("h2 h3 h4"), self.words(1, 3), False)
        item, signed = self.pick("div li article" if nameless else "div li article p"), nameless or self.chance(0.5)
        if item != "p" and signed:  # boxes alike: who, when, what
            own = "" if nameless else self.attribute("comment reply entry item c1 post-reply") if self.chance(0.5) else ""
            who, when, what = self.pick("div h4 p h5"), self.chance(0.7), self.pick("p p div")
            for _ in range(self.rng.integers(2, 6)):
                self.parts.append(f"<{item}{own}>")
                line = f"<b>{self.words(1, 2)}</b>" if self.chance(0.5) else self.words(1, 2)
                self.add(who, f"{line} <span>{self.date()}</span>" if when and self.chance(0.9) else line, False, close=False)
                if when and self.chance(0.2):
                    self.add("div", self.date(), False, close=False)
                self.add(what, self.inner(self.sentence(2, 50)), False, close=False)
                self.parts.append(f"</{item}>")
            return
        for _ in range(self.rng.integers(1, 5)):
            if item == "p":
                self.add("p", self.sentence(2, 40), False)
                continue
            self.parts.append(f'<{item}{self.attribute("comment reply comment-body response") if self.chance(0.7) else ""}>')
            if self.chance(0.6):
                self.add(self.pick("div b-line h4 p").replace("b-line", "div"), self.words(1, 3), False, self.chance(0.3))
            self.add("p", self.inner(self.sentence(2, 40)), False)
            self.parts.append(f"</{item}>")
        if self.chance(0.4):
            self.inside("form", "", self.form)

    def other(self, kind: str, bare: bool = False) -> None:
        """A part that isn't the article's. bare: only its element tells what it is."""
        own = OTHER_NAMES[kind]
        if kind == "teaser":
            self.inside(self.pick("div section aside ul").replace("ul", "div"), self.attribute("teasers grid cards more-stories related weitere"), self.teasers) if self.chance(0.6) else self.teasers()
            return
        if kind in ("nav", "header", "footer", "aside", "form") and (bare or self.chance(0.7)):
            tag, attr = kind, "" if bare else self.attribute(own)
        else:
            tag, attr = self.pick("div section" if kind != "nav" else "div ul"), f' class="{self.pick(own)}"'
            if kind == "nav" and self.chance(0.15):
                tag, attr = "div", ' role="navigation"'
        body = {"nav": lambda: self.links(2, 9, tag=self.pick("li li a-line").replace("a-line", "div")), "form": self.form, "comments": self.comments}.get(kind)
        if kind == "comments" and self.chance(0.3):  # only what is in it tells
            self.inside(self.pick("div section"), self.pick(["", "", ' id="x1"', ' class="block"']), lambda: self.comments(True))
            return
        if kind == "nav" and self.chance(0.35) or kind in ("header", "footer", "share") and self.chance(0.15):
            self.inside(tag if tag != "ul" else "div", attr, self.line_of_links)
            return
        if kind == "header" and self.chance(0.25):  # a title and what it says below
            self.inside(tag, attr, lambda: (self.add(self.pick("h1 h1 h2 p"), self.words(1, 5), False, self.chance(0.3)), self.add(self.pick("p div h2"), self.words(2, 8), False)))
            return
        if kind in ("header", "footer") and self.chance(0.45 if kind == "header" else 0.3):  # its own text
            self.inside(tag, attr, lambda: self.add("", ("&copy; 2024 " if kind == "footer" and self.chance(0.6) else "") + self.words(1, 5), False))
            return
        if body is None and kind in ("share", "aside", "footer", "header") and self.chance(0.4):
            body = lambda: (self.add(self.pick(_HEADINGS), self.words(1, 4), False) if self.chance(0.4) else None, self.links(2, 7))
        if body is None and kind == "header" and self.chance(0.5):
            body = lambda: self.add(self.pick("h1 h1 h2 div"), self.words(1, 4), False, self.chance(0.5))
        if body is None and kind in ("aside", "footer") and self.chance(0.15):
            body = lambda: self.table(False)

        def some() -> None:
            wide = kind in ("notice", "footer", "aside", "div")
            if self.chance(0.15):
                self.add("", self.sentence(2, 30 if wide else 8), False)
                return
            for _ in range(self.rng.integers(1, 4)):
                mark = "&copy; " if kind == "footer" and self.chance(0.5) else ""
                self.add(self.pick("p div p h3 p h2 h4"), mark + self.sentence(2, 40 if wide else 8), False, self.chance(0.3))
            if kind == "notice" and self.chance(0.5):
                self.add("button", self.words(1, 2), False)

        self.inside(tag, attr, body or some)

    def unseen(self) -> None:
        """What no reader sees, or stands in for what needs a script."""
        tag = self.pick("div noscript template svg span-line")
        if tag == "svg":
            self.parts.append("<svg><path d='M0'/>")
            self.add("", self.words(1, 3), False)
            self.parts.append("</svg>")
        elif tag in ("noscript", "template"):
            self.inside(tag, "", lambda: self.add(self.pick("p div"), self.sentence(2, 20), False))
        else:
            hidden = self.pick(["hidden", 'aria-hidden="true"', 'style="display: none"'])
            self.inside("div", f" {hidden}", lambda: self.add(self.pick("p div"), self.sentence(2, 30), False))

    def piece(self, kind: str) -> None:
        """A part of the article."""
        rng = self.rng
        if kind == "list":
            tag = self.pick("ul ul ol")
            self.parts.append(f"<{tag}>")
            all_linked = self.chance(0.1)
            for _ in range(rng.integers(1, 5)):
                self.add("li", self.inner(self.sentence(1, 15)), True, all_linked or self.chance(0.1))
            self.parts.append(f"</{tag}>")
        elif kind == "terms":
            self.parts.append("<dl>")
            for _ in range(rng.integers(1, 4)):
                self.add("dt", self.words(1, 3), True)
                self.add("dd", self.sentence(2, 20), True)
            self.parts.append("</dl>")
        elif kind == "heading":
            self.add(self.pick(_HEADINGS), self.words(1, 8), True)
        elif kind == "table":
            self.table(True)
        elif kind == "pre":
            self.add("pre", self.sentence(1, 30).replace(" ", "\n", 2), True)
        elif kind == "quote":
            if self.chance(0.5):
                self.add("blockquote", self.sentence(), True)
            else:
                self.inside("blockquote", "", lambda: self.add("p", self.sentence(), True))
        elif kind == "figure":
            self.parts.append('<figure><img src="x.png" alt="y">')
            self.add("figcaption", self.sentence(2, 15), True)
            self.parts.append("</figure>")
        elif kind == "details":
            self.parts.append("<details>")
            self.add("summary", self.words(1, 6), True)
            self.add("p", self.sentence(), True)
            self.parts.append("</details>")
        elif kind == "section":
            def body() -> None:
                self.add(self.pick(_HEADINGS), self.words(1, 6), True)
                for _ in range(rng.integers(1, 4)):
                    self.add("p", self.inner(self.sentence(1, 60)), True)

            self.inside(self.pick("section div"), "", body)
        elif kind == "sections":  # alike
            tag, head, n = self.pick("section div"), self.pick(_HEADINGS), rng.integers(1, 3)
            for _ in range(rng.integers(2, 5)):
                self.parts.append(f"<{tag}>")
                self.add(head, self.words(1, 6), True)
                for _ in range(n):
                    self.add("p", self.sentence(3, 60), True, close=False)
                self.parts.append(f"</{tag}>")
        elif kind == "plain":
            self.add("div", self.inner(self.sentence(2, 60)), True)
        elif kind == "address":
            self.add("address", self.words(2, 8), True)
        else:
            self.add("p", self.inner(self.sentence(1, 80)), True, self.chance(0.03))

    KINDS = ["list", "terms", "heading", "heading", "table", "pre", "quote", "figure", "details", "section", "sections", "sections", "plain", "address"]

    def article(self, tag: str, attr: str, nested: bool) -> None:
        rng = self.rng

        def body() -> None:
            style = rng.random()
            if self.chance(0.07):  # no more than a paragraph or two
                for _ in range(rng.integers(1, 3)):
                    self.add("p", self.inner(self.sentence(4, 40)), True)
                return
            if style < 0.08:  # text of the element itself
                if self.chance(0.5):
                    self.add("h1", self.words(2, 10), True)
                self.add("", self.inner(self.sentence(2, 80)).replace(". ", ".<br><br>"), True)
                return
            if style < 0.9:
                title = self.pick("h1 h1 h1 h1 h2 h3")
                if self.chance(0.2):
                    self.inside("header", "", lambda: self.add(title, self.words(2, 10), True))
                elif self.chance(0.95):
                    self.add(title, self.words(2, 10), True)
            for _ in range(rng.integers(1, 9)):
                kind = rng.random()
                if kind < 0.13:
                    self.other(self.pick("div div div share aside notice form form nav"), self.chance(0.3))
                elif kind < 0.16:
                    self.unseen()
                elif kind < 0.45:
                    self.piece(self.pick(self.KINDS))
                else:
                    self.piece("p")
            if self.chance(0.4):
                self.piece(self.pick(self.KINDS))
            if nested and self.chance(0.25):
                self.other(self.pick("comments share aside"))

        if nested and self.chance(0.15):
            inner = body
            body = lambda: self.inside("div", self.attribute(CONTENT_NAMES), inner)
        self.inside(tag, attr, body)


def layout_table(m: Maker) -> tuple[str, list[bool]]:
    """A page whose parts are cells of a table, without names."""
    side, above, below = m.chance(0.5), m.chance(0.6), m.chance(0.8)
    cell = lambda body: m.inside("td", "", body)
    menu = lambda: m.line_of_links() if m.chance(0.6) else m.links(2, 6)

    def rows() -> None:
        if above:
            m.inside("tr", "", lambda: cell(menu if m.chance(0.5) else lambda: m.add("", m.words(1, 4), False)))
        m.parts.append("<tr>")
        if side:
            cell(menu)
        m.article("td", "", False)
        m.parts.append("</tr>")
        if below:
            m.inside("tr", "", lambda: cell(lambda: m.add("", "&copy; 2024 " * m.chance(0.8) + m.words(1, 6), False) if m.chance(0.7) else m.line_of_links()))

    m.parts.append("<html><body>")
    m.inside("table", m.pick(["", " width=100%"]), rows)
    return "".join(m.parts) + "</body></html>", m.labels


def labelled_page(rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A made-up page and, for each of its blocks, whether it belongs to the article."""
    m = Maker(rng)
    if m.chance(0.03):  # no markup at all
        m.add("", m.sentence(2, 80), True)
        return "".join(m.parts), m.labels
    style = rng.random()
    named = f' class="{m.pick(CONTENT_NAMES)}"' if m.chance(0.7) else f' id="{m.pick(CONTENT_NAMES)}"'
    tag, attr, nested = (
        ("article", m.attribute(CONTENT_NAMES), True) if style < 0.4 else ("main", m.attribute(CONTENT_NAMES), True) if style < 0.52 else (m.pick("div div section"), named, True)
        if style < 0.75 else ("td", named, True) if style < 0.78 else (m.pick("div section"), "", False) if style < 0.9 else ("", "", False)
    )
    if m.chance(0.06):
        return layout_table(m)
    plain = tag in ("", "div", "section") and not attr
    if m.chance(0.9):
        m.parts.append(f"<!DOCTYPE html><html><head><title>{m.words(2, 8)}</title><script>var a = '</p>';</script></head><body>")
    shell = m.chance(0.3)
    m.parts.append('<div class="wrapper">' if shell and not plain else "<div>" if shell else "")
    busy = m.chance(0.55 if plain else 0.9)
    bare = m.chance(0.4)
    if busy:
        for kind in ["nav", "header", "div", "notice", "form", "aside"]:
            if m.chance(0.8 if kind in ("nav", "header") else 0.3):
                m.other(kind, bare)
    if m.chance(0.12):  # a menu that nothing names
        m.inside(m.pick("div p div"), "", m.line_of_links)
    if m.chance(0.1):
        m.unseen()
    if m.chance(0.06) and tag:
        m.other("teaser")
    if tag == "td":
        m.parts.append("<table><tr>")
    if tag in ("article", "div") and style < 0.4 and m.chance(0.2):
        m.inside("main", "", lambda: (m.article(tag, attr, nested), m.other(m.pick("aside comments share teaser")) if m.chance(0.5) else None))
    else:
        m.article(tag, attr, nested)
    if tag == "td":
        m.parts.append("</tr></table>")
    if busy:
        for kind in rng.permutation(["footer", "aside", "comments", "div", "notice", "share", "form", "nav", "teaser"]):
            if m.chance(0.8 if kind == "footer" else 0.25):
                m.other(str(kind), bare and kind != "comments")
    m.parts.append("</div>" if shell else "")
    return "".join(m.parts) + ("</body></html>" if m.chance(0.9) else ""), m.labels
