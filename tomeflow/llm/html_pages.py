"""Labelled pages for the extraction model, written from a small grammar of layouts.

An element that carries ``data-main="1"`` belongs to the article and one that carries
``data-main="0"`` does not; an element without the attribute has its parent's label.
Texts are invented syllables; only structure, names, lengths and links tell.
"""

from __future__ import annotations

import random

SYLLABLES = "ka lo mi ru te sa no vi pe da zu fi go ré ño schä ßen çe 日 本 の kri plu tan dor wel".split()
MAIN, OTHER = ' data-main="1"', ' data-main="0"'

ARTICLE_NAMES = ["content", "post", "entry-content", "article-body", "story", "main-content", "postBody", "text", "", ""]
ADVERT_NAMES = ["ad", "ads", "advert", "ad-slot", "banner", "sponsored", "promo", "adsense top", "dfp-ad"]
MENU_NAMES = ["nav", "menu", "main-nav", "breadcrumbs", "navbar", "top-menu", "pagination"]
NOTICE_NAMES = ["cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "newsletter", "popup", "modal", "subscribe-box", "paywall", "announcement"]
COMMENT_NAMES = ["comments", "comment-list", "discussion", "disqus_thread", "reader-comments", "replies", "respond"]
SIDE_NAMES = ["sidebar", "side", "widget", "related", "right-rail", "recommended", "more-stories", "popular", "teaser"]
FOOT_NAMES = ["footer", "foot", "site-footer", "copyright", "legal"]
HEAD_NAMES = ["header", "masthead", "site-header", "topbar", "logo", "branding"]
SHARE_NAMES = ["share", "social", "share-buttons", "follow-us"]


class Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randrange(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randrange(lo, hi + 1)))

    def sentences(self, n: int) -> str:
        out = []
        for _ in range(n):
            s = self.words(1, 16).capitalize()
            if self.rng.random() < 0.15:
                s = s.replace(" ", f" <a href='/{self.word()}'>{self.word()}</a> ", 1)
            if self.rng.random() < 0.15:
                s = s.replace(" ", f" <b>{self.word()}</b> ", 1)
            out.append(s + self.rng.choice([".", ".", ".", "!", "?", "&amp;", ""]))
        return " ".join(out)

    def named(self, names: list[str]) -> str:
        name = self.rng.choice(names)
        return f' {self.rng.choice(["class", "class", "id"])}="{name}"' if name else ""

    def tag(self, tag: str, inside: str, attrs: str = "") -> str:
        return f"<{tag}{attrs}>{inside}</{tag}>"

    def links(self, lo: int = 2, hi: int = 9) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 4)}</a>' for _ in range(self.rng.randrange(lo, hi))]
        kind = self.rng.randrange(3)
        if kind == 0:
            return self.tag(self.rng.choice(["ul", "ul", "ol"]), "".join(self.tag("li", i) for i in items))
        if kind == 1:
            return "".join(self.tag("div", i) for i in items)
        return " | ".join(items)

    def paragraph(self) -> str:
        n = self.rng.choice([1, 1, 2, 3, 6, 12])
        text = self.words(1, 3).capitalize() + "." if self.rng.random() < 0.12 else self.sentences(n)
        return f"<p><b>{text}<br>" if self.rng.random() < 0.06 else self.tag("p", text)

    def article_parts(self) -> list[str]:
        rng = self.rng
        parts = []
        for _ in range(rng.choice([1, 2, 4, 8, 15])):
            kind = rng.random()
            if kind < 0.72:
                parts.append(self.paragraph())
            elif kind < 0.78:
                parts.append(self.tag(rng.choice(["h2", "h3"]), self.words(1, 6)))
            elif kind < 0.83:
                parts.append(self.tag(rng.choice(["ul", "ol"]), "".join(self.tag("li", self.sentences(1)) for _ in range(rng.randrange(1, 6)))))
            elif kind < 0.87:
                parts.append(self.tag("blockquote", self.tag("p", self.sentences(2)) if rng.random() < 0.5 else self.sentences(2)))
            elif kind < 0.9:
                parts.append(self.tag("figure", '<img src="x.jpg">' + self.tag("figcaption", self.words(2, 12))))
            elif kind < 0.93:
                rows = "".join(self.tag("tr", "".join(self.tag("td", self.words(1, 4)) for _ in range(3))) for _ in range(rng.randrange(1, 4)))
                parts.append(self.tag("table", rows))
            elif kind < 0.95:
                parts.append(self.tag("pre", self.words(3, 20)))
            elif kind < 0.98:
                parts.append(self.tag("section", self.tag("h2", self.words(1, 5)) + self.paragraph()))
            else:
                parts.append(self.tag("div", self.sentences(2)))
        return parts

    # Parts of a page that are not the article.

    def menu(self) -> str:
        tag, names = self.rng.choice([("nav", ["", "", *MENU_NAMES]), ("div", MENU_NAMES), ("ul", MENU_NAMES)])
        inside = self.links() if tag != "ul" else "".join(self.tag("li", f'<a href="#">{self.words(1, 3)}</a>') for _ in range(5))
        return self.tag(tag, inside, self.named(names) + OTHER)

    def advert(self) -> str:
        inside = self.rng.choice([self.words(2, 8), self.sentences(1), self.tag("p", self.sentences(2)), f'<a href="/">{self.words(2, 8)}</a>'])
        return self.tag(self.rng.choice(["div", "div", "section", "aside", "p"] if not inside.startswith("<p") else ["div", "aside"]), inside, self.named(ADVERT_NAMES) + OTHER)

    def notice(self) -> str:
        inside = self.rng.choice([self.sentences(1), self.tag("p", self.sentences(2)) + self.tag("button", self.words(1, 2)), self.tag("div", self.sentences(1))])
        return self.tag(self.rng.choice(["div", "div", "section", "aside", "dialog"]), inside, self.named(NOTICE_NAMES) + OTHER)

    def head(self) -> str:
        inside = self.rng.choice([self.tag("h1", self.words(1, 4)), self.tag("div", f'<a href="/">{self.words(1, 3)}</a>'), self.words(1, 6), self.tag("p", self.words(2, 9))])
        if self.rng.random() < 0.4:
            inside += self.menu()
        tag, names = self.rng.choice([("header", ["", "", *HEAD_NAMES]), ("div", HEAD_NAMES)])
        return self.tag(tag, inside, self.named(names) + OTHER)

    def foot(self) -> str:
        inside = self.rng.choice([f"&copy; {self.words(1, 3)} &middot; {self.sentences(1)}", self.tag("p", f"&copy; 2020 {self.words(1, 6)}"), self.links(), self.tag("p", self.sentences(2)), self.sentences(1)])
        tag, names = self.rng.choice([("footer", ["", "", *FOOT_NAMES]), ("div", FOOT_NAMES)])
        return self.tag(tag, inside, self.named(names) + OTHER)

    def side(self) -> str:
        inside = self.rng.choice([self.tag("h3", self.words(1, 3)) + self.links(), self.tag("p", self.sentences(2)), self.links(), self.tag("h2", self.words(1, 3)) + self.tag("p", self.sentences(3)), self.sentences(1)])
        tag, names = self.rng.choice([("aside", ["", "", *SIDE_NAMES]), ("div", SIDE_NAMES), ("section", SIDE_NAMES)])
        return self.tag(tag, inside, self.named(names) + OTHER)

    def form(self) -> str:
        inside = self.rng.choice(["", self.tag("label", self.words(1, 3))]) + '<input type="text">' + self.rng.choice([self.tag("button", self.words(1, 2)), self.tag("p", self.sentences(1)), self.tag("select", self.tag("option", self.word()) * 3), self.words(1, 5)])
        return self.tag("form", inside, self.named(["", "", "search", "login-form", "contact"]) + OTHER)

    def comments(self) -> str:
        rng = self.rng
        one = lambda: rng.choice([self.tag("p", self.sentences(rng.choice([1, 2, 4]))), self.tag("div", self.tag("b", self.word()) + self.tag("p", self.sentences(2)), self.named(["comment", "reply", "comment-body"])), self.tag("article", self.tag("p", self.sentences(2)), self.named(["comment", "comment-entry"])), self.tag("li", self.sentences(1))])
        inside = rng.choice(["", self.tag("h2", self.words(1, 2)), self.tag("h3", self.words(1, 2))]) + "".join(one() for _ in range(rng.randrange(1, 6)))
        if rng.random() < 0.3:
            inside += self.form()
        return self.tag(rng.choice(["div", "section", "section", "ol", "aside"]), inside, self.named(COMMENT_NAMES) + OTHER)

    def share(self) -> str:
        return self.tag(self.rng.choice(["div", "ul"]), self.links(2, 5) if self.rng.random() < 0.6 else self.words(1, 5), self.named(SHARE_NAMES) + OTHER)

    def page(self) -> str:
        rng = self.rng
        parts = self.article_parts()
        title = self.tag("h1", self.words(1, 9))
        heading = rng.choice([title, title, title, "", self.tag("header", title) if rng.random() < 0.5 else title])
        for make in (self.advert, self.notice, self.side, self.form, self.share, self.menu, self.comments):
            if rng.random() < 0.1:
                parts.insert(rng.randrange(len(parts) + 1), make())
        body = heading + "".join(parts)
        kind = rng.random()
        if kind < 0.5:
            article = self.tag("article", body, self.named(["", "", "", *ARTICLE_NAMES]) + MAIN)
        elif kind < 0.68:
            article = self.tag("div", body, self.named([n for n in ARTICLE_NAMES if n]) + MAIN)
        elif kind < 0.8:
            article = self.tag("main", body, self.named(["", *ARTICLE_NAMES]) + MAIN)
        elif kind < 0.88:
            article = self.tag("section", body, self.named([n for n in ARTICLE_NAMES if n]) + MAIN)
        else:
            article = self.tag("article", self.tag("div", body, self.named(ARTICLE_NAMES)), MAIN)
        before = [f() for f in (self.notice, self.head, self.menu, self.advert, self.form, self.share) if rng.random() < 0.45]
        after = [f() for f in (self.share, self.comments, self.side, self.advert, self.form, self.menu, self.foot, self.notice) if rng.random() < 0.4]
        if rng.random() < 0.3:
            rng.shuffle(before)
        middle = article
        if rng.random() < 0.25:
            extra = self.side()
            middle = self.tag(rng.choice(["div", "main"]), article + extra if rng.random() < 0.5 else extra + article, self.named(["", "wrapper", "container", "page", "row"]) + OTHER)
        inside = "".join(before) + middle + "".join(after)
        if rng.random() < 0.2:
            inside = self.tag("div", inside, self.named(["", "wrapper", "container", "page", "layout"]) + OTHER)
        end = "" if rng.random() < 0.1 else "</body></html>"
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title><style>p{{}}</style></head><body{OTHER}>{inside}{end}"


def labelled_pages(n: int = 700, seed: int = 20240229) -> list[str]:
    rng = random.Random(seed)
    return [Writer(rng).page() for _ in range(n)]
