"""Labelled pages: layouts made by rules around given words, every block marked as content or not."""

from __future__ import annotations

import html
import random

from meterline.llm.dom import LABEL

_SPARE = "the quick review of a long winter, and what it meant for the town. Many were there when it began, some left early.".split()


class _Maker:
    def __init__(self, words: list[str], seed: int) -> None:
        self.words, self.random = words or _SPARE, random.Random(seed)

    def pick(self, *options: str) -> str:
        return self.random.choice(options)

    def some(self, chance: float) -> bool:
        return self.random.random() < chance

    def text(self, low: int, high: int) -> str:
        n = self.random.randint(low, high)
        at = self.random.randrange(len(self.words))
        return html.escape(" ".join(self.words[(at + i) % len(self.words)] for i in range(n)))

    def sentences(self, low: int, high: int) -> str:
        parts = [self.text(4, 18).capitalize() + self.pick(".", ".", ".", "!", "?", "") for _ in range(self.random.randint(low, high))]
        if self.some(0.25):
            parts.insert(self.random.randrange(len(parts) + 1), f'{self.pick("<b>", "<em>", "<i>", "<strong>")}{self.text(1, 6)}')
        if self.some(0.2):
            parts.insert(self.random.randrange(len(parts) + 1), f'<a href="/{self.random.randrange(99)}">{self.text(1, 4)}</a>')
        if self.some(0.15):
            parts.append("<br>" + self.text(1, 6))
        return " ".join(parts)

    def mark(self, tag: str, name: str, inside: str, content: int) -> str:
        return f'<{tag}{f" {name}" if name else ""} {LABEL}="{content}">{inside}</{tag}>'

    def named(self, *names: str) -> str:
        name = self.pick(*names)
        return f'{self.pick("class", "class", "id")}="{name}"'

    def link_list(self) -> str:
        items = [f'<li><a href="/{i}">{self.text(1, 4)}</a></li>' for i in range(self.random.randint(3, 9))]
        return self.pick("<ul>{}</ul>", "<ul class='list'>{}</ul>", "<div>{}</div>").format("".join(items)) if self.some(0.8) else " | ".join(f'<a href="#">{self.text(1, 2)}</a>' for _ in range(5))

    # what is not content

    def nav(self) -> str:
        return self.mark(*self.pick_pair(("nav", ""), ("div", self.named("menu", "main-nav", "navbar", "breadcrumbs", "top-menu")), ("ul", 'role="navigation"')), self.link_list(), 0)

    def pick_pair(self, *pairs: tuple[str, str]) -> tuple[str, str]:
        return self.random.choice(pairs)

    def header(self) -> str:
        inside = f"<{(t := self.pick('div', 'p', 'span'))}>{self.text(1, 6)}</{t}>" + (self.nav() if self.some(0.6) else "")
        return self.mark(*self.pick_pair(("header", ""), ("div", self.named("header", "site-header", "masthead", "topbar"))), inside, 0)

    def footer(self) -> str:
        inside = self.pick("&copy; ", "Copyright 2020 ", "") + self.text(2, 16) + self.pick("", " &middot; " + self.sentences(1, 2)) + (self.link_list() if self.some(0.4) else "")
        return self.mark(*self.pick_pair(("footer", ""), ("footer", ""), ("div", self.named("footer", "site-footer", "page-footer"))), self.pick("{}", "<p>{}</p>").format(inside), 0)

    def advert(self) -> str:
        inside = self.pick("", "Advertisement ", "Sponsored ") + self.pick(self.text(2, 10), self.sentences(1, 3))
        return self.mark(*self.pick_pair(("div", self.named("ad", "ads", "advert", "ad-banner", "sponsored", "promo-box")), ("aside", self.named("ad", "promo"))), self.pick("{}", "<p>{}</p>").format(inside), 0)

    def notice(self) -> str:
        inside = self.pick("We use cookies. ", "Notice: ", "") + self.sentences(1, 3) + self.pick("", "<button>OK</button>", "<a href='#'>Accept</a>")
        return self.mark(*self.pick_pair(("div", self.named("cookie-notice", "consent", "notice", "alert", "cookie-banner", "popup")), ("div", 'role="alert"'), ("dialog", ""), ("section", self.named("gdpr", "notice"))), self.pick("{}", "<p>{}</p>").format(inside), 0)

    def sidebar(self) -> str:
        inside = f"<h3>{self.pick('Related', 'Most read', self.text(1, 3))}</h3>" + self.pick(self.link_list(), f"<p>{self.sentences(1, 2)}</p>", self.link_list() + f"<p>{self.text(5, 20)}</p>")
        return self.mark(*self.pick_pair(("aside", ""), ("div", self.named("sidebar", "side-bar", "widget", "right-rail")), ("aside", self.named("sidebar", "related"))), inside, 0)

    def form(self) -> str:
        inside = f"<label>{self.text(1, 4)}</label><input name=q><p>{self.pick('Subscribe', 'Sign up', '')} {self.text(2, 12)}</p><button>Go</button>"
        return self.mark(*self.pick_pair(("form", ""), ("form", self.named("newsletter", "search-form", "login")), ("div", self.named("newsletter", "subscribe-box", "signup"))), inside, 0)

    def related(self) -> str:
        inside = f"<h{self.pick('3', '4')}>{self.pick('Related', 'Read next', 'More stories', self.text(1, 3))}</h4>" + self.link_list()
        return self.mark(*self.pick_pair(("div", self.named("related", "recommended", "more-stories", "read-next")), ("section", self.named("related-posts", "trending"))), inside, 0)

    def share(self) -> str:
        return self.mark("div", self.named("share", "social", "share-bar"), self.pick("Share ", "") + " ".join(f'<a href="#">{self.text(1, 1)}</a>' for _ in range(4)), 0)

    def comments(self) -> str:
        one = lambda: self.pick("<div class='comment'>{}</div>", "<li>{}</li>", "<article class='comment'>{}</article>", "<div>{}</div>").format(f"<{(t := self.pick('b', 'h4', 'span'))}>{self.text(1, 2)}</{t}><p>{self.sentences(1, 4)}</p>")
        inside = f"<h{self.pick('2', '3')}>{self.pick('Comments', '3 comments', 'Replies', 'Leave a reply')}</h3>" + "".join(one() for _ in range(self.random.randint(1, 5)))
        return self.mark(*self.pick_pair(("section", self.named("comments", "discussion", "comment-section")), ("div", self.named("comments", "comment-list", "respond", "reader-comments")), ("ol", self.named("commentlist"))), inside, 0)

    # content

    def block(self) -> str:
        kind = self.random.random()
        if kind < 0.06:
            return self.pick(self.sentences(1, 4), self.sentences(1, 2), self.text(1, 4)) + self.pick("<br>", " ", "")
        if kind < 0.72:
            return self.pick("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}").format(self.pick(self.sentences(1, 7), self.sentences(1, 3), self.text(1, 3)))
        if kind < 0.8:
            return f"<h2>{self.text(1, 8)}</h2><p>{self.sentences(1, 4)}</p>"
        if kind < 0.86:
            return self.pick("<ul>{}</ul>", "<ol>{}</ol>").format("".join(f"<li>{self.text(2, 14)}" for _ in range(self.random.randint(2, 6))))
        if kind < 0.9:
            return f"<blockquote>{self.pick('<p>{}</p>', '{}').format(self.sentences(1, 3))}</blockquote>"
        if kind < 0.93:
            return f"<pre>{self.text(3, 20)}</pre>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{self.text(1, 3)}</td><td>{self.text(1, 3)}</td></tr>" for _ in range(3)) + "</table>"
        return f"<figure><img src=x><figcaption>{self.text(3, 12)}</figcaption></figure>" if self.some(0.5) else f"<div>{self.sentences(1, 4)}</div>"

    def content(self) -> str:
        parts = [self.block() for _ in range(self.random.choice([1, 1, 1, 2, 2, 3, 5, 8, 14, 25]))]
        for junk, chance in ((self.advert, 0.3), (self.share, 0.2), (self.related, 0.15), (self.form, 0.15), (self.notice, 0.1), (self.sidebar, 0.1), (self.nav, 0.06)):
            if self.some(chance):
                parts.insert(self.random.randrange(len(parts) + 1), junk())
        heading = f"<h1>{self.text(2, 12)}</h1>" if self.some(0.85) else ""
        if heading and self.some(0.15):
            heading = f"<header>{heading}</header>"
        inside = heading + "".join(parts) + (self.comments() if self.some(0.2) else "")
        outer = self.pick_pair(("article", ""), ("article", ""), ("article", self.named("post", "entry", "story")), ("main", ""), ("div", self.named("content", "main-content", "post-body", "article-text", "entry-content", "story-body")), ("section", self.named("article", "content")), ("div", ""))
        made = self.mark(*outer, inside, 1)
        if self.some(0.35):
            made = self.pick("{}", "<main>{}</main>", "<div id='main'>{}</div>", "<div class='wrapper'>{}</div>", "<div class='row'><div class='col'>{}</div></div>").format(made + (self.sidebar() if self.some(0.3) else ""))
        return made

    def page(self) -> str:
        before = [f() for f, c in ((self.notice, 0.3), (self.header, 0.45), (self.nav, 0.6), (self.advert, 0.4), (self.form, 0.15)) if self.some(c)]
        after = [f() for f, c in ((self.comments, 0.35), (self.related, 0.25), (self.sidebar, 0.4), (self.advert, 0.2), (self.form, 0.2), (self.notice, 0.1), (self.footer, 0.85)) if self.some(c)]
        if self.some(0.06):  # little but the text
            before, after = [], after[:1]
        return f'<!DOCTYPE html><html><head><title>{self.text(1, 6)}</title><style>p{{}}</style></head><body {LABEL}="0">' + "".join(before) + self.content() + "".join(after) + "</body></html>"


def labelled_pages(words: list[str], count: int, seed: int = 11) -> list[str]:
    return [_Maker(words, seed * 1_000_003 + i).page() for i in range(count)]
