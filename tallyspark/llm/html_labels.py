"""Labelled pages that the extraction model is trained on.

A bounded set (``n`` pages, 300 by default) composed from layout parts by a
seeded generator.  Elements that hold the article carry ``data-gold="1"``,
which the parser turns into labels; the model never sees the attribute.
"""

from __future__ import annotations

import random

from tallyspark.llm.html import Page, parse

_SYLLABLES = "an be co de el fi ga ho in ju ka lo mi no or pa qu re so ti ul ve wi zo".split()


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self, lo: int = 6, hi: int = 20) -> str:
        return self.words(lo, hi).capitalize() + "."

    def prose(self, lo: int = 1, hi: int = 5) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))
        if self.r.random() < 0.2:
            text += f' <a href="/{self.word()}">{self.words(1, 3)}</a> {self.sentence()}'
        if self.r.random() < 0.2:
            text += f" <em>{self.words(1, 4)}</em> <b>{self.words(1, 3)}</b>."
        return text

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def name(self, *options: str) -> str:
        """A class or id from the options, or none."""
        if self.r.random() < 0.15:
            return ""
        return f' {self.pick("class", "id", "class")}="{self.pick(*options)}"'

    def links(self, lo: int = 3, hi: int = 8) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.r.randint(lo, hi)))

    # parts that are not content

    def nav(self) -> str:
        menu = f"<ul>{self.links()}</ul>"
        return self.pick(
            f"<nav>{menu}</nav>",
            f'<div class="{self.pick("menu", "nav", "navbar", "navigation", "breadcrumbs")}">{menu}</div>',
            f'<div role="navigation">{menu}</div>',
            "<nav>" + "".join(f'<a href="/{self.word()}">{self.words(1, 2)}</a> ' for _ in range(4)) + "</nav>",
        )

    def header(self) -> str:
        inside = self.pick(f"<h1>{self.words(1, 3)}</h1><p>{self.words(2, 8)}</p>", f"<a href='/'>{self.words(1, 2)}</a>", f"<div>{self.words(1, 4)}</div>{self.nav()}")
        return self.pick(f"<header>{inside}</header>", f'<div class="{self.pick("header", "masthead", "topbar", "site-header")}">{inside}</div>')

    def footer(self) -> str:
        inside = self.pick(f"&copy; {self.words(1, 4)}", f"<p>&copy; 2024 {self.words(2, 6)}.</p><ul>{self.links(2, 4)}</ul>", f"<p>{self.sentence()}</p>")
        return self.pick(f"<footer>{inside}</footer>", f'<div class="{self.pick("footer", "site-footer", "copyright")}">{inside}</div>')

    def ad(self) -> str:
        inside = self.pick(self.sentence(2, 8), f"<p>{self.prose(1, 2)}</p>", f'<a href="/{self.word()}">{self.words(2, 6)}</a>')
        return f'<div class="{self.pick("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner", "advertisement")}">{inside}</div>'

    def side(self) -> str:
        inside = self.pick(f"<h3>{self.words(1, 3)}</h3><ul>{self.links()}</ul>", f"<p>{self.prose(1, 2)}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.sentence()}</p><ul>{self.links(2, 4)}</ul>")
        return self.pick(f"<aside>{inside}</aside>", f'<aside class="sidebar">{inside}</aside>', f'<div class="{self.pick("sidebar", "widget", "related", "share", "social", "side")}">{inside}</div>', f'<section class="{self.pick("related", "recommended", "trending")}">{inside}</section>')

    def notice(self) -> str:
        inside = self.pick(f"<p>{self.sentence()}</p>", self.sentence(), f"<p>{self.prose(1, 3)}</p><button>{self.word()}</button>")
        return f'<{(t := self.pick("div", "div", "section", "p" if inside[0] != "<" else "div"))}{self.pick(" class", " id")}="{self.pick("cookie-banner", "cookie", "consent", "notice", "alert", "newsletter", "popup", "site-notice")}">{inside}</{t}>'

    def form(self) -> str:
        return f"<form{self.name('search', 'login', 'subscribe')}>{self.pick('', f'<p>{self.sentence()}</p>')}<label>{self.words(1, 3)}</label><input type='text'><button>{self.word()}</button></form>"

    def comments(self) -> str:
        one = lambda: self.pick(f'<div class="comment"><p>{self.prose(1, 3)}</p></div>', f"<li><p>{self.prose(1, 2)}</p></li>", f'<article class="comment"><header>{self.words(1, 2)}</header><p>{self.prose(1, 3)}</p></article>')
        inside = f"<h2>{self.words(1, 2)}</h2>" + "".join(one() for _ in range(self.r.randint(1, 5)))
        tag = self.pick("div", "section", "section", "ol")
        return f"<{tag}{self.pick(' class', ' id')}=\"{self.pick('comments', 'comment-list', 'commentlist', 'discussion', 'replies', 'user-comments', 'disqus_thread')}\">{inside}</{tag}>"

    def junk(self, n: int) -> str:
        return "".join(self.pick(self.nav, self.ad, self.side, self.notice, self.form)() for _ in range(self.r.randint(0, n)))

    # content

    def block(self) -> str:
        g = ' data-gold="1"'
        items = lambda: "".join(f"<li{g}>{self.sentence(2, 12)}</li>" for _ in range(self.r.randint(2, 5)))
        x = self.r.random()
        if x < 0.68:
            return f"<p{g}>{self.prose()}</p>"
        if x < 0.74:
            return f"<p{g}>{self.words(1, 4)}</p>"
        if x < 0.82:
            return f"<h{(k := self.r.randint(2, 4))}{g}>{self.words(2, 6)}</h{k}>"
        if x < 0.88:
            return f"<ul{g}>{items()}</ul>"
        if x < 0.92:
            return f"<blockquote{g}><p{g}>{self.prose(1, 2)}</p></blockquote>"
        if x < 0.95:
            rows = "".join(f"<tr{g}><td{g}>{self.words(1, 3)}</td><td{g}>{self.words(1, 3)}</td></tr>" for _ in range(3))
            return f"<table{g}>{rows}</table>"
        if x < 0.97:
            return f"<pre{g}>{self.words(3, 10)}</pre>"
        return f"<div{g}><p{g}>{self.prose()}</p></div>"

    def article(self) -> str:
        g = ' data-gold="1"'
        heading = f"<h1{g}>{self.words(3, 9)}</h1>"
        if self.r.random() < 0.15:
            heading = f"<header{g}>{heading}</header>"
        body = []
        short = self.r.random() < 0.2  # many short paragraphs, as in verse or lists of remarks
        for _ in range(self.r.randint(10, 40) if short else self.r.randint(1, 9)):
            body.append(f"<p{g}>{self.words(1, 4)}</p>" if short else self.block())
            if self.r.random() < 0.1:
                body.append(self.pick(self.ad, self.side, self.notice, self.form)())
        if self.r.random() < 0.15:
            body.append(self.comments())
        inside = heading + "".join(body)
        if self.r.random() < 0.3:
            inside = f"<div{g}{self.name('content', 'article-body', 'entry', 'text')}>{inside}</div>"
        return self.pick(
            f"<article{g}>{inside}</article>",
            f"<article{g}{self.name('post', 'story', 'entry')}>{inside}</article>",
            f"<main{g}>{inside}</main>",
            f"<main{g}><article{g}>{inside}</article></main>",
            f'<div{g} class="{self.pick("content", "post", "entry-content", "article", "main", "story-body")}">{inside}</div>',
            f'<div{g} id="{self.pick("content", "main", "article")}">{inside}</div>',
            f"<section{g}>{inside}</section>",
        )

    def page(self) -> str:
        middle = self.junk(2) + self.article() + self.pick("", "", self.comments()) + self.junk(2)
        if self.r.random() < 0.3:
            middle = f'<div{self.name("wrapper", "container", "page")} data-gold="1">{middle}</div>'
        top = self.pick(self.header() + self.nav(), self.nav(), self.header(), "")
        end = self.pick(self.footer(), self.footer(), "")
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 5)}</title></head><body>{top}{middle}{end}</body></html>"


def labelled_page(html: str) -> Page:
    page = parse(html)
    for n in page.nodes:
        # the shell around everything is as much content as not: it counts as content
        n.gold = int('data-gold="1"' in n.attrs or n.tag in ("#root", "html", "body"))
        n.attrs = n.attrs.replace(' data-gold="1"', "")
    return page


def labelled_pages(n: int = 300, seed: int = 1) -> list[Page]:
    return [labelled_page(_Writer(seed * 100_003 + k).page()) for k in range(n)]
