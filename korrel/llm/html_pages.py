"""Labelled pages to train the extractor on: page layouts of many kinds, drawn by a seeded generator.

Every text of a page is drawn anew from one distribution, whatever its place, so that only structure and form tell the article
from the rest. A page comes as its HTML and the list of texts that make up its article.
"""

from __future__ import annotations

import random

_SYLLABLES = "an be co da el fi go ha in ju ka lo mi ne or pa qui re so ta un vi wa xe yo zu ch sh th st er ung ción eau".split()


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.article: list[str] = []

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.choice([1, 1, 2, 2, 3])))

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def sentence(self, n: int | None = None) -> str:
        return self.words(n or self.r.randint(1, 18)).capitalize() + self.r.choice([".", ".", ".", "!", "?", ""])

    def prose(self) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.06:
            return " ".join(w + r.choice(["***", "%%%", "&&&", "$$$", "###"]) for w in self.words(r.randint(3, 60)).split())
        if kind < 0.1:
            return (self.sentence().upper() + "!! ") * r.randint(1, 6)
        if kind < 0.14:
            return " | ".join(self.words(r.randint(4, 60)).split())
        return " ".join(self.sentence() for _ in range(r.choice([1, 1, 1, 2, 3, 6, 12])))

    def own(self, text: str) -> str:
        text = " ".join(text.split())
        self.article.append(text)
        return self.escape(text)

    def escape(self, text: str) -> str:
        return text.replace("&", "&amp;").replace("<", "&lt;").replace('"', "&quot;")

    def pick(self, names: str) -> str:
        name = self.r.choice(names.split())
        return self.r.choice([f' class="{name}"', f' id="{name}"', f" class='{name} {self.word()}'", f' class={name}'])

    def any_class(self) -> str:
        return self.r.choice(["", "", f' class="{self.word()}"', f' id="{self.word()}"'])

    def links(self, n: int | None = None) -> str:
        items = [f'<a href="/{self.word()}">{self.escape(self.words(self.r.choice([1, 1, 2, 4])))}</a>' for _ in range(n or self.r.randint(2, 8))]
        return self.r.choice([lambda: "<ul><li>" + "</li><li>".join(items) + "</li></ul>", lambda: " ".join(items), lambda: " | ".join(items), lambda: "<ul><li>" + "<li>".join(items) + "</ul>", lambda: "<p>" + " &middot; ".join(items) + "</p>"])()

    def wrap(self, tags: str, cue: str, inner: str, plain: float = 0.0) -> str:
        tag = self.r.choice(tags.split())
        named = self.r.random() >= plain
        return f"<{tag}{self.pick(cue) if named else self.any_class()}>{inner}</{tag}>"

    def texts(self, n: int = 0) -> str:
        out = []
        for _ in range(n or self.r.randint(1, 3)):
            t = self.escape(self.prose())
            out.append(self.r.choice([t, f"<p>{t}</p>", f"<p>{t}", f"<div>{t}</div>", f"<span>{t}</span>"]))
        return " ".join(out)

    def menu(self) -> str:
        return self.r.choice([lambda: f"<nav{self.any_class()}>{self.links()}</nav>", lambda: self.wrap("div ul", "menu nav navbar breadcrumbs main-menu topnav", self.links())])()

    def header(self) -> str:
        r = self.r
        name = r.choice([f"<h1>{self.words(2)}</h1>", f"<p>{self.sentence()}</p>", f'<a href="/">{self.words(2)}</a>', f"<div>{self.sentence()}</div>", f"<h2>{self.words(3)}</h2>"])
        inner = name + r.choice(["", self.menu(), f"<p>{self.sentence()}</p>", self.links(3)])
        return r.choice([lambda: f"<header{self.any_class()}>{inner}</header>", lambda: self.wrap("div", "header masthead site-header banner topbar", inner)])()

    def footer(self) -> str:
        r = self.r
        inner = r.choice(["&copy; ", "Copyright ", "", "&#169; "]) + f"{self.word()}.example.com " + r.choice(["&middot; ", "- ", "<br>", ""]) + self.escape(self.prose()) + r.choice(["", self.links(3), self.texts(1)])
        return r.choice([lambda: f"<footer{self.any_class()}>{inner}</footer>", lambda: self.wrap("div", "footer site-footer colophon bottom", inner)])()

    def ad(self) -> str:
        return self.wrap("div div div aside section p", "ad ads advert advertisement sponsored promo ad-slot adbox", self.r.choice([self.escape(self.prose()), self.texts(), f"<h3>{self.words(3)}</h3>{self.texts(1)}", self.links(2)]))

    def side(self) -> str:
        inner = self.r.choice([f"<h3>{self.words(2)}</h3>", "<h2>" + self.words(2) + "</h2>", ""]) + self.r.choice([self.links(), self.texts(), self.links() + self.texts(1)])
        return self.r.choice([lambda: f"<aside{self.any_class()}>{inner}</aside>", lambda: self.wrap("div section", "sidebar widget related recommended side-bar popular", inner)])()

    def notice(self) -> str:
        return self.wrap("div div section p", "cookie-notice consent notice alert popup newsletter modal cookie-banner subscribe paywall message", self.r.choice([self.texts(), self.escape(self.prose()) + f" <button>{self.word()}</button>"]))

    def form(self) -> str:
        r = self.r
        inner = "".join(r.choice([f"<label>{self.words(2)}</label><input name=q>", f"<p>{self.escape(self.sentence())}</p>", f"<button>{self.word()}</button>", f"<select><option>{self.word()}<option>{self.word()}</select>", f"<legend>{self.words(2)}</legend>", "<textarea>x</textarea>", f"<div>{self.words(3)}</div>"]) for _ in range(r.randint(2, 5)))
        return f"<form action='/s'{self.r.choice(['', self.pick('search login contact-form')])}>{inner}</form>"

    def comments(self) -> str:
        r = self.r
        each = []
        for _ in range(r.randint(1, 5)):
            body = r.choice([f"<p>{self.escape(self.prose())}</p>", f"<div>{self.escape(self.prose())}</div>", self.texts()])
            who = r.choice(["", f"<h4>{self.word()}</h4>", f"<b>{self.word()}</b><br>", f"<cite>{self.words(2)}</cite> "])
            each.append(r.choice([f"<li>{who}{body}</li>", f'<div class="comment">{who}{body}</div>', f'<article class="comment">{who}{body}</article>', f"<div>{who}{body}</div>", f"<blockquote>{who}{body}</blockquote>"]))
        head = r.choice(["", f"<h2>{self.words(2)}</h2>", f"<h3>{self.words(1)}</h3>"])
        inner = head + ("<ol>" + "".join(each) + "</ol>" if each[0].startswith("<li") else "".join(each)) + r.choice(["", self.form()])
        return self.wrap("section div ol ul aside", "comments comment-list discussion reader-comments responses disqus_thread", inner)

    def paragraph(self) -> str:
        r, t = self.r, self.prose()
        if r.random() < 0.15:
            a, b = self.sentence(3), self.sentence(4)
            text = f"{a} {b} {t}"
            self.article.append(" ".join(text.split()))
            return f"<p>{self.escape(a)} <a href='/x'>{self.escape(b)}</a> {self.escape(t)}</p>"
        t = self.own(t)
        return r.choice([f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}<br>", f"<p{self.any_class()}>{t}</p>", f"<p><em>{t}</em></p>", f"<P>{t}</P>", f"<div>{t}</div>"])

    def part(self) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.82:
            return f"<h{(k := r.randint(2, 4))}>{self.own(self.words(r.randint(1, 6)))}</h{k}>"
        if kind < 0.89:
            return "<ul>" + "".join(f"<li>{self.own(self.sentence())}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
        if kind < 0.93:
            return f"<blockquote>{r.choice(['<p>', ''])}{self.own(self.prose())}</blockquote>"
        if kind < 0.96:
            return f"<pre>{self.own(self.words(6))}</pre>"
        return "<table><tr>" + "".join(f"<td>{self.own(self.words(2))}</td>" for _ in range(3)) + "</tr></table>"

    def body(self) -> str:
        r = self.r
        head = f"<h{(k := r.choice([1, 1, 1, 2]))}>{self.own(self.sentence())}</h{k}>" if r.random() < 0.9 else ""
        if head and r.random() < 0.15:
            head = f"<header>{head}</header>"
        parts = [self.part() for _ in range(r.choice([0, 1, 2, 3, 5, 8, 14]))] or ([] if head else [self.paragraph()])
        for _ in range(r.choice([0, 0, 1, 2])):
            parts.insert(r.randint(0, len(parts)), r.choice([self.ad, self.ad, self.notice, self.side, self.form, self.menu])())
        if r.random() < 0.25:
            parts.append(self.wrap("div ul", "share social sharing", self.links(3)))
        inner = head + "".join(parts)
        if r.random() < 0.12:
            inner += self.comments()
        return inner

    def main(self) -> str:
        r = self.r
        inner = self.body()
        kind = r.random()
        if kind < 0.4:
            inner = f"<article{self.any_class()}>{inner}</article>"
        elif kind < 0.55:
            inner = f"<main{self.any_class()}>{inner}</main>"
        elif kind < 0.85:
            inner = self.wrap("div div section td", "content article post entry-content story main-content articleBody post-body", inner)
        elif kind < 0.95:
            inner = f"<div{self.any_class()}>{inner}</div>"
        if r.random() < 0.3:
            inner = r.choice([f"<main>{inner}</main>", f'<div id="page">{inner}</div>', f"<div><div>{inner}</div></div>"])
        return inner

    def page(self) -> str:
        r = self.r
        out = [f for f, p in ((self.notice, 0.2), (self.header, 0.45), (self.menu, 0.6), (self.ad, 0.35), (self.form, 0.15), (self.side, 0.15)) if r.random() < p]
        r.shuffle(out)
        before = [f() for f in out]
        middle = self.main()
        after = [f() for f, p in ((self.ad, 0.2), (self.side, 0.4), (self.comments, 0.35), (self.form, 0.15), (self.notice, 0.15), (self.menu, 0.1)) if r.random() < p]
        r.shuffle(after)
        last = self.footer() if r.random() < 0.8 else ""
        head = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{self.words(4)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
        return head + r.choice(["", "<!-- x -->"]) + "".join(before) + middle + "".join(after) + last + r.choice(["</body></html>", "", "<script>track(1)</script></body></html>"])


def labelled(n: int, seed: int = 0) -> list[tuple[str, list[str]]]:
    """``n`` pages and the texts of their articles."""
    out = []
    for k in range(n):
        p = _Page(seed * 1_000_003 + k)
        out.append((p.page(), p.article))
    return out
