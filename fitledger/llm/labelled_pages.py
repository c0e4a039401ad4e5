"""Labelled training pages: seeded layouts of invented text whose main blocks are known."""

from __future__ import annotations

import random
from collections.abc import Iterator

SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu an er is on ul é ß ñ".split()
CONTENT = "content post entry article story body main text page single blog news".split()
MENU = "nav menu navbar navigation topbar breadcrumb breadcrumbs links".split()
HEAD = "header masthead top banner branding site".split()
FOOT = "footer bottom colophon copyright legal".split()
SIDE = "sidebar side widget related rail popular recommended trending".split()
NOTICE = "cookie notice consent banner alert message gdpr popup modal newsletter".split()
ADVERT = "ad ads advert advertisement sponsored promo sponsor".split()
COMMENTS = "comments comment discussion responses replies disqus respond".split()
SHARE = "share social tags meta tools actions".split()
NOTICE_WORDS = ("we use cookies accept privacy policy settings subscribe newsletter sign up free offer "
                "javascript enable browser update terms").split()
COMMENT_WORDS = "reply says posted thanks agree great ago report like anonymous comment".split()
LINK_WORDS = "home about contact login register privacy terms help search next previous more share tweet".split()
FOOT_WORDS = "copyright all rights reserved powered by contact imprint terms privacy".split()


class _Page:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.main: set[str] = set()

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def sentence(self, low: int = 1, high: int = 20) -> str:
        words = " ".join(self.word() for _ in range(self.rng.randint(low, high)))
        return words.capitalize() + self.rng.choice([".", ".", ".", ".", "!", "?", ""])

    def prose(self) -> str:
        n = self.rng.choice([1, 1, 1, 2, 3, 5, 8])
        return " ".join(self.sentence(1, self.rng.choice([2, 8, 20])) for _ in range(n))

    def named(self, names: list[str]) -> str:
        """A class or id attribute with one of the names, alone or joined to another word."""
        name = self.rng.choice(names)
        kind = self.rng.choice(["class", "class", "class", "id"])
        more = self.rng.choice(["", "", f"-{self.word()}", f" {self.word()}", "-wrap", "-box", "_area"])
        return f' {kind}="{name}{more}"'

    def plain(self) -> str:
        return self.rng.choice(["", "", f' class="{self.word()}"', f' id="{self.word()}"'])

    def keep(self, tag: str, text: str) -> str:
        self.main.add(" ".join(text.split()))
        inner = text
        if self.rng.random() < 0.15 and " " in text:
            first, rest = text.split(" ", 1)
            inner = self.rng.choice([f"<b>{first}</b> {rest}", f'<a href="/{self.word()}">{first}</a> {rest}',
                                     f"<em>{first}</em> {rest}"])
        return f"<{tag}{self.plain() if self.rng.random() < 0.2 else ''}>{inner}</{tag}>"

    def links(self, low: int = 2, high: int = 8) -> str:
        rng = self.rng
        words = [rng.choice([self.word(), rng.choice(LINK_WORDS), f"{self.word()} {self.word()}"])
                 for _ in range(rng.randint(low, high))]
        if rng.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words) + "</ul>"
        return " ".join(f'<a href="/{w}">{w}</a>' for w in words)

    def other(self, words: list[str] | None = None) -> str:
        """Text that isn't main: a sentence or two, with some of the given words."""
        text = self.rng.choice([self.prose, self.sentence])()
        if words and self.rng.random() < 0.6:
            text = " ".join(self.rng.sample(words, min(len(words), self.rng.randint(2, 6)))) + " " + text
        tag = self.rng.choice(["p", "p", "span", "div", ""])
        return f"<{tag}>{text}</{tag}>" if tag else text

    def part(self, tags: list[str], names: list[str], inside: str, marked: float = 0.75) -> str:
        """An element told by its tag, by its name, or by both."""
        tag = self.rng.choice(tags)
        name = self.named(names) if tag == "div" or self.rng.random() < marked else self.plain()
        return f"<{tag}{name}>{inside}</{tag}>"

    def menu(self) -> str:
        return self.part(["nav", "nav", "div", "ul"], MENU, self.links())

    def head(self) -> str:
        inside = self.rng.choice([f"<h1>{self.sentence(1, 4)}</h1>", f"<div>{self.sentence(1, 5)}</div>",
                                  self.other(), f'<a href="/">{self.word()}</a>'])
        return self.part(["header", "header", "div"], HEAD, inside + (self.menu() if self.rng.random() < 0.4 else ""))

    def foot(self) -> str:
        mark = self.rng.choice(["&copy; ", "&#169; ", "", "Copyright "])
        text = mark + self.rng.choice([self.other, self.sentence])()
        inside = self.rng.choice([text, self.other(FOOT_WORDS), text + self.links(1, 4)])
        return self.part(["footer", "footer", "div"], FOOT, inside)

    def side(self) -> str:
        inside = self.rng.choice([f"<h3>{self.sentence(1, 3)}</h3>" + self.links(), self.other(), self.links()])
        return self.part(["aside", "aside", "div", "section"], SIDE, inside, 0.9)

    def notice(self) -> str:
        inside = self.rng.choice([self.other(NOTICE_WORDS), self.sentence()]) + self.rng.choice(
            ["", "<button>OK</button>", '<a href="#">OK</a>'])
        role = self.rng.choice(["", "", ' role="alert"', ' role="dialog"'])
        return f"<div{self.named(NOTICE)}{role}>{inside}</div>"

    def advert(self) -> str:
        return self.part(["div", "div", "aside", "section"], ADVERT,
                         self.rng.choice([self.other(), self.sentence(), self.links(1, 2)]), 1.0)

    def form(self) -> str:
        inside = "".join(self.rng.choice([f"<label>{self.sentence(1, 3)}</label><input>", f"<p>{self.sentence()}</p>",
                                          f"<div>{self.sentence(1, 6)}</div>", "<button>Go</button>"])
                         for _ in range(self.rng.randint(1, 3)))
        return f"<form{self.plain()}>{inside}</form>"

    def comments(self) -> str:
        rng = self.rng
        each = []
        for _ in range(rng.randint(1, 5)):
            body = "".join(f"<p>{self.prose()}</p>" for _ in range(rng.randint(1, 2)))
            who = f"<span>{self.word()} {rng.choice(COMMENT_WORDS)}</span>" if rng.random() < 0.6 else ""
            tag = rng.choice(["li", "div", "article"])
            each.append(f"<{tag}{self.named(COMMENTS) if rng.random() < 0.6 else ''}>{who}{body}</{tag}>")
        title = f"<h3>{rng.choice(['Comments', 'Responses', 'Discussion', self.sentence(1, 3)])}</h3>"
        tag = rng.choice(["section", "div", "div", "ol", "ul"])
        return f"<{tag}{self.named(COMMENTS)}>{title if tag in ('section', 'div') else ''}{''.join(each)}</{tag}>"

    def share(self) -> str:
        return f"<div{self.named(SHARE)}>{self.links(1, 5)}</div>"

    def body(self) -> str:
        rng = self.rng
        out = [self.keep("h1", self.sentence(1, 12))] if rng.random() < 0.8 else []
        for _ in range(rng.choice([1, 2, 4, 8, 15, 25])):
            kind = rng.random()
            if kind < 0.72:
                text = self.keep("p", self.prose())
                out.append(text.removesuffix("</p>") if rng.random() < 0.1 else text)
            elif kind < 0.8:
                out.append(self.keep(rng.choice(["h2", "h3"]), self.sentence(1, 8)))
            elif kind < 0.86:
                tag = rng.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(self.keep("li", self.sentence()) for _ in range(rng.randint(1, 5))) + f"</{tag}>")
            elif kind < 0.9:
                out.append(f"<blockquote>{self.keep('p', self.prose())}</blockquote>")
            elif kind < 0.93:
                out.append("<table>" + "".join(
                    "<tr>" + "".join(self.keep("td", self.sentence(1, 4)) for _ in range(2)) + "</tr>"
                    for _ in range(rng.randint(1, 3))) + "</table>")
            elif kind < 0.95:
                out.append(self.keep("pre", self.sentence()))
            else:
                out.append(rng.choice([self.advert, self.advert, self.share, self.side, self.form, self.notice])())
        return "".join(out)

    def whole(self) -> str:
        rng = self.rng
        inside = self.body()
        late = "".join(f() for f in (self.share, self.comments) if rng.random() < 0.25)
        style = rng.random()
        if style < 0.45:
            inside = f"<article{self.plain()}>{inside}{late if rng.random() < 0.5 else ''}</article>" + (
                "" if rng.random() < 0.5 else self.comments() if rng.random() < 0.3 else "")
        elif style < 0.6:
            inside = f"<main{self.plain()}>{inside}</main>{late}"
        elif style < 0.9:
            inside = f"<div{self.named(CONTENT)}>{inside}{late}</div>"
        else:
            inside = f"<div{self.plain()}>{inside}</div>{late}"
        if rng.random() < 0.3:
            inside = f"<{rng.choice(['main', 'div', 'section'])}{self.plain()}>{inside}"
        before = [f() for f, chance in ((self.notice, 0.25), (self.head, 0.5), (self.menu, 0.7), (self.form, 0.15),
                                        (self.advert, 0.4), (self.side, 0.15)) if rng.random() < chance]
        after = [f() for f, chance in ((self.side, 0.35), (self.advert, 0.2), (self.comments, 0.25), (self.form, 0.15),
                                       (self.foot, 0.8), (self.notice, 0.15)) if rng.random() < chance]
        return ("<!DOCTYPE html><html><head><title>" + self.sentence(1, 6) + "</title><style>p{margin:0}</style></head><body>"
                + "".join(before) + inside + "".join(after) + rng.choice(["</body></html>", ""]))


def labelled_pages(n: int, seed: int = 0) -> Iterator[tuple[str, set[str]]]:
    """(page, texts of its main blocks) for ``n`` pages; a text is main wherever it stands in the page."""
    rng = random.Random(seed)
    for _ in range(n):
        page = _Page(rng)
        yield page.whole(), page.main
