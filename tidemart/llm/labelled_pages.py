"""Labelled web pages to train the extraction model on: layouts put together by a rule, main parts marked."""

from __future__ import annotations

import random

# Names that page authors commonly give to the parts of a page, by the part.
PARTS = {
    "nav": (("nav", ""), ("div", "menu"), ("ul", "navbar"), ("div", "breadcrumbs"), ("div", "nav-links"), ("div", "pagination")),
    "header": (("header", ""), ("div", "header"), ("div", "masthead"), ("div", "site-header"), ("div", "topbar")),
    "footer": (("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright")),
    "side": (("aside", ""), ("div", "sidebar"), ("div", "widget"), ("section", "related"), ("div", "recommended"), ("div", "trending")),
    "ad": (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "promo"), ("aside", "ad"), ("p", "ad"), ("ins", "adsbygoogle"), ("section", "banner")),
    "notice": (("div", "cookie-notice"), ("div", "cookie"), ("div", "consent"), ("div", "notice"), ("div", "banner"), ("div", "popup"), ("div", "alert"), ("section", "gdpr"), ("p", "notice"), ("div", "paywall")),
    "form": (("form", ""), ("div", "newsletter"), ("div", "subscribe"), ("form", "search"), ("div", "login"), ("div", "signup")),
    "share": (("div", "share"), ("ul", "social"), ("div", "share-buttons"), ("div", "follow")),
    "comments": (("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "discussion"), ("div", "replies"), ("div", "responses"), ("article", "comment"), ("div", "reader-comments")),
}
MAIN = (("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "post-content"), ("div", "entry"), ("section", "story"), ("div", "main"), ("div", "text"), ("div", ""))
MISLEADING = ("search-results", "page-header", "main-nav-page", "sidebar-layout", "has-comments", "no-sidebar", "form-page", "popular-story", "notice-board", "related-reading")
LETTERS = "etaoinshrdlu"


def labelled_pages(pages: int = 1200, seed: int = 11) -> list[str]:
    """Pages in which ``data-main="1"`` opens a main part and ``data-main="0"`` a part that is not, each down to its leaves."""
    r = random.Random(seed)

    def words(low: int, high: int) -> str:
        out = ["".join(r.choice(LETTERS) for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high))]
        return (" ".join(out)).capitalize() + r.choice([".", ".", ".", "", "?"])

    def tag(name: str, css: str, body: str, label: str = "") -> str:
        where = r.choice(["class", "class", "id"])
        return f"<{name}{f' {where}={chr(34)}{css}{chr(34)}' if css else ''}{f' data-main={label}' if label else ''}>{body}</{name}>"

    def inline(text: str) -> str:
        if r.random() < 0.25:
            name = r.choice(["b", "i", "em", "strong", "a", "span", "code"])
            text += f" <{name}{' href=x' if name == 'a' else ''}>{words(1, 6)}</{name}> {words(1, 10)}"
        return text

    def links() -> str:
        item = r.choice(["<li><a href=x>{}</a></li>", "<a href=x>{}</a> "])
        body = "".join(item.format(words(1, 3)) for _ in range(r.randint(1, 9)))
        return f"<ul>{body}</ul>" if item.startswith("<li") else body

    def part(kind: str) -> str:
        name, css = r.choice(PARTS[kind])
        if kind in ("nav", "share"):
            body = links()
        elif kind == "comments":
            body = "".join(r.choice(["<p>{}</p>", "<div class=comment><p>{}</p></div>", "<li>{}</li>", "<div class=reply>{}</div>"]).format(inline(words(3, 60))) for _ in range(r.randint(1, 5)))
            body = r.choice(["", "<h3>Comments</h3>", "<h2>Replies</h2>"]) + body
        elif kind == "form":
            body = r.choice(["<label>{0}</label><input><button>{1}</button>", "<p>{0}</p><input><button>{1}</button>", "<p>{0}</p>"]).format(words(2, 20), words(1, 2))
        elif kind == "header":
            body = r.choice(["<a href=x>{0}</a>", "<h1>{0}</h1>", "<p>{0}</p>", "{0}"]).format(words(1, 8)) + (links() if r.random() < 0.5 else "")
        else:
            body = r.choice(["{}", "<p>{}</p>", "<h3>x</h3><p>{}</p>", "<a href=x>{}</a>", "<p>{} <a href=x>more</a></p>"]).format(words(2, 45))
        return tag(name, css, body, "0")

    def block() -> str:
        kind = r.random()
        if kind < 0.68:
            return f"<p>{inline(words(1, 120))}</p>"
        if kind < 0.72:  # further reading and sources, which are part of the text
            name = r.choice(["ul", "ol", "p"])
            item = "<li><a href=x>{}</a></li>" if name != "p" else "<a href=x>{}</a> "
            return f"<{name}>" + "".join(item.format(words(1, 9)) for _ in range(r.randint(1, 5))) + f"</{name}>"
        if kind < 0.80:
            return f"<h2>{words(1, 9)}</h2>"
        if kind < 0.86:
            name = r.choice(["ul", "ol"])
            return f"<{name}>" + "".join(f"<li>{inline(words(1, 25))}</li>" for _ in range(r.randint(1, 5))) + f"</{name}>"
        if kind < 0.90:
            return r.choice([f"<blockquote>{words(4, 50)}</blockquote>", f"<blockquote><p>{words(4, 50)}</p></blockquote>"])
        if kind < 0.93:
            return f"<pre>{words(3, 40)}</pre>"
        if kind < 0.95:
            return f"<figure><img src=x><figcaption>{words(2, 15)}</figcaption></figure>"
        if kind < 0.97:
            return "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        return r.choice(["<div><p>{}</p></div>", "<section><p>{}</p></section>", "<div>{}</div>"]).format(inline(words(3, 90)))

    def page() -> str:
        length = r.choice([2, 4, 12])
        body = ([f"<h1>{words(2, 12)}</h1>"] if r.random() < 0.8 else []) + [block() for _ in range(r.randint(1, length))]
        for kind in ("ad", "share", "side", "form", "comments", "notice"):
            if r.random() < 0.22:
                body.insert(r.randint(1, len(body)), part(kind))
        around = [part(k) for k in ("notice", "header", "nav", "ad") if r.random() < 0.6]
        after = [part(k) for k in ("comments", "side", "form", "share", "nav", "ad", "footer") if r.random() < 0.5]
        title, layout = f"<html><head><title>{words(2, 8)}</title></head>", r.random()
        if layout < 0.15:  # the text stands right in the body
            if r.random() < 0.5:
                around, after = [], []
            return f"{title}<body data-main=1>{''.join([*around, *body, *after])}</body></html>"
        if layout < 0.19:  # no main text at all, a loose line perhaps
            loose = f"<p data-main=0>{words(1, 12)}</p>" if r.random() < 0.5 else ""
            return f"{title}<body>{''.join([*around, loose, *after])}</body></html>"
        name, css = r.choice(MAIN)
        if r.random() < (0.15 if name in ("article", "main") else 0.04):
            css = r.choice(MISLEADING)
        main = tag(name, css, "".join(body), "1")
        if r.random() < 0.25:
            outer = f" id={r.choice(MISLEADING)}" if r.random() < 0.3 else ""
            # what holds nothing but the main part is part of it
            main = f"<main{outer} data-main=1>{main}</main>" if name != "main" else f"<div class=wrapper{outer} data-main=1>{main}</div>"
        inside = "".join([*around, main, *after])
        return f"{title}<body>{r.choice(['{}', '<div>{}</div>', '<div class=container>{}</div>']).format(inside)}</body></html>"

    return [page() for _ in range(pages)]
