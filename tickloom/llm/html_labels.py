"""Labelled pages for the block classifier, written for this purpose: parts of main text and of page furniture in many layouts."""

from __future__ import annotations

LONG = (
    "The ferry left the harbour before dawn and carried forty passengers, two goats and the mail across the strait.",
    "Engineers measured the old bridge in three seasons and found that its stones move more in spring than in winter.",
    "Nobody had asked the bakers how much flour they would need, so the mill ran out of it on the second market day.",
    "A later survey found the same beetle in nine valleys, which suggests that it walked there rather than flew.",
)
SHORT = ("It rained.", "Two boats came back.", "Nothing else was heard of them.", "So they waited until the evening tide.", "Quite.")
TITLES = ("A crossing in winter", "Notes on a stone bridge", "Bread for the market")
LINKS = ("Home", "World news", "Contact us", "Sports", "Archive of the year", "Terms", "Privacy policy")
NOTICES = ("We use cookies to improve your visit to these pages.", "Accept all", "Please sign in to go on reading this site.")
ADS = ("Buy two lamps and get the third one free until Sunday.", "Cheap flights from all airports.", "Great offers for you today in the shop round the corner.")
REMARKS = (
    "I was on that ferry and the goats were three, not two, as my sister will also tell you.",
    "Great read, thanks.", "First!", "My uncle built a bridge like that one and it fell down in the year after, so be careful with stones.",
)
FEET = ("Copyright 2020 by the publisher of these pages.", "All rights reserved.", "Made in a small town by the sea.")


def _list(items: tuple[str, ...]) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(items)) + "</ul>"


def _partly_linked(text: str, share: float) -> str:
    """A paragraph whose first words, about `share` of all, are a link."""
    words = text.split(" ")
    n = int(len(words) * share)
    return f"<p><a href='/x'>{' '.join(words[:n])}</a> {' '.join(words[n:])}</p>" if n else f"<p>{text}</p>"


def pages() -> list[tuple[str, set[str]]]:
    """(html, texts of the main blocks) of each page; all texts of a page differ, so that a text names its block."""
    out = []
    for k in range(12):
        article, semantic, div_page = k % 3 != 2, k % 2 == 0, k % 3 == 2
        title, body = TITLES[k % 3], [LONG[k % 4], SHORT[k % 5], LONG[(k + 1) % 4], SHORT[(k + 2) % 5], LONG[(k + 2) % 4]][: 2 + k % 4]
        text = f"<h1>{title}</h1>" + "".join(f"<p>{t}</p>" if (i + k) % 3 else f"<p><b>{t}</b><br>" for i, t in enumerate(body))
        if k % 4 == 1:
            text += '<ul><li>A box of nails.</li><li>Rope, forty yards of it.</li></ul>'
        main = {title, *body} | ({"A box of nails.", "Rope, forty yards of it."} if k % 4 == 1 else set())
        inner = ""
        if k % 4 == 3:
            inner = f"<aside><p>{ADS[0]}</p></aside>"
        if k % 4 == 2:
            inner = '<div class="share"><a href="/s">Share this story</a></div>'
        top = f"<nav>{_list(LINKS[:5])}</nav>" if semantic else f'<div id="menu">{_list(LINKS[:5])}</div>'
        head = "<header><p>The Daily Page</p><p>News since 1901, every day but Monday</p></header>" if semantic else '<div class="site-header"><p>The Daily Page</p></div>'
        ad = f'<div class="ad">{ADS[k % 3]}</div>'
        notice = f'<div class="cookie-notice"><p>{NOTICES[0]}</p><button>{NOTICES[1]}</button></div>' if k % 2 else f'<div class="notice">{NOTICES[2]}</div>'
        form = '<form action="/q"><label>Search the site</label><p>Type a word and press the key.</p></form>'
        side = f"<aside><h2>More to read</h2><p>{ADS[(k + 1) % 3]}</p>{_list(('Ten lighthouses to see', 'A history of rope'))}</aside>" if semantic else f'<div class="sidebar"><h3>More to read</h3><p>{ADS[(k + 1) % 3]}</p></div>'
        remarks = '<section class="comments"><h3>What others say</h3>' + "".join(f"<p>{t}</p>" for t in REMARKS) + "</section>"
        foot = f"<footer><p>{FEET[k % 3]}</p><a href='/t'>Imprint</a></footer>" if semantic else f'<div class="footer">{FEET[k % 3]} <a href="/t">Imprint</a></div>'
        if article:
            text = f"<article>{text}{inner}</article>"
        elif div_page and k % 2:
            text = f'<div class="post-content">{text}{inner}</div>'
        else:
            text = f"<div>{text}{inner}</div>"
        order = [top + head, head + top][k % 2] + [ad + notice, notice, ad][k % 3]
        after = [side + remarks, remarks, side, form + remarks][k % 4]
        out.append((f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{order}{text}{after}{foot}</body></html>", main))
    # Short main parts that are named as such: alone, first or last on the page, or among links.
    for k in range(16):
        text, link = SHORT[k % 5], f"<div><a href='/{k}'>{LINKS[k % 7]}</a></div>"
        body = [text, *LONG[k % 4 : k % 4 + k // 8]]
        inner = (link if k & 4 else "").join(_partly_linked(t, (0, 0.2, 0.4, 0.49)[k % 4]) for t in body)
        tag = ("article", "main")[k // 8]
        before, after = link if k & 1 else "", link if k & 2 else ""
        out.append((f"<html><body>{before}<{tag}>{inner}{link if k & 4 else ''}</{tag}>{after}</body></html>", set(body)))
    out += [unmarked(k, LONG, SHORT, TITLES, LINKS, (*NOTICES[1:], *ADS[1:2], *FEET)) for k in range(36)]
    return out


def unmarked(k: int, long: tuple[str, ...], short: tuple[str, ...], titles: tuple[str, ...], links: tuple[str, ...], strips: tuple[str, ...]) -> tuple[str, set[str]]:
    """Page number k in which no name tells main text from furniture: `strips` are short texts without links, like many
    paragraphs, but they stand among links or at the ends of the page while paragraphs stand by paragraphs."""
    def linked(i: int, n: int) -> str:
        return "<div>" + " ".join(f'<a href="/{j}">{links[(i + j) % len(links)]}</a>' for j in range(n)) + "</div>"

    def strip(i: int) -> str:
        return f"<p>{strips[i % len(strips)]}</p>"

    title, body = titles[k % len(titles)], []
    for i in range(2 + k % 3):
        body.append(long[(k + i) % len(long)])
        if (k + i) % 2:
            body.append(short[(k + i) % len(short)])
    text = (f"<h1>{title}</h1>" if k % 2 else f"<p>{title}</p>") + "".join(_partly_linked(t, (0, 0.1, 0, 0.3, 0.45)[(k + i) % 5]) for i, t in enumerate(body))
    top = [linked(k, 1), linked(k, 3) + strip(k) + linked(k + 3, 1), strip(k) + linked(k, 2), ""][k % 4]
    foot = [linked(k + 1, 2) + strip(k + 1), linked(k + 1, 1) + strip(k + 1) + linked(k + 2, 2) + strip(k + 2), linked(k + 1, 1)][(k // 3) % 3]
    return f"<html><body>{top}{text}{foot}</body></html>", {title, *body}
