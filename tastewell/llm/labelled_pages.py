"""Labelled pages that the page model learns from: hand-written parts, put together in many layouts.

``data-main`` marks the main text, ``data-not`` what is not part of it inside. The texts are
placeholders: only their length, punctuation, links and markup reach the model.
"""

from __future__ import annotations

import random

PAGES = 240
SEED = 11

WORDS = (
    "harbour ledger of the quiet and morning river to stone a window in for green letter with under wheel paper that bread from house lamp "
    "after winter is road"
).split()

# Parts that are not main text. {t} is a short phrase, {s} a sentence, {l} a list of links.
ABOVE = [
    "<nav><ul>{l}</ul></nav>",
    '<div class="menu"><ul>{l}</ul></div>',
    '<header><div class="logo">{t}</div><nav>{l}</nav></header>',
    "<header><h1>{t}</h1><p>{s}</p></header>",
    '<div id="header"><a href="/">{t}</a></div>',
    '<ul class="breadcrumbs">{l}</ul>',
    '<div class="ad">{s}</div>',
    '<div class="advert"><p>{s}</p><a href="/x">{t}</a></div>',
    '<div class="cookie-notice"><p>{s} {s}</p><button>{t}</button></div>',
    '<div class="notice">{s}</div>',
    '<section class="alert"><p>{s}</p></section>',
    '<form action="/search"><input name="q"><button>{t}</button></form>',
    '<div class="skip-link"><a href="#m">{t}</a></div>',
]
BELOW = [
    "<footer>&copy; {t} &middot; {s} {s}</footer>",
    "<footer><p>{s}</p><ul>{l}</ul></footer>",
    '<div id="footer"><p>{s}</p></div>',
    '<div class="footer">&copy; {t}. {s}</div>',
    '<aside><h3>{t}</h3><ul>{l}</ul></aside>',
    '<aside class="sidebar"><p>{s} {s}</p></aside>',
    '<div class="sidebar"><h2>{t}</h2><p>{s}</p><p>{s} {s}</p></div>',
    '<div class="related"><h3>{t}</h3><ul>{l}</ul></div>',
    '<section id="comments"><h2>{t}</h2><div class="comment"><p>{s} {s}</p></div><div class="comment"><p>{s} {s} {s}</p></div></section>',
    '<div class="comments"><ol><li><p>{s} {s}</p></li><li>{s}</li></ol></div>',
    '<ul class="comment-list"><li>{s} {s}</li><li>{s}</li></ul>',
    '<form class="newsletter"><label>{s}</label><input><button>{t}</button></form>',
    '<form><p>{s}</p><fieldset><label>{t}</label></fieldset></form>',
    '<div class="ads"><p>{s} {s}</p></div>',
    '<div class="share-buttons">{l}</div>',
    '<dialog class="popup"><p>{s} {s}</p></dialog>',
    '<div class="subscribe"><p>{s}</p></div>',
    '<div style="display:none"><p>{s} {s}</p></div>',
]
# Inside the article, but not of it.
BETWEEN = [
    '<div class="ad">{s}</div>',
    '<aside class="promo"><p>{s} {s}</p></aside>',
    '<aside>{s}</aside>',
    '<div class="share">{l}</div>',
    '<div class="related-links"><ul>{l}</ul></div>',
    '<form class="signup"><p>{s}</p><button>{t}</button></form>',
    '<nav class="toc"><ol>{l}</ol></nav>',
    '<div class="notice"><p>{s}</p></div>',
    '<div class="comments"><p>{s} {s}</p><p>{s}</p></div>',
]
# Blocks of an article; the holder around them carries the mark.
BLOCKS = [
    "<p>{p}</p>", "<p>{p}</p>", "<p>{p}", "<p><b>{p}<br>", "<p>{p} <a href='/x'>{t}</a> {p}</p>", "<p>{s}</p>", "<p>{t}</p>",
    "<h2>{t}</h2>", "<h3>{t}</h3>", "<ul><li>{s}</li><li>{t}</li><li>{s} {s}</li></ul>", "<ol><li>{t}</li><li>{s}</li></ol>",
    "<blockquote>{p}</blockquote>", "<blockquote><p>{s}</p></blockquote>", "<pre>{p}</pre>", "<div>{p}</div>", "<div><p>{p}</p></div>",
    "<table><tr><th>{t}</th><td>{t}</td></tr><tr><td>{t}</td><td>{s}</td></tr></table>",
    "<figure><img src='x'><figcaption>{s}</figcaption></figure>", "<dl><dt>{t}</dt><dd>{s}</dd></dl>", "<section><h2>{t}</h2><p>{p}</p></section>",
    "<div class='box'><p>{p}</p></div>",
]
HOLDERS = [
    ("<article data-main>", "</article>"), ("<article data-main>", "</article>"), ("<main><article data-main>", "</article></main>"),
    ("<main data-main>", "</main>"), ('<div class="content" data-main>', "</div>"), ('<div id="main"><div class="post" data-main>', "</div></div>"),
    ('<section class="story" data-main>', "</section>"), ('<div class="entry-content" data-main>', "</div>"), ('<div class="wrap"><div data-main>', "</div></div>"),
    ('<div class="page"><div class="article-body" data-main>', "</div></div>"), ("<div data-main>", "</div>"),
]


def _fill(part: str, rng: random.Random) -> str:
    phrase = lambda a, b: " ".join(rng.choice(WORDS) for _ in range(rng.randint(a, b)))
    sentence = lambda: phrase(4, 14).capitalize() + "."
    makers = {
        "{t}": lambda: phrase(1, 6).capitalize(),
        "{s}": sentence,
        "{p}": lambda: " ".join(sentence() for _ in range(rng.randint(1, 9))),
        "{l}": lambda: "".join(f'<li><a href="/{i}">{phrase(1, 3)}</a></li>' for i in range(rng.randint(2, 7))),
    }
    for mark, make in makers.items():
        while mark in part:
            part = part.replace(mark, make(), 1)
    return part


def labelled_pages(pages: int = PAGES, seed: int = SEED) -> list[str]:
    """The same pages for the same seed."""
    rng = random.Random(seed)
    out = []
    for _ in range(pages):
        above = [rng.choice(ABOVE) for _ in range(rng.randint(0, 4))]
        below = [rng.choice(BELOW) for _ in range(rng.randint(0, 5))]
        blocks = ["<h1>{t}</h1>"] * rng.randint(0, 1) + [rng.choice(BLOCKS) for _ in range(rng.randint(1, 8))]
        start, end = rng.choice(HOLDERS)
        body = ""
        for block in blocks:
            body += block
            if rng.random() < 0.12:  # the mark of the holder does not cover this part
                body += rng.choice(BETWEEN).replace(">", " data-not>", 1)
        head = f"<html><head><title>{{t}}</title><script>var x = 1;</script></head><body>{''.join(above)}"
        out.append(_fill(f"<!DOCTYPE html>{head}{start}{body}{end}{''.join(below)}</body></html>", rng))
    return out
