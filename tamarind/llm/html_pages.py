"""Labelled pages for the HTML model, made by a rule: every combination step takes the next
variant of each part. ``data-y`` marks content (1) and the rest (0); nodes inherit it."""

from __future__ import annotations

import random

LABEL = "data-y"
N_PAGES = 240

_WORDS = ("river stone market window letter garden winter signal copper valley engine harbor paper lantern "
          "meadow ticket bridge castle thunder velvet silver pocket orange candle mirror forest island summer").split()


def _text(rng: random.Random, least: int, most: int, end: str = ".") -> str:
    n = rng.randint(least, most)
    words = [rng.choice(_WORDS) for _ in range(n)]
    return " ".join(w.capitalize() if i % 9 == 0 else w for i, w in enumerate(words)) + end


def _links(rng, n, tag="li"):
    return "".join(f'<{tag}><a href="/{i}">{_text(rng, 1, 3, "")}</a></{tag}>' for i in range(n))


def _paragraphs(rng) -> str:
    out = []
    for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 6, 7])):
        kind = rng.randrange(14)
        p = _text(rng, 1, rng.choice([2, 20, 70]), rng.choice([".", "!", "", "?"]))
        out.append({0: f"<p>{p} <a href='/x'>{_text(rng, 1, 6, '')}</a> {_text(rng, 1, 9)}</p>", 1: f"<h2>{_text(rng, 1, 6, '')}</h2><p>{p}</p>",
                    2: f"<ul><li>{_text(rng, 1, 9)}</li><li>{p}</li></ul>", 3: f"<blockquote><p>{p}</p></blockquote>",
                    4: f"<p><b>{p}<br><p>{_text(rng, 1, 40)}", 5: f"<p><a href='/y'>{_text(rng, 1, 5)}</a></p>",
                    6: f"<div>{p}</div>", 7: f"<pre>{p}</pre>", 8: f"<figure><figcaption>{p}</figcaption></figure>",
                    9: f"<table><tr><td>{_text(rng, 1, 4, '')}</td><td>{p}</td></tr></table>",
                    10: f"<ol><li><p>{p}</p></li></ol>"}.get(kind, f"<p>{p}</p>"))
        if rng.randrange(7) == 0:
            out.append(_boilerplate_inside(rng))
    return "".join(out)


def _boilerplate_inside(rng) -> str:
    t = _text(rng, 1, 25)
    return rng.choice([
        f'<div class="ad" data-y="0">{t}</div>', f'<div class="advert" data-y="0"><p>{t}</p></div>',
        f'<aside data-y="0"><p>{t}</p></aside>', f'<div class="share-buttons" data-y="0"><ul>{_links(rng, 3)}</ul></div>',
        f'<div class="related" data-y="0"><ul>{_links(rng, 4)}</ul></div>', f'<section class="sponsored" data-y="0">{t}</section>',
        f'<form data-y="0"><p>{t}</p><button>{_text(rng, 1, 2, "")}</button></form>',
        f'<div class="newsletter-signup" data-y="0"><p>{t}</p></div>', f'<div class="notice" data-y="0"><p>{t}</p></div>',
        f'<nav data-y="0"><ul>{_links(rng, 4)}</ul></nav>', f'<footer data-y="0">{t}</footer>',
        f'<section class="comments" data-y="0"><h2>{_text(rng, 1, 2, "")}</h2><p>{_text(rng, 2, 50)}</p></section>'])


def _article(rng) -> str:
    head = rng.choice(["", f"<h1>{_text(rng, 1, 9, '')}</h1>", f"<h1>{_text(rng, 1, 9, '')}</h1>",
                       f"<header class='entry-header'><h1>{_text(rng, 1, 8, '')}</h1></header>"])
    body = head + _paragraphs(rng)
    return rng.choice([
        f"<article data-y='1'>{body}</article>", f"<article data-y='1'>{body}</article>", f"<article data-y='1'>{body}</article>",
        f"<main><article class='post' data-y='1'>{body}</article></main>", f"<main data-y='1'>{body}</main>",
        f"<div id='content' data-y='1'>{body}</div>", f"<div class='wrap'><div class='article-body' data-y='1'>{body}</div></div>",
        f"<div class='page'><section class='post-content' data-y='1'>{body}</section></div>",
        f"<article data-y='1'><div class='entry-content'>{body}</div></article>",
        f"<main id='main'><div class='story' data-y='1'>{body}</div></main>"])


def _before(rng) -> str:
    t = _text(rng, 1, 30)
    return "".join(rng.sample([
        f"<nav><ul>{_links(rng, rng.randint(1, 8))}</ul></nav>", f"<header><p>{_text(rng, 1, 6, '')}</p><ul>{_links(rng, 3)}</ul></header>",
        f"<div class='menu'><ul>{_links(rng, 5)}</ul></div>", f"<div class='ad'>{t}</div>", f"<div id='cookie-banner'><p>{t}</p></div>",
        f"<div class='ad'>{_text(rng, 1, 80)}</div>", f"<div class='site-header'><h2>{_text(rng, 1, 4, '')}</h2></div>",
        f"<aside class='sidebar'><h3>{_text(rng, 1, 3, '')}</h3><ul>{_links(rng, 6)}</ul></aside>", f"<div class='notice'>{t}</div>",
        f"<form><label>{_text(rng, 1, 3, '')}</label><select><option>{_text(rng, 1, 1, '')}</select></form>",
        f"<div class='breadcrumb'>{_links(rng, 3, 'span')}</div>", f"<div role='navigation'>{_links(rng, 4, 'p')}</div>",
        f"<header><h1>{_text(rng, 1, 5, '')}</h1><p>{t}</p></header>"], rng.randint(0, 4)))


def _after(rng) -> str:
    t = _text(rng, 1, 40)
    return "".join(rng.sample([
        f"<section class='comments'><h3>{_text(rng, 1, 2, '')}</h3><div class='comment'><p>{t}</p></div><div class='comment'><p>{_text(rng, 5, 70)}</p></div></section>",
        f"<div id='comments'><ul><li><p>{_text(rng, 1, 60)}</p></li></ul></div>", f"<aside><p>{t}</p></aside>",
        f"<article class='comment'><p>{_text(rng, 3, 60)}</p></article>", f"<section id='disqus_thread'><p>{_text(rng, 3, 60)}</p></section>",
        f"<div class='related-posts'><h3>{_text(rng, 1, 3, '')}</h3><ul>{_links(rng, 5)}</ul></div>", f"<div class='sponsored'><p>{t}</p></div>",
        f"<div class='ads'>{t}</div>", f"<form><p>{_text(rng, 1, 20)}</p><textarea>{_text(rng, 1, 9)}</textarea><button>ok</button></form>",
        f"<div class='widget'><h3>{_text(rng, 1, 3, '')}</h3><p>{t}</p></div>", f"<div class='modal'><p>{t}</p></div>"], rng.randint(0, 4)))


def _foot(rng) -> str:
    t = _text(rng, 1, 30)
    return rng.choice(["", f"<footer>&copy; {t}</footer>", f"<footer>&copy; {_text(rng, 1, 60)}</footer>", f"<footer><p>{t}</p><ul>{_links(rng, 4)}</ul></footer>",
                       f"<div class='footer'><p>{t}</p></div>", f"<footer>{t}\n{_text(rng, 1, 20)}</footer>"])


def labelled_pages(n: int = N_PAGES) -> list[str]:
    rng = random.Random(20240501)
    out = []
    for i in range(n):
        begin = f"<!DOCTYPE html><html><head><title>{_text(rng, 1, 6)}</title></head><body>" if i % 5 else ""
        around = [_before(rng), _article(rng), _after(rng), _foot(rng)] if i % 9 else ["", _article(rng), "", ""]
        out.append(begin + "".join(around) + rng.choice(["</body></html>" if begin else "", ""]))
    return out
