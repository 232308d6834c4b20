"""Density of page elements against a plain computation, and pages whose names mislead."""

import math
import random

import pytest

from sluice.llm import html_text
from sluice.llm.html_text import BLOCKS, main_text, parse

PROSE = "A sentence of the article that is long enough to count, with commas, and more words than any menu has. " * 4


def page(inner):
    return f"<html><head><title>T</title></head><body><nav><a href=x>Home</a> <a href=y>News</a></nav>{inner}<footer>Imprint</footer></body></html>"


@pytest.mark.parametrize("noise", [
    '<div id="comments-3" class="comments-area"><p>reader one says</p></div>', '<div class="comment-section"><p>reader two says</p></div>',
    '<div class="ad-banner">buy now</div>', '<section class="advert-top"><p>buy more</p></section>', '<div class="cookie_notice">we use them</div>'])
@pytest.mark.parametrize("whole", ["<article><h1>Title</h1>{}{}</article>", "<div><h1>Title</h1>{}{}</div>"])
def test_names_with_hyphens_are_words(noise, whole):
    got = main_text(page(whole.format(f"<p>{PROSE}</p><p>{PROSE}</p>", noise)))
    assert got == "\n\n".join(["Title", PROSE.strip(), PROSE.strip()])


@pytest.mark.parametrize("open_, close", [('<form action="/x">', "</form>"), ('<div class="widget main-widget">', "</div>"), ('<div class="promo"><form>', "</form></div>"),
                                          ('<div id="social-science" role="dialog">', "</div>")])
def test_a_name_does_not_drop_most_of_a_page(open_, close):
    got = main_text(page(f'{open_}<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><div class="comment">short reply</div>{close}'))
    assert "Title" in got and got.count("A sentence of the article") == 8 and "short reply" not in got


def test_comments_come_back_only_where_nothing_else_is():
    got = main_text(page(f'<div><p>{PROSE}</p></div><div class="comments">{"<p>" + PROSE + "</p>"}{"<p>" + PROSE + "</p>"}</div>'))
    assert got == PROSE.strip()
    assert main_text(f'<body><div class="comments"><p>{PROSE}</p></div></body>') == PROSE.strip()
    assert main_text('<body><div hidden><p>never</p></div><script>x</script></body>') == ""


def test_the_titled_article_of_a_main_element():
    got = main_text(page(f"<main><article><h1>Title</h1><p>Short text.</p></article><article><h2>Teaser</h2><p>{PROSE}</p><p>{PROSE}</p></article></main>"))
    assert got == "Title\n\nShort text."


def brute_density(node, root_share):
    """Characters, tags, link characters and link tags by walking the whole subtree of each element anew."""
    chars = tags = link_chars = link_tags = 0
    todo = [(node, False)]
    while todo:
        at, linked = todo.pop()
        for part in at.parts:
            if isinstance(part, str):
                n = len("".join(part.split()))
                chars += n
                link_chars += n if linked else 0
            elif not part.dropped:
                tags += 1
                link_tags += part.tag == "a"
                todo.append((part, linked or part.tag == "a"))
    if not chars:
        return 0.0, (chars, link_chars)
    ratio = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + root_share * chars + math.e)
    scale = math.log(max(base, 1.0 + 1e-9) + 1e-9) if base > 1 else 1.0
    value = chars / max(tags, 1) * math.log(ratio) / scale if ratio > 1 else 0.0
    return value, (chars, link_chars)


def random_page(rng, depth=0):
    out = ""
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.4 or depth > 4:
            out += " ".join("word" * rng.randint(1, 3) for _ in range(rng.randint(0, 30)))
        elif kind < 0.6:
            out += f"<a href=x>{'link ' * rng.randint(0, 5)}</a>"
        else:
            tag = rng.choice(["div", "section", "span", "b", "blockquote", "nav"])
            out += f"<{tag}>{random_page(rng, depth + 1)}</{tag}>"
    return out


def test_densities_equal_a_plain_computation():
    rng = random.Random(4)
    for _ in range(150):
        root = parse(f"<body>{random_page(rng)}</body>")
        order = html_text._measure(root)
        _, (chars, link_chars) = brute_density(root, 0.0)
        share = link_chars / max(chars, 1)
        found = {id(n): brute_density(n, share)[0] for n in order}
        for n in order:
            assert n.density == pytest.approx(found[id(n)], rel=1e-9, abs=1e-12)
            inner = [p for p in n.parts if not isinstance(p, str) and not p.dropped and p.tag in BLOCKS]
            assert n.total == pytest.approx(sum(found[id(p)] for p in inner), rel=1e-9, abs=1e-12)
