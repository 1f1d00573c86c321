"""Wrappers whose class mentions a part of a page, bad markup, and a plain version of the scorer."""

import random
import time

import pytest

from ashlar.llm import html_text


@pytest.mark.parametrize("name", ["has-sidebar", "layout-no-sidebar", "page-with-nav", "content hidden-xs", "search-result", "social"])
def test_a_wrapper_keeps_its_article(name):
    page = f'<html><body><nav><a href=x>Home</a></nav><div class="{name}"><article><h1>Head</h1><p>The text of the page.</p></article></div><div class="sidebar"><p>See, also.</p></div><footer>c</footer></body></html>'
    assert html_text.extract(page) == "Head\nThe text of the page."


def test_sections_and_siblings():
    page = "<article><h1>T</h1><p>One, two, three.</p><section id=discussion><p>We discuss it.</p></section><section id=comments><p>I, a reader, say so, too, and, more.</p></section></article>"
    assert html_text.extract(page) == "T\nOne, two, three.\nWe discuss it."
    long = "long text, " * 20 + "end."
    assert html_text.extract(f"<body><div><p>{long}</p></div><div><p>Short last line.</p></div><div class=promo><p>Buy.</p></div></body>") == long + "\nShort last line."
    assert html_text.extract(f"<body><div class=social><p>{long}</p></div><div class=cookie-notice><p>We use cookies.</p></div></body>") == long


@pytest.mark.parametrize("bad", ["<div>x", "<a ", "<a b='", "<b>x", "<", "<ul><li>x", "<span><div>", "&a", "<!-", "<table><tr><td>x"])
def test_time_grows_with_the_page_only(bad):
    def seconds(size):
        page = (bad * size)[:size]
        begin = time.process_time()
        html_text.extract(page)
        return time.process_time() - begin

    seconds(20_000)
    assert seconds(1_000_000) < 12 * seconds(200_000) + 1


def test_points_against_a_plain_version():
    """add_up() passes points from the leaves; here each block walks up to the root."""
    rng = random.Random(4)
    for _ in range(50):
        page, open_ = "<body>", []
        for _ in range(60):
            if open_ and rng.random() < 0.4:
                page += f"</{open_.pop()}>"
            elif rng.random() < 0.5:
                open_.append(rng.choice(["div", "p", "section", "ul", "li", "a", "span", "article"]))
                page += f"<{open_[-1]}>"
            else:
                page += "word, " * rng.randrange(1, 40)
        found, nodes = html_text.blocks_of(page)
        html_text.add_up(found, nodes)
        score, chars = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, 0)
        for holder, text, linked in found:
            points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
            node, share = (holder.parent if holder.tag in html_text.INSIDE else holder), 1.0
            while node is not None and node.parent is not None:
                score[node] += points * share
                node, share = node.parent, share / 2
            node = holder
            while node is not None:
                chars[node] += len(text)
                node = node.parent
        for x in nodes[1:]:
            assert abs(x.score - score[x]) < 1e-9 and x.chars == chars[x]
