"""The block labeller on names that its training doesn't hold, and formulas and buttons inside lines."""

import random

import pytest

from viewloom.llm import blocks
from viewloom.llm.text import table


@pytest.fixture(scope="module")
def pages(spark):
    rows = table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "html").orderBy("page_id").collect()
    return [r["html"] for r in rows if r["html"]]


@pytest.fixture(scope="module")
def model(pages):
    return blocks.fit([b for b in map(blocks.blocks, pages[:100]) if b])


def main(model, html):
    own = blocks.blocks(html)
    return [b.text for b, p in zip(own, model.probabilities([blocks.vectors(own)])[0], strict=True) if p >= 0.5]


def article(html):
    return [b.text for b in blocks.blocks(html) if blocks.teacher(b) == 1]


@pytest.mark.parametrize("name", ["detail", "news-detail", "readme", "c2", "lesson-text", "wp-block-x"])
def test_everyday_names_keep_the_article(model, pages, name):
    for html in pages[100:200]:
        assert main(model, html.replace("<article", f'<div class="{name}"').replace("</article>", "</div>")) == article(html)


def test_random_names_keep_the_article(model, pages):
    rng = random.Random(3)
    for html in pages[50:250]:
        names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(3)]
        other = html.replace("<article", f'<div class="{names[0]}"').replace("</article>", "</div>").replace('class="ad"', f'class="{names[1]}"')
        assert main(model, other.replace("<body>", f'<body class="{names[2]}">')) == article(html)


def test_each_telling_name_has_an_input_of_its_own():
    seen = {}
    for name in (*blocks.ELEMENTS, *blocks.MAIN, *blocks.OTHER, "#detail", "unknown-element"):
        (at,) = blocks.vector(blocks.Block("a", (name,), 0.0), 0.0)[: blocks.PATH].nonzero()[0]
        assert at not in seen, (name, seen[at])
        seen[at] = name
    assert blocks.vector(blocks.Block("a", ("#readme",), 0.0), 0.0)[: blocks.PATH].nonzero()[0].tolist() == [blocks.PATH - 2]


def test_formulas_buttons_and_objects_stay_inside_their_line():
    page = "<body><p>x <math><mrow><mi>a</mi><mo>+</mo><mn>1</mn></mrow></math> z <button>Go</button> on <object data='f'>instead</object> <svg><text>no</text></svg>end<script>1</script>.</p><p>next</p></body>"
    own = blocks.blocks(page)
    assert [b.text for b in own] == ["x a+1 z Go on instead end.", "next"]
    assert 0 < own[0].linked < 0.5 and own[1].linked == 0
    assert [b.linked for b in blocks.blocks("<div><button>Accept all</button></div>")] == [1.0]
