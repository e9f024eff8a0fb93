"""Pages without article or main, whose text is spread over sibling containers."""

import time

import pytest

from corpusforge.llm import pagetext

TITLE, LEAD, STORY, MORE = "The title", "lead " * 30, "story " * 60, "more " * 40


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<body><div class=content><h1>{TITLE}</h1><div class=post><p>{STORY}</p><p>{MORE}</p></div></div><div class=other><p>junk</p></div></body>", [TITLE, STORY, MORE]),
        (f"<body><div class=content><div class=lead><p>{LEAD}</p></div><div class=text><p>{STORY}</p></div></div></body>", [LEAD, STORY]),
        (f"<body><div class=content><p>{LEAD}</p><ul><li>{STORY}</li><li>{MORE}</li></ul></div></body>", [LEAD, STORY, MORE]),
        (f"<body><h1>{TITLE}</h1><div class=post><p>{STORY}</p></div><div class=other><p>junk</p></div></body>", [TITLE, STORY]),
    ],
)
@pytest.mark.parametrize("strange", [False, True])
def test_article_over_sibling_containers(page, want, strange):
    p = pagetext.Page(page)
    own = p.votes()
    winners = sorted((k for k in own if own[k] >= pagetext.KEEP * max(own.values())), key=lambda k: (-own[k], k))
    assert p.text([1] if strange else winners) == "\n".join(x.strip() for x in want)


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article><header><h1>{TITLE}</h1></header><p>{STORY}</p></article>", [TITLE, STORY]),
        (f"<article><h1 class='post-header'>{TITLE}</h1><p>{STORY}</p><p class='reply'>{LEAD}</p></article>", [TITLE, STORY, LEAD]),
        (f"<body><header><h1>site</h1></header><article><p>{STORY}</p></article><footer>foot</footer></body>", [STORY]),
        (f"<body><div class='share-story'><p>{STORY}</p><p>{MORE}</p></div></body>", [STORY, MORE]),
        (f"<article><p>{STORY}</p><div class='related'><a href=x>other things to read</a></div><div class='notice'>be aware</div></article>", [STORY]),
        (f"<article><p>{STORY}</p><div class='comments'><p>{MORE}</p></div></article>", [STORY]),
        (f"<article><p>a < b <3 <![CDATA[c &amp; d]]> <!-- no --> e</p>{STORY}", ["a < b <3 c & d e", STORY]),
        (f"<article><p title='a > b'>{LEAD}</p><p title='to > {STORY}</p><p title='>{MORE}</p></article>", [LEAD, MORE]),
        (f"<article><p>{LEAD}</p><p title='no end>{STORY}</p><p>{MORE}</p></article>", [LEAD, STORY, MORE]),
    ],
)
def test_articles_that_use_marks(page, want):
    assert pagetext.Page(page).text([]) == "\n".join(x.strip() for x in want)


@pytest.mark.parametrize(
    "page",
    ["<a " * 1_600_000, "<![CDATA[" * 500_000, "<div>" * 400_000 + "</span>" * 400_000, "<b>" * 300_000 + "<p>x" * 300_000, "<b><div>" * 200_000 + "</b>" * 400_000, "<!--" * 1_000_000, "<a title=\"" * 400_000, "x < " * 1_000_000, "<p>word" * 500_000, "&amp" * 1_000_000],
    ids=["tags", "cdata", "deep", "inline", "crossed", "comments", "quotes", "signs", "blocks", "entities"],
)
def test_long_pages_in_time(page):
    began = time.time()
    pagetext.Page(page).text([])
    assert time.time() - began < 15
