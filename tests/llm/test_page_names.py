"""Names of classes are evidence, not verdicts."""

import pytest
from postlens.llm import html_extract


def text(html):
    return html_extract.main_text(html_extract.parse(html))


LONG = "Enough words to be the text of a page, several of them in a row. " * 3


@pytest.mark.parametrize(
    "name", ["post category-social", "entry search-engines", "post tag-form", "article-body related-work", "story side-story", "post notice"]
)
def test_no_name_empties_an_article(name):
    html = f"<body><nav>menu</nav><article class='{name}'><h1>T</h1><p>One.</p><p>Two.</p></article><footer>f</footer></body>"
    assert text(html) == "T\n\nOne.\n\nTwo."
    assert text(f"<body><div class='{name}'><div id='content'>{html}</div></div></body>") == "T\n\nOne.\n\nTwo."


def test_teasers_in_a_main_part():
    html = "<main><h1>T</h1><p>One.</p><article class='teaser'><p>x</p></article><p>Two.</p></main>"
    assert text(html) == "T\n\nOne.\n\nx\n\nTwo."
    assert text(f"<main><p>Before.</p><article><p>{LONG}</p></article></main>") == LONG.strip()


def test_an_article_inside_a_form():
    html = f"<body><form><input><nav>n</nav><article><p>{LONG}</p></article></form></body>"
    assert text(html) == LONG.strip()
    assert text(f"<body><form><div><p>{LONG}</p></div><button>Go</button></form></body>") == LONG.strip()
    assert text(f"<body><p>{LONG}</p><form><p>Your mail</p></form></body>") == LONG.strip()


def test_lines_are_cut_by_whole_classes_only():
    html = "<article><p id='notice-of-claim'>A.</p><p class='share-price'>B.</p><p class='advert'>C.</p><li class='form'>D</li></article>"
    assert text(html) == "A.\n\nB."


def test_comments_and_adverts_go():
    html = (
        f"<body><article><p>{LONG}</p><div class='ad-slot'>buy</div></article>"
        "<div id='comments'><article class='comment'><p>reader</p></article><article><p>reader two</p></article></div>"
        "<section class='related-posts'><article class='teaser'><p>more</p></article></section>"
        "<div class='cookie-banner'>ok</div><article class='ad'>buy</article></body>"
    )
    assert text(html) == LONG.strip()


def test_numbers_in_names_are_one_style():
    keys = {html_extract.parse(f"<div id='post-{n}' class='c{n}'></div>").children[0].key for n in (123, 4567, 89012)}
    assert len(keys) == 1
    assert html_extract.parse("<div class='facade'></div>").children[0].key == "div.facade"
