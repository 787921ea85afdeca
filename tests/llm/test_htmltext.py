"""What is and is not the main text of a page."""

import pytest

from asterism.llm.htmltext import main_text

LONG = "a long paragraph of the article, with a comma and many words in it, " * 4
LONG = LONG.strip()


def page(body):
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


@pytest.mark.parametrize("gone", [
    "<div class='post-comments'><p>{0}</p></div>", "<section id=comments><article class='comment-body'><p>{0}</p></article></section>",
    "<article class=comment-body><p>{0}</p></article>", "<div class='main-menu'><p>{0}</p></div>", "<div class=content-ads>{0}</div>",
    "<div hidden><p>{0}</p></div>", "<div style='display: none'>{0}</div>", "<p hidden>{0}</p>", "<aside>{0}</aside>", "<form>{0}</form>",
    "<nav><ul><li><a href=x>{0}</a></li></ul></nav>", "<footer><p>{0}</p></footer>", "<div class='cookie-notice'>{0}</div>", "<p class=ad>{0}</p>",
    "<div role=complementary><p>{0}</p></div>", "<div class='comment_text'><p>{0}</p></div>", "<div class='comments-area'><div class='text'><p>{0}</p></div></div>",
])
@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "{}"])
def test_furniture(holder, gone):
    short = "And a short closing line."
    body = holder.format(f"<h1>The title</h1><p>{LONG}</p>{gone.format('Other words that are ' + LONG)}<p>{LONG}</p><p>{short}</p>")
    assert main_text(page(body)) == f"The title {LONG} {LONG} {short}"


@pytest.mark.parametrize("kept", [
    "<header><h1>{0}</h1></header>", "<div class='article-header'><h1>{0}</h1></div>", "<p class=social>{0}</p>", "<p class='related'>{0}</p>",
    "<div class='has-sidebar'><p>{0}</p></div>", "<div class='page-with-comments'><p>{0}</p></div>", "<h2 class=tags>{0}</h2>", "<div class=platform>{0}</div>",
    "<ul><li>{0}</li></ul>", "<p><a href=x>{0}</a></p>",
])
def test_parts_of_an_article(kept):
    body = f"<header><h1>The site</h1></header><article>{kept.format('Few words')}<p>{LONG}</p></article><footer>{LONG}</footer>"
    assert main_text(page(body)) == f"Few words {LONG}"


def test_surges_choose_the_element():
    # A long passage beside an article of a few words, and the other way round.
    assert main_text(page(f"<article><p>Teaser.</p></article><div><p>{LONG}</p><p>End.</p></div>")) == f"{LONG} End."
    assert main_text(page(f"<div><p>{LONG}</p></div><article><p>{LONG}</p><p>End.</p></article>")) == f"{LONG} End."
    assert main_text(page("<article><p>Few words.</p></article><div>menu</div>")) == "Few words."
    # Several articles one after the other; an article in a main element, with its title before it.
    assert main_text(page(f"<article>{LONG} one</article><article>{LONG} two</article>")) == f"{LONG} one {LONG} two"
    assert main_text(page(f"<main><h1>Title</h1><article><p>{LONG}</p></article><div>Read on: x</div></main>")) == f"Title {LONG}"
    assert main_text(page(f"<main><div><p>{LONG}</p></div><article><p>Teaser</p></article></main>")) == f"{LONG} Teaser"


def test_without_an_article_element():
    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(4))
    inner = "link 0 link 1 link 2 link 3"
    body = f"<ul>{links}</ul><h1>Title</h1><p>{LONG}</p><ul>{links}</ul><p>{LONG}</p><p>Short end.</p><ul>{links}</ul>"
    assert main_text(page(body)) == f"Title {LONG} {inner} {LONG} Short end."
    sections = "".join(f"<section><h2>Part {i}</h2><p>{LONG}</p></section>" for i in range(3))
    assert main_text(page(f"<div>Top words</div><div>{sections}</div><div>Bottom words</div>")) == " ".join(f"Part {i} {LONG}" for i in range(3))
    assert main_text("plain text") == "plain text" and main_text(page("")) == "" and main_text(None) == ""


def test_odd_markup():
    assert main_text("<article><p>One<p>Two<b>bold</article><div class='a") == "One Twobold"
    assert main_text("<article " + "<" * 3000) == ""
    assert main_text("<div>" * 3000 + LONG) == LONG
