import pytest

from tierline.llm import html_text

TEXT = "<h1>Title here</h1><p>some words, more words, and the rest.</p><p>a second paragraph</p>"
PLAIN = "Title here some words, more words, and the rest. a second paragraph"
SIDE = "<div class='sidebar'><p>not this</p></div>"


@pytest.mark.parametrize(
    "start",
    [
        "<div class='content has-sidebar'>",
        "<div class='no-sidebar'>",
        "<div id='page-with-header'>",
        "<section class='widget-area'>",
        "<section class='widget-area'><div class='header-main'>",
    ],
)
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_hinted_wrappers_keep_the_text(start, inner):
    end = "</div></section>" if start.count("<") == 2 else start.split()[0].replace("<", "</") + ">"
    page = f"<html><body><nav>menu</nav>{start}<{inner}>{TEXT}</{inner}>{SIDE}{end}<div id=footer>end</div></body></html>"
    if inner == "div":
        assert html_text.main_text(page) == PLAIN
    else:
        assert html_text.main_text(f"<main>{page}</main>") == PLAIN
        assert html_text.main_text(page) == PLAIN


@pytest.mark.parametrize(
    "page",
    [
        f"<article>{TEXT}<div class='comments'><article>{'me too ' * 90}</article></div></article>",
        f"<article>{TEXT}</article><div class='comments'><p>{'me too ' * 90}</p></div>",
        f"<main>{TEXT}<div id='related-posts'><article>other</article></div></main>",
        f"<article>{TEXT}</article><div class='footer'><p>{'long terms ' * 90}</p></div>",
        f"<article>{TEXT}</article><div class='menu' role='navigation'><article>{'x ' * 900}</article></div>",
    ],
)
def test_hinted_parts_beside_the_text_are_cut(page):
    assert html_text.main_text(page) == PLAIN
