import pytest

from headway.llm import web_pages

MENU = "<div class='menu'>" + "<a href=x>l</a>" * 9 + "</div>"


def test_a_page_of_divs_keeps_all_its_parts():
    long, short = "words of content " * 60, "other words of content " * 8
    want = ["A title", long.strip(), short.strip()]
    for body in (f"<p>{long}</p><p>{short}</p>", f"<div><p>{long}</p></div><div><p>{short}</p></div>"):
        assert web_pages.main_text(f"<body>{MENU}<div id=content><h1>A title</h1>{body}</div></body>").split("\n") == want


@pytest.mark.parametrize("bad", ["<![foo]>", "<![ x>", "<![if !IE]>"])
def test_a_bad_declaration_does_not_end_the_page(bad):
    first, second = "words of content " * 20, "more words of content " * 20
    assert web_pages.main_text(f"<article><p>{first}</p>{bad}<p>{second}</p></article>").split("\n") == [first.strip(), second.strip()]
