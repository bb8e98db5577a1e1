"""Main text of hand-made pages of several templates; the expected texts are written by hand."""

import html
import re

import pytest

from skiagram.llm import html_text

SHORT = "The river rose in the night and carried the old bridge away."
LONG = "Engineers who had warned of the weak pillars for years came at dawn, measured what was left of them and found that three of the five could still be used."
READER = "I remember that bridge well, my father took us there every summer and we fished from it until the sun went down. "
COOKIES = "We and our partners store cookies on your device to measure how the site is used. "
HEAD = "<h1>A bridge is lost</h1>"
ARTICLE = f"{HEAD}<p>{SHORT}</p><p>{LONG} {LONG}</p><p>It rained.</p><p>{LONG}</p>"
WANTED = f"A bridge is lost {SHORT} {LONG} {LONG} It rained. {LONG}"
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>Sport</a></li><li><a href=/d>Contact</a></li></ul>"
COMMENTS = "".join(f"<div class='comment' id='comment-{k}'><p><b>Reader {k}</b></p><p>{READER * 3}</p></div>" for k in range(12))
PAGES = {
    "more comments than article": (f"<body><div class=navbar>{MENU}</div><div>{ARTICLE}</div><div class='comment-list'>{COMMENTS}</div><div class=footer>© 2020 The Paper. All rights reserved.</div>", WANTED),
    "comments in a list": (f"<body><div id=menu>{MENU}</div><div id=wrap>{ARTICLE}<h2 class=comments-title>9 thoughts</h2><ol class=commentlist>{f'<li class=comment><p>{READER * 4}</p></li>' * 9}</ol></div>", WANTED),
    "comments as articles": (f"<body><article>{ARTICLE}<section id=comments><article><p>{READER * 6}</p></article><article><p>{READER}</p></article></section></article>", WANTED),
    "one long comment": (f"<body><main>{ARTICLE}</main><div id=disqus_thread><p>{READER * 12}</p></div>", WANTED),
    "a notice longer than the article": (f"<body><div class='cookie-notice'><p>{COOKIES * 30}</p></div><div>{ARTICLE}</div>", WANTED),
    "a notice in camel case": (f"<body><div id=cookieBanner><p>{COOKIES * 9}</p></div><div>{ARTICLE}</div>", WANTED),
    "a layout that has a sidebar": (f"<body class=no-comments><div class='layout has-sidebar'><div class=sidebar><h3>Latest</h3>{MENU}<p>{SHORT}</p></div><div>{ARTICLE}</div></div>", WANTED),
    "a name that only looks like boilerplate": (f"<body><div id='social-science'>{ARTICLE}</div><div class='share-buttons'><a href=x>Tweet</a> <a href=y>Mail this story to somebody you know</a></div>", WANTED),
    "commentary isn't a comment": (f"<body><div class=top-menu>{MENU}</div><div class='commentary'>{ARTICLE}</div>", WANTED),
    "an advert amid the text": (f"<body><div>{HEAD}<p>{SHORT}</p><div class='ad-slot'><p>Buy a new boat today and save a third of the price, only this week.</p></div><p>{LONG}</p></div>", f"A bridge is lost {SHORT} {LONG}"),
    "sign up and related": (f"<body><div>{ARTICLE}</div><div class='newsletter-signup-box'><p>{'Get the best of our stories each morning in your inbox, free of charge and without adverts. ' * 3}</p></div><div id=related-posts><h3>More</h3><ul><li><a href=z>A dam is built</a></li></ul></div>", WANTED),
    "table layout": (f"<body><table><tr><td class=nav>{MENU}</td><td>{ARTICLE}</td><td class=ads><p>Buy a new boat today.</p></td></tr></table>", WANTED),
    "a list in the text": (f"<body><div>{MENU}</div><div>{HEAD}<p>{SHORT}</p><ul><li>three pillars,</li><li>one rail,</li><li>no lamp.</li></ul><p>{LONG}</p></div><div><p>© 2020 The Paper</p></div>", f"A bridge is lost {SHORT} three pillars, one rail, no lamp. {LONG}"),
    "a link that is a paragraph": (f"<body><div>{MENU}</div><div>{HEAD}<p>{SHORT}</p><p><a href=x>See the pictures of the night</a></p><p>{LONG}</p></div><div><a href=x>Imprint</a> <a href=y>Terms</a></div>", f"A bridge is lost {SHORT} See the pictures of the night {LONG}"),
}


@pytest.fixture(scope="module")
def weights(spark):
    return html_text.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_pages_of_several_templates(weights, name):
    page, wanted = PAGES[name]
    assert html_text.main_text(page, weights) == wanted


def test_comments_go_however_many_they_are(weights):
    """The verdict on an element of a sure name doesn't depend on its share of the page."""
    for n in (1, 3, 30, 300):
        for around in ("class=comments", "id=respond", "class='cookie-notice'", "class=sidebar"):
            assert html_text.main_text(f"<div>{ARTICLE}</div><div {around}>{f'<p>{READER}</p>' * n}</div>", weights) == WANTED


def test_levels_of_names():
    level = html_text.name_level
    assert [level(x, False) for x in ("comment-list", "x cookie-notice", "share-buttons", "ad-slot", "site__footer")] == [3, 2, 2, 2, 2]
    assert [level(x, False) for x in ("social-science", "legal", "google-ad")] == [1, 1, 1]
    assert [level(x, False) for x in ("", "has-sidebar", "page--no-comments", "navy", "commentary", "side-effects-none header", "site-header")] == [0, 0, 0, 0, 0, 1, 0]
    assert [level(x, True) for x in ("site-header", "x top", "top-story", "branding")] == [2, 1, 0, 2]


def test_smoothness_is_learned_and_decides_for_the_better(weights, spark):
    """Link paragraphs put amid the text of plain pages: alone they look like menus, their neighbours tell."""
    assert weights[1, -1] > 1
    alone = weights.copy()
    alone[1, -1] = 0
    right, right_alone = 0, 0
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").orderBy("page_id").collect()
    for r in rows:
        page = re.sub(r"<(/?)(nav|footer|article)>", r"<\1div>", r.html).replace('<div class="ad">', "<div>")
        found = list(re.finditer(r"<p>([^<]{60,})</p><p>", page))
        if not found:
            continue
        m = found[len(found) // 2]
        link = f'<p><a href="/x">{m[1][:60].strip()}</a></p>'
        page = page[: m.start()] + link + page[m.end() - 3 :]
        marked = r.html.replace(m[0], link + "<p>", 1)
        wanted = html.unescape(re.sub("<[^>]*>", " ", marked[marked.index("<article>") : marked.index("</article>")])).split()
        right += html_text.main_text(page, weights).split() == wanted
        right_alone += html_text.main_text(page, alone).split() == wanted
    assert right > 2 * right_alone and right >= 10
