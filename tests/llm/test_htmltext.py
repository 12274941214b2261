"""Operator 8: names only propose, foreign and unclosed markup, nesting, odd input."""
import time

import pytest

from cohort_spark.llm import htmltext

ONE = "The first paragraph of the story is long enough, it says things. It goes on and on for a while, with commas."
TWO = "The second paragraph is as long as the first, and it says more things, with marks; it ends here."
P, BOTH = f"<p>{ONE}</p><p>{TWO}</p>", f"{ONE}\n{TWO}"
NAV, FOOT = "<nav><a href=/>Home</a><a href=/a>About</a></nav>", "<footer>Copyright 2024, all rights reserved.</footer>"
AD = "<div class='ad banner'>Buy the thing now, it is cheap, it is good, it is here.</div>"


@pytest.mark.parametrize("page", [
    f"{NAV}<div class='layout has-sidebar'><article>{P}</article><div class=sidebar><p>Side text here.</p></div></div>{FOOT}",
    f"{NAV}<div id='content-with-sidebar'>{P}</div>{FOOT}",
    f"{NAV}<div class='post no-comments'>{P}</div>{AD}{FOOT}",
    f"{NAV}<div class='main-rail'>{P}</div><div class=rail>More of it</div>{FOOT}",
    f"{NAV}<div class='widget-area'>{P}</div>{FOOT}",
    f"<form id='aspnetForm'>{NAV}<div>{P}</div>{AD}{FOOT}</form>",
    f"<header class=header><div>{P}</div></header>",
    f"{NAV}<div class=page><div class=post>{P}</div><div class='comments'>{P}{P}{P}</div></div>{FOOT}",
    f"{NAV}<article>{P}<div class='comment-list'>{P}{P}{P}</div><form><p>Write to us, please, it helps.</p></form></article>",
    f"{NAV}<article>{P}<div class=related><a href=/x>Another story of ours</a> <a href=/y>And yet another one</a></div></article>{FOOT}",
    f"{NAV}<article>{P}<section class='discussion'><p>12 remarks.</p></section></article>{FOOT}",
    f"{NAV}<div class='ad'>{ONE}{ONE}{ONE}</div><article>{P}</article>{FOOT}",
    f"{NAV}<main><article class='has-no-sidebar'>{P}</article></main>{FOOT}",
])
def test_wrappers_and_names(page):
    assert htmltext.main_text(f"<html><body>{page}</body></html>") == BOTH


@pytest.mark.parametrize("name,heading", [("discussion", "Discussion"), ("related work", "Related work")])
def test_sections_of_a_paper_stay(name, heading):
    page = f"<body>{NAV}<article>{P}<section class='{name}'><h2>{heading}</h2>{P}</section></article>{FOOT}</body>"
    assert htmltext.main_text(page) == f"{BOTH}\n{heading}\n{BOTH}"


@pytest.mark.parametrize("inner,text", [
    ('<p>One <svg class="i"/> two.</p><p>Three is here, too.</p>', "One two.\nThree is here, too."),
    ('<p>One <svg><title>x</title><path d="M0"/></svg> two.</p><p>Three is here, too.</p>', "One two.\nThree is here, too."),
    ("<p>One <svg> two, and so on.</p><p>Three is here, too.</p>", "One two, and so on.\nThree is here, too."),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be. So, it is.</p>", "Let x=1 be. So, it is."),
    ("<p>A<!-->B, and more.</p><p>C --> D.</p>", "AB, and more.\nC --> D."),
    ("<p>A<!--->B, and<!-- x --!> more.</p>", "AB, and more."),
    ("<p>A, b<!-- never closed <p>c</p>", "A, b"),
    ("<p>&lt;b&gt; &amp; caf&eacute; &#8364;5, yes.</p>", "<b> & café €5, yes."),
    ("<p>One, two.<script>var x = '<p>no</p>';</script></p><style>p{}</style>", "One, two."),
    ("<p>One,\n   two.<br>three.</p><ul><li>four<li>five</ul>", "One, two. three.\nfour\nfive"),
])
def test_markup(inner, text):
    assert htmltext.main_text(f"<html><body><article>{inner}</article></body></html>") == text


def test_nesting_is_linear():
    def seconds(k):
        began = time.process_time()
        assert htmltext.main_text("<div>x, y." * k).count("\n") == k - 1
        htmltext.main_text("<div><b>" * k + "</i></b></p>" * k + "text, here.")
        return time.process_time() - began

    seconds(1000)
    assert seconds(16000) < 30 * max(seconds(2000), 0.02)  # the eightfold page


def test_odd_input(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    long_page = f"<body><article>{P}<p>{'word, ' * 200000}</p></article></body>"
    rows = [(1, "u", None, 1, "a"), (None, None, "", 1, "a"), (2, "u", "<p>", 1, "a"), (3, "u", f"<body>{P}</body>", 1, "a"), (3, "u", f"<body>{P}</body>", 1, "a"), (4, "u", long_page, 1, "a")]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in htmltext.extract(spark.createDataFrame(rows, schema)).collect()]
    whole = BOTH + "\n" + " ".join(["word,"] * 200000)
    assert sorted(got, key=str) == sorted([(1, "", 0), (None, "", 0), (2, "", 0), (3, BOTH, len(BOTH)), (3, BOTH, len(BOTH)), (4, whole, len(whole))], key=str)
    assert htmltext.extract(spark.createDataFrame([], schema)).count() == 0
