"""Comments as articles, custom elements, odd quotes and open tags, against pages built from known blocks."""

import random
import time

import pytest

from terrace.llm import html_text
from terrace.llm.html_text import blocks

LOW = ("BOILER", "OUTSIDE", "NAMED")


def kept(page):
    """Text that markup alone keeps."""
    return "\n".join(t for _, s, t in blocks(page) if 0.8 + html_text.SHIFT[s] >= html_text.LOW)


@pytest.mark.parametrize("page,text", [
    ("<article><p>Body.</p></article><section class=comments><article class=comment><p>Me too</p></article></section>", "Body."),
    ("<div id=comments><article>" + "<p>Long remark of many words.</p>" * 50 + "</article></div><article><p>Body.</p></article>", "Body."),
    ("<article><p>Body.</p></article><article class='comment odd'><p>First!</p></article>", "Body."),
    ("<main><p>Body.</p><div class=comments><p>No</p><ol class=replies><li>Yes</li></ol></div></main>", "Body."),
    ("<div class=comments><article><p>All there is.</p></article></div>", "All there is."),
    ("<article><title-card>Card</title-card><p>Body.</p><template-row>Row</template-row></article>", "Card\nBody.\nRow"),
    ("<article><style-guide><p>Guide</p></style-guide><p>End.</p></article>", "Guide\nEnd."),
    ("<article><p title=it's>One.</p><p>Two isn't it.</p></article>", "One.\nTwo isn't it."),
    ('<article><p title=5">One.</p><p a="x>y" b=\'<p>\' c = "d">Two "2".</p></article>', 'One.\nTwo "2".'),
    ("<article><p data-x=a=b'c>One.</p><p 'odd\">Two.</p></article>", "One.\nTwo."),
    ("<article><p>One.</p><script>if (a > b) '<p>no</p>'</script><script/><p>Two.</p></article>", "One.\nTwo."),
    ("<article><p>One.</p><!-- <p>no</p> and on", "One."),
    ("<article><p>One.</p><style>p > a {} and on", "One."),
    ("<article><p>One. <a href", "One."),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
])
def test_contract(page, text):
    assert kept(page) == text


@pytest.mark.parametrize("unit", ["<a ", "<p a=", "<p a='", "<script ", "<!-", "<!-- ", "</p", "<a b=\"'", "< ", "<div class=comments>"])
def test_open_tags_are_looked_at_once(unit):
    """Time grows with the length of the page, not with its square."""
    def seconds(n):
        t = time.perf_counter()
        blocks("<article><p>One.</p>" + unit * n)
        return time.perf_counter() - t
    seconds(100)
    assert seconds(40_000) < 3.0


def test_built_pages(tmp_path):
    """An extractor that knows what it built: blocks of every kind in random order and dress."""
    rng = random.Random(9)
    say = lambda: " ".join(rng.choice("alpha beta gamma delta it's 5\" <b>fat</b> a&amp;b".split()) for _ in range(rng.randrange(3, 12)))
    plain = lambda x: x.replace("<b>", "").replace("</b>", "").replace("&amp;", "&")
    for _ in range(300):
        parts, want = [], []
        for _ in range(rng.randrange(2, 7)):
            text = say()
            tag = rng.choice(["p", "h2", "li", "x-block", "blockquote"])
            attribute = rng.choice(["", " title=it's", ' a="<p>"', " b='>'", " c", ' d="e" f=g'])
            parts.append(f"<{tag}{attribute}>{text}</{tag}>")
            want.append(plain(text))
            parts.append(rng.choice(["", "<script>x</script>", "<!-- <p>no</p> -->", "<style>p{}</style>", "\n"]))
        remarks = "".join(f"<article class=comment><p>{say()}</p></article>" for _ in range(rng.randrange(0, 9)))
        outside = rng.choice(["<nav><a>Home</a></nav>", "<footer>Imprint</footer>", "<div class=ad>Buy</div>", ""])
        comments = rng.choice([f"<section class='comments'>{remarks}</section>", f"<div id=disqus>{remarks}</div>", remarks])
        page = f"<html><body>{outside}<article>{''.join(parts)}</article>{comments}</body></html>"
        assert kept(page) == "\n".join(want), page
