"""Main texts against a plain reading of each page's article, and on malformed and awkward pages."""
import html as html_lib
import os
import re
import time

import pytest

from trailkeep.llm import html_text, queries

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
STORY = "<p>The first paragraph of the story is long enough to count as text.</p><p>And the second one goes on about it, with more words.</p>"
TEXT = "The first paragraph of the story is long enough to count as text.\n\nAnd the second one goes on about it, with more words."
LONG = "<p>" + "A reader's remark that is longer than the whole story above it. " * 9 + "</p>"


@needs_tables
def test_equals_the_articles_blocks(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.QUERIES["op7_html"](spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"(?s)<article\b.*?>(.*?)</article>", pages[r.page_id]).group(1)
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", re.sub(r"<br\b[^>]*>", " ", article))
        texts = [" ".join(html_lib.unescape(re.sub(r"</?\w[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(t for t in texts if t) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page", [
    "<form id=aspnetForm><nav>menu</nav><article>%s</article><footer>x</footer></form>",
    '<form><div class="has-sidebar"><div class="post comments-open">%s</div></div></form>',
    '<div class="content has-sidebar"><article>%s</article></div>', '<div class="no-sidebar">%s</div>',
    '<div class="elementor-widget-wrap">%s</div>', '<div class="article social-proof">%s</div>',
    '<div class="red-alert-story"><article>%s</article></div>', '<div class="search-results-off">%s</div>',
    "<form><article>%s</article><div class=comments>" + LONG + "</div></form>",
    "<article>%s</article><ol class=commentlist><li><article>" + LONG + "</article></ol>",
    "<article>%s</article><div class=related><article>" + LONG + "</article></div>",
    "<main>%s</main><form>" + LONG + "<button>send</button></form>"])
def test_wrapped_articles_stay_and_furniture_goes(page):
    assert html_text.main_text("<html><body><nav><a>a</a></nav>" + page % STORY + "<footer>f</footer></body></html>") == TEXT


def test_marked_sections_and_unfinished_tags():
    read = html_text.main_text
    assert read("<p>a</p><![foo bar]>b") == "a\n\nb"
    assert read("<![if !IE]><p>a b c</p><![endif]>") == "a b c"
    assert read("<p>x</p><![CDATA[ a > b ]]>y") == "x\n\ny"
    assert read("<p>a</p>b &lt; c <a href=") == "a\n\nb < c"
    assert read("<![foo") == "" and read("a &amp; b") == "a & b" and read("<!x y>a") == "a"


@pytest.mark.parametrize("page", [
    "<div>", "<b><p>", "<a ", "<!--", "<a '", "<![x", "<p>x</div>", "<", "</a ", "<script>", "<form>", "<div class=ad>", "<?", "&"])
def test_time_is_linear(page):
    start = time.process_time()
    html_text.main_text(page * 20_000 + ">x")
    html_text.main_text(page * 20_000)
    assert time.process_time() - start < 20


def test_elements_beyond_the_depth_belong_to_the_last_one():
    deep = html_text.DEEPEST + 50
    assert html_text.main_text("<div>" * deep + STORY + "</div>" * deep + "<p>After all that, one more.</p>").startswith(TEXT)
