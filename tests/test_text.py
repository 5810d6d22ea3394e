import html
import random
import re
from html.entities import html5

from pyspark.sql import functions as F

from trailkeep.functions import text as T
from trailkeep.rules import STOPWORDS

t = F.col("t")


def test_every_named_reference_decodes_like_the_standard(column):
    texts = ["&" + n for n in html5] + ["q&" + n.rstrip(";") + "zz" for n in html5]
    assert column(T.html_unescape(t), texts) == [html.unescape(x) for x in texts]


def test_odd_references(column):
    rng = random.Random(7)
    pieces = ["&", "a", "m", "p", ";", "#", "x", "4", "1", "lt", "gt", "not", "copy", " ", "é"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 15))) for _ in range(1000)]
    texts += ["&amp;lt;", "&#x41;&#65;&#0;&#128;&#xD800;&#x110000;&#99999999999999999999;", "&#1;&#xfffe;&#13;", "&", "", "&copy2026"]
    assert column(T.html_unescape(t), texts) == [html.unescape(x) for x in texts]


def test_space_is_unicode(column):
    texts = ["  a  b\t\n|c\x1c ", "　", "", None]
    assert column(T.clean_space(t), texts) == ["a b /c", "", "", None]
    assert column(T.strip(t), ["\t  x y \n"]) == ["x y"]


def test_article_profile(column):
    page = '<P>One<br/>two</p><script>x("<p>")</SCRIPT> &amp;lt;b&gt; &nbsp;| <svg a=1>s</svg>end'
    assert column(T.strip_html(t), [page]) == ["One two &lt;b> / end"]


def test_contact_and_district_profiles(column):
    page = "<style>p</style>A&nbsp;B &amp; 1&#8211;2 &ndash; | "
    assert column(T.strip_html(t, "contact"), [page]) == ["A B &amp; 1&#8211;2 &ndash; |"]
    assert column(T.strip_html(t, "district"), [page]) == ["A B &amp; 1-2 - |"]


def test_clean_text_matches_python(column):
    texts = ["<p>The school is not completed.</p>", "Straße ΟΔΟΣ naïve_x 2.9% of it", None, "", "a the of"]

    def expected(x):
        if x is None:
            return ""
        words = re.findall(r"\b\w+\b", re.sub(r"<[^>]+>", " ", x).casefold())
        return " ".join(w for w in words if w not in STOPWORDS)

    assert column(T.clean_text(t), texts) == [expected(x) for x in texts]
    assert column(T.clean_text(t), texts)[0] == "school not completed"


def test_punctuation_form(column):
    texts = ["Annual growth rate reported as 2.9%", "Growth-rate projection from the 2010 Census, not an actual census count", None]
    stop = [*STOPWORDS, "not"]
    assert column(T.clean_text_punct(t, stop), texts) == [
        "annual growth rate reported 29", "growthrate projection 2010 census actual census count", ""]


def test_case_fold_of_every_character(column):
    letters = [c for c in map(chr, range(0x30000)) if not "\ud800" <= c <= "\udfff" and c.lower() != c.casefold() or c in "ßµſŉ"]
    texts = letters + ["Straße", "GROSSE STRASSE", "ﬃ ß ŉ ß", "ΌΔΟΣ ς", "".join(letters), "", None, "İ", "Ꭰꭰ"]
    found = column(T.case_fold(t), texts)
    assert found[:-2] == [None if x is None else x.lower().casefold() for x in texts[:-2]]
    assert found[-1] == "ᎠᎠ"
