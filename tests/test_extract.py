import datetime
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from trailkeep.functions import classify as C
from trailkeep.functions import extract as X
from trailkeep.functions import values as V
from trailkeep.operators import pages as P
from trailkeep.plans.collect import collect_records
from trailkeep.rules import SiteRules, place_rules, shortest_terms

t = F.col("t")
SITE = "https://town.example.org"
BUNDLE = """
<html><head><title>CDF PROJECTS IMPROVE WATER - Town Site</title>
<meta property="article:published_time" content="2026-02-26T09:00:00+00:00"></head>
<body><article><h1 class="entry-title">CDF PROJECTS IMPROVE WATER</h1>
<p>In Lusu Ward, construction of a water system at Moo Primary School
is ongoing under the Constituency Development Fund at K1.2 million.</p>
<p>Construction of a rural health post in Moomba Ward has been completed.</p>
</article></body></html>"""
RULES = SiteRules(SITE, "Town Site", places=place_rules(["Lusu", "Moomba"], ["Nalo"], ["Town"]))


t_page = F.lit("page")


def _stored(spark):
    from trailkeep.session import shared_folder
    path = f"{shared_folder(spark)}/stored-pages"
    pages(spark, BUNDLE).write.mode("overwrite").parquet(path)
    return path


def pages(spark, *htmls):
    return spark.createDataFrame([(f"{SITE}/?p={i}", h) for i, h in enumerate(htmls, 1)], "url string, html string")


def test_bundled_page(spark):
    rows = collect_records(pages(spark, BUNDLE), RULES).records.orderBy("project_name").collect()
    found = sorted((r.sector, r.funding_amount_zmw, r.status, r.constituency, r.date_reported) for r in rows if r)
    day = datetime.date(2026, 2, 26)
    assert found == [("health", None, "completed", "Moomba", day), ("water_sanitation", 1200000.0, "ongoing", "Lusu", day)]
    assert {r.project_id for r in rows} == {"REC-001", "REC-002"}


def test_the_first_saved_copy_of_a_page_gives_the_record(spark):
    dated = BUNDLE.replace("2026-02-26", "2026-03-01")
    assert dated != BUNDLE
    rows = [(10, f"{SITE}/?p=1", BUNDLE), (9, f"{SITE}/?p=1", dated)]
    frame = spark.createDataFrame(rows, "n long, url string, html string")
    found = collect_records(frame, RULES, order="n").records.collect()
    assert len(found) == 2 and {str(r.date_reported) for r in found} == {"2026-03-01"}
    assert {str(r.date_reported) for r in collect_records(frame, RULES).records.collect()} == {"2026-02-26"}


def test_extraction_is_not_repeated_in_a_filter(spark):
    frame = spark.read.schema("url string, html string").parquet(_stored(spark))
    for found in (P.pages_to_records(frame, RULES), P.paragraphs(frame), P.extract_links(frame),
                  P.extract_contacts(frame.withColumnsRenamed({"html": "text", "url": "source_url"}).withColumn("source_page", t_page))):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if line.lstrip(" +-").startswith("Filter")]
        assert filters and not any("regexp" in line for line in filters)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_title_does_not_leak_into_units(spark):
    html = """<title>CDF completed projects</title><article>
    <p>Construction of a school is ongoing under CDF.</p>
    <p>Construction of a health clinic was discussed.</p></article>"""
    rows = P.pages_to_records(pages(spark, html), RULES).orderBy("unit_no").collect()
    assert [r.status for r in rows] == ["ongoing", None]


def test_other_topic_gives_nothing(spark):
    html = "<article><p>Construction of a school funded by a private donor.</p></article>"
    assert P.pages_to_records(pages(spark, html), RULES).count() == 0


def test_page_without_units_falls_back_to_its_text(spark):
    html = "<title>CDF project talks</title><article>Talks were held.</article>"
    row = P.pages_to_records(pages(spark, html), RULES).first()
    assert (row.project_name, row.description, row.sector) == ("CDF project talks", "Talks were held.", "other")


@pytest.mark.parametrize("text, amount, strict", [
    ("K900,000 for a school and K200,000 for a clinic", None, None),
    ("No cost was reported", None, None),
    ("ZMW 1.2 million", 1200000.0, 1200000.0),
    ("at K2,099,616.03.", 2099616.03, 2099616.03),
    ("K 2, 887,051", 2.0, None),
    ("K2, 93, 400", 2.0, None),
    ("K500k", None, None),
    ("k3 bn", 3e9, 3e9),
])
def test_amounts(column, text, amount, strict):
    assert column(X.extract_amount(t), [text]) == [amount]
    assert column(X.extract_amount(t, strict=True), [text]) == [strict]


def test_status(column):
    texts = ["The clinic is not completed", "The school will be commissioned", "Construction is ongoing",
             "Handed over", "95% complete", "nearing completion", "a ground-breaking", "completedx", ""]
    assert column(C.infer_status(t), texts) == [
        None, None, "ongoing", "completed", "near_completion", "near_completion", "planned", None, None]


def test_classes(column):
    assert column(C.classify_keywords(t), ["a broad view", "School water", "Clinic", "talk"]) == [
        "infrastructure", "water_sanitation", "health", "other"]
    assert column(C.classify_keywords(t, word=True), ["a broad view", "a road"]) == ["other", "infrastructure"]
    assert column(C.classify_regex(t, RULES.places), ["Town Council in Lusu", "TOWN ward", "Nalo constituency", "Town", "Lusux"]) == [
        "Lusu", "Town", "Nalo", None, None]
    assert column(C.classify_funding(t), ["(CDF)", "LGEF", "cdfs", "the World Bank", "Local Government Equalisation Fund"]) == [
        "CDF", "LGEF", None, "World Bank", "LGEF"]


def test_shortest_terms_decide_the_same():
    assert shortest_terms(["construction", "construct", "project", "projects"]) == ["construct", "project"]


def test_titles_and_dates(column):
    htmls = ['<h1 class="x entry-title"> </h1><title>B</title>', '<meta property="og:title" content="Share | Town Site">',
             "<title>News &ndash; Town Site</title>", "<p>x</p>"]
    assert column(X.extract_title(t, "Town Site"), htmls) == ["", "Share / Town Site", "News", ""]
    dates = ['<time class="a" datetime="2024-05-06T1">', "<p>Published on March 5, 2024</p>", "published Sept 7 2023",
             "<p>Published on Smarch 5, 2024</p>", '<time datetime="2024-02-30">', "none"]
    day = datetime.date
    assert column(X.extract_date(t), dates) == [day(2024, 5, 6), day(2024, 3, 5), day(2023, 9, 7), None, None, None]
    assert column(X.extract_contact_title(t, F.lit("http://f"), "Town Site"), ["<title>Contact Us – Town Site, home</title>", "x"]) == [
        "Contact Us", "http://f"]


def test_paragraphs_and_fallback(spark):
    html = "<main><p>short</p><P class=a>This paragraph is long enough &amp; kept.</P></main>"
    rows = P.paragraphs(pages(spark, html, "<body>only &lt;text&gt;</body>", "<body></body>")).orderBy("url", "pos").collect()
    assert [r.paragraph for r in rows] == ["This paragraph is long enough & kept.", "only <text>"]


def test_links_resolve_like_the_standard(spark):
    bases = ["http://a.b/c/d/e?x=1", "https://a.b", "https://a.b/", "http://a.b/c/", "http://a.b/c//d/f.html"]
    hrefs = ["/x", "x", "x/y", "../x", "../../../../x", "./x", "..", ".", "/a/../b", "/a/./b/", "//h.k/p?q=1", "?p=5", "", "http://z/q",
             "mailto:a@b", "https:/x", "http:x", "/x//y", "x//y/", "a/..", "/a/b/..", "x?y=../z", "HTTP://Z/a"]
    rows = [(b, h, urljoin(b, h)) for b in bases for h in hrefs]
    frame = spark.createDataFrame(rows, "b string, h string, e string")
    assert frame.filter(~F.col("e").eqNullSafe(X.resolve_url(F.col("b"), F.col("h")))).collect() == []


def test_article_links(spark):
    html = '<a href="/2024/out">o</a><article><a class="x" href="/2024/a">a</a><a href="#top">t</a><a href="/2024/a">again</a><a href="https://else.org/2024/b">b</a><a href="?p=7&amp;x=1">p</a></article>'
    rows = P.extract_links(pages(spark, html)).orderBy("pos").collect()
    assert [(r.pos, r.target) for r in rows] == [(0, f"{SITE}/2024/a"), (1, f"{SITE}/?p=7&x=1")]


def test_contact_links(spark):
    html = '<a href="/about">Who <b>We</b> Are</a><a href="/x">News</a><a href="/contact#map">here</a><a href="https://else.org/staff">Staff</a>'
    rows = P.contact_links(pages(spark, html)).orderBy("pos").collect()
    assert [r.target for r in rows] == [f"{SITE}/about", f"{SITE}/contact#map"]


def test_links_of_a_page_saved_twice_are_one_list(spark):
    rows = [(f"{SITE}/", '<a href="/2024/a">a</a><a href="/2024/c">c</a>'), (f"{SITE}/x", '<a href="/2024/a">a</a>'),
            (f"{SITE}/", '<a href="/2024/b">b</a><a href="/2024/a">a</a><a href="/t">t</a><a href="/2024/d">d</a>')]
    frame = spark.createDataFrame(rows, "url string, html string")
    found = sorted((r.url, r.pos, r.target) for r in P.extract_links(frame).collect())
    assert found == [(f"{SITE}/", i, f"{SITE}/2024/{c}") for i, c in enumerate("abcd")] + [(f"{SITE}/x", 0, f"{SITE}/2024/a")]
    menu = P.contact_links(frame, menu=("a", "b"))
    assert sorted((r.url, r.target) for r in menu.collect()) == [
        (f"{SITE}/", f"{SITE}/2024/a"), (f"{SITE}/", f"{SITE}/2024/b"), (f"{SITE}/x", f"{SITE}/2024/a")]


def test_urls(column):
    urls = ["https://www.Town.example.org/x", "http://town.example.org:80/", "ftp://town.example.org", "https://town.example.org/a b"]
    assert column(X.same_site(t, F.lit(SITE)), urls) == [True, False, False, True]
    assert column(X.url_token(t), ["https://t/a/b-c d/?x=1", "https://t/?p=12", "https://t", "https://t/?p=&q"]) == [
        "post_b-c_d.html", "post_12.html", "post_home.html", "post_home.html"]
    assert column(C.looks_like_record_url(t, ("cdf",)), ["https://t/?p=1", "https://t/2024/x", "https://t/tag/cdf", "https://t/CDF-x", "https://t/x"]) == [
        True, True, False, True, False]


def test_names_and_descriptions(spark):
    long_unit = "Officials said construction of " + "a very long thing " * 9 + "tail end here and more words follow"
    frame = spark.createDataFrame([("u; provision of desks. More", "T" * 200, True), (long_unit, "T", True), ("x", "T" * 200, False), ("x y.z", "", False)],
                                  "u string, t string, m boolean")
    names = [r[0] for r in frame.select(X.make_name(F.col("u"), F.col("t"), F.col("m"))).collect()]
    assert names[0] == "provision of desks" and names[2] == "T" * 180 and names[3] == "x y"
    assert names[1].endswith("...") and len(names[1]) <= 180 and not names[1][:-3].endswith(" ")


def test_description(column):
    assert column(X.make_description(t), ["One. Two! Three?", "x" * 700, "No end"]) == ["One. Two!", "x" * 600, "No end"]


def test_contacts(spark):
    text = ("Physical Address: Plot 5, Main Road, Town. Phone 0978080795 or 097\u00a0808-0795, 0978080795, +260 097 712 3456"
            " a@b.co A.b+c@d-e.org a@b.co")
    frame = spark.createDataFrame([(text, "p", "u"), ("nothing", "p", "v")], "text string, source_page string, source_url string")
    row, = P.extract_contacts(frame).collect()
    assert (row.email, row.office_address) == ("a@b.co; A.b+c@d-e.org", "Plot 5, Main Road, Town")
    assert row.phone == "0978080795; 097 808-0795; +260 097 712 3456"
    assert (row.name, row.source_page, row.source_url) == (None, "p", "u")


def test_adjacent_emails_match_like_python(column):
    import re
    pattern = re.compile(r"[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}")
    texts = ["a@b.com_x@d.org", "x@@y.com", "a@b.cc@d.ee", "é.ü@ß.de,", "a@b", "mail:a@b.c1.co-d", "@a.bc a@.bc"]
    got = column(F.array_join(X.extract_emails(t), ";"), texts)
    assert got == [";".join(dict.fromkeys(pattern.findall(x))) for x in texts]


def test_phone_cells(column):
    assert column(V.normalize_phone(t), ["Tel 0978\t080795 or +260 (977) 123456", "none", None, "12 34"]) == [
        "0978 080795; +260 (977) 123456", "none", "", "12 34"]
