import pytest
from pyspark.sql import functions as F

from trailkeep.operators.quality import GateError
from trailkeep.plans import clean as L
from trailkeep.plans.collect import build_reviewed, collect_contacts, collect_profile
from trailkeep.plans.discovery import discover_urls
from trailkeep.plans.full_run import Step, full_run
from trailkeep.plans.summary import master_summary
from trailkeep.sources.delimited import read_delimited, write_delimited
from trailkeep.rules import CONTACT_COLUMNS, PROFILE_COLUMNS, PROJECT_COLUMNS, SiteRules, census_templates

URL = "https://town.example.org/?p=1"


def projects(spark, *changes):
    base = dict(project_id="A-001", project_name="School", sector=" Education ", constituency=None, funding_source="CDF", funding_amount_zmw=None,
                status=None, date_reported="2026-01-01", description="<p>The school is not completed.</p>", source_url=URL)
    return spark.createDataFrame([tuple({**base, **c}[k] for k in PROJECT_COLUMNS) for c in changes], ", ".join(f"{c} string" for c in PROJECT_COLUMNS))


def test_distinct_projects_of_one_page_survive(spark):
    found = L.clean_projects(projects(spark, {}, {"project_id": "A-003"}, {"project_name": "Other school", "project_id": "A-002"}))
    rows = found.clean.orderBy("project_id").collect()
    assert [r.project_id for r in rows] == ["A-001", "A-002"]
    assert found.details["duplicates_removed"] == 1 and found.details["repeated_url_rows"] == 2
    assert all(r.funding_amount_zmw is None and r.status == "unspecified" and r.sector == "education" for r in rows)
    assert rows[0].description_clean == "school not completed" and rows[0].description == "<p>The school is not completed.</p>"
    assert found.clean.columns == [*PROJECT_COLUMNS, "description_clean"]
    again = L.clean_projects(found.clean)
    assert sorted(map(str, again.clean.collect())) == sorted(map(str, rows))


@pytest.mark.parametrize("change, rule", [
    ({"funding_amount_zmw": "bad amount"}, "amount is a number"), ({"funding_amount_zmw": "-5"}, "amount is positive"),
    ({"date_reported": "2026-02-30"}, "date is a date"), ({"status": "open"}, "known status"), ({"sector": None}, "known sector"),
    ({"source_url": None}, "source is named"),
])
def test_bad_cells_stop_the_run(spark, change, rule):
    with pytest.raises(GateError, match=rule):
        L.clean_projects(projects(spark, {}, {"project_id": "A-002", **change}))


def test_same_page_variants_are_reported(spark):
    found = L.clean_projects(projects(spark, {}, {"project_id": "A-002", "description": "other"}))
    assert found.clean.count() == 2 and found.review.count() == 2 and found.details["near_duplicate_rows"] == 2


def test_post_variants_are_flagged_not_deleted(spark):
    posts = spark.createDataFrame([("News", "2026-01-01", b, URL) for b in ("First text", "Second text", "First text")], "title string, date string, body_text string, url string")
    found = L.clean_posts(posts)
    assert found.clean.count() == 2 and found.review.count() == 2 and found.details["duplicates_removed"] == 1


def test_outliers_block_every_export(spark, tmp_path):
    many = [{"project_id": f"A-{i:03d}", "project_name": f"P{i}", "funding_amount_zmw": str(1000 + i)} for i in range(20)]
    good = L.clean_projects(projects(spark, *many))
    odd = L.clean_projects(projects(spark, *many, {"project_id": "A-100", "funding_amount_zmw": "9e9"}))
    assert [r.project_id for r in odd.flagged.collect()] == ["A-100"]
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    with pytest.raises(GateError):
        L.publish({first: good, second: odd})
    assert not (tmp_path / "one").exists()
    assert L.publish({first: good}) == {first: True} and L.publish({first: good}) == {first: False}


def contacts(spark, *changes):
    base = dict(record_id="C-1", name=None, role_title=None, department="", phone=" 0978\t080795 ", email="Info@Town.ORG", office_address=None,
                source_page="Contact &ndash; Us", source_url="https://t.org/c")
    return spark.createDataFrame([tuple({**base, **c}[k] for k in CONTACT_COLUMNS) for c in changes], ", ".join(f"{c} string" for c in CONTACT_COLUMNS))


def test_contact_modes_differ_on_shared_pages(spark):
    frame = contacts(spark, {}, {"record_id": "C-2", "email": "b@t.org"}, {"record_id": "C-3", "source_url": " "})
    lenient = L.clean_contacts(frame, "script")
    row, = lenient.clean.collect()
    assert (row.record_id, row.phone, row.email, row.source_page, row.name) == ("C-1", "0978 080795", "info@town.org", "Contact – Us", "")
    assert lenient.details["removed_for_duplicate_url"] == 1 and lenient.details["removed_for_missing_url"] == 1 and lenient.details["blank name"] == 1
    with pytest.raises(GateError, match="one content per source_url"):
        L.clean_contacts(frame, "strict")


def test_strict_contacts(spark):
    row, = L.clean_contacts(contacts(spark, {}, {"record_id": "C-9"}), "strict").clean.collect()
    assert (row.record_id, row.department, row.phone, row.email) == ("C-1", None, "0978 080795", "info@town.org")
    for change, rule in (({"email": "x y@z"}, "e-mail"), ({"source_url": None}, "web address"), ({"record_id": None}, "id is present")):
        with pytest.raises(GateError, match=rule):
            L.clean_contacts(contacts(spark, change), "strict")
    with pytest.raises(GateError, match="office"):
        L.clean_contacts(contacts(spark, {}).drop("office_address"), "script")


def observations(spark, *changes):
    base = dict.fromkeys(PROFILE_COLUMNS) | dict(record_id="D-1", level=" District ", name="Lenda", population="66725.0", population_year="2010",
                                                  population_male="32186", population_female="34539", area_km2="5245.5", notes="Rate of 2.9%", source_url="https://t.org/w")
    return spark.createDataFrame([tuple({**base, **c}[k] for k in PROFILE_COLUMNS) for c in changes], ", ".join(f"{c} string" for c in PROFILE_COLUMNS))


LATER = {"record_id": "D-2", "population": "98533", "population_year": "2018", "population_male": None, "population_female": None}


def test_strict_profile(spark):
    rows = L.clean_profile(observations(spark, {}, {"record_id": "D-3"}, LATER)).clean.orderBy("record_id").collect()
    assert [(r.record_id, r.level, r.population, r.population_year, r.area_km2) for r in rows] == [
        ("D-1", "district", 66725, 2010, 5245.5), ("D-2", "district", 98533, 2018, 5245.5)]


@pytest.mark.parametrize("change, rule", [
    ({"population": "many"}, "population is a number"), ({"households": "-1"}, "households is not negative"), ({"households": "1.5"}, "households is whole"),
    ({"population_year": None}, "year"), ({"level": "town"}, "known level"), ({"population_male": "1"}, "sexes"), ({"source_url": "t.org"}, "web address"),
])
def test_strict_profile_gates(spark, change, rule):
    with pytest.raises(GateError, match=rule):
        L.clean_profile(observations(spark, change))


def test_conflicting_observations_stop_strict_and_not_lax(spark):
    frame = observations(spark, {}, {"record_id": "D-2", "notes": "other"})
    with pytest.raises(GateError, match="one observation"):
        L.clean_profile(frame)
    lax = L.clean_profile(frame, "lax")
    row, = lax.clean.collect()
    assert (row.record_id, row.notes_clean, row.level, row.population) == ("D-1", "rate 29", "district", 66725.0)
    assert lax.details["duplicates_removed"] == 1 and lax.clean.columns[-1] == "notes_clean"


def test_strict_profile_stops_on_fences(spark):
    rows = [{"record_id": f"D-{i}", "name": f"N{i}", "households": str(100 + i)} for i in range(10)]
    with pytest.raises(GateError, match="outliers: 1 failing, such as D-99"):
        L.clean_profile(observations(spark, *rows, {"record_id": "D-99", "households": "9000"}))


def test_review_build(spark):
    posts = spark.createDataFrame([(7, "2024-02-01", "https://t/?p=7"), (8, "2024-01-01", "https://t/?p=8")], "id int, date string, link string").withColumn("date", F.col("date").cast("date"))
    decisions = spark.createDataFrame([(7, "B", "health", None, 5.0, "planned", "s"), (7, "A", "health", "X", None, None, "s"), (8, "Z", "other", None, None, None, "t")],
                                      "post_id int, name string, sector string, place string, amount double, status string, summary string")
    rows = build_reviewed(decisions, posts).orderBy("project_id").collect()
    assert [(r.project_id, r.project_name, r.funding_source, str(r.date_reported)) for r in rows] == [
        ("REC-001", "Z", "CDF", "2024-01-01"), ("REC-002", "A", "CDF", "2024-02-01"), ("REC-003", "B", "CDF", "2024-02-01")]


def test_contacts_of_pages_and_hand(spark):
    pages = spark.createDataFrame([(1, "https://t/1", "<title>Contact Us – Town</title>info@t.org"), (2, "https://t/2", "<p>none</p>"), (3, "https://t/3", "0978080795")], "page_id int, url string, html string")
    manual = spark.createDataFrame([(1, "https://t/1", "info@t.org", "Ms A"), (2, "https://h", None, "Mr B")], "page_id int, source_url string, email string, name string")
    rows = collect_contacts(pages, manual, site_name="Town").orderBy("record_id").collect()
    assert [(r.record_id, r.source_url, r.name, r.source_page) for r in rows] == [
        ("REC-001", "https://t/1", "Ms A", None), ("REC-002", "https://t/3", None, "https://t/3"), ("REC-003", "https://h", "Mr B", None)]


def test_profile_of_pages(spark):
    text = ("2010 Census by the Central Statistical Office (CSO), Lenda District had 13,284 households and a population of 66,725, consisting of 32,186 males and 34,539 females. "
            "A growth rate of 2.9% lets it rise to approximately 98,533 by 2018. Total land area of 5,245 square kilometres; Novia&#39;s Southern Province; boundaries with Kalo and Choma.")
    pages = spark.createDataFrame([(1, "https://t/w", f"<p>{text}</p>"), (2, "https://t/c", "Nalo accounts")], "page_id int, url string, html string")
    rows = collect_profile(pages, census_templates("Lenda"), "Lenda", "Novia", ["Kalo", "Sina", "Choma"], {"Nalo": {"level": "constituency", "name": "Nalo"}},
                           "; added", "https://wiki").orderBy("record_id").collect()
    assert [(r.level, r.population, r.population_year, r.households) for r in rows] == [("district", 66725, 2010, 13284), ("district", 98533, 2018, None), ("constituency", None, None, None)]
    assert rows[0].notes.endswith("reported as 2.9%") and rows[1].notes.endswith("count; added") and rows[1].secondary_source_url == "https://wiki"
    assert (rows[0].area_km2, rows[0].neighboring_districts, rows[2].source_url) == (5245.0, "Kalo;Choma", "https://t/c")


def test_master_summary(spark):
    frame = spark.createDataFrame([(float(i), "x") for i in range(10)] + [(500.0, "y"), (500.0, "y")], "v double, s string")
    rows = {r.table: r for r in master_summary({"a": (frame, ["v"]), "b": (frame, [])}).collect()}
    assert (rows["a"].duplicates_removed, rows["a"].outliers, rows["b"].outliers) == (1, 1, None)


def test_whole_run_replays_its_first_input(spark, tmp_path):
    many = [{"project_id": f"A-{i:03d}", "project_name": f"P{i}", "funding_amount_zmw": str(1000 + i)} for i in range(20)]
    folder, target = str(tmp_path / "run"), str(tmp_path / "out")
    first = full_run({"projects": Step(projects(spark, *many), L.clean_projects, target)}, folder)
    found = {(r.stage, r.metric): r.value for r in first.collect()}
    assert found["decision", "output_rows"] == "20" and found["after", "max funding_amount_zmw"] == "1019.0"
    assert {m for s, m in found if s == "fence"} == {"lower funding_amount_zmw", "upper funding_amount_zmw"}
    again = full_run({"projects": Step(projects(spark, *many[:3]), L.clean_projects, target)}, folder)
    repeated = {(r.stage, r.metric): r.value for r in again.collect()}
    assert {k: v for k, v in repeated.items() if k[0] != "drift"} == found
    assert repeated["drift", "preserved rows"] == "20" and repeated["drift", "now rows"] == "3"
    assert ("drift", "now contents project_name") in repeated and ("drift", "now contents status") in repeated
    assert not any("columns" in m or "type" in m for s, m in repeated if s == "drift")
    odd = projects(spark, *many, {"project_id": "A-100", "funding_amount_zmw": "9e9"})
    with pytest.raises(GateError):
        full_run({"a": Step(projects(spark, *many), L.clean_projects, str(tmp_path / "a")), "b": Step(odd, L.clean_projects, str(tmp_path / "b"))}, folder + "2")
    assert not (tmp_path / "a").exists() and not (tmp_path / "b").exists()


def test_discovery_falls_back_in_order(spark):
    rules = SiteRules("https://town.example.org", slug_words=("cdf",))
    links = lambda *urls: spark.createDataFrame([(u,) for u in urls], "url string")
    posts = spark.createDataFrame([("https://town.example.org/a", "CDF", "construction of a road"), ("https://town.example.org/b", "News", "none"),
                                   ("https://else.example.org/c", "CDF", "construction")], "link string, title string, body string")
    pages = spark.createDataFrame([("https://town.example.org/news", '<a href="/cdf-school">x</a>')], "url string, html string")
    read = lambda *a: sorted(tuple(r) for r in discover_urls(rules, *a).collect())
    site, nothing = links("https://town.example.org/cdf-map"), links("", None)
    seeds = links("https://town.example.org/a", "https://town.example.org/s", None, "https://else.example.org/")
    assert read(seeds, posts, site, pages) == [("https://town.example.org/a", "seed"), ("https://town.example.org/s", "seed")]
    assert read(None, posts, site, pages) == [("https://town.example.org/a", "post index")]
    assert read(nothing, posts.limit(0), site, pages) == [("https://town.example.org/cdf-map", "site map")]
    assert read(nothing, posts.limit(0), nothing, pages) == [("https://town.example.org/cdf-school", "listing")]
    assert read(nothing, None, None, None) == []


def test_discovery_passes_over_places_of_other_sites(spark):
    rules = SiteRules("https://town.example.org", slug_words=("cdf",))
    other = spark.createDataFrame([("https://else.example.org/x",)], "url string")
    site = spark.createDataFrame([("https://town.example.org/cdf-map",)], "url string")
    pages = spark.createDataFrame([("https://town.example.org/news", '<a href="/cdf-school">x</a>')], "url string, html string")
    read = lambda *a: [tuple(r) for r in discover_urls(rules, *a).collect()]
    assert read(other, None, site, pages) == [("https://town.example.org/cdf-map", "site map")]
    assert read(other, None, other, pages) == [("https://town.example.org/cdf-school", "listing")]


def test_bad_cells_of_a_file_reach_the_gate(spark, tmp_path):
    table = projects(spark, {"funding_amount_zmw": "bad amount"})
    write_delimited(table, str(tmp_path / "t"))
    with pytest.raises(GateError, match="amount is a number"):
        L.clean_projects(read_delimited(spark, str(tmp_path / "t"), table.schema, cast=False))
