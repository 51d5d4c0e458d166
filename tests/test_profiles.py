from __future__ import annotations

from tallyweave.functions.lexicon import Lexicon
from tallyweave.operators import html, profiles

PROFILE = """<html><head><title>x</title></head><body><h1 class="sr-only">Menu</h1><h2 class="name">Dr Jane Roe</h2><p class="job-title">Associate Professor</p>
<p class="department">Department of Things</p><a data-user="jane" data-domain="ex.edu" href="#">mail</a><img class="profile" src="/img/jane.jpg"><main><img src="/img/logo.png"></main>
<h3>Research Interests</h3><p>Graphs and joins.</p><p>Sorting.</p><h3>Education</h3><p>PhD</p><a href="https://jane.example.org/">Personal website</a><script>var x=1;</script></body></html>"""
CARDS = """<div class="person-card"><a href="/people/ann">Ann Lee</a><p>Lecturer</p><a href="mailto:ann@ex.edu">m</a></div>
<div class="person-card"><a href="/people/bob">Bob Rayner</a></div><div class="person-card"><a href="/people/bob">bob rayner</a></div>"""
JSON_CARDS = """<html><body><h1>Faculty</h1><script class="x fd-content-json">[
{"name": "Eve Stone", "search": "Eve Stone Professor", "departmentCode": "D1", "template": "&lt;div&gt;&lt;a href='/people/eve?a=1&amp;amp;b=2'&gt;&lt;/a&gt; Eve, Professor&lt;/div&gt;"},
{"name": "No Link", "search": "No Link Lecturer", "departmentCode": "D2", "template": "&lt;p&gt;x&lt;/p&gt;"}, {"name": "Faculty", "template": ""}, 7]</script>
<script class="fd-content-json">{broken</script></body></html>"""


def table(spark, html_text, url="https://ex.edu/people/jane", school=""):
    return spark.createDataFrame([(1, url, html_text, school)], "page_id long, url string, html string, school string")


def profile(spark, html_text, url="https://ex.edu/people/jane", school=""):
    rows = profiles.profiles(table(spark, html_text, url, school)).collect()
    assert len(rows) == 1
    return rows[0]


def many(spark, pages, url="https://ex.edu/people/jane"):
    """Profiles of several pages, in their order."""
    rows = spark.createDataFrame([(i, url, page, "") for i, page in enumerate(pages)], "page_id long, url string, html string, school string").coalesce(1)
    return sorted(profiles.profiles(rows).collect(), key=lambda r: r.page_id)


def cards(spark, html_text, url="https://ex.edu/people/"):
    return sorted(profiles.list_cards(table(spark, html_text, url)).collect(), key=lambda r: r.card)


def test_profile(spark):
    r = profile(spark, PROFILE, school="Ex")
    assert (r.name, r.title, r.department, r.email, r.school) == ("Dr Jane Roe", "Associate Professor", "Department of Things", "jane@ex.edu", "Ex")
    assert (r.research_interests, r.education) == ("Graphs and joins. Sorting.", "PhD Personal website")
    assert (r.personal_homepage, r.photo_url) == ("https://jane.example.org/", "https://ex.edu/img/jane.jpg")
    # name, title, e-mail, school, department, research, education, photo of ten
    assert (r.n_useful, float(r.confidence_score)) == (8, 0.8)
    assert float(profile(spark, PROFILE).confidence_score) == 0.7


def test_empty_pages(spark):
    rows = spark.createDataFrame([(1, "https://a.b/", None), (2, None, ""), (3, "https://a.b/", "<p>")], "page_id long, url string, html string")
    got = profiles.profiles(rows).collect()
    assert len(got) == 3 and all((r.name, r.email, r.n_useful, r.visible_chars) == ("", "", 0, 0) for r in got)
    assert profiles.profiles(rows.limit(0)).count() == profiles.list_cards(rows).count() == 0


SECTIONS = {
    "siblings of any tag": ("<h2>Biography</h2><div>Born <b>here</b>.</div><blockquote>Moved.</blockquote><h2>Teaching</h2><p>no</p>", "biography", "Born here . Moved."),
    "nested bodies count once": ("<h3>Biography</h3><ul><li><p>Born in X.</p></li><li>Then Y.</li></ul>", "biography", "Born in X. Then Y."),
    "a heading that is no stop goes on": ("<h3>Education</h3><p>PhD</p><h3>Hobbies</h3><p>Chess</p><h3>Awards</h3><p>no</p>", "education", "PhD Hobbies Chess"),
    "a stop among deeper elements ends nothing": ("<h3>Education</h3><div><h3>Contact</h3>A</div><p>B</p>", "education", "Contact A B"),
    "siblings of the link around a heading": ("<div><a href='#r'><h3>Research Interests</h3></a><div>Graphs.</div><p>Joins.</p></div>", "research_interests", "Graphs. Joins."),
    "own siblings before the link's": ("<a><h3>Education</h3><i>inner</i></a><p>outer</p>", "education", "inner"),
    "labels in their order": ("<h2>Research Areas</h2><p>second</p><h2>Teaching</h2><h2>Scholarly Interests</h2><p>first</p>", "research_interests", "first"),
    "the first heading that has a section": ("<div><h2>Education</h2></div><h2>Education</h2><p>PhD</p>", "education", "PhD"),
    "labels inside longer headings": ("<h4>My Selected Publications list</h4><p>A. B.</p>", "publications", "A. B."),
    "terms of a list": ("<dl><dt>Education</dt><dd>MSc</dd><dd>PhD</dd><dt>Advisor</dt><dd>Ann</dd></dl>", "education", "MSc PhD"),
    "bold words, only elements follow": ("<p><strong>Education</strong> loose <em>tight</em></p>", "education", "tight"),
    "cut at 1200": ("<h2>Biography</h2>" + "<p>abcdefghi</p>" * 200, "biography", ("abcdefghi " * 120)[:1200].strip()),
    "many short siblings": ("<h2>Biography</h2>" + "<i>a</i>" * 5000, "biography", ("a " * 600).strip()),
    "scripts and noscript are no text": ("<h2>Biography</h2><noscript><p>no</p></noscript><script>no</script><p>yes</p>", "biography", "yes"),
    "label and value in one element": ("<div><h3>Faculty Expertise</h3>: Queues and <i>Trees</i></div>", "research_interests", "Trees"),
    "label block without elements": ("<div><b>Faculty Expertise</b>: Queues</div><p>z</p>", "research_interests", "Queues"),
    "label block of an affiliation": ("<div><h4>Affiliation:</h4> Institute of Y </div>", "department", "Institute of Y"),
    "class before text": ("<p class='x-division'>Affiliation Unit Z</p><p>Department Q</p>", "department", "Unit Z"),
    "running text": ("<p>Department of Joins Contact: x</p>", "department", "of Joins"),
    "running text up to a stop word": ("<div>Biography: Born far away. Education: PhD, Somewhere. Advisor: Ann Lee. Contact room 5</div>", "biography", "Born far away."),
    "running education": ("<div>Biography: Born far away. Education: PhD, Somewhere. Advisor: Ann Lee. Contact room 5</div>", "education", "PhD, Somewhere. Advisor: Ann Lee."),
    "running advisor": ("<div>Biography: Born far away. Education: PhD, Somewhere. Advisor: Ann Lee. Contact room 5</div>", "advisor", "Ann Lee."),
}


def test_sections(spark):
    got = many(spark, [page for page, _, _ in SECTIONS.values()])
    assert {case: r[field] for (case, (_, field, _)), r in zip(SECTIONS.items(), got, strict=True)} == {case: want for case, (_, _, want) in SECTIONS.items()}


def test_research_sentences(spark):
    texts = ["We teach. Her research focuses on joins and sorts. Then lunch.", "Jo B. research examines sorts", "research", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(profiles.research_sentence("t").alias("s")).collect()
    assert [r.s for r in rows] == ["We teach. Her research focuses on joins and sorts", "Jo B. research examines sorts", "", ""]


NAMES = {
    "<title>Jo Black - Uni</title><h1>Faculty</h1>": "Jo Black",
    "<h1>Top</h1><main><h1>JO BLACK</h1></main>": "Jo Black",
    "<h1>Top</h1><p class='user-name'>jo black</p>": "Jo Black",
    "<p class='xname'>Later</p><p class='b name'>Sooner</p>": "Sooner",
    "<h2>Second</h2><h1 class='sr-only'>Menu</h1><h1>Other</h1>": "Second",
    "<h1>x</h1><h2>" + "y" * 81 + "</h2>": "",
    "<h1>Research centers here</h1>": "",
}
FAR = "<p class='title'>Dean</p><p>one</p><p>two</p>"
#: Of three titles the one next to the name wins.
TITLES = {
    f"{FAR}<h1>Jo</h1><p class='title'>Lecturer</p><div><p class='title'>Instructor</p></div>": "Lecturer",
    f"<p class='title'>Lecturer</p><h1>Jo</h1>{FAR}": "Lecturer",
    "<h1>Jo</h1><p class='title'>Dean</p><i>x</i><p class='position'>Chair</p><i>y</i><p class='job-title'>Lecturer of X</p>": "Lecturer of X",
    "<h1>Jo</h1><p class='title'>Her work</p><p>assistant professor of y</p>": "assistant professor",
}
PHOTOS = {
    "<img class='portrait' src='/real.jpg' data-src='/lazy.jpg'>": "https://ex.edu/real.jpg",
    "<img class='portrait' data-lazy-src='/l.jpg'>": "https://ex.edu/l.jpg",
    "<main><img srcset='/i/jo.jpg 2x, /i/big.jpg 3x'></main>": "https://ex.edu/i/jo.jpg",
    "<img src='/elsewhere.jpg'>": "",
    "<main><img src='/a.jpg'><img src='/b.jpg' alt='Picture of jo'></main>": "https://ex.edu/b.jpg",
    "<main><img src='/a.jpg' alt='jo'></main><img class='person' src='/c.jpg'><article><img src='/faculty/d.jpg' alt='JO B'></article>": "https://ex.edu/faculty/d.jpg",
    "<img class='profile' src='/site-logo.png'><img class='profile' src='http://EX.edu/x/?b=2&amp;a=1#top'>": "https://ex.edu/x/?a=1&b=2",
}
EMAILS = {
    "<p>a@b.edu</p><a href='mailto:c@d.edu?x=1'>m</a>": "c@d.edu",
    "<a href='mailto:c@d.edu'>m</a><i data-user='e' data-domain='f.edu'></i>": "e@f.edu",
    "<i data-user='e f' data-domain='g'></i><p>Write to H.I@J.EDU now</p>": "H.I@J.EDU",
}


def test_fields(spark):
    pages = [*NAMES, *TITLES, *(f"<h1>Jo Black</h1>{p}" for p in PHOTOS), *EMAILS, "<a href='/x'>About</a><a href='/~jo#me'>My Homepage</a><a href='/z'>website</a>"]
    got = iter(many(spark, pages))
    for cases, field in ((NAMES, "name"), (TITLES, "title"), (PHOTOS, "photo_url"), (EMAILS, "email")):
        assert {page: next(got)[field] for page in cases} == cases
    assert next(got).personal_homepage == "https://ex.edu/~jo"


def test_cards(spark):
    got = cards(spark, CARDS)
    assert [(r.name, r.url, r.email, r.title, float(r.confidence_score)) for r in got] == [("Ann Lee", "https://ex.edu/people/ann", "ann@ex.edu", "Lecturer", 0.33), ("Bob Rayner", "https://ex.edu/people/bob", "", "", 0.11)]
    deep = "<div class='faculty-grid'>" + "<div>" * 9 + "<ul><li><p><a href='/people/al'>AL BO</a> Lecturer</p></li><li>no link here</li></ul>" + "</div>" * 10
    # the grid is a card too, with the same link and name
    assert [(r.name, r.url) for r in cards(spark, deep)] == [("Al Bo", "https://ex.edu/people/al")]


def test_fields_of_cards(spark):
    card = """<li><a href="/news">News of today</a><a href="/people/cy">Cy Dee</a> <a href="/bio/x">Other</a> | Professor, Department of Applied Joins | Research Areas: trees Education: PhD
    <img class="portrait" src="/cy.jpg" alt="cy"><a href="mailto:cy@ex.edu">write</a></li>"""
    (r,) = cards(spark, card)
    assert (r.name, r.url, r.title, r.department, r.email) == ("Cy Dee", "https://ex.edu/people/cy", "Professor", "Department of Applied Joins", "cy@ex.edu")
    assert (r.research_interests, r.education, r.photo_url) == ("trees", "PhD write", "https://ex.edu/cy.jpg")
    assert float(r.confidence_score) == 0.78
    (r,) = cards(spark, "<article><h3>Di Eff</h3> writes to di@ex.edu</article>")
    assert (r.name, r.url, r.email) == ("Di Eff", "https://ex.edu/people/", "di@ex.edu")
    (r,) = cards(spark, "<li>Gil Hay, Lecturer in trees</li><li>nobody at all here</li><li>short</li>")
    assert (r.name, r.title) == ("Gil Hay", "Lecturer")


def test_json_cards(spark):
    got = cards(spark, JSON_CARDS)
    assert [(r.name, r.url, r.title, r.department, float(r.confidence_score)) for r in got] == [
        ("Eve", "https://ex.edu/people/", "Professor", "", 0.22),
        ("No Link", "https://ex.edu/people/", "Lecturer", "D2", 0.33),
    ]


def test_escalation_and_probable_profiles(spark):
    told = "<h1>Jo</h1><p class='title'>Dean</p><p>jo@ex.edu</p><p>postdoctoral</p>"
    unit = told + "<p class='unit-department'>D</p>"
    cases = [
        ("", 4, False), ("<p>hello</p>", 4, False), ("<p>Professor of Things</p>", 0, False), (told, 1, False), (told.replace("postdoctoral", ""), 3, False),
        ("<script>" + "x" * 6000 + "</script>", 2, False), (unit + "<h3>Biography</h3><p>b</p>", 3, True), (unit, 1, False),
    ]
    rows = spark.createDataFrame([(i, "https://ex.edu/x", page, "") for i, (page, _, _) in enumerate(cases)] + [(99, "https://ex.edu/people/jo", unit, "")], "page_id long, url string, html string, school string")
    got = {r.page_id: r for r in profiles.profiles(rows).select("page_id", profiles.needs_escalation().alias("e"), profiles.is_probable_profile().alias("p")).collect()}
    assert [(got[i].e.reason, got[i].e.needed, got[i].p) for i in range(len(cases))] == [(profiles.REASONS[k], k != 4, p) for _, k, p in cases]
    assert got[99].p is True
    marked, issues = profiles.mark_escalations(table(spark, told).unionByName(table(spark, "").selectExpr("2L AS page_id", "url", "html", "school")))
    assert {r.page_id: r.llm_status for r in marked.collect()} == {1: "needs_llm", 2: "not_needed"}
    assert [(r.related_id, r.issue_type, r.message) for r in issues.collect()] == [(1, "llm_used", f"Page marked for future LLM extraction: {profiles.REASONS[1]}")]


def test_extraction_job(spark):
    schema = "page_id long, url string, html string, page_type string, parser_status string, school string, seq long"
    rows = [
        (1, "https://ex.edu/people/", CARDS, "faculty_list", "pending", "Ex", 1),
        (2, "https://ex.edu/people/jane", PROFILE, "faculty_candidate", "pending", "Ex", 2),
        (3, "https://ex.edu/list", "<p>nothing</p>", "faculty_list", "", "Ex", 3),
        (4, "https://ex.edu/team", CARDS, "faculty_candidate", None, "Ex", 4),
        (5, "https://ex.edu/people/jim", PROFILE, "faculty_list", "skipped", "Ex", 5),
        (6, "https://ex.edu/done", PROFILE, "faculty_candidate", "parsed", "Ex", 6),
        (7, "https://ex.edu/other", PROFILE, "noise", "pending", "Ex", 7),
        (8, "https://ex.edu/none", None, "faculty_list", "pending", "Ex", 8),
    ]
    pages = spark.createDataFrame(rows, schema)
    lexicon = Lexicon({"a": ["graphs"]}, strong=["graphs"])
    people, issues, after = profiles.extract_profiles(pages, lexicon)
    assert sorted((r.page_id, r.name) for r in people.collect()) == [(1, "Ann Lee"), (1, "Bob Rayner"), (2, "Dr Jane Roe"), (4, "Ann Lee"), (4, "Bob Rayner"), (5, "Dr Jane Roe")]
    assert {r.page_id: r.parser_status for r in after.collect()} == {1: "parsed", 2: "parsed", 3: "no_profile", 4: "parsed", 5: "parsed", 6: "parsed", 7: "pending", 8: "pending"}
    raised = sorted((r.page_id, r.issue_type) for r in issues.collect())
    assert raised == [(1, "low_confidence"), (1, "low_confidence"), (2, "discipline_uncertain"), (4, "low_confidence"), (4, "low_confidence"), (5, "discipline_uncertain")]
    assert {r.review_status for r in people.collect()} == {"needs_review"}
    assert after.columns == pages.columns
    from pyspark.sql import functions as F

    rule = F.when(F.col("name").startswith("Bob"), 0.6).when(F.col("name").startswith("Ann"), 0.9).otherwise(0.1).cast("decimal(9,4)")
    people, issues, after = profiles.extract_profiles(pages, lexicon, rule, least=0.45)
    assert sorted((r.page_id, r.name, r.review_status) for r in people.collect()) == [(p, n, "needs_review") for p in (1, 4) for n in ("Ann Lee", "Bob Rayner")]
    assert {r.page_id: r.parser_status for r in after.collect()} == {1: "parsed", 2: "skipped_name", 3: "no_profile", 4: "parsed", 5: "skipped_name", 6: "parsed", 7: "pending", 8: "pending"}
    assert sorted({r.issue_type for r in issues.collect()}) == ["low_confidence", "name_filter_uncertain"]
    few, _, after = profiles.extract_profiles(pages, lexicon, limit=1)
    assert few.count() == 2 and [r.page_id for r in after.filter("parser_status = 'parsed'").collect()] == [1, 6]


def test_element_rows(spark):
    page = "<main a=1 a=2><p>One<br>two<p>three</main></b><noscript><p>no</p></noscript><script>s</script>four"
    rows = {r.pos: r for r in html.elements(table(spark, page)).collect()}
    assert rows[-1].text == "One two three four" and rows[-1].attrs == {"script_chars": "1"}
    assert [(rows[k].tag, rows[k].parent, rows[k]["last"], rows[k].text) for k in (0, 1, 2, 3)] == [("main", -1, 3, "One two three"), ("p", 0, 3, "One two three"), ("br", 1, 2, ""), ("p", 1, 3, "three")]
    assert rows[0].attrs == {"a": "2"} and rows[3].inside == ["main"] and {r.tag for r in rows.values()} == {"page", "main", "p", "br"}
    links = html.elements(table(spark, "<noscript><a href='/x'>X</a></noscript>"), frozenset({"a"})).collect()
    assert [(r.tag, r.text) for r in links] == [("a", "X")]
