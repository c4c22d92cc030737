import pytest
from pyspark.sql import functions as F

from scholarweave import schemas
from scholarweave.functions import biblio
from scholarweave.operators import match
from scholarweave.plans import records
from scholarweave.sources.payloads import first_per_key, parse_json, parse_xml

ARTICLE = """<?xml version="1.0"?><pmc-articleset><article article-type="report"><front>
<journal-meta><journal-title-group><journal-title>Journal</journal-title></journal-title-group></journal-meta>
<article-meta><title-group><article-title>{title}</article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Lee</surname><given-names>Ann</given-names></name><aff> Uni </aff></contrib></contrib-group>
<pub-date date-type="pub"><year>2001</year><month>05</month></pub-date><volume>1</volume><issue>2</issue><fpage>3</fpage>
<abstract><p>{abstract}</p></abstract></article-meta></front>
<back><ref-list><ref><article-title>Census Bureau history</article-title></ref></ref-list></back></article></pmc-articleset>"""


def articles(spark, *bodies):
    landed = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    return {r.ProjID: r for r in records.article_records(landed, "n").collect()}


def test_malformed_xml_is_dropped_and_the_job_goes_on(spark):
    good = ARTICLE.format(title="Census Bureau wages", abstract="x")
    assert set(articles(spark, "<article><front>", good, None, "text")) == {"1"}


def test_unrelated_article_is_dropped(spark):
    body = ARTICLE.format(title="Plankton at low tide", abstract="Samples were taken along the coast.")
    assert articles(spark, body) == {}  # a cited title does not count


def test_article_fields(spark):
    row = articles(spark, ARTICLE.format(title="On <i>FSRDC</i> data", abstract="y"))["0"]
    assert (row.OutputTitle, row.ProjectTitle) == ("On FSRDC data", "On FSRDC data")
    assert (row.ProjectPI, row.ProjectRDC, row.OutputType) == ("Ann Lee", "Uni", "RE")
    assert row.OutputBiblio == "Journal, Vol 1, Iss 2, pp. 3"
    assert (row.OutputYear, row.OutputMonth, row.OutputPages) == ("2001", "05", "3")
    assert list(row.asDict()) == schemas.OUTPUT_COLUMNS


FORMS = {
    "sections": ("<abstract><p>x</p></abstract>", "<abstract><sec><title>A</title><p>one</p><sec><p>Census Bureau data</p></sec></sec><sec><p>two</p></sec></abstract>"),
    "fifth level": ("<abstract><p>x</p></abstract>", "<abstract>" + "<sec>" * 5 + "<p>Census Bureau data</p>" + "</sec>" * 5 + "</abstract>"),
    "list": ("<abstract><p>x</p></abstract>", "<abstract><list><list-item><p>of <i>Census</i> Bureau</p></list-item></list></abstract>"),
    "box": ("<abstract><p>x</p></abstract>", "<abstract id='a>b'><boxed-text><p id=\"1\">Census &#66;ureau</p><p/></boxed-text></abstract>"),
    "quotation": ("<abstract><p>x</p></abstract>", "<abstract><p>Said: <disp-quote><p>Census Bureau</p></disp-quote> so</p></abstract>"),
    "comment": ("<abstract><p>x</p></abstract>", "<!-- <abstract> --><abstract><p>Census <!-- no --><?x y?>Bureau</p></abstract>"),
    "two abstracts": ("<abstract><p>x</p></abstract>", "<abstract><p>Census Bureau data</p></abstract><abstract><p>short</p></abstract>"),
    "two groups": ("<contrib-group>", "<contrib-group><contrib contrib-type=\"editor\"><name><surname>Ed</surname></name></contrib></contrib-group><contrib-group>"),
    "two articles": ("</article></pmc-articleset>", "</article><article><front><article-meta><title-group><article-title>Other</article-title></title-group></article-meta></front></article></pmc-articleset>"),
    "label": ("<aff> Uni </aff>", "<aff><label>1</label>Univ <i>X</i></aff><aff>Second</aff>"),
    "escapes": ("On FSRDC data", "On FSRDC p &lt;x and y&gt; <b>z</b> &amp;lt; &amp; w"),
}


@pytest.mark.parametrize("form", FORMS)
def test_article_forms(spark, form):
    plain = form in ("sections", "fifth level", "list", "box", "quotation", "comment")
    body = ARTICLE.format(title="Wages" if plain else "On FSRDC data", abstract="x")
    assert FORMS[form][0] in body
    row = articles(spark, body.replace(*FORMS[form]))["0"]
    assert row.ProjectPI == "Ann Lee"
    assert row.ProjectRDC == ("Univ X" if form == "label" else "Uni")
    titles = {"escapes": "On FSRDC p <x and y> z &lt; & w"}
    assert row.OutputTitle == titles.get(form, "Wages" if plain else "On FSRDC data")


ABSTRACTS = {
    "<abstract><p>a</p><p>b</p></abstract>": "a b",
    "<abstract><sec><title>Aim</title><p>a <i>b</i>c</p></sec></abstract><abstract><p>d</p></abstract>": "a bc d",
    "<abstract>out<p>a<list><list-item><p>b</p></list-item></list>c</p>out</abstract><p>out</p>": "a b c",
    "<abstract><p>&amp;lt; &#233; &lt;i&gt;</p></abstract>": "&lt; \u00e9 <i>",
    "<abstract><pre>out</pre><p title='x>y'>a</p><p/><p a='1'/></abstract>": "a",
    "<abstract/><abstract></abstract>": None, "<abstract>out</abstract>": None, "<other><p>a</p></other>": None,
    "<abstract>" + "<sec>" * 40 + "<p>deep</p>" + "</sec>" * 40 + "</abstract>": "deep",
    "<abstract>" + "<p>many</p>" * 5000 + "</abstract>": " ".join(["many"] * 5000),
}


def test_paragraphs_at_any_depth(spark):
    rows = spark.createDataFrame(list(enumerate(ABSTRACTS)), "n int, body string")
    text = biblio.paragraphs_below(biblio.guarded("body"), "abstract")
    found = {r.n: r.t or None for r in rows.select("n", text.alias("t")).collect()}
    assert [found[n] for n in range(len(ABSTRACTS))] == list(ABSTRACTS.values())


def test_a_usable_answer_goes_first(spark):
    body = '{"id": "W1"}'
    rows = [
        ("a", 200, None), ("A", 200, body), ("b", 404, None), ("b", 200, "{cut"), ("c", 200, "{cut"), ("d", 200, "{}"),
        ("e", 503, None), ("f", None, None), ("g", 200, ""), ("h", 200, "{}"), ("h", 200, body), ("i", 500, body), ("i", 404, None),
    ]
    landed = spark.createDataFrame([(k, "s", c, b, None) for k, c, b in rows], schemas.LANDED_PAYLOAD)
    keys = spark.createDataFrame([(k,) for k in "abcdefghix"], "doi string")
    found = match.lookup_doi(keys, landed, "doi", parse_json("body", "id string")["id"]).collect()
    assert {r.doi: (r.status, r.external_id) for r in found} == {
        "a": ("Found", "W1"), "b": ("Not Found", None), "c": ("Exception", None), "d": ("Not Found", None),
        "e": ("Error 503", None), "f": ("Exception", None), "g": ("Exception", None), "h": ("Found", "W1"),
        "i": ("Not Found", None), "x": (None, None),
    }


def test_the_message_with_the_fewest_gaps_is_attached(spark):
    bodies = ["{}", '{"volume": "3", "container-title": ["J"]}', '{"volume": "1"}', None]
    messages = spark.createDataFrame([("10.1/A", b) for b in bodies], "key string, body string").select(
        "key", parse_json("body", schemas.CROSSREF_MESSAGE).alias("msg")
    )
    records_ = spark.createDataFrame([(1, "10.1/a"), (2, None)], "id int, doi string")
    got = {r.id: (r.OutputVenue, r.OutputVolume) for r in match.attach_crossref(records_, messages, "doi", "id").collect()}
    assert got == {1: ("J", "3"), 2: (None, None)}


def test_a_body_is_parsed_once(spark):
    landed = spark.createDataFrame([(1, "x", "a")], "n int, external_id string, body string")
    plan = records.article_records(landed, "n")._jdf.queryExecution().executedPlan().toString()
    # The body, and the text of its abstract alone for the character references in it.
    assert plan.count("from_xml") == 2, plan
    plan = records.openalex_records(landed, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_search_result(spark):
    df = spark.createDataFrame(
        [("<r><Count>2</Count><IdList><Id>11</Id><Id>12</Id></IdList></r>",), ("<r><Count>0</Count><IdList/></r>",), ("<r>",)],
        "b string",
    )
    hits = df.select(biblio.search_hit(parse_xml("b", schemas.ESEARCH_RESULT)).alias("x")).collect()
    assert [r.x for r in hits] == ["11", None, None]


def test_one_response_per_key(spark):
    landed = spark.createDataFrame(
        [("K ", "s", 500, None, "e"), ("k", "s", 200, "b", None), ("k", "s", 200, "a", None), (" ", "s", 200, "z", None)],
        schemas.LANDED_PAYLOAD,
    )
    rows = first_per_key(landed).collect()
    assert [(r.lookup_key, r.code, r.body) for r in rows] == [("k", 200, "a")]


def test_latest_employment_takes_the_first_of_equal_years(spark):
    df = spark.sql(
        """SELECT from_json('[{"end-date":{"year":{"value":"2001"}},"organization":{"name":"A"}},
        {"end-date":{"year":{"value":"2005"}},"organization":{"name":"B"}},
        {"end-date":{"year":{"value":"2005"}},"organization":{"name":"C"}},{"organization":{"name":"D"}}]',
        'array<struct<`end-date`:struct<year:struct<value:string>>,organization:struct<name:string>>>') AS jobs"""
    )
    assert df.select(biblio.latest_employment(F.col("jobs"))).first()[0] == "B"
