import re
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from scholarweave import vocabulary as V
from scholarweave.functions import biblio, predicates, text


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("x")).first()["x"]


def many(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("sentence", "expected"),
    [
        ("Wages were linked at the Census Bureau, inside an FSRDC.", True),
        ("Plankton drifts with the tide along the coast.", False),
        ("the FIRST result", True),  # "irs" inside a word counts
        (None, False),
    ],
)
def test_relatedness(spark, sentence, expected):
    assert one(spark, sentence, predicates.is_related) is expected


def test_whole_word_option(spark):
    found = many(spark, ["first", "the IRS said", "beach", "BEA."], lambda c: predicates.is_related(c, True))
    assert found == [False, True, False, True]


def test_strip_covers_unicode_white_space(spark):
    samples = ["   a b　", "\t\n x \r", " ", "", " y "]
    assert many(spark, samples, text.strip) == [s.strip() for s in samples]


def test_clean_year(spark):
    values = ["1999", " 1999 ", "1999.7", "1e3", "-5", "nan", "inf", "abc", "", None, "12d", "0x1p3", "-0.5"]
    expected = ["1999", "1999", "1999", "1000", None, None, None, None, None, None, None, None, "0"]
    assert many(spark, values, text.clean_year) == expected


def test_first_author(spark):
    values = ["Smith, John; Doe", "Ann Lee;Bo", " ;x", "", None, "Solo"]
    assert many(spark, values, text.first_author) == ["Smith", "Ann", None, None, None, "Solo"]


def test_doi_encoding_matches_percent_quoting(spark):
    values = ["10.1/a b", "10.1/~*+(x)", "10.1/é<>;", "a_b.c-d"]
    assert many(spark, values, text.encode_doi) == [quote(v, safe="") for v in values]


TITLE_CASES = [
    "Wage growth using census data", "FSRDC: Firm entry based on LBD", "Reusing plants", "using x",
    "A: B analysis of C", "Études économiques study", "No stop word here", "colon: at end", "x",
    "The FSRDC: labour markets", "!!!", "FSRDC study", "analysis of a study", "a.b.c using d", "résumé-writing Research",
    "study: of things", "12 34 based", "under_score using",
]


def test_project_title_matches_a_plain_left_to_right_search(spark):
    stop = "using|based|analysis|study|research|$"
    search = re.compile(rf"(FSRDC:?\s*)?([\w\s-]+?)(?:{stop})", re.IGNORECASE)
    expected = []
    for title in TITLE_CASES:
        hit = search.search(title)
        expected.append(hit.group(2).strip() if hit else title[:100])
    assert many(spark, TITLE_CASES, text.project_title) == expected


def test_citation_patterns(spark):
    def fields(c):
        return [tuple(x) for x in many(spark, [c], biblio.citation_compact)][0]

    assert fields("J. 12(3), 45-67") == ("12", "3", "45-67")
    assert fields("nothing") == (None, None, None)
    dated = many(spark, ["Environ. Sci. 2023, 57 (15), 5746-5753", "20235 (1), 7"], biblio.citation_dated)
    assert tuple(dated[0]) == ("57", "15", "5746-5753")
    assert tuple(dated[1]) == ("5", "1", "7")
    labelled = many(spark, ["Vol. 4, No. 2, pp. 10–20", "volume 9 issue 3"], biblio.citation_labelled)
    assert tuple(labelled[0]) == ("4", "2", "10–20")
    assert tuple(labelled[1])[:2] == ("9", "3")


def test_pages(spark):
    rows = [("1", "9"), ("1", ""), ("", "9"), (None, None), ("1", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f string, l string")
    got = df.select("i", biblio.page_range("f", "l").alias("a"), biblio.page_range_either("f", "l").alias("b"))
    assert [(r.a, r.b) for r in got.orderBy("i").collect()] == [
        ("1-9", "1-9"), ("1", "1"), (None, "9"), (None, None), ("1", "1"),
    ]


@pytest.mark.parametrize(("as_of", "status"), [(1990, "Planned"), (2001, "Active"), (2010, "Completed")])
def test_status_depends_on_the_given_year(spark, as_of, status):
    assert one(spark, "2000", lambda c: biblio.project_status(c, biblio.end_year(c), as_of)) == status


def test_first_centre_in_the_list_wins(spark):
    values = ["Texas and Michigan", "boston", "Elsewhere", None]
    assert many(spark, values, biblio.standard_centre) == ["Michigan RDC", "Boston RDC", "Elsewhere", None]


def test_type_tables(spark):
    values = ["journal-article", "DATASET", "odd-kind", "", None]
    assert many(spark, values, biblio.type_code) == ["JA", "DS", "OT", "OT", "OT"]
    assert many(spark, values, lambda c: biblio.type_code(c, True)) == ["JA", "DS", "ODD-KIND", "", ""]
    assert many(spark, values, biblio.type_label) == ["Journal Article", "Dataset", "Odd Kind", "Publication", "Publication"]


def test_keywords_drop_blank_tokens(spark):
    assert many(spark, ["a, b,,a , ", None], text.keywords) == [["a", "b"], None]


def test_lookup_status(spark):
    rows = [
        (0, 200, True, None, True), (1, 200, False, None, True), (2, 404, False, None, False), (3, 503, False, None, False),
        (4, None, False, "timeout", False), (5, 200, True, "cut", True), (6, 200, False, None, False), (7, 200, False, None, None),
    ]
    df = spark.createDataFrame(rows, "i int, code int, hit boolean, error string, well boolean")
    status = biblio.lookup_status("code", "hit", "error", "well").alias("s")
    got = [r.s for r in df.select("i", status).orderBy("i").collect()]
    assert got == ["Found", "Not Found", "Not Found", "Error 503", "Exception", "Exception", "Exception", "Exception"]

def test_has_doi_ignores_case(spark):
    df = spark.sql(
        "SELECT array(named_struct('external-id-type', 'DOI', 'external-id-value', '10.1/AbC')) AS ids, '10.1/aBc' AS doi"
    )
    assert df.select(predicates.has_doi(F.col("ids"), "doi")).first()[0] is True


def test_short_list_has_thirteen_words_and_long_list_twenty_nine():
    assert (len(V.RELATED_KEYWORDS), len(V.RELATED_KEYWORDS_LONG)) == (13, 29)
