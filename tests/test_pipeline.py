import json

from scholarweave import schemas
from scholarweave.plans.pipeline import combine, run_pipeline
from scholarweave.sources import tables
from scholarweave.workspace import scratch_path
from tests.test_payloads import ARTICLE


def test_from_landing_folder_to_outputs(spark):
    landing, output = scratch_path(spark, "landing"), scratch_path(spark, "output")
    groups = spark.createDataFrame(
        [("Ann Lee", "2001", "Wages", "10.1/A"), ("Ann Lee", "2001", "Wages", "10.1/A"), ("Bo Ray", "1990", "Firms", "10.1/b")],
        "PI string, year string, title string, doi string",
    )
    tables.write_csv(groups, f"{landing}/group1.csv")
    landed = schemas.LANDED_PAYLOAD
    spark.createDataFrame(
        [("10.1/a", "pmc", 200, ARTICLE.format(title="FSRDC wages", abstract="x"), None)], landed
    ).write.parquet(f"{landing}/articles")
    work = {"id": "https://openalex.org/W1", "title": "BEA firms study", "publication_year": 1992, "type": "report"}
    spark.createDataFrame(
        [("10.1/B", "openalex", 200, json.dumps(work), None), ("10.1/a", "openalex", 404, None, None)], landed
    ).write.parquet(f"{landing}/openalex")
    hit = {"title": "Title 13 wages", "documentType": "journal", "publishedDate": "2003-04-01", "doi": "10.9/z"}
    spark.createDataFrame([("Ann Lee", 1, json.dumps(hit))], "author string, rank bigint, body string").write.parquet(f"{landing}/core")

    got = {r.Source: r for r in run_pipeline(spark, landing, output, as_of_year=2003, related_only=False).collect()}
    assert set(got) == {"PMC", "OpenAlex", "CORE"}
    assert got["PMC"].OutputTitle == "FSRDC wages"
    assert (got["OpenAlex"].ProjectTitle, got["OpenAlex"].OutputType) == ("BEA firms", "RE")
    core = got["CORE"]
    assert (core.ProjectStatus, core.OutputYear, core.OutputMonth, core.DOI) == ("Active", "2003", "04", "10.9/z")
    lookups = tables.read_sink(spark, f"{output}/lookups")
    assert {r.doi: r.status for r in lookups.collect()} == {"10.1/a": "Not Found", "10.1/b": "Found"}
    run_pipeline(spark, landing, output, as_of_year=2003, related_only=False)
    assert tables.read_sink(spark, f"{output}/lookups").count() == 2  # nothing was looked up again
    summary = spark.read.json(f"{output}/summary").first()
    assert sorted(p.year for p in summary.plots.publications_by_year) == [1992, 2001, 2003]


def test_an_empty_landing_folder_gives_empty_outputs(spark):
    output = scratch_path(spark, "output")
    outputs = run_pipeline(spark, scratch_path(spark, "nothing"), output, as_of_year=2003)
    assert outputs.count() == 0 and outputs.columns == schemas.OUTPUT_COLUMNS


def test_profiles_and_the_filter_for_related_outputs(spark):
    landing, output = scratch_path(spark, "landing"), scratch_path(spark, "output")
    groups = spark.createDataFrame(
        [("Ann Lee", "2001", "Wages", "10.1/A"), ("Lee", "1990", "Firms", "10.1/b"), ("Cy Ray", "1990", "Soil", "10.1/c")],
        "PI string, year string, title string, doi string",
    )
    tables.write_csv(groups, f"{landing}/group1.csv")
    people = [("Ann", "Lee", "0-1", 1), ("Cy", "Ray", "0-2", 1)]
    spark.createDataFrame(people, "given string, family string, orcid string, rank bigint").write.parquet(f"{landing}/people")
    job = {"start-date": {"year": {"value": "1999"}}, "organization": {"name": "Texas lab"}}
    record = json.dumps({"activities-summary": {"employments": {"employment-summary": [job]}}})

    def work(title, doi):
        ids = {"external-id": [{"external-id-type": "doi", "external-id-value": doi}]}
        return [{"title": {"title": {"value": title}}, "type": "book-chapter", "external-ids": ids}]

    rows = [("0-1", record, json.dumps([[{}], work("Census Bureau wages", "10.2/X")])), ("0-2", record, json.dumps([work("Soil", "10.2/y")]))]
    spark.createDataFrame(rows, "orcid string, record string, groups string").write.parquet(f"{landing}/profiles")
    message = json.dumps({"container-title": ["J"], "volume": "4", "published-print": {"date-parts": [[2000, 5]]}})
    spark.createDataFrame([("10.2/x", message)], "key string, body string").write.parquet(f"{landing}/crossref")

    got = {r.ProjectPI: r for r in run_pipeline(spark, landing, output, as_of_year=2003, related_only=False).collect()}
    assert set(got) == {"Ann Lee", "Cy Ray"}
    ann = got["Ann Lee"]
    assert (ann.OutputVenue, ann.OutputVolume, ann.OutputMonth, ann.DOI, ann.Source) == ("J", "4", "5", "10.2/X", "ORCID")
    assert (ann.ProjectStatus, ann.ProjectYearStarted, ann.ProjectYearEnded) == ("Active", "1999", "Ongoing")
    related = run_pipeline(spark, landing, scratch_path(spark, "related"), as_of_year=2003).collect()
    assert [(r.ProjectPI, r.ProjectRDC) for r in related] == [("Ann Lee", "Texas RDC")]


def test_the_same_output_from_two_sources_is_kept_once(spark):
    a = spark.createDataFrame([("1", "10.1/x", "T", None)], "ProjID string, DOI string, OutputTitle string, OutputYear string")
    b = spark.createDataFrame([("1", "10.1/X ", "T", "2000")], "ProjID string, DOI string, OutputTitle string, OutputYear string")
    rows = combine({"one": a, "two": b}).collect()
    assert [(r.Source, r.OutputYear) for r in rows] == [("two", "2000")]


def test_matches_by_words_enrichment_and_analysis(spark):
    landing, output = scratch_path(spark, "landing"), scratch_path(spark, "output")
    groups = spark.createDataFrame(
        [("Ann Lee", "2001", "Wages of firms in the long run", "10.1/A"), ("Bo Ray", "1990", "Firms", "10.1/b")],
        "PI string, year string, title string, doi string",
    )
    tables.write_csv(groups, f"{landing}/group1.csv")
    index = [("10.9/q", "long run wages in the firms", "Ann; X", "PMC7"), ("10.1/B", "Other", "Bo", "PMC8"), (None, "Wages", "Ann", "PMC9")]
    spark.createDataFrame(index, "doi string, title string, author string, pmcid string").write.parquet(f"{landing}/index")
    landed = schemas.LANDED_PAYLOAD
    bodies = [("pmc7", ARTICLE.format(title="FSRDC wages", abstract="x")), ("PMC8", ARTICLE.format(title="Soil", abstract="Census Bureau").replace("2001", "1994"))]
    spark.createDataFrame([(k, "pmc", 200, b, None) for k, b in bodies], landed).write.parquet(f"{landing}/articles")
    people = [("Bo", "Ray", "0-1", 1), ("Ann", "Lee", "0-2", 1)]
    spark.createDataFrame(people, "given string, family string, orcid string, rank bigint").write.parquet(f"{landing}/people")
    ids = {"external-id": [{"external-id-type": "doi", "external-id-value": "10.2/x"}]}
    record = {"activities-summary": {"works": {"group": [{"work-summary": [{"put-code": 5, "external-ids": ids}]}]}}}
    work = {"title": {"title": {"value": "Census Bureau firms"}}, "type": "report", "external-ids": ids}
    rows = [("0-1", json.dumps(record), json.dumps([[work]]))]
    spark.createDataFrame(rows, "orcid string, record string, groups string").write.parquet(f"{landing}/profiles")
    body = json.dumps(work | {"journal-title": {"value": "Journal"}, "citation": {"citation-value": "12(3), 45-67"}})
    spark.createDataFrame([(5, body), (6, "{}")], "put_code bigint, body string").write.parquet(f"{landing}/works")
    hit = {"title": "Title 13 wages", "documentType": "journal", "publishedDate": "2003-04-01", "doi": "10.9/z", "keywords": ["a", "b"]}
    core = [("Ann Lee", n, json.dumps(hit | {"title": f"Title 13 {n}", "keywords": k})) for n, k in enumerate((["a", "b"], ["b"], ["c"]))]
    spark.createDataFrame(core, "author string, rank bigint, body string").write.parquet(f"{landing}/core")

    got = {(r.Source, r.OutputTitle): r for r in run_pipeline(spark, landing, output, as_of_year=2003).collect()}
    matches = {r.Title: (r.PMCID, r.Method) for r in spark.read.parquet(f"{output}/matches").collect()}
    assert matches == {"Wages of firms in the long run": ("PMC7", "Title words"), "Firms": ("PMC8", "DOI")}
    assert {("PMC", "FSRDC wages"), ("ORCID", "Census Bureau firms"), ("CORE", "Title 13 0")} <= set(got)
    filled = got["ORCID", "Census Bureau firms"]
    assert (filled.OutputVenue, filled.OutputVolume, filled.OutputNumber, filled.OutputPages) == ("Journal", "12", "3", "45-67")
    graph = {r.title: (r.component, r.degree) for r in spark.read.parquet(f"{output}/graph").collect()}
    assert graph["Title 13 0"][0] == graph["Title 13 1"][0] != graph["Title 13 2"][0] and graph["Title 13 2"][1] == 0
    assert spark.read.parquet(f"{output}/components").count() == 2


def test_transitive_combining(spark):
    kind = "ProjID string, DOI string, OutputTitle string, ProjectPI string, OutputYear string"
    a = spark.createDataFrame([("1", "10.1/x", "T", "P", None), ("2", "10.1/x", "t  one", "p", None)], kind)
    b = spark.createDataFrame([("1", None, "T one", "P", "2000")], kind)
    assert len(combine({"one": a, "two": b}).collect()) == 2
    rows = combine({"one": a, "two": b}, transitive=True).collect()
    assert [(r.Source, r.DOI, r.OutputYear) for r in rows] == [("one", "10.1/x", "2000")]
