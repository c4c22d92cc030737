"""Column lists and payload schemas."""

from __future__ import annotations

HARMONISED_COLUMNS = ["author", "year", "title", "doi"]

OUTPUT_COLUMNS = [
    "ProjID", "ProjectStatus", "ProjectTitle", "ProjectRDC", "ProjectYearStarted",
    "ProjectYearEnded", "ProjectPI", "OutputTitle", "OutputBiblio", "OutputType",
    "OutputStatus", "OutputVenue", "OutputYear", "OutputMonth", "OutputVolume",
    "OutputNumber", "OutputPages", "DOI", "Source",
]

# One row per stored API response; `body` is JSON or XML text.
LANDED_PAYLOAD = "key string, source string, code int, body string, error string"

CORE_WORK = (
    "title string, abstract string, fullText string, keywords array<string>, "
    "institutions array<struct<name:string>>, documentType string, publisher string, "
    "publishedDate string, doi string, volume string, issue string, pages string"
)

OPENALEX_WORK = (
    "id string, title string, publication_year int, publication_date string, type string, "
    "host_venue struct<display_name:string>, "
    "primary_location struct<source:struct<display_name:string>>, "
    "biblio struct<volume:string,issue:string,first_page:string,last_page:string>, "
    "authorships array<struct<author:struct<display_name:string>,"
    "institutions:array<struct<display_name:string>>>>"
)

_EXTERNAL_IDS = (
    "`external-ids`:struct<`external-id`:array<struct<"
    "`external-id-type`:string,`external-id-value`:string>>>"
)
_YEAR = "struct<year:struct<value:string>>"

ORCID_RECORD = (
    "`activities-summary` struct<"
    "employments:struct<`employment-summary`:array<struct<"
    f"`start-date`:{_YEAR},`end-date`:{_YEAR},organization:struct<name:string>>>>,"
    "works:struct<`group`:array<struct<`work-summary`:array<struct<"
    f"`put-code`:bigint,{_EXTERNAL_IDS}>>>>>>"
)

_WORK_FIELDS = (
    "title:struct<title:struct<value:string>>,type:string,"
    "`journal-title`:struct<value:string>,"
    "`publication-date`:struct<year:struct<value:string>,month:struct<value:string>>,"
    f"{_EXTERNAL_IDS},"
    "citation:struct<`citation-type`:string,`citation-value`:string>"
)
ORCID_WORK = f"struct<{_WORK_FIELDS}>"
ORCID_WORKS = f"array<{ORCID_WORK}>"

CROSSREF_MESSAGE = (
    "title array<string>, `container-title` array<string>, volume string, issue string, "
    "page string, author array<struct<family:string,given:string>>, "
    "`published-print` struct<`date-parts`:array<array<int>>>, "
    "published struct<`date-parts`:array<array<int>>>"
)

ESEARCH_RESULT = "Count int, IdList struct<Id:array<string>>"

PMC_ARTICLESET = (
    "article array<struct<`_article-type`:string, front:struct<"
    "`journal-meta`:struct<`journal-title-group`:struct<`journal-title`:string>>,"
    "`article-meta`:struct<"
    "`title-group`:struct<`article-title`:string>,"
    "`contrib-group`:array<struct<contrib:array<struct<`_contrib-type`:string,"
    "name:struct<surname:string,`given-names`:string>,aff:array<string>>>>>,"
    "`pub-date`:array<struct<`_date-type`:string,year:string,month:string>>,"
    "volume:string,issue:string,fpage:string,lpage:string>>>>"
)
