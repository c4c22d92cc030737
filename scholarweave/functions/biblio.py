"""Citations, output types, project status, centres and nested-payload lookups."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.functions.predicates import contains_any
from scholarweave.functions.text import ColumnOrName, col, first_nonempty, once, strip, to_number


def _filled(c: ColumnOrName) -> Column:
    return F.coalesce(col(c) != "", F.lit(False))


# --- citations -------------------------------------------------------------


def citation_compact(c: ColumnOrName) -> Column:
    """``12(3), 45-67`` as struct(volume, number, pages); null fields if absent."""
    return _citation(c, V.CITATION_VOLUME_ISSUE_PAGES, (1, 2, 3))


def citation_dated(c: ColumnOrName) -> Column:
    """``2023, 57 (15), 5746-5753`` as struct(volume, number, pages)."""
    return _citation(c, V.CITATION_YEAR_VOLUME_ISSUE_PAGES, (2, 3, 4))


def _citation(c: ColumnOrName, pattern: str, groups: tuple[int, int, int]) -> Column:
    """Search the text once, then take the short match apart."""
    names = ("volume", "number", "pages")
    return once(
        F.regexp_extract(col(c), pattern, 0),
        lambda m: F.struct(
            *[
                F.when(m != "", F.regexp_extract(m, pattern, g)).alias(name)
                for name, g in zip(names, groups)
            ]
        ),
    )


def citation_labelled(c: ColumnOrName, citation_type: ColumnOrName | None = None) -> Column:
    """Labelled volume, issue and pages; only free-form citations are read."""
    text = col(c)
    if citation_type is not None:
        text = F.when(col(citation_type) == "formatted-unspecified", text)

    def part(pattern: str, group: int) -> Column:
        return once(F.regexp_extract(text, pattern, group), lambda m: F.nullif(m, F.lit("")))

    return F.struct(
        part(V.CITATION_VOLUME, 1).alias("volume"),
        part(V.CITATION_ISSUE, 2).alias("number"),
        part(V.CITATION_PAGES, 1).alias("pages"),
    )


def page_range(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``f-l``, or ``f`` alone; null without a first page."""
    f, l = F.nullif(col(first), F.lit("")), F.nullif(col(last), F.lit(""))
    return F.when(f.isNotNull(), F.concat_ws("-", f, l))


def page_range_either(first: ColumnOrName, last: ColumnOrName) -> Column:
    """As :func:`page_range`, but a last page on its own is kept too."""
    joined = F.concat_ws("-", F.nullif(col(first), F.lit("")), F.nullif(col(last), F.lit("")))
    return F.nullif(F.btrim(joined, F.lit("-")), F.lit(""))


def crossref_biblio(msg: Column) -> Column:
    """Authors, title, journal, volume(issue), page and year; absent parts drop out."""
    authors = F.array_join(
        F.transform(
            msg["author"],
            lambda a: F.concat(
                F.coalesce(a["family"], F.lit("")), F.lit(", "), F.coalesce(a["given"], F.lit(""))
            ),
        ),
        ", ",
    )
    journal = F.get(msg["container-title"], F.lit(0))
    number = F.when(_filled(msg["issue"]), F.concat(F.lit("("), msg["issue"], F.lit(")")))
    volume = F.when(
        _filled(msg["volume"]),
        F.concat(F.lit(" "), msg["volume"], F.coalesce(number, F.lit(""))),
    )
    page = F.when(_filled(msg["page"]), F.concat(F.lit(", "), msg["page"]))
    where = F.when(
        _filled(journal),
        F.concat(
            F.lit(" "), journal, F.coalesce(volume, F.lit("")), F.coalesce(page, F.lit(""))
        ),
    )
    year = published_year(msg)
    dated = F.when(year != 0, F.concat(F.lit(" ("), year.cast("string"), F.lit(")")))
    return F.concat(
        F.coalesce(authors, F.lit("")), F.lit(". "),
        F.coalesce(F.get(msg["title"], F.lit(0)), F.lit("")), F.lit("."),
        F.coalesce(where, F.lit("")), F.coalesce(dated, F.lit("")),
    )


def date_part(date: Column, index: int) -> Column:
    """Part ``index`` (0 year, 1 month) of nested date-parts; null when absent."""
    return F.get(F.get(date["date-parts"], F.lit(0)), F.lit(index))


def published_year(msg: Column) -> Column:
    return date_part(msg["published"], 0)


def printed_month(msg: Column) -> Column:
    return date_part(msg["published-print"], 1)


def full_citation(journal, volume, issue, pages) -> Column:
    """``J, Vol v, Iss i, pp. p`` when all four are there, else null."""
    parts = [strip(c) for c in (journal, volume, issue, pages)]
    complete = _filled(parts[0]) & _filled(parts[1]) & _filled(parts[2]) & _filled(parts[3])
    return F.when(complete, F.format_string("%s, Vol %s, Iss %s, pp. %s", *parts))


def loose_citation(journal, volume, issue, pages) -> Column:
    """The same layout whatever is missing; gaps are empty."""
    parts = [F.coalesce(col(c), F.lit("")) for c in (journal, volume, issue, pages)]
    return F.format_string("%s, Vol %s, Iss %s, pp. %s", *parts)


def doi_reference(c: ColumnOrName, prefix: str = "doi:") -> Column:
    return F.when(_filled(c), F.concat(F.lit(prefix), col(c)))


# --- lookups ---------------------------------------------------------------


def lookup_status(
    code: ColumnOrName, hit: ColumnOrName, error: ColumnOrName, well_formed: ColumnOrName,
    absent_codes: tuple = (404,),
) -> Column:
    """Outcome of one stored response; an answer that cannot be read is an exception."""
    status = col(code)
    broken = (status == 200) & ~F.coalesce(col(well_formed), F.lit(False))
    return (
        F.when(col(error).isNotNull() | status.isNull() | broken, F.lit("Exception"))
        .when((status == 200) & col(hit), F.lit("Found"))
        .when((status == 200) | status.isin(*absent_codes), F.lit("Not Found"))
        .otherwise(F.concat(F.lit("Error "), status.cast("string")))
    )


# --- types and status ------------------------------------------------------


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def type_code(c: ColumnOrName, keep_unknown: bool = False) -> Column:
    """Two-letter output type; unknown types become OT or stay, upper-cased."""
    kind = F.lower(F.coalesce(col(c), F.lit("")))
    other = F.upper(kind) if keep_unknown else F.lit(V.OTHER_TYPE_CODE)
    return F.coalesce(F.try_element_at(_table(V.OUTPUT_TYPE_CODES), kind), other)


def type_label(c: ColumnOrName, has_work: ColumnOrName | None = None) -> Column:
    """Readable output type; unknown types are title-cased."""
    kind = F.lower(F.coalesce(col(c), F.lit("")))
    spelled = F.initcap(F.replace(kind, F.lit("-"), F.lit(" ")))
    label = F.coalesce(
        F.try_element_at(_table(V.OUTPUT_TYPE_LABELS), kind),
        F.when(kind != "", spelled),
        F.lit("Publication"),
    )
    return label if has_work is None else F.when(col(has_work), label).otherwise("Unknown")


def type_guess(c: ColumnOrName) -> Column:
    """Output type from a word inside the document type."""
    kind = F.lower(F.coalesce(col(c), F.lit("")))
    return _first_keyword(kind, V.OUTPUT_TYPE_GUESSES, F.lit("Other"))


def end_year(start: ColumnOrName) -> Column:
    """Projects are taken to last three years; text in, text out."""
    return (to_number(start).try_cast("bigint") + F.lit(3)).cast("string")


def project_status(start: ColumnOrName, end: ColumnOrName, as_of_year: int) -> Column:
    """Completed, Active, Planned or Unknown relative to a given year."""
    s, e = to_number(start), to_number(end)
    return (
        F.when(s.isNull() | e.isNull(), "Unknown")
        .when(e < as_of_year, "Completed")
        .when(s <= as_of_year, "Active")
        .otherwise("Planned")
    )


def status_from_end(end: ColumnOrName) -> Column:
    """Completed once there is an end date other than ``Ongoing``."""
    return F.when(_filled(end) & (col(end) != "Ongoing"), "Completed").otherwise("Active")


def output_status(published: ColumnOrName, otherwise: str = "In Progress") -> Column:
    return F.when(_filled(col(published).cast("string")), "Published").otherwise(otherwise)


# --- centres and venues ----------------------------------------------------


def _first_keyword(text: Column, pairs, default: Column) -> Column:
    (keyword, name), *rest = pairs
    chain = F.when(F.contains(text, F.lit(keyword)), F.lit(name))
    for keyword, name in rest:
        chain = chain.when(F.contains(text, F.lit(keyword)), F.lit(name))
    return chain.otherwise(default)


def standard_centre(c: ColumnOrName) -> Column:
    """Standard name of a centre; names without a known keyword stay as they are."""
    return _first_keyword(F.lower(col(c)), V.CENTRE_NAMES, col(c))


def infer_centre(institutions: Column) -> Column:
    """Standard centre named by any institution of a work."""
    names = F.lower(F.array_join(F.transform(institutions, lambda i: i["name"]), " "))
    return _first_keyword(
        F.coalesce(names, F.lit("")), V.CENTRE_NAMES, F.lit(V.UNKNOWN_CENTRE)
    )


def detect_centre(authorships: Column) -> Column:
    """First institution over all authors that names the programme or a centre."""
    names = F.flatten(
        F.transform(
            authorships,
            lambda a: F.coalesce(
                F.transform(a["institutions"], lambda i: i["display_name"]),
                F.array().cast("array<string>"),
            ),
        )
    )
    fits = F.filter(
        names,
        lambda n: contains_any(n, V.RELATED_KEYWORDS)
        | F.coalesce(n.rlike(V.CENTRE_WORD), F.lit(False)),
    )
    return F.try_element_at(fits, F.lit(1))


def work_venue(work: Column) -> Column:
    """Host venue, else the primary source."""
    return first_nonempty(
        work["host_venue"]["display_name"], work["primary_location"]["source"]["display_name"]
    )


def first_external_id(external_ids: Column, kind: str = "doi") -> Column:
    hits = F.filter(external_ids, lambda e: e["external-id-type"] == kind)
    return F.try_element_at(hits, F.lit(1))["external-id-value"]


def journal_or_issn(work: Column) -> Column:
    """Journal title, else the first ISSN."""
    return first_nonempty(
        work["journal-title"]["value"],
        first_external_id(work["external-ids"]["external-id"], "issn"),
    )


# --- employment history ----------------------------------------------------


def latest_employment(employments: Column) -> Column:
    """Organisation of the job with the latest end year; the first of equals."""
    ended = F.filter(
        F.transform(
            employments,
            lambda e, i: F.struct(
                to_number(e["end-date"]["year"]["value"]).try_cast("int").alias("ended"),
                (-i).alias("place"),
                e["organization"]["name"].alias("name"),
            ),
        ),
        lambda e: e["ended"].isNotNull(),
    )
    return F.array_max(ended)["name"]


def first_employment(employments: Column) -> Column:
    """struct(started, ended, organisation) as first given in the history."""
    starts = F.filter(employments, lambda e: e["start-date"].isNotNull())
    ends = F.filter(employments, lambda e: e["end-date"].isNotNull())

    def first(arr: Column) -> Column:
        return F.try_element_at(arr, F.lit(1))

    return F.struct(
        first(starts)["start-date"]["year"]["value"].alias("started"),
        F.when(F.coalesce(F.size(ends), F.lit(0)) < 1, F.lit("Ongoing"))
        .otherwise(first(ends)["end-date"]["year"]["value"]).alias("ended"),
        first(employments)["organization"]["name"].alias("organisation"),
    )


# --- articles --------------------------------------------------------------


def article_fields(articleset: Column, body: ColumnOrName) -> Column:
    """Flat struct of the first parsed article of a guarded body; null parts stay null.

    The abstract is all paragraphs of all abstracts, wherever they stand in them, and
    the author is the first one of all groups of contributors.
    """
    article = F.get(articleset["article"], F.lit(0))
    meta = article["front"]["article-meta"]
    people = F.flatten(F.filter(F.transform(meta["contrib-group"], lambda g: g["contrib"]), lambda c: c.isNotNull()))
    authors = F.filter(people, lambda c: c["_contrib-type"] == "author")
    author = F.try_element_at(authors, F.lit(1))
    name = F.concat_ws(" ", author["name"]["given-names"], author["name"]["surname"])
    dates = F.filter(meta["pub-date"], lambda d: d["_date-type"] == "pub")
    date = F.try_element_at(dates, F.lit(1))
    return F.struct(
        plain(meta["title-group"]["article-title"]).alias("title"),
        F.when(article.isNotNull(), once(paragraphs_below(up_to_first_end(body, "article"), "abstract"), lambda t: F.nullif(t, F.lit("")))).alias("abstract"),
        date["year"].alias("year"),
        date["month"].alias("month"),
        meta["volume"].alias("volume"),
        meta["issue"].alias("issue"),
        page_range(meta["fpage"], meta["lpage"]).alias("pages"),
        F.lower(article["_article-type"]).alias("article_type"),
        article["front"]["journal-meta"]["journal-title-group"]["journal-title"].alias("journal"),
        F.nullif(strip(name), F.lit("")).alias("first_author"),
        F.nullif(strip(plain(_without_label(F.get(author["aff"], F.lit(0))))), F.lit("")).alias("institution"),
    )


# Attributes of a tag; their values may hold angle brackets.
_ATTRIBUTES = r"""(?:\s(?:[^<>"']++|"[^"]*"|'[^']*')*+)?"""
# Stand for the begin and the end of a paragraph while other tags are removed, and between
# these and text.
_BEGIN, _END, _CUT = "\ue002", "\ue003", "\ue004"


def up_to_first_end(xml: ColumnOrName, name: str) -> Column:
    """A document up to the end of its first element of a name, none of which stands in another."""
    return F.substring_index(col(xml), f"</{name}>", 1)


def paragraphs_below(xml: ColumnOrName, name: str, paragraph: str = "p") -> Column:
    """Text of all paragraphs at any depth below the elements ``name``, joined by spaces.

    Paragraphs may stand in sections, lists, boxes, quotations or other paragraphs. Text
    outside paragraphs, as of headings, is left out; that of tags inside them is kept. The
    document is a well-formed one whose escaped angle brackets are guarded.
    """
    text = col(xml)
    remarks = F.contains(text, F.lit("<!--")) | F.contains(text, F.lit("<?"))
    plain_text = F.when(remarks, F.regexp_replace(text, r"(?s)<!--.*?-->|<\?.*?\?>", "")).otherwise(text)
    pattern = f"(?s)<{name}{_ATTRIBUTES}(?<!/)>(.*?)</{name}\\s*>"
    return once(F.regexp_extract_all(plain_text, F.lit(pattern), F.lit(1)), lambda parts: _paragraph_text(parts, paragraph))


def _paragraph_text(parts: Column, paragraph: str) -> Column:
    # Plain tags are replaced as they are; patterns, which are dear, are for what is left.
    marked = F.array_join(parts, " ")
    for tag, mark in ((f"<{paragraph}>", _BEGIN), (f"</{paragraph}>", _END)):
        marked = F.replace(marked, F.lit(tag), F.lit(mark))

    def other_tags(text: Column) -> Column:
        changed = text
        for pattern, mark in (
            (f"<{paragraph}(?:/|{_ATTRIBUTES}(?<=/))>", ""), (f"<{paragraph}{_ATTRIBUTES}>", _BEGIN), (f"</{paragraph}\\s*>", _END),
        ):
            changed = F.regexp_replace(changed, pattern, mark)
        return F.when(F.contains(text, F.lit("<")), plain_tags(changed)).otherwise(text)

    kept = once(once(marked, other_tags), _inside_marks)
    # Parsed once more, as text of one element, for its entities and character references.
    text = F.from_xml(F.concat(F.lit("<r><t>"), kept, F.lit("</t></r>")), "t string", {"mode": "PERMISSIVE"})["t"]
    return F.when(F.size(parts) > 0, _unguarded(text))


def _inside_marks(marked: Column) -> Column:
    """The texts between marks, joined by spaces. Marks are followed through one by one only
    where some stand inside others."""
    filled = lambda texts: F.array_join(F.filter(texts, lambda x: F.trim(x) != ""), " ")

    def unless_nested(pieces: Column) -> Column:
        behind = F.slice(pieces, 2, F.size(pieces))
        flat = F.forall(behind, lambda p: F.contains(p, F.lit(_END)))
        return F.when(flat, filled(F.transform(behind, lambda p: F.substring_index(p, _END, 1)))).otherwise(_nested_text(marked))

    return once(F.split(marked, _BEGIN), unless_nested)


def _nested_text(marked: Column) -> Column:
    tokens = marked
    for mark in (_BEGIN, _END):
        tokens = F.replace(tokens, F.lit(mark), F.lit(_CUT + mark + _CUT))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, token: Column) -> Column:
        depth = acc["depth"] + F.when(token == _BEGIN, 1).when(token == _END, -1).otherwise(0)
        text = (acc["depth"] > 0) & ~token.isin(_BEGIN, _END) & (F.trim(token) != "")
        return F.struct(depth.alias("depth"), F.when(text, F.concat(acc["kept"], F.array(token))).otherwise(acc["kept"]).alias("kept"))

    return F.aggregate(F.split(tokens, _CUT), start, step, lambda acc: F.array_join(acc["kept"], " "))


def _without_label(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<label\b[^<>]*>.*?</label>", "")


# Stand for escaped angle brackets of a text while its inline tags are removed.
_LESS, _GREATER = "\ue000", "\ue001"


def guarded(body: ColumnOrName) -> Column:
    """XML whose escaped angle brackets survive :func:`plain`."""
    return F.replace(F.replace(col(body), F.lit("&lt;"), F.lit(_LESS)), F.lit("&gt;"), F.lit(_GREATER))


def plain(c: ColumnOrName) -> Column:
    """Text of an element of a guarded body without the inline tags inside it."""
    return _unguarded(plain_tags(c))


def _unguarded(text: Column) -> Column:
    # Few texts have such a mark, and to look for one is cheap.
    marked = lambda t: F.contains(t, F.lit(_LESS)) | F.contains(t, F.lit(_GREATER))
    return once(text, lambda t: F.when(marked(t), F.translate(t, _LESS + _GREATER, "<>")).otherwise(t))


def plain_tags(c: ColumnOrName) -> Column:
    """Text without tags, still guarded."""
    return F.regexp_replace(col(c), r"</?[A-Za-z][^<>]*>", "")


def search_hit(result: Column) -> Column:
    """First id of a search result that reports at least one hit."""
    return F.when(result["Count"] > 0, F.get(result["IdList"]["Id"], F.lit(0)))
