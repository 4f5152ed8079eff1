"""JSON parsing, validation and text templates for structured resumes and postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import month_of

RECORD = "map<string, string>"
LISTS = ["workexp", "awards", "certificates", "publications", "personal_projects"]
#: Fields of a structured resume in the order they are checked, as (camel case,
#: snake case, kind, required, may be null). A kind is "text", ("list", kind) or
#: ("record", name, fields).
_TEXTS = ("list", "text")
_LOCATION = ("record", "Location", [("address", "address", "text", False, True), ("postalCode", "postal_code", "text", False, True), ("city", "city", "text", False, True), ("countryCode", "country_code", "text", False, True)])
_LANGUAGE = ("record", "Language", [("language", "language", "text", True, False), ("fluency", "fluency", "text", False, True)])
_BASICS = [(n, n, "text", False, True) for n in ("name", "email", "phone", "website", "summary")]
_BASICS += [("location", "location", _LOCATION, False, True)]
_BASICS += [(n, n, "text", False, True) for n in ("twitter", "github", "linkedin")]
_BASICS += [("languages", "languages", ("list", _LANGUAGE), False, True)]
_WORK = [
    ("companyName", "company_name", "text", True, False),
    ("position", "position", "text", True, False),
    ("startDate", "start_date", "text", False, True),
    ("endDate", "end_date", "text", False, True),
    ("summary", "summary", _TEXTS, False, True),
    ("skills", "skills", _TEXTS, False, True),
]
_AWARD = [
    ("title", "title", "text", True, False),
    ("dateReceived", "date_received", "text", True, True),
    ("awarder", "awarder", "text", False, True),
    ("summary", "summary", "text", False, True),
]
_CERTIFICATE = [
    ("certificateName", "certificate_name", "text", True, False),
    ("dateIssued", "date_issued", "text", True, True),
    ("issuer", "issuer", "text", True, False),
    ("certificateUrl", "certificate_url", "text", False, True),
]
_PUBLICATION = [
    ("publicationName", "publication_name", "text", True, False),
    ("publisherName", "publisher_name", "text", False, True),
    ("releaseDate", "release_date", "text", False, True),
    ("publicationUrl", "publication_url", "text", False, True),
    ("summary", "summary", "text", False, True),
]
_PROJECT = [
    ("projectName", "project_name", "text", True, False),
    ("startDate", "start_date", "text", False, True),
    ("endDate", "end_date", "text", False, True),
    ("highlights", "highlights", _TEXTS, False, True),
    ("projectUrl", "project_url", "text", False, True),
    ("keywords", "keywords", _TEXTS, False, True),
]
RESUME_FIELDS = [
    ("basics", "basics", ("record", "BasicInformation", _BASICS), True, False),
    ("workexp", "workexp", ("list", ("record", "WorkExperience", _WORK)), False, True),
    ("education", "education", _TEXTS, False, True),
    ("awards", "awards", ("list", ("record", "Award", _AWARD)), False, True),
    ("certificates", "certificates", ("list", ("record", "Certificate", _CERTIFICATE)), False, True),
    ("publications", "publications", ("list", ("record", "Publication", _PUBLICATION)), False, True),
    ("skills", "skills", _TEXTS, False, True),
    ("personal_projects", "personal_projects", ("list", ("record", "Project", _PROJECT)), False, True),
]
RESUME_SCHEMA = f"struct<basics: {RECORD}, education: array<string>, skills: array<string>, " + ", ".join(f"{n}: array<{RECORD}>" for n in LISTS) + ">"


def is_json(raw: Column) -> Column:
    """Whether the text is one JSON object."""
    return F.coalesce(F.get_json_object(raw, "$").isNotNull(), F.lit(False)) & F.ltrim(raw).startswith("{")


def parse_or(raw: Column, schema: str, fallback: Column) -> Column:
    """Parsed record, or the fallback where the text is not JSON."""
    return F.when(is_json(raw), F.from_json(raw, schema)).otherwise(fallback)


def parse_or_null(raw: Column, schema: str) -> Column:
    return F.when(is_json(raw), F.from_json(raw, schema))


def int_or_zero(text: Column) -> Column:
    """Whole part of a number in text; 0 for anything else."""
    return F.coalesce(text.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def list_or_empty(items: Column) -> Column:
    return F.coalesce(items, F.array().cast("array<string>"))


def text_or(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def score_or(text: Column, default: float = 50.0) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(default))


# The rules are one SQL expression: as text it is put together much faster than column by column.
_NONE = "cast(array() AS array<string>)"


def _message(path: str, msg: str, value: str) -> str:
    return f"array(concat({path}, ': {msg} (value: \\'', {value}, '\\')'))"


def _kind_of(value: str) -> str:
    """STRING, ARRAY, OBJECT, VOID, … of a variant."""
    return f"regexp_extract(schema_of_variant({value}), '^[A-Z]+', 0)"


def _shown(value: str) -> str:
    """Text of a value in a message; lists and records are shown as JSON."""
    text = f"try_variant_get({value}, '$', 'string')"
    return f"CASE {_kind_of(value)} WHEN 'VOID' THEN 'None' WHEN 'STRING' THEN {text} WHEN 'BOOLEAN' THEN initcap({text}) ELSE to_json({value}) END"


def _problems(value: str, path: str, kind, nullable: bool, shown: str, depth: int) -> str:
    """Messages for a value that is there, of this kind, and for all below it."""
    if kind == "text":
        wanted, msg, below = "STRING", "Input should be a valid string", _NONE
    elif kind[0] == "list":
        e, i = f"e{depth}", f"i{depth}"
        each = _problems(e, f"concat({path}, '.', cast({i} AS string))", kind[1], False, _shown(e), depth + 1)
        wanted, msg, below = "ARRAY", "Input should be a valid list", f"flatten(transform(try_variant_get({value}, '$', 'array<variant>'), ({e}, {i}) -> {each}))"
    else:
        wanted, msg, below = "OBJECT", f"Input should be a valid dictionary or instance of {kind[1]}", _field_problems(value, path, kind[2], depth)
    null = f"WHEN 'VOID' THEN {_NONE} " if nullable else ""
    return f"CASE {_kind_of(value)} WHEN '{wanted}' THEN {below} {null}ELSE {_message(path, msg, shown)} END"


def _field_problems(record: str, path: str | None, fields: list, depth: int) -> str:
    found = []
    for camel, snake, kind, required, nullable in fields:
        own = f"try_variant_get({record}, '$.{camel}', 'variant')"
        value = own if camel == snake else f"coalesce({own}, try_variant_get({record}, '$.{snake}', 'variant'))"
        at = f"'{camel}'" if path is None else f"concat({path}, '.{camel}')"
        missing = _message(at, "Field required", "'N/A'") if required else _NONE
        # A field is taken once, as the one element of a list. The report looks a value up
        # under its camel case name only.
        f, o = f"f{depth}", f"struct({value} AS v, {own} AS o)"
        shown = f"CASE WHEN {f}.o IS NULL THEN 'N/A' ELSE {_shown(f + '.o')} END"
        below = _problems(f"{f}.v", at, kind, nullable, shown, depth + 1)
        found.append(f"flatten(transform(array({o}), {f} -> CASE WHEN {f}.v IS NULL THEN {missing} ELSE {below} END))")
    return f"concat({', '.join(found)})"


def validation_errors(record: str) -> Column:
    """Messages ``path.index.field: text (value: '…')`` for every broken rule of a structured
    resume, a column of variants: missing fields, nulls, and values of a wrong type at any path."""
    return F.expr(_field_problems(record, None, RESUME_FIELDS, 0))


def _checked(df: DataFrame, raw: str, when: Column | None = None) -> DataFrame:
    """Columns parsed, errors and valid, for the rows of ``when`` alone.

    The messages come out of a generator: as a plain column, a later filter on them would be
    moved below and parse a record again for each of its fields."""
    wanted = F.lit(True) if when is None else when
    typed = df.withColumns({"parsed": F.when(wanted, F.from_json(raw, RESUME_SCHEMA)), "_typed": F.when(wanted & is_json(F.col(raw)), F.try_parse_json(raw))})
    found = F.when(~wanted, F.lit(None)).when(F.col("_typed").isNull(), F.array(F.lit("Invalid JSON"))).otherwise(validation_errors("_typed"))
    return typed.select("*", F.explode_outer(F.array(found)).alias("errors")).withColumn("valid", F.size("errors") == 0).drop("_typed")


def validate(df: DataFrame, raw: str) -> DataFrame:
    """Parse structured resumes and list what is wrong with each; rows with errors
    are the quarantine, to be run again after a repair."""
    return _checked(df, raw)


def retry_quarantine(df: DataFrame, raw: str, repair) -> DataFrame:
    """Second pass: quarantined rows go through ``repair`` and are validated again, in the
    same pass over the input."""
    names = ["parsed", "errors", "valid"]
    first = validate(df, raw).withColumnsRenamed({n: f"_first_{n}" for n in names})
    mended = first.withColumn(raw, F.when(F.col("_first_valid"), F.col(raw)).otherwise(repair(F.col(raw))))
    again = _checked(mended, raw, ~F.col("_first_valid"))
    return again.select(*df.columns, *[F.when(F.col("_first_valid"), F.col(f"_first_{n}")).otherwise(F.col(n)).alias(n) for n in names])


# ---- section texts -----------------------------------------------------------------


def _date_range(start: Column, end: Column) -> Column:
    text = F.concat(month_of(start, "N/A"), F.lit(" - "), month_of(end, "Present"))
    return F.concat(F.lit(" ("), F.regexp_replace(text, "^[ -]+|[ -]+$", ""), F.lit(")"))


def _list_text(items: Column, sep: str, empty: str) -> Column:
    return F.when(F.size(F.coalesce(items, F.array().cast("array<string>"))) > 0, F.array_join(items, sep)).otherwise(empty)


def work_experience_text(entries: Column) -> Column:
    one = lambda e: F.concat(
        F.coalesce(e["position"], F.lit("Unknown Position")),
        F.lit(" at "),
        F.coalesce(e["companyName"], F.lit("Unknown Company")),
        _date_range(e["startDate"], e["endDate"]),
        F.lit("\nResponsibilities:\n\t"),
        _list_text(e["summary"], "\n\t", "No responsibilities listed"),
        F.lit("\nSkills: "),
        _list_text(e["skills"], ", ", "No skills listed"),
    )
    return F.when(F.size(entries) > 0, F.array_join(F.transform(entries, one), "\n\n")).otherwise("No work experience listed")


def projects_text(entries: Column) -> Column:
    one = lambda e: F.concat(
        F.lit("Project: "),
        F.coalesce(e["projectName"], F.lit("Unnamed Project")),
        _date_range(e["startDate"], e["endDate"]),
        F.lit("\nHighlights:\n\t"),
        _list_text(e["highlights"], "\n\t", "No highlights provided"),
        F.lit("\nKeywords: "),
        _list_text(e["keywords"], ", ", "No keywords provided"),
        F.lit("\n"),
        F.coalesce(e["projectUrl"], e["project_url"], F.lit("")),
    )
    return F.when(F.size(entries) > 0, F.array_join(F.transform(entries, one), "\n\n")).otherwise("No projects listed.")


def _labelled(entries: Column, fields: list[tuple[str, str]]) -> Column:
    def one(e: Column) -> Column:
        parts = [F.concat(F.lit(f"{label}: "), F.coalesce(e[f], F.lit(""))) for label, f in fields]
        return F.concat_ws(", ", *parts)

    return F.when(F.size(entries) > 0, F.array_join(F.transform(entries, one), "\n")).otherwise("")


def awards_text(entries: Column) -> Column:
    return _labelled(entries, [("Award", "title"), ("Date", "dateReceived"), ("Awarder", "awarder"), ("Summary", "summary")])


def certificates_text(entries: Column) -> Column:
    return _labelled(entries, [("Certificate", "certificateName"), ("Date Issued", "dateIssued"), ("Issuer", "issuer")])


def publications_text(entries: Column) -> Column:
    return _labelled(
        entries, [("Publication", "publicationName"), ("Publisher", "publisherName"), ("Release Date", "releaseDate"), ("Summary", "summary")]
    )


def misc_text(awards: Column, certificates: Column, publications: Column, skills: Column) -> Column:
    """Awards, certificates, publications and skills, those that are there; null if none is."""
    listed = F.when(F.size(skills) > 0, F.concat(F.lit("Skills: "), F.array_join(skills, ", ")))
    parts = [awards_text(awards), certificates_text(certificates), publications_text(publications), listed]
    kept = F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n"))


def posting_text(posting: Column, fields: dict) -> Column:
    """``key : value`` lines of a nested posting. ``fields`` gives the shape: None for
    plain values, "list" for lists, a dict for nested records. Nulls are skipped."""

    def line(name: str, shape) -> Column:
        c = posting[name]
        if shape == "list":
            value = F.array_join(c, ",")
        elif isinstance(shape, dict):
            value = F.when(c.isNotNull(), posting_text(c, shape))
        else:
            value = c.cast("string")
        return F.coalesce(F.concat(F.lit(f"{name} : "), value, F.lit(" \n")), F.lit(""))

    return reduce(lambda a, b: F.concat(a, b), [line(n, s) for n, s in fields.items()])
