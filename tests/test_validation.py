"""Typed validation of structured resumes: every path, every kind of wrong value."""

import json

import pytest

from rankloom.functions import structured as J

GOOD = {
    "basics": {"name": "n", "location": {"city": "c", "postalCode": None}, "languages": [{"language": "en", "fluency": None}]},
    "workexp": [{"companyName": "a", "position": "b", "summary": ["x"], "skills": None}],
    "education": ["e"],
    "awards": [{"title": "t", "dateReceived": None}],
    "certificates": [{"certificate_name": "c", "date_issued": "d", "issuer": "i"}],
    "publications": [{"publicationName": "p"}],
    "skills": [],
    "personal_projects": [{"projectName": "p", "highlights": ["h"], "keywords": []}],
    "unknown": 3,
}


def paths(value, at=()):
    """Every path to a value whose type matters."""
    yield at
    if isinstance(value, dict):
        for k, v in value.items():
            if k != "unknown":
                yield from paths(v, (*at, k))
    if isinstance(value, list):
        for i, v in enumerate(value):
            yield from paths(v, (*at, i))


def with_value(at, new):
    out = json.loads(json.dumps(GOOD))
    place = out
    for k in at[:-1]:
        place = place[k]
    place[at[-1]] = new
    return json.dumps(out)


def errors(spark, raws):
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string").coalesce(1)
    return [r["errors"] for r in J.validate(df, "raw").orderBy("i").collect()]


def test_a_good_resume_has_no_errors(spark):
    assert errors(spark, [json.dumps(GOOD), '{"basics": {}}']) == [[], []]


def test_a_wrong_type_at_every_path(spark):
    every = [p for p in paths(GOOD) if p]
    got = errors(spark, [with_value(p, 42) for p in every])
    for p, found in zip(every, got):
        camel = {"certificate_name": "certificateName", "date_issued": "dateIssued"}.get(p[-1], p[-1])
        name = ".".join(str(x) for x in (*p[:-1], camel))
        shown = "N/A" if camel != p[-1] else "42"
        assert len(found) == 1 and found[0].startswith(f"{name}: Input should be a valid ") and found[0].endswith(f"(value: '{shown}')"), (p, found)
    assert len(every) > 30


@pytest.mark.parametrize(
    "path, value, message",
    [
        (("workexp", 0, "position"), None, "workexp.0.position: Input should be a valid string (value: 'None')"),
        (("workexp", 0), "x", "workexp.0: Input should be a valid dictionary or instance of WorkExperience (value: 'x')"),
        (("education", 0), False, "education.0: Input should be a valid string (value: 'False')"),
        (("skills",), {"a": 1}, "skills: Input should be a valid list (value: '{\"a\":1}')"),
        (("basics",), None, "basics: Input should be a valid dictionary or instance of BasicInformation (value: 'None')"),
        (("basics", "languages", 0), {}, "basics.languages.0.language: Field required (value: 'N/A')"),
    ],
)
def test_messages(spark, path, value, message):
    assert errors(spark, [with_value(path, value)]) == [[message]]


def test_what_is_no_object_is_invalid(spark):
    assert errors(spark, ["[1]", "5", "", "{", None, '{"basics": }']) == [["Invalid JSON"]] * 6


def test_several_errors_in_order(spark):
    raw = '{"workexp": [{"position": 1}, 2], "skills": [3, "x", null]}'
    assert errors(spark, [raw]) == [
        [
            "basics: Field required (value: 'N/A')",
            "workexp.0.companyName: Field required (value: 'N/A')",
            "workexp.0.position: Input should be a valid string (value: '1')",
            "workexp.1: Input should be a valid dictionary or instance of WorkExperience (value: '2')",
            "skills.0: Input should be a valid string (value: '3')",
            "skills.2: Input should be a valid string (value: 'None')",
        ]
    ]
