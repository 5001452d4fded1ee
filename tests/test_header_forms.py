import pytest

from corpuslens.functions.header_forms import LADDERS
from corpuslens.operators import metadata as M

HEADING = "The Project Gutenberg EBook of A Tale, of Two, by Jane Roe"
CASES = [
    ("title", "label", "Title: A Tale", "A Tale"),
    ("title", "heading", HEADING, "A Tale, of Two"),
    ("title", "heading", "Project Gutenberg Etext of Emma", "Emma"),
    ("release_date", "release", "Release Date: May 2, 1999 [EBook #1]", "May 2, 1999"),
    ("release_date", "posting", "Posting Date: June 1, 2001 [EBook #2]", "June 1, 2001"),
    ("release_date", "first posted", "First posted: July 3, 2004 [eBook #3]", "July 3, 2004"),
    ("release_date", "last updated", "Most recently updated: 2020-01-02", "2020-01-02"),
    ("release_date", "last updated", "Last Updated: 2020-01-03", "2020-01-03"),
    ("language", "label", "Language: English", "English"),
    ("language", "written in", "Written in: French", "French"),
    ("encoding", "label", "Character set encoding: UTF-8", "UTF-8"),
    ("encoding", "short label", "Encoding: ASCII", "ASCII"),
    ("encoding", "charset", '<meta content="text/html; charset=utf-8">', "utf-8"),
]


def found(books, *texts):
    return {r["file_name"]: r.asDict() for r in M.metadata_by_form(books(*texts)).collect()}


def test_every_form_is_tried(books):
    rows = found(books, *[f"one\n{line}\nlast" for _, _, line, _ in CASES])
    for i, (field, form, _, value) in enumerate(CASES):
        row = rows[f"b{i}"]
        assert (row[field], row[f"{field}_form"]) == (value, form)
        others = [f for f in LADDERS if f != field]
        assert all(row[f] is None and row[f"{f}_form"] is None for f in others), row
    assert {(f, form) for f, form, _, _ in CASES} == {(f, form) for f, ladder in LADDERS.items() for form, _ in ladder}


@pytest.mark.parametrize("field", LADDERS)
def test_the_highest_form_wins_wherever_it_stands(books, field):
    lines = {form: (line, value) for f, form, line, value in CASES if f == field}
    order = [form for form, _ in LADDERS[field]]
    for i, form in enumerate(order):
        text = "\n".join(lines[f][0] for f in reversed(order[i:]))
        row = found(books, text)["b0"]
        assert (row[field], row[f"{field}_form"]) == (lines[form][1], form)


def test_odd_texts(books):
    rows = found(books, None, "", "Title:   ", HEADING + "\nTitle: X")
    for name in ("b0", "b1"):
        assert all(v is None for k, v in rows[name].items() if k != "file_name")
    assert (rows["b2"]["title"], rows["b2"]["title_form"]) == ("", "label")
    assert (rows["b3"]["title"], rows["b3"]["title_form"]) == ("X", "label")


def test_the_first_forms_are_the_usual_fields(books):
    texts = [line for _, _, line, _ in CASES] + [None, "Title: a\nLanguage: b", "Title:\n\n  Foo"]
    usual = {r["file_name"]: r for r in M.metadata(books(*texts)).collect()}
    for name, row in found(books, *texts).items():
        for field, first in (("title", ("label",)), ("language", ("label",)), ("encoding", ("label",)), ("release_date", ("release", "posting"))):
            assert usual[name][field] == (row[field] if row[f"{field}_form"] in first else None)


def test_counts(books):
    counts = {(r["field"], r["form"]): r["n"] for r in M.form_counts(M.metadata_by_form(books("Title: a", HEADING, "x"))).collect()}
    assert counts[("title", "label")] == counts[("title", "heading")] == counts[("title", None)] == 1
    assert counts[("language", None)] == 3
