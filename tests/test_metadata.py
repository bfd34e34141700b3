import pytest

from lectern.operators import metadata

BOOK = (
    "Title: The Long Walk Home\nRelease Date: May 4, 1999\nLanguage: English\n"
    "Character set encoding: ISO-8859-1\nbody\n"
)


@pytest.fixture
def books(spark):
    texts = [
        BOOK,
        "Title: Short\nRelease Date: July 14, 0999\nLanguage: French\n",
        "no header",
        "Release Date: June 1, 1999\nLanguage: English",
        "Language: French\nTitle:",
    ]
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)


def test_units(books):
    by_line = metadata.header_metadata(books)
    by_document = metadata.header_metadata(books, unit="document")
    assert by_line.count() == 10
    assert by_document.count() == 4
    full = by_document.where("title LIKE 'The%'").first()
    assert tuple(full) == ("The Long Walk Home", "May 4, 1999", "English", "ISO-8859-1")
    with pytest.raises(ValueError):
        metadata.header_metadata(books, unit="page")


def test_row_counts(books):
    assert tuple(metadata.metadata_row_counts(books).first()) == (13, 10)
    assert tuple(metadata.metadata_row_counts(books, unit="document").first()) == (5, 4)


def test_years(books):
    found = metadata.header_metadata(books)
    assert [tuple(r) for r in metadata.releases_per_year(found).collect()] == [("1999", 2)]
    assert tuple(metadata.release_year_stats(found).first()) == (2, "1999", "1999")
    assert [tuple(r) for r in metadata.top_release_years(found).collect()] == [("1999", 2)]


def test_languages_break_ties_by_name(books):
    found = metadata.header_metadata(books)
    assert [tuple(r) for r in metadata.language_counts(found).collect()] == [("English", 2), ("French", 2)]
    assert tuple(metadata.language_summary(found).first()) == ("English", 2, 4)


def test_titles(books):
    found = metadata.header_metadata(books)
    assert tuple(metadata.title_length_stats(found).first()) == (11.5, 5, 18, 2)
    assert [tuple(r) for r in metadata.title_length_histogram(found).collect()] == [(0, 1), (10, 1)]


def test_missing_fields(books):
    assert tuple(metadata.missing_field_report(metadata.header_metadata(books)).first()) == (8, 7, 6, 9)


def test_profile(spark):
    frame = spark.createDataFrame([("a", 1.0), (None, 2.0)], "name string, size double")
    assert [tuple(r) for r in metadata.book_profile(frame).collect()] == [
        ("name", "string", 1, 2), ("size", "double", 2, 2)
    ]
