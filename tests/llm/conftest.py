import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, in several partitions."""

    def build(rows, partitions=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return build


PROSE = (
    "the quick river moved along {0} stones while seven {1} birds watched over the {2} valley and nobody"
    " asked why morning {3} lights burned so long behind that old {4} mill where rain had fallen since"
    " autumn {5} came early this year with cold hands and {6} promises that few people ever kept for more"
    " than {7} days in a row because every road leads somewhere else when the {8} snow begins to melt {9}"
)


@pytest.fixture(scope="session")
def prose():
    """Distinct invented text of about 80 words; equal numbers give equal text."""

    def make(number, times=1):
        words = [[f"w{number}x{k}y{i}" for i in range(10)] for k in range(times)]
        return " ".join(PROSE.format(*w) for w in words)

    return make


@pytest.fixture
def odd_rows(prose):
    """NULLs, empty and blank texts, repeated rows, ties, a long text and odd characters."""
    long = prose(1, 300)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, prose(5)), (6, prose(5)), (7, prose(5) + " "),
        (8, long), (8, long), (None, prose(9)), (None, None), (10, "naïve Ünïcode \x00 \x1c text\r\n x  y"),
        (11, "x " * 400), (12, "a b c d e"), (13, "A b C d E"),
    ]
