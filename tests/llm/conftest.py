import pytest

SF001 = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, norm string, sha int, size string, h int, row string, fp string, key int, score string, quality string, "
          "taken string, word binary, _score double, rank int, found string, root string, x string")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from allelic.llm.common import ship_package
    ship_package(spark)


def odd_rows():
    """(doc_id, text, source): nulls, empty, very long and repeated texts and ids."""
    passage = "one two three four five six seven eight nine ten eleven twelve"
    long_text = " ".join(f"Word{i % 977} is, {i}." for i in range(60_000))
    rows = [(1, "alpha beta gamma", "a"), (2, "alpha  beta\tgamma", "a"), (3, "alpha beta gamma", None),
            (4, None, "b"), (5, "", "b"), (6, " \n\t ", None), (7, long_text, "c"), (8, long_text, "c"),
            (9, f"before {passage} after", "a"), (10, passage.upper(), "d"), (11, "<|endoftext|> café \U0001f600  x", "d"),
            (12, "Mail a.b+c@mail.example.com or +1 (456) 555-2186, 42.144.35.254; 4041894974608795!", "a"),
            (12, "the same id again", "a"), (13, "twice", "e"), (13, "twice", "e"), (None, "twice", "e"), (None, None, None),
            (None, "no id", "f"), (15, "All rights reserved. CC BY-NC 4.0, GNU General  Public License", "a"),
            (16, "a\x00b \x1c c\x7fd", "a"), (-17, "negative id", "a")]
    return rows + [(100 + i, "hot text of many copies", "a") for i in range(40)]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows in a table with many more columns, whose names clash."""
    rows = [(i, t, None if i is None else "en", s, None if i == 9 else 5, "i", "n", 1, "s", 2, "r", "f", 3, "sc", "q", "t", b"w", 0.5, 4, "fo", "ro", "x")
            for i, t, s in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
