import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHING = ("kept", "row", "found_id", "fp", "a", "b", "place", "key", "words", "n_tokens", "component_id", "_kept_id")

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil magic jugs of very cold rain"


def unlike(seed: int, words: int) -> str:
    """Words that no other seed has."""
    return " ".join(f"w{seed}x{i}" for i in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    shared = unlike(900, 70)
    return [
        (1, None, "en", "s1", 0),
        (2, "", "en", "s1", 0),
        (3, " \t\n \n", None, "s2", 5),
        (4, unlike(4, 300), "en", None, None),
        (None, unlike(5, 80), "en", "s3", 1),
        (None, None, None, None, None),
        (7, PROSE, "en", "s1", 9),
        (7, PROSE, "en", "s1", 9),
        (8, PROSE, "de", "s2", 9),
        (9, unlike(9, 60) + " " + shared, "en", "s1", 1),
        (10, shared + " " + unlike(10, 60), "fr", "s4", 1),
        (11, unlike(11, 30_000), "en", "s1", 1),
        (12, "na " * 5_000, "en", "s5", 1),
        (13, "na " * 4_000 + unlike(13, 5), "en", "s5", 1),
        (14, "é" * 3_000 + " ñandú 漢字 🙂", "es", "s6", 1),
        (15, "Shared footer line of the site.\n" + unlike(15, 40), "en", "s1", 1),
        (16, "Shared footer line of the site.\n" + unlike(16, 40), "en", "s2", 1),
        (17, unlike(17, 40) + "\n Shared footer line of the site.", "en", "s3", 1),
        (18, "Shared footer line of the site.\n" + unlike(18, 40), "en", "s4", 1),
        (19, unlike(19, 20) + "\nShared footer line of the site.\n" + unlike(190, 20), "en", "s5", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
