"""Small awkward tables for the operators."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = (
    "The morning train left the station on time, and nobody in the first carriage said a word "
    "about the weather. A child counted the bridges until she fell asleep. "
)

AWKWARD = [
    (5, None, "en", "a", None),
    (3, "", None, "a", 0),
    (None, "text without an id and some words after that", "en", None, 3),
    (7, " \n\t \n", "en", "b", 5),
    (9, "one", "en", "b", 3),
    (11, "repeated row of exactly eight words in it", "en", "c", 1),
    (11, "repeated row of exactly eight words in it", "en", "c", 1),
    (12, "repeated row of exactly eight words in it", "en", "c", 1),
    (13, "naïve Ünïcödé \U0001f600 текст 漢字 ԯ׆   <|endoftext|> it's 12345", "fr", "c", 1),
    (14, PROSE * 400, "en", "long", 1),
    (20, "same id, first text, with enough words to be a shingle", "en", "c", 1),
    (20, "same id, second text, other words than in the first one", "en", "c", 1),
    (-4, "a negative id", "en", "", 1),
]


def awkward(spark, **extra):
    """The table above, with further columns under clashing names."""
    docs = spark.createDataFrame(AWKWARD, DOCS)
    return docs.withColumns({name: F.lit(value) for name, value in extra.items()})


def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
