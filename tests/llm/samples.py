"""Rows that every operator must take."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# besides the columns of the table: names that operators use themselves, and one that differs in case only
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("Text", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("line", T.StringType()), T.StructField("tie", T.StringType()),
])
LABELS = "doc_id long, quality int, toxic int, y string"

LONG = " ".join(f"word{i % 997}" for i in range(60_000))


def rows():
    plain = "a quiet line about the weather in the north\nand one more line that says nothing new at all"
    out = [
        (1, plain, "en", "a", len(plain)),
        (2, plain, "en", "a", len(plain)),
        (3, None, "en", None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", None, "b", 4),
        (6, LONG, "en", "c", len(LONG)),
        (7, plain.replace("quiet", "quyet"), "en", None, len(plain)),
        (8, "Ça va très bien, merci. Здравствуйте 你好 <|endoftext|> <s> \U0001f600", "fr", "a", 40),
        (8, "Ça va très bien, merci. Здравствуйте 你好 <|endoftext|> <s> \U0001f600", "fr", "a", 40),  # a repeated row
        (None, plain, "en", "c", None),
        (9, "nul \x00 and \x1c control \x85 marks", None, "", 10),
    ]
    return [r + ("x", "y", "z", "f", "l", "t") for r in out]
