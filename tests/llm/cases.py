"""Rows with the awkward cases that every operator must take."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
#: Columns beside those of documents, named like columns that the operators use inside.
EXTRA = ["node", "n", "point", "h", "text_sha256", "sequence_id", "bucket", "root", "list", "a", "b", "size", "start", "word"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)
LONG = " ".join(f"palabra{i % 977} larga{i}." for i in range(30_000))
PLAIN = "The river ran over the old stones while seven patient herons watched the grey water and waited for fish to come near the bank in the evening light."
#: (doc_id, text, lang, source): nulls in every column, empty, blank, very long, equal, near equal and repeated rows.
ROWS = [
    (None, None, None, None), (1, None, "en", None), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, "a"), (4, "one", "en", "a"), (5, "one two three", "en", "b"), (6, "ONE two\tthree", "en", "b"),
    (7, PLAIN, "en", "a"), (8, PLAIN, "en", "a"), (8, PLAIN, "en", "a"), (9, PLAIN.replace("The river", "A river"), "en", "a"), (10, PLAIN + "  ", "en", "a"), (11, LONG, "es", "a"), (12, LONG + " fin", "es", None),
    (13, "x" * 60_000, "en", "a"), (None, PLAIN, "en", "a"), (14, "a b \U0001f642 été İ ẞ", "fr", "a"), (15, "123 456 !!", "en", "a"), (16, "A B C D E F G H", "en", "a"), (17, "a b c d e f g h", "en", "a"),
]
