import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, rank int, n long"

LONG = "word " * 30000
ROWS = [
    (1, "The same  text\there.", "en", "a"),
    (2, "The same text here.", "en", "b"),
    (None, "The same text here.", "en", "b"),
    (3, None, None, None),
    (4, "", "en", None),
    (5, " \n\t ", "fr", "a"),
    (6, LONG, "en", "a"),
    (7, "La même chose, été, déjà vu: l'eau et le vin de la maison.", "fr", "c"),
    (7, "La même chose, été, déjà vu: l'eau et le vin de la maison.", "fr", "c"),
    (8, "one two three", "en", "b"),
    (9, "one two three", "en", "b"),
    (10, "12345 !!! ...", "en", "b"),
]


def edge_docs(spark, rows=ROWS):
    """Nulls, blanks, a long text, ties, repeated rows, and columns with clashing names."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", 7, 3) for i, t, lang, s in rows], SCHEMA)


def docs_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
