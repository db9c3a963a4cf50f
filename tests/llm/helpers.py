"""Small tables with the awkward rows every operator has to take, and sf0.001 as pandas."""

import pyarrow.dataset as ds

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "bucket string, h1 string, pos string, line string, rep string, label string, length string, "
    "score string, term string, word string, component_id string, kept string, place string, copy string"
)
LONG = " ".join(f"word{k % 977}x{k}" for k in range(30_000))
SHARED = "a line that is long enough to be counted as a shared one indeed"


def edge_rows():
    texts = [
        (None, "no id at all, but words"),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, LONG),
        (5, "the same text twice"),
        (5, "the same text twice"),
        (6, "x"),
        (7, "Ünï cödé ünd so weiter"),
        (8, SHARED + "\nown one"),
        (9, SHARED + "\nown two"),
        (10, SHARED.upper() + " \nown three"),
        (11, SHARED + "\n" + SHARED),
        (12, SHARED),
        (13, "!!! ??? ..."),
        (14, "the same text twice"),
    ]
    return [(i, t, "en" if i and i % 2 else None, None, None, *["x"] * 14) for i, t in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def pandas(name):
    return ds.dataset(f"{SF}/{name}.parquet").to_table().to_pandas()


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
