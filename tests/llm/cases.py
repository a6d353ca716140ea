"""Small tables for the operators: odd rows, copies, long texts."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = "ka lo mi ru ten sha vor eli dun qua pei nor".split()
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(2, 4))) for _ in range(n))


def row(i, text, source="a"):
    return (i, text, "en", source, None if text is None else len(text))


def odd_rows():
    """Null and empty texts, null ids and sources, repeated rows, equal ids, a very long text, letters of many kinds."""
    long_text = prose(1, 20_000)
    return [
        row(1, None), row(2, ""), row(3, " \t\n\x0b\f\r "), row(4, "one"), row(5, "Two\u00a0words \u00c9T\u00c9 \u4e2d\u6587 \U0001f600 \x1c\x85"),
        row(None, "a text without an id " + prose(2, 30)), row(None, None, None), row(6, prose(3, 60), None), row(6, prose(3, 60), None),
        row(7, prose(4, 40)), row(7, prose(5, 40)), row(8, long_text, "b"), row(9, long_text + " end", "b"), row(10, "x " * 300, "b"),
    ]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def store(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def with_clashes(df):
    """Extra columns with the names that operators use inside."""
    from pyspark.sql import functions as F

    for c in ("row", "key", "fp", "size", "copies", "rate", "_quality", "target", "taken", "doc", "w", "shape"):
        df = df.withColumn(c, F.lit("extra"))
    return df
