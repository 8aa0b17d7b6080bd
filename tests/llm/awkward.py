"""Rows that every operator must take: nulls, empty and very long texts, repeats, further columns."""

LONG = "word and other words that go on. " * 30_000


def documents(spark, texts, partitions=3):
    """Documents numbered from 0, with a column that clashes with names operators may use."""
    rows = [(k, text, "en", f"src{k % 2}", 0, k) for k, text in enumerate(texts)]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, hits long"
    )
    return spark.createDataFrame(rows, schema).repartition(partitions)


def awkward_rows(spark):
    """Every column null in turn, repeated rows, and a long text; columns as of documents, and more."""
    rows = [
        (1, "plain text here. more of it.", "en", "a", 1, 1, 1, 0.5, "x"),
        (1, "plain text here. more of it.", "en", "a", 1, 1, 1, 0.5, "x"),
        (2, None, "en", "a", 1, 1, 1, 0.5, "x"),
        (3, "", None, "a", 1, 1, 1, 0.5, "x"),
        (4, " \n\t .!? ", "de", None, 1, 1, 1, 0.5, "x"),
        (None, "no id but a text", "en", "a", None, None, None, None, None),
        (5, LONG, "en", "a", 1, 1, 1, 0.5, "x"),
        (6, "é ü 漢字 🙂 \x00 \x85 end", "fr", "a", 1, 1, 1, 0.5, "x"),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long,"
        " hits long, left long, score double, component_id string"
    )
    return spark.createDataFrame(rows, schema)
