"""Small document tables with the cases that every operator must handle."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: The names that operators give to columns of their own.
CLASHING = ["keep_id", "digest", "id", "hash", "clean", "lang_pred", "score", "c0", "class_id", "key", "block", "n_tokens", "word", "entity", "t", "sequence_id"]


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang); with columns that clash with the operators' own."""
    full = [(row[0], row[1], row[2] if len(row) > 2 else "en", None, None) for row in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def odd_rows():
    """Null in any column, empty and blank texts, ties, repeated rows, control and private-use characters."""
    return [
        (None, "a text without an identifier", None),
        (None, None, None),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \t\n\x0b\x0c\r ", "en"),
        (6, "same words here", "en"),
        (7, "same \n words\there", "fr"),
        (7, "same \n words\there", "fr"),
        (8, "x\x1cy z   w   ", None),
        (9, "été ß ﬃ 日本語 😀 \u0000 end", "de"),
        (10, "12345 67890 !!!", None),
    ]
