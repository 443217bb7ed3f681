"""Odd tables that every operator must handle, and small helpers."""



DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SENTENCE = "the cat sat on the mat and looked at the dog in the garden of the old house by the river "


def documents(spark, rows, extra=True):
    """Rows of (doc_id, text, source); with columns whose names operators use themselves."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(full, DOCS)
    if not extra:
        return df
    for name in ("row", "score", "runs", "key", "h", "part", "kept", "slot", "ids", "label"):
        df = df.selectExpr("*", f"concat('own ', '{name}') AS {name}")
    return df


def odd_rows():
    """Nulls in every column, empty, blank, one-word and very long texts, repeated rows and ids."""
    long = " ".join(f"word{i % 5000}" for i in range(60_000)) + "\n" + "x" * 300_000
    return [
        (1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, "one", "b"), (4, "one", "b"),
        (5, SENTENCE * 6, "b"), (5, SENTENCE * 6, "b"), (5, "other text under the same id", "c"),
        (None, SENTENCE * 6, "a"), (None, None, None), (6, long, "a"), (7, "ÀÉ ñ 漢字 🙂 \x00 \x1c end\r\n", "a"),
        (8, "\n".join([SENTENCE * 4] * 5), "b"), (-9, SENTENCE * 7, "b"),
    ]
