"""Small documents with every oddity that operators have defined results for."""

ODD = ("doc_id long, text string, lang string, source string, n_chars long, n int, start long, key string, "
       "label int, class_id long, row string")


def odd_documents(spark, texts=()):
    long = "word " * 30_000
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, long), (5, "Same text here."), (5, "Same text here."),
            (None, "No id at all, but words."), (6, "!!! ???"), (7, "a")]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    extra = [(i, t, "en" if i else None, None if i == 5 else "s", None, 1, 2, "k", 1, 3, "r") for i, t in rows]
    return spark.createDataFrame(extra, ODD)


def no_documents(spark):
    return odd_documents(spark).limit(0)
