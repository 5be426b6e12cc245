"""Small frames for the training-data operators' tests."""


def documents(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, langs[i] if langs else None) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string")
