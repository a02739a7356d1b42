"""Small document tables with nulls, repeats and columns that clash with working names."""

DOCS = "doc_id long, text string, fp long, key string, component string, items string, sequence_id string, v string, seg long"


def docs(spark, rows):
    """(doc_id, text) rows with extra columns under names the operators use inside."""
    return spark.createDataFrame([(d, t, 1, "k", None, "i", "s", None, 0) for d, t in rows], DOCS)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
