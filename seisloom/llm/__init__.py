"""Operations of a training-data pipeline (text, URLs, tokens, vectors, media) on Spark.

Nothing outside this subpackage imports it.
"""
