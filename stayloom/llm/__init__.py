"""Operations of a training-data pipeline over a corpus of documents.

Every operator takes DataFrames and returns DataFrames; `queries` binds them to the given tables.
"""
