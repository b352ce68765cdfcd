"""Operations of a training-data pipeline over crawled documents.

One module per operator; ``queries`` registers a thin query for each. Nothing
else in the library imports this subpackage.
"""
