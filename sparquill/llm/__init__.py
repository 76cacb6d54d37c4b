"""Operations of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames and leaves columns that it does not know untouched.
"""
