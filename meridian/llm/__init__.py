"""Operations of a large-scale training-data pipeline.

Every module holds one operator with its general interface; ``catalog`` binds
the operators to the driver's tables. Nothing outside this package imports it.
"""
