"""meridian: user-level product-analytics and causal-inference operators on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
DataFrame / SQL / MLlib primitives and parameterised by column names.
"""

__version__ = "0.1.0"
