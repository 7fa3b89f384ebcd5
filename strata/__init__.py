"""strata: tested, parameterised DataFrame -> DataFrame operators for layered
(bronze / silver / gold) analytics on Spark.

Every operator is a plain function over DataFrames; Catalyst plans the work.
"""

__version__ = "0.1.0"
