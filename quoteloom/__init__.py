"""quoteloom: incremental loading of keyed daily series into tables, on Spark.

Every operator is a plain function over DataFrames; the caller owns the
SparkSession.  See README.md for the map of modules.
"""

from quoteloom.contract import Contract, ContractBook, Field
from quoteloom.errors import ContractError, LoadError

__all__ = ["Contract", "ContractBook", "ContractError", "Field", "LoadError"]
