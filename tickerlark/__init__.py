"""Trading-sentiment analytics over tables and streams of short posts, on PySpark.

Every operator is a function ``op(df, **params) -> DataFrame`` and chains with
``DataFrame.transform``. See README.md for the map of modules.
"""

from tickerlark.params import DEFAULTS, Params

__all__ = ["DEFAULTS", "Params"]
