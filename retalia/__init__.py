"""retalia: retail analytics as PySpark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` on built-in Spark
SQL expressions; there is no Python UDF anywhere in the package.
"""

from retalia.params import Params

__all__ = ["Params"]
