"""cardlens: a Spark-native feature engine for card-transaction logs.

Operators are plain functions ``DataFrame -> DataFrame`` (or functions that
return ``Column`` lists for one fused aggregate).  Nothing here collects data
to the driver except small fitted value lists and model parameters.
"""

__all__ = ["session"]
