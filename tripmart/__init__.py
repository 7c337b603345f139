"""tripmart: a Spark-native lakehouse for monthly trip records.

Layers, all expressed as DataFrame / Spark SQL plans:

* landing  -- decide which published files are new, revised, present or unavailable
* silver   -- contract-typed months with seven quality flags, one partition per month
* gold     -- clean trips aggregated by month, pickup zone and hour
* checks   -- data tests written as queries that return violations
* serving  -- filtered, limited questions on the mart
"""

__version__ = "0.1.0"
