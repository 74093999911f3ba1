"""adlake: a Spark-native lakehouse for advertising report data.

Layers: bronze (raw report tables) -> silver (typed, cleaned) -> gold (star
schema) -> KPI tables -> report tables.  Everything is DataFrame / SQL work
that Catalyst plans; there are no UDFs.
"""

__version__ = "0.1.0"
