"""billstar: a Spark-native invoice lakehouse.

Multi-source billing files -> raw (bronze) copy -> standardised silver ->
quality gate -> staging -> star schema (4 dimensions + invoice fact) ->
isolation-forest anomaly labels -> collection (relance) mart, plus views
and reports. Every step is a DataFrame -> DataFrame function; persistence
lives in :mod:`billstar.plans.warehouse` and :mod:`billstar.plans.runner`.
"""

__version__ = "0.1.0"
