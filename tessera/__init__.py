"""tessera: Spark-native IT service-desk analytics.

Source contracts (``sources``) -> conformed marts (``plans.marts_*``) ->
measures with filter context and time intelligence (``plans.measures``,
``operators.timeintel``) -> dashboard queries (``plans.pages``) ->
quality / backfill / deploy jobs and streaming refresh.
"""

__version__ = "0.1.0"
