"""snapfacet: snapshot ETL and faceted search on Spark.

Column functions live in ``snapfacet.functions``, DataFrame operators in
``snapfacet.operators``, sources and sinks in ``snapfacet.sources``, jobs and the registered
queries in ``snapfacet.plans`` and the stream intake in ``snapfacet.streaming``.
"""

__version__ = "0.1.0"
