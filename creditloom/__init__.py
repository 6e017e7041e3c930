"""Credit-portfolio analytics as Spark DataFrame operators.

``functions``   Column expressions (dates, text, numbers, bands, rules)
``operators``   DataFrame -> DataFrame building blocks (dedupe, joins, KPIs, profiling, checks)
``sources``     scans, sinks and table registration
``plans``       the domain pipelines composed from the operators
``streaming``   incremental pick-up of late snapshot files
``catalog``     the query catalogue used by ``__spark_entry__``
"""

from creditloom.session import spark_session
from creditloom.settings import Settings

__all__ = ["Settings", "spark_session"]
