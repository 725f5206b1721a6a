"""caseflow: support-ticket analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
built-ins; the batch wiring lives in :mod:`caseflow.plans.pipeline`.
"""

__version__ = "0.1.0"
