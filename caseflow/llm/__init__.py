"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries only when it can be imported.  One module per operator, each
with its method, its parameters and its defined results for odd rows in the
module text; :mod:`caseflow.llm.catalog` holds the registered queries.
"""
