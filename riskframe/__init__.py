"""riskframe: outcome-risk analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames; the heavy lifting is done by
Catalyst-planned expressions, aggregates, joins and windows.  Python code in
tasks is limited to the few places Spark has no built-in (partial Gram
matrices for LSA, tree-path contributions).
"""

__version__ = "0.1.0"
