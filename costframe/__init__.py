"""costframe: cloud-cost and usage analytics as Spark DataFrame plans.

Subpackages: ``functions`` (Column expressions), ``sources`` (scans),
``operators`` (normalisers, conform, upsert), ``plans`` (reports, checks,
load jobs), ``streaming`` (incremental loads).  See README.md.
"""

__version__ = "0.1.0"
