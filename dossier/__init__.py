"""Document screening as Spark jobs.

Sub-packages: ``sources`` (readers, writers, file listings), ``functions``
(column expressions), ``operators`` (DataFrame to DataFrame), ``streaming``
(incremental file processing) and ``plans`` (the registered queries).
"""
