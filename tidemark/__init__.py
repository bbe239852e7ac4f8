"""tidemark: sensor-reading and market-bar analytics as Spark DataFrame plans.

Subpackages
-----------
sources    test-table loading, derived fixtures, the synthetic reading source, IO sinks
functions  column expressions: exact decimal moments, calendar parts, hash draws
operators  DataFrame -> DataFrame operators (series windows, profiles, reshape,
           bar cleaning and metrics, upsert, serving queries, data-quality checks)
plans      end-to-end chains and the registry of named queries with their SQL oracles
llm        operators of a training-data pipeline; nothing else imports it
"""

__version__ = "0.1.0"
