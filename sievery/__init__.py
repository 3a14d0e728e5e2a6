"""sievery: chat-workspace sieve, payload building and delivery on Spark.

Modules: ``sources`` (API pages, landing writers, adapter views),
``functions`` (Column rules), ``operators`` (DataFrame operators),
``sinks`` (payload tables and delivery), ``streaming`` (stream twins),
``plans`` (jobs, registered queries and their SQL twins).
"""

__version__ = "0.1.0"
