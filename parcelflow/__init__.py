"""parcelflow: a Spark-native ledger for regional property listings and the monthly
statistics around them.

Everything is a DataFrame -> DataFrame function over Spark; I/O lives in
``parcelflow.plans.sinks`` and ``parcelflow.plans.jobs``.
"""

__version__ = "0.1.0"
