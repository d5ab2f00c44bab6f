"""fathom: a Spark-native library of relational analytics queries.

The package is organised the way a Spark user would organise it:

* ``sources``   – reading the base Parquet tables and deriving the domain
                  tables (catalog, fleet, cash ledgers, flights) from them.
* ``functions`` – column-expression helpers (dialect forms, text classes).
* ``operators`` – reusable DataFrame -> DataFrame operators (either-key join,
                  ALL comparison, top-with-ties, ledgers, global numbering...).
* ``plans``     – the analytical queries themselves, each registered with an
                  equivalent SQL text used as an independent oracle.
* ``streaming`` – the ledger aggregations as Structured Streaming queries.
"""

from fathom.session import build_session

__all__ = ["build_session"]
