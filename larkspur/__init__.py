"""larkspur: governed event ingestion and lakehouse tables on PySpark.

JSON events are decoded and validated, routed to catalog-declared tables,
coerced to the declared column types, staged as Parquet with a manifest,
merged into larger files and committed through a ledger so that readers only
see whole merges. Everything is expressed with DataFrame / Structured
Streaming operators; see the sub-packages:

* ``functions`` - column builders (coercion, time parsing, ids, keys)
* ``sources``   - envelope decode/encode, catalog scan, event sources
* ``operators`` - validation, projection, grouping, staging, compaction,
                  publish, read, schema evolution
* ``streaming`` - the ``foreachBatch`` ingest query
* ``plans``     - the registered queries and their DuckDB oracles
"""

__version__ = "0.1.0"
