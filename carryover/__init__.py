"""carryover: copy, register and validate tables on Spark.

Sub-packages:

* ``sources``   — catalog tables and Parquet paths (S1–S11)
* ``operators`` — write modes, registration, export, counts, fingerprints, file statistics
* ``plans``     — check runner, batch migration, staging, catalog profiles
* ``functions`` — driver-side helpers over names and check values

Modules: ``session`` (scratch location, local session), ``jobs`` (job labels
and scheduler pools), ``config`` / ``cli`` (YAML runs, ``python -m carryover``),
``keys`` (one function per inventory key, used by ``__spark_entry__``).
"""

__version__ = "0.1.0"
