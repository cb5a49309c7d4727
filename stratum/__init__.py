"""stratum: layered (bronze -> silver -> gold) analytics on Spark.

Everything is a DataFrame transformation built from Catalyst expressions:

* ``stratum.functions``  Column-level building blocks (cleaning, banding,
  date parts, rollup measures) and the fixed vocabularies they use.
* ``stratum.operators``  DataFrame -> DataFrame operators (quality flags and
  quarantine, latest-per-key, keyed upsert, change rows, calendar gate).
* ``stratum.sources``    Table layout, reads/writes, CSV calendar, the bronze
  adapters over the benchmark tables.
* ``stratum.streaming``  Incremental CSV ingest with lineage and schema
  evolution, incremental bronze -> silver append.
* ``stratum.plans``      The silver cleaners (V1-V8) and gold marts (G1-G9).
"""

from stratum.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
