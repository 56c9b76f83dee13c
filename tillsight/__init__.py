"""tillsight — retail customer analytics as Spark DataFrame operators.

Layers:
  sources/    read raw invoice lines, write and read the star schema
  functions/  Column builders (trim, title case, money rounding, date parts, classifiers)
  operators/  ETL steps (clean, enrich, RFM, keys, star), distributed ranking, skew-safe joins
  plans/      the analytics marts over the star, one function per business question
  streaming/  nothing: the pipeline is batch only
  oracle/     DuckDB SQL used to check every mart
  warehouse   the star for a data folder, built once per session
  __main__    ``python -m tillsight build|mart``
"""

from tillsight.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
