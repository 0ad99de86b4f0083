"""sparkplate: medallion analytics and recommendations for review-and-rating data on PySpark.

Every operator is a function ``DataFrame(s) -> DataFrame`` on the public Spark API.
Sub-packages:

* ``sources``   – raw readers, catalog reads/writes, analog views over the driver tables
* ``functions`` – column-expression helpers (dates, text, numbers, scoring)
* ``operators`` – silver/gold models, dashboard aggregates, ids, look-ups, scoring,
  TF-IDF content similarity, time split, ALS, data quality, run metrics
* ``plans``     – the end-to-end pipeline, query registry and plan checks
* ``streaming`` – incremental (file-stream) form of the bronze ingest
"""

from sparkplate.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
