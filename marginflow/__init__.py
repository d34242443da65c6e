"""marginflow: marketing-agency analytics on Spark.

Layers, each a set of DataFrame -> DataFrame functions:

* ``sources``    raw source schemas, readers, sinks and the testdata adapter
* ``functions``  column-level helpers (rounding, guarded ratios, text rules)
* ``operators``  reusable relational operators (cleansing, lookup joins,
                 two-tier cost allocation, conditional aggregates, checks)
* ``plans``      the published models (operational and business layer),
                 data-quality contracts and analyst queries
* ``streaming``  intentionally empty: every model is a full rebuild
"""

from marginflow.session import get_session

__all__ = ["get_session"]
