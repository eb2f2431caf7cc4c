"""opsgrain: warehouse-operations reporting on Spark.

Raw event telemetry and inventory snapshots become one work-event grain
(paired sessions, bin presentations, completed lines, completed orders);
roll-ups, report pages, measures and data-quality gates are DataFrame
functions over that grain.
"""

__version__ = "0.1.0"
