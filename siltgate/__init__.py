"""Data-quality and reporting jobs on PySpark.

Everything here takes DataFrames and gives DataFrames back.  Nothing is collected
to the driver and no UDF is used; the few functions that run a job of their own
(sinks, streams, a measured broadcast) say so.
"""

from siltgate.spec import ForeignKey, TableSpec, retail_specs

__all__ = ["ForeignKey", "TableSpec", "retail_specs"]
