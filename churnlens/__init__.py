"""churnlens: customer-attrition analytics expressed as Spark DataFrame / SQL / ML plans.

Every operator takes and returns DataFrames (or fitted ``pyspark.ml`` models) and stays on
built-in JVM expressions; nothing row-level is collected to the driver.
"""

__version__ = "0.1.0"
