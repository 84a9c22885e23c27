"""tableflow: move tables between systems with their quality under control, on Spark.

Rules are built-in Column expressions; operators are DataFrame -> DataFrame
functions, so Catalyst plans the whole job and nothing passes through the driver.
"""

__version__ = "0.1.0"
