"""dimweave: warehouse dimension and fact loading on Spark.

Change events (batch tables or Structured Streaming micro-batches) are turned into
versioned (SCD type 2) dimensions, merged rate updates and fact rows with DataFrame
operators only.  Every operator takes its key, order and attribute columns as
parameters; the banking names live in ``plans``.
"""

__version__ = "0.1.0"
