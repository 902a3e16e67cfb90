"""callcast: campaign-contact analytics as Spark jobs.

Every public job takes DataFrames (or a SparkSession plus a data folder) and
returns a DataFrame; row-sized work stays on the executors.
"""

__version__ = "0.1.0"
