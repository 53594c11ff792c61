"""starforge: star-schema loading, SCD2, profiling and data-quality checks as Spark jobs.

Every operator takes and returns DataFrames; nothing pulls rows to the driver.
The reference date of a run is always an explicit ``as_of`` argument.
"""

__version__ = "0.1.0"
