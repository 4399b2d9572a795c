"""glossa: a PySpark engine for building, checking and querying a multilingual text corpus.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions; nothing is collected to the driver except bounded scalars
(row counts of dimensions, single-row guards).
"""

__version__ = "0.1.0"
