"""millrace: a Spark-native analytics engine for recruitment-source data.

Operators are DataFrame-to-DataFrame functions planned by Catalyst.  The
package falls into ``sources`` (readers and parsers), ``functions`` (column
expressions), ``operators`` (relational building blocks), ``plans`` (the named
queries and their SQL twins) and ``streaming`` (incremental folds).
"""

__version__ = "0.1.0"
