"""hearth: a Spark-native warehouse library for longitudinal health records.

Layers: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` (reads/writes), ``plans`` (the warehouse jobs composed
from operators), ``streaming`` (incremental loads).
"""

__version__ = "0.1.0"
