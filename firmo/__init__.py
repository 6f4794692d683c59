"""firmo: a Spark-native engine for company (firmographic) data.

Layers are plain ``DataFrame -> DataFrame`` functions; nothing runs until a
sink (``materialize_layer``, ``export_*``) or the caller triggers an action.
"""

__version__ = "0.1.0"
