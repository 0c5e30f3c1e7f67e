"""ctxlake: a catalog of analytics metadata, built and queried with PySpark."""
