"""A Spark-first workbench for large text corpora and the event streams around them."""
