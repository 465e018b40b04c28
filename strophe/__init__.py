"""strophe: preparation of time-segmented text corpora on PySpark."""
