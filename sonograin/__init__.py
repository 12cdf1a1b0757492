"""sonograin: long-form text and its timed narration as Spark DataFrames."""
