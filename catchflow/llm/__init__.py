"""Training-data operators on Spark. Nothing outside this subpackage (and ``corpus_pipeline``) imports it."""
