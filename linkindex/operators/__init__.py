"""DataFrame operators of the pipeline."""
