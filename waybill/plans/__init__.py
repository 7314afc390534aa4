"""Entity configuration and the pipeline."""
