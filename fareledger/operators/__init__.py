"""Registry, run log, quality, model-check and profiling operators."""
