"""Multi-step pipelines built from the operators."""
