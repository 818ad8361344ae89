"""Feature pipelines and regression models."""
