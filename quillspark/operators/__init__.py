"""DataFrame -> DataFrame operators, grouped by the pipeline stage they serve."""
