"""Training-data operators: extraction, formatting, filtering, de-duplication,
mixing and sharding.  Nothing outside this subpackage imports it."""
