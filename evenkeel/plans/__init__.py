"""Multi-stage work: staging, raw zone, source registry and the full build."""
