"""DataFrame operators: records, ranking cuts, sampling, dedup, balance, split, metrics."""
