"""Source operators. Each takes DataFrames or paths and returns record rows."""
