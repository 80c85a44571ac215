from starloom.plans.analytics import most_played, plays_by_hour, row_counts
from starloom.plans.comparison import compare, load_both, read_benchmark
from starloom.plans.etl import RunConfig, merge_dimension, offending_keys, run, run_counted
from starloom.plans.ssb import drill, one_dim, same_dist, two_dim
from starloom.plans.tickets import load_tickets

__all__ = [
    "RunConfig",
    "compare",
    "drill",
    "load_both",
    "load_tickets",
    "merge_dimension",
    "most_played",
    "offending_keys",
    "one_dim",
    "plays_by_hour",
    "read_benchmark",
    "row_counts",
    "run",
    "run_counted",
    "same_dist",
    "two_dim",
]
