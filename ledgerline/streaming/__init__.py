"""No streaming operators: both workloads are full-refresh batch jobs."""
