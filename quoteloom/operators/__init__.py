"""DataFrame operators: projection, contract checks, fetch, incremental logic, audits."""
