"""Every query of the engine by name, with its DuckDB counterpart."""

from weftline.plans import queries

QUERIES = {name: run for name, (run, _) in queries.Q.items()}
ORACLES = {name: sql for name, (_, sql) in queries.Q.items() if sql}
