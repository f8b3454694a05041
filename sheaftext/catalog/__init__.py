"""Named queries over the test tables, each with SQL that recomputes its result."""

from sheaftext.catalog import batches, documents, modes, scans, values, writes

MODULES = (scans, modes, values, documents, writes, batches)


def all_queries() -> dict:
    return {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
