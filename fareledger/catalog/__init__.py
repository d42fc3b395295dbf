"""The operators applied to the generic order tables, each with the SQL it must equal."""

from fareledger.catalog import files, model, profiles, quality, raw_rules, registry, staging

MODULES = (model, quality, raw_rules, staging, profiles, registry, files)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
