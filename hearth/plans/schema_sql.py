"""Declared column types as DuckDB names them."""


def duck_type(kind: str) -> str:
    return {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}.get(kind, kind.upper())
