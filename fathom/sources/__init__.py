from fathom.sources.tables import TABLES, Tables, read_table  # noqa: F401
