from hirescope.sources.tables import load_table, TABLES  # noqa: F401
