from . import clean, country, sql_functions, validate  # noqa: F401
