from . import fixtures, readers  # noqa: F401
