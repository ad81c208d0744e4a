from .queries import queries  # noqa: F401
