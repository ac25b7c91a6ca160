"""Ready-made jobs over the given tables, each with an independent SQL statement."""

from importlib import import_module

MODULES = ("preparing", "joining", "sequences", "sampling", "evaluating", "modelling", "live")


def load_all() -> None:
    """Import every module that registers jobs."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
