"""Feed compositions (E1-E8) and their bindings to the driver tables."""

from .registry import ORACLES, QUERIES, binding, table  # noqa: F401


def load_all() -> None:
    """Import every binding module so the registry is complete."""
    from . import bind_clean, bind_edge, bind_feeds, bind_io, bind_resolve, bind_state, bind_stream  # noqa: F401
