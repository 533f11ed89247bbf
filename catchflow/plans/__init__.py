"""Query plans over the driver's tables: derived views, registered queries and their oracle SQL."""

_LOADED = False


def load_all() -> None:
    """Import every query module so its queries register."""
    global _LOADED
    if _LOADED:
        return
    from . import q_assemble, q_evaluate, q_forcing, q_io, q_post, q_projection, q_sources, q_streaming  # noqa: F401
    _LOADED = True
