from .tables import Source

__all__ = ["Source"]
