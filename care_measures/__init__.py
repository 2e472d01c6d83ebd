"""Clinical and dental quality reporting on Spark DataFrames."""

from .config import SiteConfig
from .functions.periods import Period
from .plans import measures
from .sources.tables import Source

__all__ = ["Period", "SiteConfig", "Source", "measures"]
