"""Tables and the stand-in table service."""

from .intermediate import shared_folder, written
from .tables import TABLES, complete, exists, load

__all__ = ["TABLES", "complete", "exists", "load", "shared_folder", "written"]
