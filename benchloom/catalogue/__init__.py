"""All registered queries. Importing the package fills the registry."""

from benchloom.catalogue import acceptance, datasets, generation, publication, texts  # noqa: F401
from benchloom.catalogue.base import ENTRIES, oracle, run

__all__ = ["ENTRIES", "oracle", "run"]
