from sluiceway.sources.queries import from_item, read_query
from sluiceway.sources.sectioned import load_bundle, read_sections

__all__ = ["from_item", "load_bundle", "read_query", "read_sections"]
