"""Data sources: delimited text loaders and the bindings of the driver tables."""

from rateflow.sources.tables import base_ratings, delta_ratings, items_table, ratings_table  # noqa: F401
from rateflow.sources.text import (  # noqa: F401
    read_deltas_text, read_items_text, read_ratings_text,
    write_deltas_text, write_items_text, write_ratings_text,
)
