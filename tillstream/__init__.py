"""Shop analytics as plain Spark DataFrame transformations, in batch and on streams."""

from tillstream.session import checkpoint_dir, configure

__all__ = ["checkpoint_dir", "configure"]
