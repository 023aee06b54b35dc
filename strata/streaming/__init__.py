"""Incremental pick-up of new raw files (file-source stream, availableNow)."""

from .pickup import land_new_files  # noqa: F401
