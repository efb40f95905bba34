"""Importing this package registers every report."""

from . import advanced, business, dashboard, frames, kpis, pipeline, profile, quality  # noqa: F401
