"""Queries over the test tables, grouped by kind; importing registers them."""

from smelter.plans.catalogue import (  # noqa: F401
    cleaning,
    formats,
    gold,
    keys,
    layers,
    ordered,
    scalars,
    shaping,
    stored,
    streams,
    texts,
    tracking,
    written,
)
