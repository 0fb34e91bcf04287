"""Patterns for the SQL twins, spelt out for an engine whose \\s covers ASCII only."""

from __future__ import annotations

SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACES = f"[{SPACE}]+"
EDGE_SPACES = f"^[{SPACE}]+|[{SPACE}]+$"
NOT_IN_CHOICE = f"[^a-zA-Z0-9_@.{SPACE}]"
