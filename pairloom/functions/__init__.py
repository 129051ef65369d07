"""Native column expressions."""

from pairloom.functions.text import (
    as_text,
    clean_text,
    collapse_whitespace,
    falsy,
    has_visible_text,
    render_prompt,
    straighten_quotes,
)

__all__ = [
    "as_text",
    "clean_text",
    "collapse_whitespace",
    "falsy",
    "has_visible_text",
    "render_prompt",
    "straighten_quotes",
]
