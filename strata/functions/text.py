"""Rules for the text fields of control rows, as SQL expressions, and for run parameters."""

from __future__ import annotations

_WHITESPACE = " \t\n\r\f\v"


def stripped(field: str) -> str:
    """Field without surrounding whitespace; NULL becomes empty."""
    return f"btrim(coalesce({field}, ''), '{_WHITESPACE}')"


def or_default(field: str, default: str) -> str:
    """Stripped field, or the default where nothing is left."""
    return f"coalesce(nullif({stripped(field)}, ''), '{default}')"


def first_filled(*fields: str) -> str:
    """First field that is neither NULL nor ''. A field of blanks counts as filled."""
    return "coalesce(" + ", ".join(f"nullif({field}, '')" for field in fields) + ")"


def group_key(group_id: str | None) -> str:
    """Required run parameter, as it is stored in the control tables."""
    key = (group_id or "").strip().upper()
    if not key:
        raise ValueError("GROUP_ID is required.")
    return key


def layer_of(group: str) -> str:
    """Layer named by the group's suffix, or ALL."""
    return next((layer for layer in ("L0", "L1", "L2") if group.endswith(f"_{layer}")), "ALL")


def parse_keys(merge_keys: str | None) -> list[str]:
    """Key columns of a comma-separated list."""
    return [key.strip() for key in (merge_keys or "").split(",") if key.strip()]
