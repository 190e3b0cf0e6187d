"""Names for columns that an operator adds to a table whose columns it does not know."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *stems: str) -> list[str]:
    """For each stem a name that none of ``columns`` has, whatever its case: the stem with as many underscores as it takes."""
    taken = {c.lower() for c in columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        out.append(stem)
    return out
