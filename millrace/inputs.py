"""Shapes the queries and their SQL share: item cells made from ``part``, ids made from bytes."""

from __future__ import annotations

import re

# Item phrases around the part name {p} and part size {n}; each part gets the one its key selects.
PHRASES = [
    "{n} cups chopped {p}s",
    "{n}/2 lb. {p}, peeled and diced",
    "2 ½ tsp. {p} (optional)",
    "butter margarine or {p}",
    "Campbell’s {p} soup to taste",
    "low fat {p}/mi; {n}½ oz cream cheese",
    "{p} | chocolate cocoa, {n} pkg. jell-o",
    "10x sugar, {n}.5 g {p}, icing sugar",
    "Ripe {p} berries - cut into inch pieces",
    "carefully washed,  dried and {p} leaves",
    "{n} large eggs, 2% milk; White  Lily flour {p}",
    "• {p} e tract × {n} bottles. margerine",
    "salt, 2 tsp salt, {p}, {n} g {p}s",
]


def _concat(phrase: str) -> str:
    parts = [p for p in re.split(r"(\{[np]\})", phrase) if p]
    names = {"{n}": "CAST(p_size AS STRING)", "{p}": "p_name"}
    return " || ".join(names.get(p, f"'{p}'") for p in parts)


def item_sql() -> str:
    """SQL expression over ``part``, the same text for both engines."""
    cases = " ".join(f"WHEN {i} THEN {_concat(p)}" for i, p in enumerate(PHRASES))
    return f"CASE p_partkey % {len(PHRASES)} {cases} END"
