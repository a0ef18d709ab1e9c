"""Colour scales as column expressions.

A scale is a set of knots per channel or a list of colours.  The colour of an
index is an expression, so pixels are coloured inside codegen without a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: knots (position, left value, right value) per channel --
_V = {
    "red": ((0.0, 0, 0), (0.45, 0, 0), (0.5, 0.05, 0.05), (0.55, 0.5, 0.5), (1, 1, 1)),
    "green": ((0.0, 1, 1), (0.45, 0.5, 0.5), (0.5, 0.05, 0.05), (0.55, 0, 0), (1, 0, 0)),
    "blue": ((0.0, 0, 0), (0.45, 0, 0), (0.5, 0.05, 0.05), (0.55, 0, 0), (1, 0, 0)),
}
_RHO = {
    "red": (
        (0.0, 0.38, 0.38), (0.3, 0.16, 0.16), (0.5, 0.27, 0.27), (0.7, 0.31, 0.31), (0.8, 0.49, 0.49), (0.85, 0, 0),
        (0.9, 1, 1), (0.95, 1, 1), (0.98, 0.67, 0.67), (0.995, 0.67, 0.67), (1, 1, 1),
    ),
    "green": (
        (0.0, 0, 0), (0.3, 0.28, 0.28), (0.5, 0.55, 0.55), (0.7, 0.78, 0.78), (0.8, 0.89, 0.89), (0.85, 0.81, 0.81),
        (0.9, 1, 1), (0.95, 0.55, 0.55), (0.98, 0, 0), (0.995, 0, 0), (1, 0, 0),
    ),
    "blue": (
        (0.0, 0.57, 0.57), (0.3, 0.97, 0.97), (0.5, 0.83, 0.83), (0.7, 1, 1), (0.8, 1, 1), (0.85, 0, 0),
        (0.9, 0, 0), (0.95, 0.45, 0.45), (0.98, 0, 0), (0.995, 0, 0), (1, 1, 1),
    ),
}
_JET = {
    "red": ((0.0, 0, 0), (0.35, 0, 0), (0.66, 1, 1), (0.89, 1, 1), (1, 0.5, 0.5)),
    "green": ((0.0, 0, 0), (0.125, 0, 0), (0.375, 1, 1), (0.64, 1, 1), (0.91, 0, 0), (1, 0, 0)),
    "blue": ((0.0, 0.5, 0.5), (0.11, 1, 1), (0.34, 1, 1), (0.65, 0, 0), (1, 0, 0)),
}

KNOTS = {
    "vrad": _V,
    "rho": _RHO,
    "th": {
        "red": ((0.0, 1, 1), (0.33, 0.95, 0.95), (0.4, 0.24, 0.24), (0.45, 0.22, 0.22), (0.55, 0.04, 0.04), (0.63, 0.95, 0.95), (0.85, 1, 1), (1, 1, 1)),
        "green": ((0.0, 1, 1), (0.33, 0.97, 0.97), (0.4, 0.46, 0.46), (0.4, 0.98, 0.98), (0.55, 0.62, 0.62), (0.63, 1, 1), (0.85, 0, 0), (1, 0, 0)),
        "blue": ((0.0, 1, 1), (0.33, 0.95, 0.95), (0.4, 0.78, 0.78), (0.4, 0.52, 0.52), (0.55, 0.27, 0.27), (0.63, 0, 0), (0.85, 0, 0), (1, 1, 1)),
    },
    "th1": {
        "red": ((0.0, 1, 1), (0.2, 0.95, 0.95), (0.4, 0.24, 0.24), (0.45, 0.22, 0.22), (0.55, 0.04, 0.04), (0.63, 0.95, 0.95), (0.85, 1, 1), (1, 1, 1)),
        "green": ((0.0, 1, 1), (0.2, 0.97, 0.97), (0.4, 0.46, 0.46), (0.4, 0.98, 0.98), (0.55, 0.62, 0.62), (0.63, 1, 1), (0.85, 0, 0), (1, 0, 0)),
        "blue": ((0.0, 1, 1), (0.2, 0.95, 0.95), (0.4, 0.78, 0.78), (0.4, 0.52, 0.52), (0.55, 0.27, 0.27), (0.63, 0, 0), (0.85, 0, 0), (1, 1, 1)),
    },
    "th2": {
        "red": ((0.0, 1, 1), (0.25, 0.95, 0.95), (0.5, 0.24, 0.24), (0.5, 0.22, 0.22), (0.55, 0.04, 0.04), (0.63, 0.95, 0.95), (0.85, 1, 1), (1, 1, 1)),
        "green": ((0.0, 1, 1), (0.25, 0.97, 0.97), (0.5, 0.46, 0.46), (0.5, 0.98, 0.98), (0.55, 0.62, 0.62), (0.63, 1, 1), (0.85, 0, 0), (1, 0, 0)),
        "blue": ((0.0, 1, 1), (0.25, 0.95, 0.95), (0.5, 0.78, 0.78), (0.5, 0.52, 0.52), (0.55, 0.27, 0.27), (0.63, 0, 0), (0.85, 0, 0), (1, 1, 1)),
    },
    "jet": _JET,
}


def add_scale(name: str, knots: dict) -> None:
    """Make a scale of one's own known by name; its reverse comes with it."""
    if set(knots) != {"red", "green", "blue"}:
        raise ValueError("a scale has red, green and blue knots")
    KNOTS[name] = knots

# --- fixed values: listed scales ------------------------------------------
LISTED = {
    "zdr": ("#b7b7b7", "#0055ff", "#66b3df", "#00ffff", "#489d39", "#f9ea3c", "#ff078b"),
    "hscan": (
        "#adccff", "#3f88ff", "#0060ff", "#ffd77c", "#ffaf00", "#ff601c", "#ff6363", "#ff4242", "#fc2f2f", "#ff1c1c",
        "#ff0000", "#f4a5ff", "#e168f2", "#e635ff", "#bd00d8", "#7c008e", "#b2b2b2", "#898989", "#5b5b5b", "#262525",
    ),
    "hid_flCSU": (
        "#ffffff", "#add8e6", "#0000cd", "#ff8c00", "#ffb6c1", "#00ffff", "#a9a9a9", "#00ff00", "#ffff00", "#ff0000", "#ff00ff",
    ),
    "hid_ss": (
        "#ffffff", "#add8e6", "#0000cd", "#ff8c00", "#ffb6c1", "#00ffff", "#a9a9a9", "#00ff00", "#ffff00", "#ff0000",
    ),
}


@dataclass(frozen=True)
class Scale:
    """A named scale with ``entries`` colours; ``_r`` at the end of the name reverses it."""

    name: str
    entries: int = 256

    def __post_init__(self):
        if self.base not in KNOTS and self.base not in LISTED:
            raise ValueError(f"unknown colour scale: {self.name}")

    @property
    def base(self) -> str:
        return self.name.removesuffix("_r")

    @property
    def size(self) -> int:
        return len(LISTED[self.base]) if self.base in LISTED else self.entries

    def knots(self, channel: str) -> list[tuple[float, float, float]]:
        forward = [(float(x), float(a), float(b)) for x, a, b in KNOTS[self.base][channel]]
        if self.name.endswith("_r"):
            return [(1.0 - x, a, b) for x, a, b in reversed(forward)]
        return forward

    def level(self, index: Column, channel: str) -> Column:
        """The channel in 0..1 at an index."""
        last = self.size - 1
        if self.base in LISTED:
            colours = LISTED[self.base][::-1] if self.name.endswith("_r") else LISTED[self.base]
            at = 1 + 2 * ("red", "green", "blue").index(channel)
            steps = [int(c[at : at + 2], 16) for c in colours]
            out = F.lit(steps[-1] / 255)
            for i, step in reversed(list(enumerate(steps[:-1]))):
                out = F.when(index <= i, F.lit(step / 255)).otherwise(out)
            return out
        knots = self.knots(channel)
        out = F.lit(knots[-1][1])
        for (x0, _, right), (x1, left, _) in reversed(list(zip(knots, knots[1:]))):
            if x1 > x0:
                share = (index - x0 * last) / (x1 * last - x0 * last)
                out = F.when(index <= x1 * last, share * (left - right) + right).otherwise(out)
        return F.when(index <= 0, F.lit(knots[0][2])).when(index >= last, F.lit(knots[-1][1])).otherwise(out)

    def byte(self, index: Column, channel: str) -> Column:
        return F.floor(self.level(index, channel) * 255).cast("short")


def index_of(value: Column, vmin: Column, vmax: Column, size: int) -> Column:
    """Index of a value: clipped to the range, scaled, cut, the top inside the last entry."""
    share = F.least(F.greatest((value - vmin) / F.when(vmax != vmin, vmax - vmin), F.lit(0.0)), F.lit(1.0))
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * size), F.lit(size - 1)).cast("int")
