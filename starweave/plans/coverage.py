"""Which partitions of a catalog lie within reach of another's, from the listings alone.

A cell of any order is an interval of order-29 pixels, so a catalog's footprint is a sorted list of
disjoint intervals, and overlap is two binary searches. Cells that do not overlap may still hold rows within a
match radius of each other; they do at most if their centres are no further apart than both cells' radii and the match radius.
A listing has one row per file, which the driver holds anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

DEEPEST = 29
#: Cells that are compared with all others at a time.
BLOCK = 2048

# Fixed values of the pixelisation: the row of each base pixel, in quarter turns, and its place along the row.
_ROW = np.array([2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4])
_COLUMN = np.array([1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7])

Cells = Sequence[tuple[int, int]]


def _arrays(cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    table = np.array([tuple(c) for c in cells], np.int64).reshape(-1, 2)
    return table[:, 0], table[:, 1]


def intervals(cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """First pixel and one behind the last, at the deepest order, of the disjoint intervals that ``cells`` cover."""
    order, pixel = _arrays(cells)
    shift = 2 * (DEEPEST - order)
    start, end = pixel << shift, (pixel + 1) << shift
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by]) if len(by) else end
    opens = np.ones(len(start), bool)
    opens[1:] = start[1:] > end[:-1]
    return start[opens], end[np.append(np.flatnonzero(opens)[1:] - 1, len(end) - 1)] if len(end) else end


def overlapping(cells: Cells, others: Cells) -> np.ndarray:
    """For each of ``cells``, whether it shares sky with any of ``others``."""
    order, pixel = _arrays(cells)
    shift = 2 * (DEEPEST - order)
    start, end = intervals(others)
    return np.searchsorted(start, (pixel + 1) << shift, "left") > np.searchsorted(end, pixel << shift, "right")


def centres(cells: Cells) -> np.ndarray:
    """Unit vectors to the centres of nested pixels, one per row."""
    order, pixel = _arrays(cells)
    side = np.int64(1) << order
    face, inside = pixel >> (2 * order), pixel & (side * side - 1)
    x, y = _every_second_bit(inside), _every_second_bit(inside >> 1)
    ring = _ROW[face] * side - x - y - 1
    north, south = ring < side, ring > 3 * side
    length = np.where(north, ring, np.where(south, 4 * side - ring, side))  # of the ring, in quarter turns
    cap = length * length / (3.0 * side * side)
    z = np.where(north, 1 - cap, np.where(south, cap - 1, (2 * side - ring) * 2 / (3.0 * side)))
    shifted = np.where(north | south, 0, (ring - side) & 1)
    place = (_COLUMN[face] * length + x - y + 1 + shifted) // 2
    turn = (place - (shifted + 1) / 2) * (np.pi / 2) / length
    flat = np.sqrt(np.maximum(0, 1 - z * z))
    return np.stack([flat * np.cos(turn), flat * np.sin(turn), z], axis=1)


def _every_second_bit(value: np.ndarray) -> np.ndarray:
    found = np.zeros_like(value)
    for k in range(DEEPEST):
        found |= (value >> (2 * k) & 1) << k
    return found


def cell_radius(order: int) -> float:
    """An angle that no point of a cell exceeds from its centre: 1.1 times the side of a square of the same area.

    The longest such angle is found where the caps begin, and is 1.045 times that side for small cells.
    """
    return 1.1 * np.sqrt(4 * np.pi / 12) / 2**order


def within_reach(cells: Cells, others: Cells, radius_arcsec: float) -> np.ndarray:
    """For each of ``cells``, whether a row in it may lie within the radius of a row in ``others``."""
    near = overlapping(cells, others) if len(cells) and len(others) else np.zeros(len(cells), bool)
    left = np.flatnonzero(~near)
    if not len(left) or not len(others):
        return near
    reach = np.array([cell_radius(k) for k in range(DEEPEST + 1)])
    one, two = centres([cells[k] for k in left]), centres(others)
    own, theirs = reach[_arrays(cells)[0][left]], reach[_arrays(others)[0]] + np.radians(radius_arcsec / 3600)
    for at in range(0, len(left), BLOCK):
        angle = np.arccos(np.clip(one[at : at + BLOCK] @ two.T, -1, 1))
        near[left[at : at + BLOCK]] = (angle <= own[at : at + BLOCK, None] + theirs).any(axis=1)
    return near
