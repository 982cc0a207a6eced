"""Which days are built together, so that a build of any size consists of steps of a known size."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Input of one group. Its shuffles have up to some thousands of partitions, its blocks (one for each pair
# of map and reduce task) are large enough to be fetched well, and a failure costs one group.
GROUP_BYTES = 128 * 1024**3


@dataclass(frozen=True)
class Group:
    """Days that are built in one go, and the bytes of the largest of their inputs."""

    days: tuple[str, ...]
    bytes: int


def groups_of_days(sizes: Mapping[str, int], most: int = GROUP_BYTES) -> list[Group]:
    """The days (and their bytes) in order, in groups of at most ``most`` bytes or of one day."""
    groups: list[Group] = []
    days: list[str] = []
    total = 0
    for day, size in sorted(sizes.items()):
        if days and total + size > most:
            groups.append(Group(tuple(days), total))
            days, total = [], 0
        days.append(day)
        total += size
    return groups + ([Group(tuple(days), total)] if days else [])
