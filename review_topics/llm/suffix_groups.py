"""Suffix arrays of many strings at once by grouping, after the linear-time construction from Lyndon prefixes.

Suffixes with a common Lyndon prefix form a group. Groups are taken in descending order; a suffix's previous smaller suffix
is its nearest neighbour to the left that no group has taken yet, and how many members of the group point to it splits that
neighbour's own group. When all groups are taken, each is put in order by what follows its members' runs, smallest group
first; ranks are never renamed and nothing recurses. All strings take one group a step, as array operations.
"""

from __future__ import annotations

import numpy as np


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ``first[i] .. first[i] + size[i] - 1``."""
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(first - ends + size, size)


def suffix_arrays(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions of ``text`` in the order of the suffixes of each string, one string behind the other.

    String ``i`` is ``text[starts[i]:starts[i + 1]]``, the last one ends with ``text``; none is empty, and each ends in a
    symbol that is smaller than all others in it. Symbols are integers from 0 to 65535.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    string = np.repeat(np.arange(len(starts)), sizes)
    order = np.argsort(string << 16 | text.astype(np.int64), kind="stable")
    key = (string << 16 | text)[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(new) - 1
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    groups = int(new.sum())
    begin, end = np.zeros(2 * n + 1, np.int64), np.zeros(2 * n + 1, np.int64)
    begin[:groups] = np.flatnonzero(new)
    end[:groups] = np.append(begin[1:groups], n)

    left, right = np.arange(-1, n), np.arange(1, n + 2)  # what is not taken yet; n stands for nothing
    left[starts] = n
    right[np.append(starts[1:], n) - 1] = n
    mark = np.full(n + 1, -1, np.int64)
    depth, follower = np.zeros(n, np.int64), np.zeros(n, np.int64)
    floor, top = starts.astype(np.int64), starts + sizes
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    step = 0
    while len(top):
        first = begin[group[order[top - 1]]]
        size = top - first
        if (size == 1).all():
            members = np.sort(order[first])
        else:
            members = np.sort(order[_ranges(first, size)])
        taken.append((first, size))

        # Runs of members that are neighbours among what is left.
        joined = right[members[:-1]] == members[1:]
        heads = np.flatnonzero(np.concatenate(([True], ~joined)))
        lengths = np.diff(np.append(heads, len(members)))
        tails = heads + lengths - 1
        before, behind = left[members[heads]], right[members[tails]]
        depth[members] = np.repeat(tails, lengths) - np.arange(len(members)) + 1
        follower[members] = np.repeat(behind, lengths)
        right[before] = behind
        left[behind] = before

        # The suffixes before the runs leave their groups for new ones just above, longer runs higher.
        real = before < n
        moved, count = before[real], lengths[real]
        if len(moved):
            source = group[moved]
            by = np.lexsort((count, source))
            moved, count, source = moved[by], count[by], source[by]
            edge = np.concatenate(([True], source[1:] != source[:-1]))
            at_edge = np.flatnonzero(edge)
            many = np.diff(np.append(at_edge, len(moved)))
            heirs = source[at_edge]
            slots = _ranges(end[heirs] - many, many)
            mark[moved] = step
            sitting = order[slots]
            displaced = sitting[mark[sitting] != step]
            old = place[moved]
            holes = old[old < np.repeat(end[heirs] - many, many)]
            order[holes], place[displaced] = displaced, holes
            order[slots], place[moved] = moved, slots
            end[heirs] -= many
            fresh = edge.copy()
            fresh[1:] |= count[1:] != count[:-1]
            at_fresh = np.flatnonzero(fresh)
            number = groups + np.arange(len(at_fresh))
            begin[number] = slots[at_fresh]
            end[number] = slots[np.append(at_fresh[1:], len(moved)) - 1] + 1
            group[moved] = np.repeat(number, np.diff(np.append(at_fresh, len(moved))))
            groups += len(number)

        top = first
        more = top > floor
        if not more.all():
            top, floor = top[more], floor[more]
        step += 1
        if groups > n:  # group numbers are used up only if numbers of emptied groups are never taken again
            alive, packed = np.unique(group, return_inverse=True)
            begin[: len(alive)], end[: len(alive)] = begin[alive], end[alive]
            group, groups = packed.astype(np.int64), len(alive)

    rank = np.full(n + 1, -1, np.int64)
    for first, size in reversed(taken):
        if (size == 1).all():
            rank[order[first]] = first
            continue
        slots = _ranges(first, size)
        members = order[slots]
        by = np.lexsort((rank[follower[members]], depth[members], np.repeat(first, size)))
        order[slots] = members[by]
        rank[members[by]] = slots
    return order
