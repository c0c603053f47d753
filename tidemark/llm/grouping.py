"""Suffix arrays by the linear grouping construction.

First phase: suffixes are grouped by their longest Lyndon prefix. Groups are taken in descending order; for each suffix of a
group the nearest earlier suffix of a lower group (its previous smaller one) is found along such pointers; the suffixes that
are pointed to leave their group for a new one right above it, those with more pointers further up. Second phase: from the
lowest suffix on, the order within the groups is emitted along the same pointers. Nothing is renamed and nothing recursive.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """The suffix array of numbers whose last one is smaller than all others and occurs once."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * (n + 1)
    start, last = 0, None
    for k, i in enumerate(order):
        if text[i] != last:
            start, last = k, text[i]
        place[i], group[i] = k, start
        size[start] += 1
    previous = list(range(-1, n - 1))
    end = n - 1
    while end >= 0:
        own = group[order[end]]
        pointed: dict[int, int] = {}
        for i in order[own : end + 1]:
            p = previous[i]
            while p >= 0 and group[p] >= own:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = own - 1
        if not pointed:
            continue
        if len(pointed) == 1:
            levels = [list(pointed)]
        else:
            by_count: dict[int, list[int]] = {}
            for j, count in pointed.items():
                by_count.setdefault(count, []).append(j)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for level in levels:
            for j in level:
                g = group[j]
                tail, at = g + size[g] - 1, place[j]
                other = order[tail]
                order[tail], order[at] = j, other
                place[j], place[other] = tail, at
                size[g] -= 1
            fresh = [group[j] + size[group[j]] for j in level]
            for j, new in zip(level, fresh, strict=True):
                group[j] = new
            for new in fresh:
                size[new] += 1
    out, following, done = [-1] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[following[g]] = j
            following[g] += 1
            done[j] = 1
            j = previous[j]
    return out
