"""Deep-shallow ordering of byte strings, with the common prefixes of neighbours.

Multikey quicksort splits the strings byte by byte down to a shallow depth.  Groups that still agree
there have long common prefixes; a blind trie orders them: it branches on single bytes, compares a
string in full only with the leaf it is led to, and so looks at every string about once.
"""

from __future__ import annotations

SHALLOW = 16


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """The length of the longest common prefix; the first ``start`` bytes are known to agree."""
    low, high = start, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _byte(string: bytes, depth: int) -> int:
    return string[depth] if depth < len(string) else -1


def order(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Places in sorted order, and the common prefix of each with the next one."""
    places: list[int] = []
    common: list[int] = []
    todo: list[tuple[list[int], int, int]] = [(list(range(len(strings))), 0, 0)] if strings else []
    while todo:
        group, depth, before = todo.pop()  # before: the common prefix with what has been placed
        if len(group) == 1:
            found, inner = group, []
        elif depth >= shallow:
            found, inner = blind_trie(strings, group, depth)
        else:
            pivot = _byte(strings[group[len(group) // 2]], depth)
            less = [x for x in group if _byte(strings[x], depth) < pivot]
            equal = [x for x in group if _byte(strings[x], depth) == pivot]
            more = [x for x in group if _byte(strings[x], depth) > pivot]
            parts = [(less, depth), (equal, depth + 1 if pivot >= 0 else shallow), (more, depth)]
            parts = [(x, d) for x, d in parts if x]
            # The first part meets what was placed; parts agree with each other up to this depth.
            todo += reversed([(x, d, before if i == 0 else depth) for i, (x, d) in enumerate(parts)])
            continue
        if places:
            common.append(before)
        places += found
        common += inner
    return places, common


def blind_trie(strings: list[bytes], group: list[int], depth: int) -> tuple[list[int], list[int]]:
    """The order of strings that agree in their first ``depth`` bytes (or are equal and shorter)."""
    root: list = [None, [group[0]]]  # a leaf is (None, places); a branch is (depth, {byte: child})

    for place in group[1:]:
        string, node = strings[place], root
        while node[0] is not None:
            node = node[1].get(_byte(string, node[0])) or next(iter(node[1].values()))
        leaf = strings[node[1][0]]
        same = common_prefix(string, leaf, min(depth, len(string), len(leaf)))
        if same == len(string) == len(leaf):
            node[1].append(place)
            continue
        node = root
        while node[0] is not None and node[0] < same:
            node = node[1][_byte(string, node[0])]
        if node[0] == same:
            node[1][_byte(string, same)] = [None, [place]]
        else:
            node[:] = [same, {_byte(leaf, same): list(node), _byte(string, same): [None, [place]]}]

    places: list[int] = []
    common: list[int] = []
    todo = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if node[0] is None:
            if places:
                common.append(before)
            places += node[1]
            common += [len(strings[node[1][0]])] * (len(node[1]) - 1)
        else:
            children = [node[1][x] for x in sorted(node[1])]
            todo += [(child, before if i == 0 else node[0]) for i, child in reversed(list(enumerate(children)))]
    return places, common
