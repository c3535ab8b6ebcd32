"""Deep-shallow sorting of many small groups of strings of one width.

Open segments of a group are split by their next eight bytes, all segments of
all groups together (multikey quicksort with wide symbols), down to a shallow
depth. What is still together there has a long common prefix; each such
segment is ordered by a blind trie, which compares a string with one other
string of its segment only.
"""

from __future__ import annotations

import numpy as np


def _words(strings: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian 8-byte numbers, short rows filled with zeros."""
    width = -(-strings.shape[1] // 8) * 8
    padded = np.zeros((len(strings), width), np.uint8)
    padded[:, :strings.shape[1]] = strings
    return padded.view(">u8").astype(np.uint64)


def _first_difference(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Length of the common prefix of rows of two arrays of words."""
    differ = a != b
    word = differ.argmax(axis=1)
    rows = np.arange(len(a))
    bits = (a[rows, word] ^ b[rows, word])
    lead = np.zeros(len(a), np.int64)
    for shift in (32, 16, 8):  # leading zero bytes of the differing word
        low = bits < (np.uint64(1) << np.uint64(64 - shift))
        lead += np.where(low, shift // 8, 0)
        bits = np.where(low, bits << np.uint64(shift), bits)
    return np.where(differ.any(axis=1), np.minimum(width, word * 8 + lead), width)


class _Node:
    __slots__ = ("depth", "children")

    def __init__(self, depth: int):
        self.depth, self.children = depth, {}


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Indexes of equally long strings in ascending order, equal strings in their given order."""
    width = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]
    root = _Node(width)
    root.children[None] = [0]  # a leaf: the indexes of equal strings
    for i in range(1, len(strings)):
        s = strings[i]
        # blindly down: only the bytes at branching depths are looked at
        node = root
        while isinstance(node, _Node):
            node = node.children.get(s[node.depth] if node.depth < width else None) or next(iter(node.children.values()))
        other = numbers[i] ^ numbers[node[0]]
        shared = width if not other else width - (other.bit_length() + 7) // 8
        if shared == width:
            node.append(i)
            continue
        # down again to where the string leaves the trie
        above, node = None, root
        while isinstance(node, _Node) and node.depth < shared:
            above, node = node, node.children[s[node.depth]]
        if isinstance(node, _Node) and node.depth == shared:
            node.children[s[shared]] = [i]
            continue
        branch = _Node(shared)
        branch.children[s[shared]] = [i]
        below = node
        while isinstance(below, _Node):
            below = next(iter(below.children.values()))
        branch.children[strings[below[0]][shared]] = node
        if above is None:
            root = branch
        else:
            above.children[s[above.depth]] = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack += [node.children[k] for k in sorted(node.children, key=lambda k: -1 if k is None else k, reverse=True)]
        else:
            out += node
    return out


def deep_shallow(strings: np.ndarray, groups: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows of ``strings`` in ascending order inside each of the ascending
    ``groups``; for each place in that order the length of the prefix shared with the row
    before, -1 where a group begins."""
    n, width = strings.shape
    words = _words(strings)
    order = np.arange(n)
    segment = np.r_[0, np.cumsum(groups[1:] != groups[:-1])] if n else np.zeros(0, np.int64)
    for k in range(min(words.shape[1], shallow // 8)):
        sizes = np.bincount(segment, minlength=int(segment[-1]) + 1) if n else np.zeros(0, np.int64)
        open_ = np.flatnonzero(sizes[segment] > 1)
        if not len(open_):
            break
        symbol, own = words[order[open_], k], segment[open_]
        split = np.lexsort((symbol, own))
        order[open_] = order[open_][split]
        symbol = symbol[split]
        fresh = np.zeros(n, bool)
        fresh[open_[1:]] = (symbol[1:] != symbol[:-1]) & (own[1:] == own[:-1])
        segment = segment + np.cumsum(fresh)
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, n])
    raw = strings.tobytes()
    for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        rows = order[start:start + size]
        texts = [raw[r * width:(r + 1) * width] for r in rows.tolist()]
        if size == 2:
            if texts[1] < texts[0]:
                order[start:start + 2] = rows[::-1]
        else:
            order[start:start + size] = rows[blind_trie_order(texts)]
    common = np.full(n, -1, np.int64)
    if n > 1:
        common[1:] = _first_difference(words[order[1:]], words[order[:-1]], width)
        common[1:][groups[order[1:]] != groups[order[:-1]]] = -1
    return order, common
