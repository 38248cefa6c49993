"""Deep-shallow sorting of byte strings with their common prefix lengths.

Multikey quicksort orders the strings by eight bytes at a time, down to a shallow depth.
Strings that still agree there are ordered by a blind trie: a search follows branching
bytes only, one comparison with the leaf it ends at gives the true common prefix, and
that is where the new string branches off.
"""

from __future__ import annotations

import numpy as np

#: Bytes that multikey quicksort looks at.
SHALLOW = 96


def sort_with_prefixes(strings: np.ndarray, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(order, prefix) of the rows of a byte matrix: rows in ascending order, and how many
    leading bytes each shares with the one before (0 for the first). Equal rows stay in
    the order they came in. The first ``known`` bytes are the same in all rows."""
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    order: list[int] = []
    depth = known // 8
    stack = [(np.arange(n), depth)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) == 1:
            order.append(int(rows[0]))
        elif depth * 8 >= min(SHALLOW, width):
            order += blind_trie_order([strings[r].tobytes() for r in rows], rows)
        else:
            column = words[rows, depth]
            pivot = column[len(rows) // 2]
            less, equal = column < pivot, column == pivot
            for part, deeper in ((~less & ~equal, 0), (equal, 1), (less, 0)):  # the last one pushed comes first
                if part.any():
                    stack.append((rows[part], depth + deeper))
    found = np.array(order, dtype=np.int64)
    return found, shared_prefixes(strings[found])


def blind_trie_order(strings: list[bytes], rows: np.ndarray) -> list[int]:
    """``rows`` in the order of their strings, all of one length. A node is [depth, {byte: node
    or leaf}], a leaf the list of places of equal strings."""
    width = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]
    root: list | None = None
    for i, s in enumerate(strings):
        if root is None:
            root = [width, {-1: [i]}]
            continue
        node, path = root, []
        while True:
            path.append(node)
            depth, branches = node
            nxt = branches.get(s[depth] if depth < width else -1)
            if nxt is None:
                nxt = next(iter(branches.values()))
            if depth >= width:
                leaf = nxt
                break
            node = nxt
        common = width - ((numbers[i] ^ numbers[leaf[0]]).bit_length() + 7) // 8
        if common == width:
            leaf.append(i)
            continue
        # the first node on the way that is deeper than the common part hangs below the branching
        k = next(k for k, node in enumerate(path) if node[0] > common or k == len(path) - 1)
        own = [width, {-1: [i]}]
        below = path[k]
        if below[0] == common:
            below[1][s[common]] = own
        elif k and path[k - 1][0] == common:
            path[k - 1][1][s[common]] = own
        else:
            branching = [common, {strings[leaf[0]][common]: below, s[common]: own}]
            if k:
                path[k - 1][1][s[path[k - 1][0]]] = branching
            else:
                root = branching
    out: list[int] = []
    stack = [root]
    while stack:
        depth, branches = stack.pop()
        if depth >= width:
            out += [int(rows[i]) for i in branches[-1]]
        else:
            stack += [branches[b] for b in sorted(branches, reverse=True)]
    return out


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many leading bytes each row shares with the one before."""
    out = np.zeros(len(rows), dtype=np.int64)
    if len(rows) > 1:
        out[1:] = common_length(rows[1:], rows[:-1])
    return out


def common_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that rows of two matrices share."""
    differ = a != b
    first = differ.argmax(axis=1)
    return np.where(differ.any(axis=1), first, a.shape[1])
