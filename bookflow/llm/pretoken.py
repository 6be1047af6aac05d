"""Pre-tokenisation without regex.

The pattern `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+` is run as a finite
automaton. Each code point becomes an element (its class, with the look-ahead that the pattern needs); each element is
a function from state to state. Function composition is associative, so states come from a blocked prefix scan over
arrays: compose within blocks (all blocks at once), scan the block totals, then apply. Texts of a batch are laid end to
end with a separator element that returns any state to the start.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

END, LETTER, NUMBER, OTHER, SPACE_NEXT, WHITE_NEXT, WHITE, CONTRACTED_1, CONTRACTED_2 = range(9)
START, IN_LETTER, IN_NUMBER, IN_OTHER, PREFIX, IN_WHITE, LEFT_1, LEFT_2 = range(8)
#: The White_Space property.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLOCK = 64


@lru_cache(1)
def code_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    found[WHITE_SPACE] = WHITE
    return found


def step(state: int, element: int) -> tuple[int, bool]:
    """The next state, and whether a token starts at the element."""
    runs = {LETTER: IN_LETTER, NUMBER: IN_NUMBER, OTHER: IN_OTHER}
    if element in (CONTRACTED_1, CONTRACTED_2):
        if state in (IN_OTHER, PREFIX):
            return IN_OTHER, False
        return (LEFT_1 if element == CONTRACTED_1 else LEFT_2), True
    if element == LETTER and state in (LEFT_1, LEFT_2):
        return (START if state == LEFT_1 else LEFT_1), False
    if element in runs:
        return runs[element], state not in (PREFIX, runs[element])
    if element == WHITE:
        return IN_WHITE, state != IN_WHITE
    return (PREFIX if element == SPACE_NEXT else START), True


@lru_cache(1)
def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the elements' functions, the composition table, the action of each function, and where tokens start."""
    functions = [tuple(step(s, e)[0] for s in range(8)) for e in range(9)]
    known = {f: i for i, f in reversed([*enumerate(functions)])}
    listed = [*known]
    listed.sort(key=known.get)
    known = {f: i for i, f in enumerate(listed)}
    at = 0
    while at < len(listed):  # closure under composition
        for f in functions:
            g = tuple(f[s] for s in listed[at])
            if g not in known:
                known[g] = len(listed)
                listed.append(g)
        at += 1
    n = len(listed)
    composed = np.zeros((n, n), np.uint16)
    for i, f in enumerate(listed):
        for j, g in enumerate(listed):
            h = tuple(g[s] for s in f)
            composed[i, j] = known.setdefault(h, len(known))
    assert len(known) == n
    starts = np.array([[step(s, e)[1] for e in range(9)] for s in range(8)], bool)
    return np.array([known[f] for f in functions], np.uint16), composed, np.array(listed, np.uint8), starts


def scan(functions: np.ndarray, composed: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of a one-dimensional array of function ids."""
    n = len(functions)
    if n <= BLOCK:
        out = functions.copy()
        for i in range(1, n):
            out[i] = composed[out[i - 1], functions[i]]
        return out
    width = BLOCK
    rows = -(-n // width)
    padded = np.zeros(rows * width, functions.dtype)
    padded[:n] = functions
    grid = np.ascontiguousarray(padded.reshape(rows, width).T)
    for j in range(1, width):
        grid[j] = composed[grid[j - 1], grid[j]]
    before = scan(grid[-1], composed)
    out = grid.T.copy()
    out[1:] = composed[before[:-1, None], out[1:]]
    return out.reshape(-1)[:n]


def elements(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The automaton's input: classes with look-ahead; `ends` are the places of the separators."""
    kind = code_classes()[codes]
    kind[ends] = END
    white = kind == WHITE
    solid_next = np.zeros(len(kind), bool)
    solid_next[:-1] = ~(white[1:] | (kind[1:] == END))
    out = kind.copy()
    out[white & solid_next] = WHITE_NEXT
    out[white & solid_next & (codes == 0x20)] = SPACE_NEXT
    for i in np.flatnonzero(codes == 0x27):
        after = codes[i + 1 : i + 3].tolist()
        if after and after[0] in (0x73, 0x74, 0x6D, 0x64):
            out[i] = CONTRACTED_1
        elif after in ([0x72, 0x65], [0x76, 0x65], [0x6C, 0x6C]):
            out[i] = CONTRACTED_2
    return out


def tokens(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of the texts, in order, and how many each text has."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kind = elements(codes, ends)
    ids, composed, action, starts = machine()
    after = action[scan(ids[kind], composed), START]
    before = np.empty_like(after)
    before[0] = START
    before[1:] = after[:-1]
    at = np.flatnonzero(starts[before, kind])
    real = kind[at[:-1]] != END if len(at) else np.zeros(0, bool)
    first, last = at[:-1][real], at[1:][real]
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    return [joined[i:j] for i, j in zip(first.tolist(), last.tolist())], counts
