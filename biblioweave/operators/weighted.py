"""The best weighted ratio of every query in a block of texts, by arrays: the same numbers as ``functions.wratio``, without its nested loop.

A pair passes by one of three kinds of numbers, and each is searched without loss; what is found is scored exactly.

* Whole texts (as written, tokens sorted, distinct tokens): the letters, and the pairs of neighbouring letters, that two texts have in common
  bound their common subsequence from above. Letters are counted in unary, so one matrix product bounds all pairs of a block.
* Tokens of one text among those of the other: whatever is covered far enough shares one of its rarest tokens, of which so many are looked up
  that the others do not suffice.
* Windows: with ``k`` edits at most, one of ``k + 1`` chunks of the shorter text occurs unchanged in the window. Chunks are looked up by
  their hash at all places of the longer texts.

Texts that share a token pass without a search (``fuzzy._by_shared_token``); their score is the least that other pairs have to reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np

from ..functions.text import WHITESPACE

TOKENS, WINDOW, FAR_WINDOW = 0.95, 0.9, 0.6

_EPS = 1e-9
_SPACES = str.maketrans(WHITESPACE, " " * len(WHITESPACE))
# Rows and letters at a time; they bound the memory of a task and do not change what is found.
_PAIRS, _PLACES, _TABLE = 1 << 17, 1 << 19, 1 << 21
_LONGEST_CHUNK, _SHORTEST_CHUNK = 12, 3
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def tokens(text: str) -> list[str]:
    return sorted(t for t in text.translate(_SPACES).split(" ") if t)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Alphabet:
    """All letters of some texts, numbered."""

    def __init__(self, texts: Iterable[str]):
        used = np.unique(_points("".join(set().union(" ", *texts))))
        self.size = len(used)
        self.number = np.zeros(int(used[-1]) + 1, np.int32)
        self.number[used] = np.arange(len(used))
        self.blank = int(self.number[32])


class Texts:
    """Texts as one array of numbered letters, with where each starts and how long it is."""

    def __init__(self, texts: list[str], alphabet: Alphabet):
        self.alphabet = alphabet
        self.n = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.cumsum(self.n) - self.n
        self.codes = alphabet.number[_points("".join(texts))]
        self.owner = np.repeat(np.arange(len(texts)), self.n)

    def take(self, rows: np.ndarray) -> Texts:
        out = object.__new__(Texts)
        out.alphabet, out.n = self.alphabet, self.n[rows]
        out.start = np.cumsum(out.n) - out.n
        out.owner, place = spans(self.start[rows], self.start[rows] + out.n)
        out.codes = self.codes[place]
        return out


def spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, value`` for every value from ``low`` up to ``high``, which is not included."""
    many = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(many)), many)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + low[row]


def _bunches(weight: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of rows whose weights add up to about ``most`` at the most, or that have one row."""
    total, at = np.cumsum(weight), 0
    while at < len(weight):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
        yield slice(at, end)
        at = end


def lcs(one: Texts, i: np.ndarray, other: Texts, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The longest common subsequence of text ``i`` of ``one`` with ``size`` letters of ``other`` from place ``first`` on, bit by bit."""
    out = np.zeros(len(i), np.int64)
    if not len(i):
        return out
    words = (one.n[i] + 63) >> 6
    order = np.lexsort((size, words))
    weight = words[order] * (one.alphabet.size + 1) + 64
    for part in _bunches(weight, _PAIRS * 64):
        for rows in np.split(order[part], np.flatnonzero(np.diff(words[order[part]])) + 1):
            out[rows] = _lcs(one, i[rows], other, first[rows], size[rows], int(words[rows[0]]))
    return out


def _lcs(one: Texts, i: np.ndarray, other: Texts, first: np.ndarray, size: np.ndarray, words: int) -> np.ndarray:
    if not words or not size.any():
        return np.zeros(len(i), np.int64)
    letters = one.alphabet.size + 1  # one more for places past the end of a window
    used, own = np.unique(i, return_inverse=True)
    row, place = spans(one.start[used], one.start[used] + one.n[used])
    at = place - one.start[used][row]
    key = ((at >> 6) * len(used) + row) * letters + one.codes[place]
    order = np.argsort(key, kind="stable")
    key, bit = key[order], np.left_shift(np.uint64(1), (at[order] & 63).astype(np.uint64))
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    masks = np.zeros(words * len(used) * letters, np.uint64)
    masks[key[heads]] = np.bitwise_or.reduceat(bit, heads)
    masks = masks.reshape(words, len(used) * letters)
    state = np.full((words, len(i)), ~np.uint64(0))
    base, last = own * letters, len(other.codes) - 1
    for step in range(int(size.max())):
        met = base + np.where(step < size, other.codes[np.minimum(first + step, last)], letters - 1)
        carry = None
        for w in range(words):
            v = state[w]
            hit = v & masks[w][met]
            total = v + hit
            if words > 1:
                over = total < v
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            state[w] = total | (v ^ hit)
    # Bits past the end of a text are never hit, but a carry can pass through them: they are not counted.
    left = np.minimum(np.maximum(one.n[i][None] - 64 * np.arange(words)[:, None], 0), 64)
    inside = np.where(left == 64, ~np.uint64(0), np.left_shift(np.uint64(1), np.minimum(left, 63).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~state & inside).sum(axis=0).astype(np.int64)


def _letters(t: Texts) -> np.ndarray:
    return np.bincount(t.owner * 32 + (t.codes & 31), minlength=32 * len(t.n)).reshape(-1, 32).astype(np.int32)


def _pairs_of_letters(t: Texts) -> np.ndarray:
    """How often every pair of neighbours occurs, a blank before and after the text among them, in 256 classes."""
    if not len(t.n):
        return np.zeros((0, 256), np.uint16)
    blank = t.alphabet.blank
    after = np.full(len(t.codes), blank, np.int64)
    after[:-1] = np.where(t.owner[1:] == t.owner[:-1], t.codes[1:], blank)
    some = t.n > 0
    head = np.zeros(len(t.n), np.int64)
    head[some] = t.codes[t.start[some]]
    place = lambda one, two: (one * 7 + two * 37) & 255
    keys = np.concatenate([t.owner * 256 + place(t.codes.astype(np.int64), after), np.flatnonzero(some) * 256 + place(blank, head[some])])
    return np.minimum(np.bincount(keys, minlength=256 * len(t.n)), 65535).reshape(-1, 256).astype(np.uint16)


def near(q: Texts, c: Texts, least: np.ndarray, may: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """Pairs whose ratio may be ``least`` of the query or more: ``q`` and ``c`` rows, a superset in parts of a bounded size.

    ``may`` tells pairs that are asked for at all.
    """
    rows_q, rows_c = np.flatnonzero((q.n > 0) & (least <= 1 + _EPS)), np.flatnonzero(c.n > 0)
    if not len(rows_q) or not len(rows_c):
        return
    rows_q, rows_c = rows_q[np.argsort(q.n[rows_q], kind="stable")], rows_c[np.argsort(c.n[rows_c], kind="stable")]
    loosest = float(least[rows_q].min())
    # 2 * shorter >= least * (n + m), so n / m lies between least / (2 - least) and its inverse.
    reach = max(loosest / (2 - loosest), 1e-9) if loosest < 2 else 1
    low, high = q.n[rows_q[0]] * reach - 1, q.n[rows_q[-1]] / reach + 1
    rows_c = rows_c[(c.n[rows_c] >= low) & (c.n[rows_c] <= high)]
    if not len(rows_c):
        return
    qs, cs = q.take(rows_q), c.take(rows_c)
    count_q, count_c = _letters(qs), _letters(cs)
    neighbours_c = None
    most = np.minimum(np.minimum(count_q.max(axis=0), count_c.max(axis=0)), 12)
    bucket, level = spans(np.ones(32, np.int64), most.astype(np.int64) + 1)
    unary = lambda counts: (counts[:, bucket] >= level).astype(np.float32)
    beyond = np.maximum(count_q - most, 0).sum(axis=1)
    half = least[rows_q] / 2
    for a in range(0, len(rows_q), 512):
        some = slice(a, a + 512)
        n = qs.n[some]
        from_c, to_c = np.searchsorted(cs.n, [n[0] * reach - 1, n[-1] / reach + 1], side="left")
        if from_c == to_c:
            continue
        # Common letters less those needed, as one product: unary counts, and the lengths times the share that is needed.
        left = np.column_stack([unary(count_q[some]), beyond[some] - half[some] * n, -half[some]]).astype(np.float32)
        neighbours_q = _pairs_of_letters(qs.take(np.arange(a, min(a + 512, len(rows_q)))))
        for b in range(int(from_c), int(to_c), 4096):
            own = slice(b, min(b + 4096, int(to_c)))
            right = np.column_stack([unary(count_c[own]), np.ones(len(cs.n[own])), cs.n[own]]).astype(np.float32)
            slack = 0.01 + 1e-5 * float(n[-1] + cs.n[own][-1])
            found = np.flatnonzero(left @ right.T >= -slack)
            for at in range(0, len(found), _PAIRS):
                i, j = np.divmod(found[at : at + _PAIRS], right.shape[0])
                i, j = i + a, j + b
                asked = may(rows_q[i], rows_c[j])
                i, j = i[asked], j[asked]
                needed = half[i] * (qs.n[i] + cs.n[j]) - 1e-6
                fits = np.minimum(count_q[i], count_c[j]).sum(axis=1) >= needed
                i, j, needed = i[fits], j[fits], needed[fits]
                if not len(i):
                    continue
                if neighbours_c is None:
                    neighbours_c = _pairs_of_letters(cs)
                # A letter that goes takes two pairs of neighbours with it, one that comes breaks one.
                gone, come = qs.n[i] - needed, cs.n[j] - needed
                kept = np.maximum(qs.n[i] + 1 - 2 * gone - come, cs.n[j] + 1 - 2 * come - gone)
                common = np.concatenate([
                    np.minimum(neighbours_q[i[k : k + 8192] - a], neighbours_c[j[k : k + 8192]]).sum(axis=1, dtype=np.int64) for k in range(0, len(i), 8192)
                ])
                fits = common >= kept
                if fits.any():
                    yield rows_q[i[fits]], rows_c[j[fits]]


def ratio(q: Texts, c: Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    first = q.n[i] <= c.n[j]
    common = np.zeros(len(i), np.int64)
    common[first] = lcs(q, i[first], c, c.start[j[first]], c.n[j[first]])
    rest = ~first
    common[rest] = lcs(c, j[rest], q, q.start[i[rest]], q.n[i[rest]])
    return np.where((q.n[i] > 0) & (c.n[j] > 0), 2.0 * common / np.maximum(q.n[i] + c.n[j], 1), 0.0)


def _joined(parts: list[str]) -> int:
    return sum(map(len, parts)) + max(len(parts) - 1, 0)


def token_set(a: list[list[str]], b: list[list[str]], i: np.ndarray, j: np.ndarray, least: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    """The ratio of token sets (distinct, sorted tokens) where it is ``least`` or more; less than that elsewhere."""
    out, ones, twos, open_rows, sums = np.zeros(len(i)), [], [], [], []
    for row, (x, y, needed) in enumerate(zip(i.tolist(), j.tolist(), least.tolist())):
        mine, theirs = a[x], b[y]
        if not mine or not theirs:
            continue
        common = set(mine).intersection(theirs)
        if common and (len(common) == len(mine) or len(common) == len(theirs)):
            out[row] = 1.0
            continue
        one, two = [t for t in mine if t not in common], [t for t in theirs if t not in common]
        both, n, m, gap = _joined(list(common)), _joined(one), _joined(two), 1 if common else 0
        total = 2 * (both + gap) + n + m
        if gap:
            out[row] = max(1.0 - (gap + x) / (2 * both + gap + x) for x in (n, m))
        if 1.0 - abs(n - m) / total >= max(needed - _EPS, out[row]):
            ones.append(" ".join(one))
            twos.append(" ".join(two))
            open_rows.append(row)
            sums.append(total)
    if ones:
        one, two, rows = Texts(ones, alphabet), Texts(twos, alphabet), np.array(open_rows)
        all_rows = np.arange(len(ones))
        apart = one.n + two.n - 2 * lcs(one, all_rows, two, two.start, two.n)
        out[rows] = np.maximum(out[rows], 1.0 - apart / np.array(sums))
    return out


def covered(a: list[list[str]], b: list[list[str]], least: np.ndarray):
    """Pairs in which the tokens of ``a`` may be among those of ``b`` as far as ``least`` asks, a superset in parts: rows of both."""
    ids: dict[str, int] = {}
    flat_b = np.fromiter((ids.setdefault(t, len(ids)) for x in b for t in x), np.int64)
    owner_b = np.repeat(np.arange(len(b)), [len(x) for x in b])
    order = np.argsort(flat_b, kind="stable")
    flat_b, owner_b = flat_b[order], owner_b[order]
    often = np.bincount(flat_b, minlength=len(ids))
    rows, wanted = [], []
    for row, (mine, needed) in enumerate(zip(a, least.tolist())):
        if not mine or needed > 1 + _EPS:
            continue
        share = 2 * (1 - needed) / needed
        # Tokens that are not shared have at most so many letters, joined; of the rarest ones that have more, one is shared.
        free = max((share * (_joined(mine) - 1) - 1) / (1 + share), 0) + 1e-6
        known = sorted((often[ids[t]] if t in ids else 0, t) for t in mine)
        letters = -1
        for _, t in known:
            letters += len(t) + 1
            if t in ids:
                rows.append(row)
                wanted.append(ids[t])
            if letters > free:
                break
    rows, wanted = np.array(rows, np.int64), np.array(wanted, np.int64)
    low, high = np.searchsorted(flat_b, wanted, side="left"), np.searchsorted(flat_b, wanted, side="right")
    for part in _bunches(high - low, _PAIRS):
        at, place = spans(low[part], high[part])
        yield rows[part][at], owner_b[place]


def most_edits(n: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The most letters that two texts may not have in common, where the ratio of a text of ``n`` letters with a window is ``least`` or more."""
    whole, cut = (1 - least) * 2 * n + 1e-6, (1 - least) * (2 * n - 1) + 1e-6
    odd = np.where(cut >= 1, 2 * np.floor((cut - 1) / 2) + 1, 0)
    return np.maximum(2 * np.floor(whole / 2), odd).astype(np.int64)


def _hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sums of letters times powers, from which the hash of any stretch follows, and the inverse powers."""
    powers = np.ones(len(t.codes) + 1, np.uint64)
    powers[1:] = _PRIME
    inverse = np.ones(len(t.codes) + 1, np.uint64)
    inverse[1:] = _INVERSE
    powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
    mixed = (t.codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((mixed ^ (mixed >> np.uint64(29))) * powers[:-1], dtype=np.uint64)]), inverse


def _mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def windows(short: Texts, long: Texts, least: np.ndarray, may: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """Ratios of short texts with windows of long ones that are ``least`` of the short text or more: rows of both and the ratio, in parts."""
    rows = np.flatnonzero((short.n > 0) & (least <= 1 + _EPS))
    if not len(rows) or not len(long.codes):
        return
    edits = most_edits(short.n, np.minimum(least, 1.0))
    step = short.n // (edits + 1)
    size = np.minimum(step, _LONGEST_CHUNK)
    dense = (edits > 0) & (size < _SHORTEST_CHUNK)

    def scored(i, j, d):
        """The windows around diagonal ``d``."""
        low, high = np.maximum(d - 2 * edits[i], -edits[i]), np.minimum(d + 2 * edits[i], long.n[j] - short.n[i] + edits[i])
        for part in _bunches(np.maximum(high - low + 1, 0), _PAIRS):
            row, at = spans(low[part], high[part] + 1)
            p, t = i[part][row], j[part][row]
            first, end = np.maximum(at, 0), np.minimum(at + short.n[p], long.n[t])
            width = np.maximum(end - first, 0)
            value = 2.0 * lcs(short, p, long, long.start[t] + first, width) / (short.n[p] + width)
            fits = (value >= least[p] - _EPS) & (width > 0)
            if fits.any():
                yield p[fits], t[fits], value[fits]

    def tested(i, j, d):
        """Diagonals whose surroundings hold as many letters of the short text as any window of them must."""
        first, end = np.maximum(d - edits[i], 0), np.minimum(d + edits[i] + short.n[i], long.n[j])
        needed = least[i] * short.n[i] / (2 - least[i])
        return lcs(short, i, long, long.start[j] + first, end - first) >= needed - 1e-6

    for i in rows[dense[rows]]:
        j = np.arange(len(long.n))
        j = j[(long.n >= short.n[i]) & may(np.full(len(j), i), j)]
        for part in _bunches((long.n[j] + 2 * edits[i]) // (4 * edits[i] + 1) + 1, _PAIRS):
            row, number = spans(np.zeros(len(j[part]), np.int64), (long.n[j[part]] + 2 * edits[i]) // (4 * edits[i] + 1) + 1)
            yield from scored(np.full(len(row), i), j[part][row], edits[i] + number * (4 * edits[i] + 1))

    rows = rows[~dense[rows]]
    if not len(rows):
        return
    own_sums, own_inverse = _hashes(short)
    shift = np.uint64(64 - _TABLE.bit_length() + 1)
    chunks = []
    for z in np.unique(size[rows]).tolist():
        some = rows[size[rows] == z]
        row, number = spans(np.zeros(len(some), np.int64), edits[some] + 1)
        pattern = some[row]
        chunk = number * step[pattern]
        at = short.start[pattern] + chunk
        hashed = _mixed((own_sums[at + z] - own_sums[at]) * own_inverse[at])
        order = np.argsort(hashed)
        known = np.zeros(_TABLE, bool)
        known[hashed >> shift] = True
        chunks.append((z, hashed[order], pattern[order], chunk[order], known))

    for group in _bunches(long.n, _PLACES):
        texts = long.take(np.arange(len(long.n))[group])
        sums, inverse = _hashes(texts)
        rest = texts.start[texts.owner] + texts.n[texts.owner] - np.arange(len(texts.codes))
        for z, hashed, pattern, chunk, known in chunks:
            if len(texts.codes) < z:
                continue
            h = _mixed((sums[z:] - sums[:-z]) * inverse[: len(sums) - z])
            place = np.flatnonzero(known[h >> shift])
            place = place[rest[place] >= z]
            h = h[place]
            low = np.searchsorted(hashed, h, side="left")
            real = (low < len(hashed)) & (hashed[np.minimum(low, len(hashed) - 1)] == h)
            place, h, low = place[real], h[real], low[real]
            high = np.searchsorted(hashed, h, side="right")
            for part in _bunches(high - low, 2 * _PAIRS):
                at, key = spans(low[part], high[part])
                i, where = pattern[key], place[part][at]
                j = texts.owner[where]
                fits = np.flatnonzero((texts.n[j] >= short.n[i]) & may(i, j + group.start))
                i, j = i[fits], j[fits]
                d = where[fits] - texts.start[j] - chunk[key[fits]]
                fits = (d >= -2 * edits[i]) & (d <= texts.n[j] - short.n[i] + 2 * edits[i])
                i, j, d = i[fits], j[fits] + group.start, d[fits]
                if not len(i):
                    continue
                order = np.lexsort((d, j, i))
                i, j, d = i[order], j[order], d[order]
                new = np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (d[1:] != d[:-1])])
                i, j, d = i[new], j[new], d[new]
                fits = tested(i, j, d)
                yield from scored(i[fits], j[fits], d[fits])


def best_of(queries: list[str], choices: list[str], least: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, choice, score`` of the best choice, the one of the lowest rank on ties, for queries with a choice of ``least`` or more.

    Not all numbers of pairs that share a token are searched for (``fuzzy._by_shared_token``), no others are left out.
    """
    shortest, longest = min(map(len, queries), default=0), max(map(len, queries), default=0)
    near_enough = np.arange(len(choices))
    if least.min(initial=2.0) > FAR_WINDOW + _EPS:
        # Lengths further apart are scaled down below what is asked for.
        near_enough = near_enough[[shortest <= 8 * len(t) and len(t) <= 8 * longest for t in choices]]
        choices, rank = [choices[k] for k in near_enough], rank[near_enough]
    alphabet = Alphabet([*queries, *choices])
    length_q, length_c = (np.array([len(t) for t in x], dtype=np.int64) for x in (queries, choices))
    best_score, best_choice = np.full(len(queries), -1.0), np.zeros(len(queries), np.int64)

    def keep(i, j, score):
        fits = score >= least[i]
        i, j, score = i[fits], j[fits], score[fits]
        if not len(i):
            return
        order = np.lexsort((rank[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.concatenate([[True], i[1:] != i[:-1]])
        i, j, score = i[first], j[first], score[first]
        better = (score > best_score[i]) | ((score == best_score[i]) & (rank[j] < rank[best_choice[i]]))
        best_score[i[better]], best_choice[i[better]] = score[better], j[better]

    def lengths(i, j):
        return np.maximum(length_q[i], length_c[j]), np.minimum(length_q[i], length_c[j])

    def similar(i, j):
        longer, shorter = lengths(i, j)
        return 2 * longer < 3 * shorter

    def scale(i, j):
        longer, shorter = lengths(i, j)
        return np.where(longer <= 8 * shorter, WINDOW, FAR_WINDOW)

    def apart(i, j):
        """Pairs that are compared by windows, and that their scale lets pass."""
        longer, shorter = lengths(i, j)
        return (2 * longer >= 3 * shorter) & (shorter > 0) & (scale(i, j) >= least[i] - _EPS)

    def by_windows(q, c, score):
        nearest = least / (WINDOW * score(1.0))
        for i, j, x in windows(q, c, nearest, apart):
            keep(i, j, score(x) * scale(i, j))
        lowest = np.full(len(choices), nearest.min(initial=2.0))
        for j, i, x in windows(c, q, lowest, lambda j, i: (c.n[j] < q.n[i]) & apart(i, j)):
            keep(i, j, score(x) * scale(i, j))

    # Factors are applied in the order of ``weighted_ratio``, so that equal scores are equal numbers.
    q, c = Texts(queries, alphabet), Texts(choices, alphabet)
    for i, j in near(q, c, least, lambda i, j: np.ones(len(i), bool)):
        keep(i, j, ratio(q, c, i, j))
    by_windows(q, c, lambda x: x)

    query_tokens, choice_tokens = ([tokens(t) for t in x] for x in (queries, choices))
    q, c = (Texts([" ".join(t) for t in x], alphabet) for x in (query_tokens, choice_tokens))
    for i, j in near(q, c, least / TOKENS, similar):
        keep(i, j, ratio(q, c, i, j) * TOKENS)
    by_windows(q, c, lambda x: x * TOKENS)

    query_sets, choice_sets = ([list(dict.fromkeys(t)) for t in x] for x in (query_tokens, choice_tokens))
    q, c = (Texts([" ".join(t) for t in x], alphabet) for x in (query_sets, choice_sets))
    by_windows(q, c, lambda x: x * TOKENS)

    def keep_sets(i, j):
        keep(i, j, token_set(query_sets, choice_sets, i, j, least[i] / TOKENS, alphabet) * TOKENS)

    for i, j in near(q, c, least / TOKENS, similar):
        keep_sets(i, j)
    alike = np.flatnonzero((2 * length_c < 3 * longest) & (3 * length_c > 2 * shortest))
    alike_sets = [choice_sets[k] for k in alike]
    for i, j in covered(query_sets, alike_sets, least / TOKENS):
        fits = similar(i, alike[j])
        keep_sets(i[fits], alike[j[fits]])
    for j, i in covered(alike_sets, query_sets, np.full(len(alike), least.min(initial=2.0) / TOKENS)):
        fits = similar(i, alike[j])
        keep_sets(i[fits], alike[j[fits]])
    found = np.flatnonzero(best_score >= 0)
    return found, near_enough[best_choice[found]], best_score[found]
