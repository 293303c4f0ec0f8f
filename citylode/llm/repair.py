"""Re-Pair: frequent pairs of ids become nonterminals, over and over; rules and expansion lengths are kept.

A packed shard is, in this order, little-endian: the magic ``RPR2``; uint32 numbers of base ids, rules, symbols
and documents, of documents without id (they come first), of bits of a symbol and of bytes of an expansion length;
the rules, as one list of their left and
right symbols; the expansion length of every rule; doc_ids as int64 and document lengths in ids as uint32; the
symbols. Symbols below the number of base ids are ids, the others rules in order. A list of symbols is the low
16 bits of each as uint16, then, for every further bit, that bit of all symbols, packed eight to a byte.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

MAGIC = b"RPR2"
LEAST = 3  # a rule costs two symbols and a length, and saves a symbol per use: two uses do not pay for it
FALL = 0.67  # of the limit from one round to the next
SLOTS = 19  # binary logarithm of the counters that rule out rare pairs, at most
NEVER = 255  # the round of places that begin no pair frequent enough


def counted(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of some pairs how often it occurs among them, or more where pairs share a counter."""
    bits = min(SLOTS, len(left).bit_length() + 1)
    slot = (left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
    slot = slot.astype(np.intp)
    return np.bincount(slot, minlength=1 << bits).take(slot)


def chosen_pairs(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Those of some pairs, sorted, that can be replaced together.

    In falling order of their counts, a pair is taken unless one taken before ends with its first symbol or
    begins with its second: then no two of the chosen ones overlap in the text. Each step takes all pairs that
    no undecided one precedes in that way.
    """
    order = np.argsort(-counts, kind="stable")
    left, right = found[order] >> np.uint64(32), found[order] & np.uint64(0xFFFFFFFF)
    names, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    left, right = at[:len(order)], at[len(order):]
    open_, taken = np.arange(len(order)), np.zeros(len(order), bool)
    begun, ended = np.zeros(len(names), bool), np.zeros(len(names), bool)
    while len(open_):
        x, y = left[open_], right[open_]
        begins, ends = np.full(len(names), len(order)), np.full(len(names), len(order))
        begins[x[::-1]] = open_[::-1]  # the first undecided pair that begins with a symbol
        ends[y[::-1]] = open_[::-1]
        good = (ends[x] >= open_) & (begins[y] >= open_)
        taken[open_[good]] = True
        begun[x[good]] = ended[y[good]] = True
        open_ = open_[~good & ~ended[x] & ~begun[y]]
    return np.sort(found[order[taken]])


def taken_places(where: np.ndarray, following: np.ndarray | None = None) -> np.ndarray:
    """Which of some places, sorted, are replaced: only pairs of two equal symbols overlap, and of a run of them
    the first, third and so on are. The place that follows each is the next number unless given."""
    following = where + 1 if following is None else following
    goes_on = where[1:] == following[:-1]
    if not goes_on.any():
        return np.ones(len(where), bool)
    begins = np.concatenate([[True], ~goes_on])
    run_start = np.maximum.accumulate(np.where(begins, np.arange(len(where)), 0))
    return (np.arange(len(where)) - run_start) % 2 == 0


def by_pair(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of symbols of ``bits`` bits, sorted, and where each was; equal ones stay in order.

    Where a pair and its place fit 64 bits together, numbers of both are sorted, which is faster.
    """
    room = np.uint64(len(left).bit_length())
    if 2 * bits + int(room) > 64:
        pairs = left.astype(np.uint64) << np.uint64(32) | right
        order = np.argsort(pairs, kind="stable")
        return pairs[order], order
    keys = left.astype(np.uint64) << (room + np.uint64(bits))
    keys |= right.astype(np.uint64) << room
    keys |= np.arange(len(left), dtype=np.uint64)
    keys.sort()
    order = (keys & ((np.uint64(1) << room) - np.uint64(1))).astype(np.intp)
    keys >>= room
    return keys >> np.uint64(bits) << np.uint64(32) | keys & ((np.uint64(1) << np.uint64(bits)) - np.uint64(1)), order


def falling_limits(most: int, least: int) -> tuple[list[int], np.ndarray]:
    """The limits of the rounds, and for every count up to ``most`` the first round that takes such pairs."""
    limits = [max(least, most)]
    while limits[-1] > least:
        limits.append(max(least, int(limits[-1] * FALL)))
    rounds = np.full(most + 1, NEVER, np.uint8)
    for k in reversed(range(len(limits))):
        rounds[limits[k]:] = k
    return limits, rounds


def compress(ids: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (a pair of symbols each) of a sequence of ids below ``base``.

    Goes on until no pair occurs ``least`` times. Each round takes the pairs above a falling limit, the most
    frequent ones first, and replaces all those together that do not overlap. All occurrences of a pair arise
    in one round, that of its newer symbol, and only get fewer after it. So a place is counted when its pair
    arises, and looked at again in the round whose limit that count reaches. Symbols stay where they are and
    are linked, so that a round costs what it looks at.
    """
    symbols, rules, made, n = ids.astype(np.uint32), [], 0, len(ids)
    alive = np.ones(n, bool)
    if n < 2:
        return symbols, np.zeros((0, 2), np.uint32)
    kind = np.int32 if n < 1 << 31 else np.int64
    after, before = np.arange(1, n + 1, dtype=kind), np.arange(-1, n, dtype=kind)
    counts = counted(symbols[:-1], symbols[1:])
    most = int(counts.max())
    limits, rounds = falling_limits(most, least)
    turn = np.full(n, NEVER, np.uint8)  # the round in which a place is looked at
    turn[:-1] = rounds.take(counts)
    k, last = 0, len(limits) - 1
    while True:
        limit, coming = limits[k], min(k + 1, last)
        places = np.flatnonzero(turn == k)
        pairs, order = by_pair(symbols.take(places), symbols.take(after.take(places)), (base + made).bit_length())
        places = places.take(order)  # in the order of their pairs, then of the text
        starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.arange(0)
        found, sizes = pairs.take(starts), np.diff(starts, append=len(pairs))
        same = found >> np.uint64(32) == found & np.uint64(0xFFFFFFFF)
        counts = np.where(same, (sizes + 1) // 2, sizes)  # at least so many of them do not overlap
        often = np.flatnonzero(counts >= limit)
        if not len(often) and k == last:
            break
        turn[places] = np.repeat(np.maximum(rounds.take(np.minimum(counts, most)), coming), sizes)
        k = coming
        if not len(often):
            continue
        chosen = chosen_pairs(found[often], counts[often])
        at = np.searchsorted(found, chosen)
        where = places.take(spans(starts[at], sizes[at]))
        new, first = np.repeat(np.arange(base + made, base + made + len(chosen), dtype=np.uint32), sizes[at]), base + made
        gone = after.take(where)
        if (found[at] >> np.uint64(32) == found[at] & np.uint64(0xFFFFFFFF)).any():
            taken = taken_places(where, gone)
            where, new, gone = where[taken], new[taken], gone[taken]
        then = after.take(gone)
        symbols[where] = new
        alive[gone], turn[gone] = False, NEVER
        after[where], before[then] = then, where
        prior = before.take(where)
        prior = prior[prior >= 0]
        end = then == n  # the last symbol begins no pair
        turn[where[end]] = NEVER
        born = np.concatenate([where[~end], prior[symbols.take(prior) < first]])
        if len(born):
            counts = counted(symbols.take(born), symbols.take(after.take(born)))
            turn[born] = np.maximum(rounds.take(np.minimum(counts, most)), coming)
        rules.append(np.column_stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)]).astype(np.uint32))
        made += len(chosen)
    return symbols[alive], np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def pack_symbols(symbols: np.ndarray, bits: int) -> bytes:
    """Symbols of ``bits`` bits each: the low halves, then one plane for each further bit."""
    planes = [np.packbits((symbols >> np.uint32(k) & np.uint32(1)).astype(np.uint8)).tobytes() for k in range(16, bits)]
    return (symbols & np.uint32(0xFFFF)).astype("<u2").tobytes() + b"".join(planes)


def packed_size(n: int, bits: int) -> int:
    return 2 * n + max(0, bits - 16) * -(-n // 8)


def unpack_symbols(data: bytes, n: int, bits: int) -> np.ndarray:
    out = np.frombuffer(data, "<u2", n).astype(np.uint32)
    for k in range(16, bits):
        plane = np.frombuffer(data, np.uint8, -(-n // 8), 2 * n + (k - 16) * -(-n // 8))
        out |= np.unpackbits(plane, count=n).astype(np.uint32) << np.uint32(k)
    return out


def by_depth(rules: np.ndarray, base: int) -> list[np.ndarray]:
    """Numbers of rules, those first that only use ids, then those that use such rules, and so on."""
    depth = np.zeros(base + len(rules), np.int32)
    while len(rules):
        deeper = depth[rules].max(axis=1) + 1
        if (deeper == depth[base:]).all():
            break
        depth[base:] = deeper
    order = np.argsort(depth[base:], kind="stable")
    return np.split(order, np.searchsorted(depth[base:][order], np.arange(2, depth.max() + 1))) if len(rules) else []


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for."""
    lengths = np.ones(base + len(rules), np.int64)
    for some in by_depth(rules, base):
        lengths[base + some] = lengths[rules[some]].sum(axis=1)
    return lengths[base:]


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several stretches, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes)


def pack_shard(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, base: int, nameless: int = 0) -> bytes:
    """A shard of whole documents as bytes; the first ``nameless`` ones have no id."""
    symbols, rules = compress(ids, base)
    bits = max(16, int(base + len(rules)).bit_length())
    sizes = expansion_lengths(rules, base)
    width = next(w for w in (1, 2, 4) if sizes.max(initial=0) < 1 << 8 * w)
    return b"".join([
        MAGIC, np.array([base, len(rules), len(symbols), len(doc_ids), nameless, bits, width], "<u4").tobytes(),
        pack_symbols(rules.T.reshape(-1), bits), sizes.astype(f"<u{width}").tobytes(), doc_ids.astype("<i8").tobytes(),
        lengths.astype("<u4").tobytes(), pack_symbols(symbols, bits)])


@dataclass(frozen=True)
class Shard:
    """A packed shard, opened."""
    base: int
    rules: np.ndarray
    rule_lengths: np.ndarray
    doc_ids: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    nameless: int = 0

    @cached_property
    def expansion(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length and start of every symbol's ids in a flat table of them, and that table."""
        lengths = np.concatenate([np.ones(self.base, np.int64), self.rule_lengths.astype(np.int64)])
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.uint16)
        flat[:self.base] = np.arange(self.base)
        for some in by_depth(self.rules, self.base):
            parts, whole = self.rules[some].reshape(-1), self.base + some
            flat[spans(starts[whole], lengths[whole])] = flat[spans(starts[parts], lengths[parts])]
        return lengths, starts, flat

    @cached_property
    def ends(self) -> np.ndarray:
        """Ids up to the end of each symbol: where to look for an id without decoding what comes before."""
        return np.cumsum(self.expansion[0][self.symbols])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths, starts, flat = self.expansion
        return flat[spans(starts[symbols], lengths[symbols])]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from start to stop; only the symbols that cover them are expanded."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return np.zeros(0, np.uint16)
        lo = int(np.searchsorted(self.ends, start, "right"))
        hi = int(np.searchsorted(self.ends, stop, "left")) + 1
        before = int(self.ends[lo - 1]) if lo else 0
        return self.expand(self.symbols[lo:hi])[start - before:stop - before]

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the shard."""
        start = int(self.lengths[:k].sum())
        return self.ids(start, start + int(self.lengths[k]))


def open_shard(data: bytes) -> Shard:
    if data[:4] != MAGIC:
        raise ValueError("not a packed shard")
    base, rules, symbols, docs, nameless, bits, width = np.frombuffer(data, "<u4", 7, 4).tolist()
    at = 32
    pairs = unpack_symbols(data[at:at + packed_size(2 * rules, bits)], 2 * rules, bits).reshape(2, -1).T
    at += packed_size(2 * rules, bits)
    out = []
    for kind, n in ((f"<u{width}", rules), ("<i8", docs), ("<u4", docs)):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return Shard(base, pairs, *out, unpack_symbols(data[at:at + packed_size(symbols, bits)], symbols, bits), nameless)
