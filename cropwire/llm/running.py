"""Online logistic context mixing along running text.

A text is a run of tokens, and a token a run of bits: its path in a binary tree
over the corpus's most frequent words, in which every other word is one escape.
Each predictor counts, in a hashed context and at a place of the tree, how often
the training texts went on with a 0 and with a 1: without context, after the
word before, after the two words before; one more counts what the text itself
has shown so far. The mixer adds their log odds with weights that a gate picks
(how much is known in the contexts) and, when the token is known, moves the
weights by the gradient of its cost. Weights are learned along the training
texts and go on being learned along every text that is scored.

Many texts are worked on side by side, each with weights of its own. After its
first ``STEADY`` tokens a text's weights move once per group of tokens, which
grows with the text, so that a long text takes few steps more.
"""

from __future__ import annotations

import numpy as np

from cropwire.llm.common import bits_for
from cropwire.llm.words import mix

#: Words, by count, with a path of their own in the tree; all others share the escape.
CODED = (1 << 12) - 1
#: Bits of a slot of the hashed contexts, by the size of the corpus.
LEAST_SLOT_BITS, MOST_SLOT_BITS = 10, 20
#: Added to a place's counts.
PRIOR = 0.4
#: Gates: levels of what is known after the word before, and after the two words before.
LEVELS_ONE, LEVELS_TWO = np.array([1, 8, 64]), np.array([1, 2, 4, 16])
GATES = (len(LEVELS_ONE) + 1) * (len(LEVELS_TWO) + 1)
#: Predictors: no context, one word, two words, the text itself, and a constant.
INPUTS, FIRST_WEIGHT = 5, 0.3
#: Rate of learning along a text.
RATE = 0.015
#: Tokens after which a text's groups begin to grow.
STEADY = 512
#: Tokens whose places are looked up at once.
AT_ONCE = 1 << 14
#: Most bits of a text's own table, and slots of the texts that run side by side (one larger table is taken alone).
OWN_BITS, OWN_SLOTS = 17, 1 << 22
_RATE = np.float32(RATE)
#: By a bit (2: filling): its sign, and what it adds to both counts of a place in one number.
_SIGN, _MORE = np.array([-1, 1, 0], np.float32), np.array([1, 1j, 0], np.complex64)
_FIND_BITS = 18
#: Lengths of path that are worked on side by side, shorter paths filled up; and numbers that a row of weights takes.
LENGTHS, ROW = 5, 8
#: Log odds are held as whole parts of this size.
ODDS_STEP = 1 / 8


def _take(x: np.ndarray, at: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``x[at]`` without a check of the places, which is slower."""
    return x.take(at, mode="clip", out=out)


class Code:
    """A binary tree over words (hashes in order, counts) and the escape, which is symbol 0 and was seen ``other`` times."""

    def __init__(self, h: np.ndarray, count: np.ndarray, other: int):
        self.h = np.concatenate([np.zeros(1, np.uint64), h])
        place = (h >> np.uint64(64 - _FIND_BITS)).astype(np.int64)
        self.find = np.zeros(1 << _FIND_BITS, np.int32)
        self.find[place] = np.arange(1, len(h) + 1)
        # Several words share the place: looked for one by one.
        self.find[np.bincount(place, minlength=1 << _FIND_BITS) > 1] = -1
        self._paths(np.concatenate([[max(1, other)], count]).astype(np.int64))

    def _paths(self, weight: np.ndarray) -> None:
        """Huffman's tree: the two lightest nodes are joined until one is left."""
        n = len(weight)
        leaves = np.argsort(weight, kind="stable").tolist()
        heavy, parent, side = [*weight.tolist(), *[0] * (n - 1)], np.full(2 * n - 1, -1, np.int64), np.zeros(2 * n - 1, np.uint8)
        leaf, inner = 0, n
        for new in range(n, 2 * n - 1):
            for s in (0, 1):
                if inner >= new or (leaf < n and heavy[leaves[leaf]] <= heavy[inner]):
                    x, leaf = leaves[leaf], leaf + 1
                else:
                    x, inner = inner, inner + 1
                heavy[new] += heavy[x]
                parent[x], side[x] = new, s
        self.size = np.zeros(n, np.int64)
        up, at = [], np.arange(n)
        while (more := parent[at] >= 0).any():
            self.size += more
            up.append((more, parent[at] - n, side[at]))
            at = np.where(more, parent[at], at)
        self._lengths(weight)
        self.cut = np.cumsum(self.wide) - self.wide
        self.node, self.bit = np.zeros(int(self.wide.sum()), np.int32), np.zeros(int(self.wide.sum()), np.uint8)
        #: Every place's bit, or 2 where a path is filled up.
        self.kind = np.full(len(self.bit), 2, np.uint8)
        for k, (more, node, bit) in enumerate(up):
            to = (self.cut + self.size - 1 - k)[more]
            self.node[to], self.bit[to], self.kind[to] = node[more], bit[more], bit[more]
        self.spread = _spread(self.node)
        #: Inner nodes; the last is the root.
        self.nodes = n - 1

    def _lengths(self, weight: np.ndarray) -> None:
        """Few lengths that paths are filled up to, the longest first, and which one each path has: lengths are joined where that fills up least."""
        lengths, many = np.unique(self.size), np.bincount(self.size, weight)
        lengths, many = lengths.tolist(), many[lengths].tolist()
        while len(lengths) > LENGTHS:
            k = min(range(len(lengths) - 1), key=lambda i: many[i] * (lengths[i + 1] - lengths[i]))
            shorter, _ = many.pop(k), lengths.pop(k)
            many[k] += shorter
        self.lengths = np.array(lengths[::-1])
        self.length = len(lengths) - 1 - np.searchsorted(lengths, self.size)
        self.wide = self.lengths[self.length]

    def symbols(self, h: np.ndarray) -> np.ndarray:
        out = self.find[(h >> np.uint64(64 - _FIND_BITS)).astype(np.int64)]
        hard = np.flatnonzero(out < 0)
        out[hard] = np.minimum(np.searchsorted(self.h[1:], h[hard]) + 1, len(self.h) - 1)
        out[self.h[out] != h] = 0
        return out


def _spread(node) -> np.ndarray:
    return (np.atleast_1d(node).astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)


def slot_bits(tokens: int) -> int:
    return min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, bits_for(tokens, 1) + 2))


def _slot(context: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    return (((context ^ spread) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)).astype(np.int64)


class Stream:
    """Texts as running tokens: symbol, and hashes of the word and the two words before; ``begin`` of every text, and the end."""

    def __init__(self, symbol, one, two, begin):
        self.symbol, self.one, self.two, self.begin = symbol, one, two, begin

    @classmethod
    def of(cls, code: Code, h: np.ndarray, one: np.ndarray, context: np.ndarray, begin: np.ndarray) -> "Stream":
        half = np.uint64(32)
        return cls(code.symbols(h), (mix(one) >> half).astype(np.uint32), (context >> half).astype(np.uint32), begin)


def count(code: Code, s: Stream, tokens: np.ndarray, bits: int, table: np.ndarray) -> None:
    """Adds these tokens to ``table``: how often each symbol occurs, then the bits, 0 and 1 side by side, in the slots of one and of two words before."""
    symbols = len(code.size)
    table[:symbols] += np.bincount(s.symbol[tokens], minlength=symbols)
    each = AT_ONCE << 2
    for a in range(0, len(tokens), each):
        t = tokens[a:a + each]
        size = _take(code.size, _take(s.symbol, t))
        first = np.cumsum(size) - size
        of_token = np.repeat(np.arange(len(t)), size)
        at = _take(_take(code.cut, _take(s.symbol, t)) - first, of_token)
        at += np.arange(len(at))
        bit, spread, base = _take(code.bit, at), _take(code.spread, at), symbols
        for context in (s.one, s.two):
            slot = _slot(_take(_take(context, t), of_token), spread, bits)
            slot <<= 1
            slot += bit
            np.add.at(table[base:base + (2 << bits)], slot, table.dtype.type(1))
            base += 2 << bits


def table_size(code: Code, bits: int) -> int:
    return len(code.size) + (4 << bits)


def first_weights() -> np.ndarray:
    """(gate, input): all predictors alike."""
    out = np.full((GATES, INPUTS), FIRST_WEIGHT)
    out[:, -1] = 0
    return out


def _odds(counts: np.ndarray, left_out: bool) -> np.ndarray:
    """Log odds of every place, in ``ODDS_STEP``; with ``left_out`` by place * 2 + bit, that bit's own part taken out."""
    n0, n1 = counts.T.astype(np.float32)
    prior = np.float32(PRIOR)
    if left_out:
        odds = np.stack([np.log((n1 + prior) / (np.maximum(n0 - 1, 0) + prior)), np.log((np.maximum(n1 - 1, 0) + prior) / (n0 + prior))], axis=1).ravel()
    else:
        odds = np.log((n1 + prior) / (n0 + prior))
    return np.clip(np.rint(odds / ODDS_STEP), -127, 127).astype(np.int8)


class Mixer:
    """Runs along texts. ``left_out``: a token's own part is taken out of the counts, as for a text not learned from."""

    def __init__(self, code: Code, table: np.ndarray, bits: int, left_out: bool):
        self.code, self.bits, self.left_out, self.lengths = code, bits, left_out, code.lengths.tolist()
        # Without context: every symbol's count at the places of its path.
        symbols = len(code.size)
        plain = np.bincount(code.node.astype(np.int64) * 2 + code.bit, np.repeat(table[:symbols].astype(np.float64), code.wide) * (code.kind < 2), minlength=2 * code.nodes)
        cut = symbols + (2 << bits)
        plain = _odds(plain.reshape(-1, 2), left_out)[code.node.astype(np.int64) * 2 + code.bit if left_out else code.node]
        #: Without context by place of the paths, as it speaks for the bit there; in the contexts by slot.
        self.plain = plain * np.float32(ODDS_STEP) * _SIGN[code.kind]
        counts = [x.reshape(-1, 2) for x in (table[symbols:cut], table[cut:])]
        self.odds = [_odds(c, left_out) for c in counts]
        one, two = (c.sum(axis=1) - left_out for c in counts)
        self.level = [(np.digitize(one, LEVELS_ONE) * (len(LEVELS_TWO) + 1)).astype(np.uint8), np.digitize(two, LEVELS_TWO).astype(np.uint8)]

    def _steps(self, begin: np.ndarray, size: np.ndarray):
        """Per step the tokens of all texts that are known after it, the texts they are of and each text's number of them."""
        p, most, falling, all_texts = 0, int(size[0]), -size, np.arange(len(size))
        while p < most:
            to = p + 1 + p // STEADY
            a = int(np.searchsorted(falling, -p, side="left"))
            if to == p + 1:
                yield begin[:a] + p, all_texts[:a], 1
            else:
                wide = np.minimum(size[:a], to) - p
                text = np.repeat(all_texts[:a], wide)
                yield np.arange(len(text)) + np.repeat(begin[:a] + p - (np.cumsum(wide) - wide), wide), text, wide
            p = to

    def _blocks(self, steps):
        held, many = [], 0
        for step in steps:
            held.append(step)
            many += len(step[0])
            if many >= AT_ONCE:
                yield held
                held, many = [], 0
        if held:
            yield held

    def _by_level(self, s: Stream, block):
        """A block's tokens, step by step and by falling length of path, and the texts they are of; its bits' tokens (as
        places in the block) and places in the paths, step by step, length by length and level by level; and each step's number of tokens by length."""
        t, text = (np.concatenate([b[i] for b in block]) for i in (0, 1))
        many, lengths = np.array([len(b[0]) for b in block]), self.code.lengths
        key = np.repeat(np.arange(len(block)) * len(lengths), many) + _take(self.code.length, _take(s.symbol, t))
        if len(block) * len(lengths) <= 1 << 16:
            key = key.astype(np.uint16)  # sorted faster
        order = np.argsort(key, kind="stable")
        t, text = _take(t, order), _take(text, order)
        of_length = np.bincount(key, minlength=len(block) * len(lengths))
        wide = np.tile(lengths, len(block))
        level = np.repeat(of_length, wide)
        first = np.repeat(np.cumsum(of_length) - of_length, wide)
        of_token = np.arange(int(level.sum())) + np.repeat(first - (np.cumsum(level) - level), level)
        at = _take(_take(self.code.cut, _take(s.symbol, t)), of_token)
        at += np.repeat(np.tile(np.concatenate([np.arange(x) for x in lengths]), len(block)), level)
        return t, text, of_token, at, of_length.reshape(len(block), -1)

    def run(self, s: Stream, weight: np.ndarray, texts: np.ndarray | None = None, scored: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of every token (0 unless ``scored``); and, per gate, the weights (by input) at the texts' ends, each as often as the text used them, and how often in all.

        Each text goes on from ``weight`` by itself.
        """
        code, out, tokens_of = self.code, np.zeros(len(s.symbol), np.float32), np.zeros(GATES, np.int64)
        begin, size = s.begin[:-1], np.diff(s.begin)
        if texts is not None:
            begin, size = begin[texts], size[texts]
        if not code.nodes or not len(size):
            return out, np.zeros((GATES, INPUTS)), tokens_of
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        own_bits = np.clip(np.ceil(np.log2(size)).astype(np.int64) + 1, 3, OWN_BITS)
        ends = np.cumsum(1 << own_bits)
        learned, a = np.zeros((GATES, INPUTS)), 0
        while a < len(size):
            z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + OWN_SLOTS, side="right")))
            self._part(s, begin[a:z], size[a:z], own_bits[a:z], weight.astype(np.float32), out if scored else None, learned, tokens_of)
            a = z
        return out, learned, tokens_of

    def _part(self, s: Stream, begin, size, own_bits, weight: np.ndarray, out: np.ndarray | None, learned: np.ndarray, tokens_of: np.ndarray) -> None:
        """Runs along some texts side by side, the longest first.

        Paths are filled up to one of a few lengths. A step's bits lie by length and there level by
        level, so that the tokens of a length have their bits side by side. All inputs are taken
        towards the bit that came: a positive one speaks for it, and where a path is filled up they are 0.
        """
        code = self.code
        # Row by row a text's gate.
        w = np.zeros((GATES, ROW), np.float32)
        w[:, :INPUTS] = weight
        w = np.tile(w, (len(size), 1))
        as_rows, inputs = w.view(f"V{4 * ROW}").ravel(), np.arange(INPUTS)
        used = np.zeros(len(w), np.int64)
        # Texts with tables of one size have the same slot side by side, since many of them are at the same few places. Both counts of a place, with the prior, are in one number.
        _, of, many = np.unique(-own_bits, return_inverse=True, return_counts=True)
        slots = many << own_bits[np.cumsum(many) - many]
        # The last one is for what paths are filled up with.
        own = np.full(int(slots.sum()) + 1, PRIOR * (1 + 1j), np.complex64)
        own_begin = ((np.cumsum(slots) - slots) - (np.cumsum(many) - many))[of] + np.arange(len(size))
        own_apart, own_shift = many[of], (32 - own_bits).astype(np.uint32)
        root = _spread(code.nodes - 1)
        for block in self._blocks(self._steps(begin, size)):
            t, text, of_token, at, of_length = self._by_level(s, block)
            kind, spread = _take(code.kind, at), _take(code.spread, at)
            one, two = _take(s.one, t), _take(s.two, t)
            x = np.empty((INPUTS, len(at)), np.float32)
            x[0] = _take(self.plain, at)
            sign = _take(_SIGN, kind, out=x[4])
            part = sign * np.float32(ODDS_STEP)
            for i, context in ((1, one), (2, two)):
                place = _slot(_take(context, of_token), spread, self.bits)
                if self.left_out:
                    place <<= 1
                    place += kind & 1
                np.multiply(_take(self.odds[i - 1], place), part, out=x[i])
            gate = _take(self.level[0], _slot(one, root, self.bits)).astype(np.int64) + _take(self.level[1], _slot(two, root, self.bits))
            row = text * GATES + gate
            used += np.bincount(row, minlength=len(used))
            own_at = (spread >> _take(_take(own_shift, text), of_token)) * _take(_take(own_apart, text), of_token)
            own_at += _take(_take(own_begin, text), of_token)
            np.putmask(own_at, kind == 2, len(own) - 1)
            more = _take(_MORE, kind)
            bits_of = (of_length @ code.lengths).tolist()
            cost, room = np.empty(len(at), np.float32), np.empty(INPUTS * max(bits_of), np.float32)
            k, e = 0, 0
            for (tokens, _, group), many_bits, tokens_of_length in zip(block, bits_of, of_length.tolist()):
                kk, ee = k + len(tokens), e + many_bits
                here, rows, places, weighed = x[:, e:ee], row[k:kk], own_at[e:ee], room[:INPUTS * many_bits].reshape(INPUTS, many_bits)
                seen = own[places]
                odds = seen.imag / seen.real
                np.multiply(np.log(odds, out=odds), sign[e:ee], out=here[3])
                now = w.take(rows, axis=0, mode="clip")
                by_input, parts, a, b = np.ascontiguousarray(now.T[:INPUTS]), [], 0, 0
                for n, wide in zip(tokens_of_length, self.lengths):
                    if n:
                        to, z = a + n * wide, b + n
                        parts.append((here[:, a:to].reshape(INPUTS, wide, n), b, z))
                        np.multiply(parts[-1][0], by_input[:, None, b:z], out=weighed[:, a:to].reshape(INPUTS, wide, n))
                        a, b = to, z
                z = np.add.reduce(weighed, axis=0, out=cost[e:ee])
                np.maximum(z, -20, out=z)
                np.minimum(z, 20, out=z)
                np.exp(z, out=z)
                here *= 1 / (1 + z)
                move = by_input
                for part, b, z in parts:
                    np.add.reduce(part, axis=1, out=move[:, b:z])
                if isinstance(group, int):
                    move *= _RATE
                    now[:, :INPUTS] += move.T
                    as_rows[rows] = now.view(as_rows.dtype).ravel()
                    # Of two places of a token that share a slot one counts.
                    seen += more[e:ee]
                    own[places] = seen
                else:
                    move *= (RATE / group).astype(np.float32)[text[k:kk]]
                    np.add.at(w.reshape(-1), (rows[:, None] * ROW + inputs).ravel(), move.T.ravel())
                    np.add.at(own, places, more[e:ee])
                k, e = kk, ee
            if out is not None:
                out[t] = np.bincount(of_token, np.log(1 + 1 / cost) * (kind < 2), minlength=len(t)) / -np.log(10)
        used = used.reshape(-1, GATES)
        tokens_of += used.sum(axis=0)
        learned += np.einsum("tg,tgi->gi", used.astype(float), w.reshape(-1, GATES, ROW)[:, :, :INPUTS])
