"""Adaptive context mixing of token ids, and a range coder that it drives.

A block of ids is coded on its own; all its statistics begin anew.  Every id is predicted by three orders:

* order 2 and order 1 each name one id, the one that last followed the same two (one) ids, with a confidence of 0 to 15; how often a
  prediction of some confidence was right is learnt as the block goes by, and gives its probability p;
* order 0 has adaptive counts of all ids that neither of them named.

The orders are mixed with weights that follow, id by id, how well each of them foretold the last ones (Bayes' rule, with a floor for either):

    P(x) = w (p2 [x = a] + (1 - p2) P0(x)) + (1 - w) (p1 [x = b] + (1 - p1) P0(x))

The coder is told which case holds (a, b or neither) with the mixed probabilities, and in the last case the id by order 0.
It works with 48-bit numbers and puts out 16 bits at a time; carries are added to the words put out before.  Everything that both sides compute is either whole
numbers or single IEEE additions, products and quotients, so any machine gives the same.

A block is cut into lanes, runs of equal length that go in step, one array element each: an id costs some array operations for all lanes together.
Contexts, weights and coders are a lane's own; predictions, confidences and counts are the block's, and learn from all lanes after each step.
Where two lanes teach one slot in a step, the later lane wins.  The lanes' words stand in the order in which the reader takes them in.
"""

from __future__ import annotations

import numpy as np

#: Most ids of a block.
BLOCK = 1 << 22
#: A lane has so many ids or more (in blocks that do), and there are at most so many lanes.
LEAST_STEPS, MOST_LANES = 256, 8192
MOST_SLOTS_BITS, STEP = 18, 16
SCALE, PARTS = 16, 65_000.0
LOW, HALF, FULL = 1 << 32, (1 << 32) - 1, 1 << 48
MOST, LEAST, ENOUGH = 0.998, 0.002, 1 << 14
FLOOR, OTHER = 0.02, 1 / 64
# Fixed tables by outcome (a confidence, 16 more with a hit): how the confidence changes (of those that miss, 0 and 1 give way to the id that came), and for
# pairs of outcomes the factor in favour of order 2 where one order alone was right.
SURER = np.array([(s >> 1) - s for s in range(16)] + [int(s < 15) for s in range(16)])
PREFER = np.kron([[1.0, 1 / OTHER], [OTHER, 1.0]], np.ones((16, 16)))
#: What confidences are worth is judged after each of the first steps, then after every so many.
EARLY, SELDOM = 32, 4
#: Counts are summed up anew when so many (as a power of 2) of their ids are new, one of 2^LATE; the reader finds ids through about 2^FINDER_BITS places.
LATE, FINDER_BITS = 4, 16


def lanes_for(n: int) -> int:
    """How many lanes a block of ``n`` ids has."""
    return max(1, min(MOST_LANES, n // LEAST_STEPS))


class Model:
    """What is known of a block so far."""

    def __init__(self, lanes: int, n: int, vocabulary: int):
        if vocabulary > 1 << 31:
            raise ValueError("a vocabulary has 2^31 ids at most")
        bits = min(MOST_SLOTS_BITS, max(8, n.bit_length()))
        self.shift = 32 - bits
        self.held = [np.zeros(1 << bits, dtype=np.int64) for _ in range(2)]
        # for the confidences of an order, then the same with a hit: how often they were met; the first guess grows with confidence
        self.met = [np.concatenate([np.arange(19, 3, -1), np.arange(1, 17)]) for _ in range(2)]
        self.pairs, self.step = np.zeros(1024, dtype=np.int64), 0
        self.judge()
        self.weight = np.full(lanes, 0.5)
        self.counts = np.ones(vocabulary, dtype=np.int64)
        self.seen = self.new = 0
        self.waiting: list[np.ndarray] = []
        self.sum_up()

    def judge(self) -> None:
        """What the confidences are worth: the shares of hits, and by which factor each pair of outcomes (of order 1, of order 2) moves the odds of order 2."""
        for k, met in enumerate(self.met):
            met += self.pairs.reshape(32, 32).sum(axis=k)
            much = met.reshape(2, 16).sum(axis=0) > ENOUGH
            met >>= np.concatenate([much, much])
        self.pairs[:] = 0
        self.right = [np.clip(met[16:] / (met[:16] + met[16:]), LEAST, MOST) for met in self.met]
        self.parts = [right * PARTS for right in self.right]
        two, one = (np.concatenate([1.0 - right, right]) for right in self.right)
        self.moves = (two * PREFER / one[:, None]).reshape(-1)

    def sum_up(self) -> None:
        """Takes the ids that wait into order 0."""
        if self.waiting:
            self.counts += STEP * np.bincount(np.concatenate(self.waiting), minlength=len(self.counts))
        self.waiting, self.seen, self.new = [], self.seen + self.new, 0
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.total = int(self.ends[-1])
        self.finder = None

    def predict(self, last: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, parts of a, parts of b): the orders' predictions and their shares of 2^16; b has none where it is a."""
        near = last * 0x9E3779B1
        self.at = [((near + second * 0x85EBCA6B) & HALF) >> self.shift, (near & HALF) >> self.shift]
        self.entry = [held[at] for held, at in zip(self.held, self.at)]
        self.sure = [e & 15 for e in self.entry]
        a, b = self.guess = [e >> 4 for e in self.entry]
        pa, pb = self.weight * self.parts[0][self.sure[0]], (1.0 - self.weight) * self.parts[1][self.sure[1]]
        same = a == b
        parts_a = (pa + pb * same).astype(np.int64) + 1
        return a, b, parts_a, (pb.astype(np.int64) + 1) * ~same

    def learn(self, ids: np.ndarray, others: np.ndarray) -> None:
        """Takes in the ids that came; ``others`` are those that no order named."""
        fresh = ids << 4 | 1
        outcome = [sure + ((g == ids) << 4) for sure, g in zip(self.sure, self.guess)]
        for held, at, entry, came in zip(self.held, self.at, self.entry, outcome):
            kept = entry + SURER[came]
            held[at] = kept + (fresh - kept) * (came <= 1)
        pair = outcome[0] + (outcome[1] << 5)
        own = self.weight * self.moves[pair]
        self.weight = FLOOR + (1.0 - FLOOR - FLOOR) * (own / (own + (1.0 - self.weight)))
        self.pairs += np.bincount(pair, minlength=1024)
        self.step += 1
        if self.step < EARLY or self.step % SELDOM == 0:
            self.judge()
        self.waiting.append(others)
        self.new += len(others)
        if self.new > self.seen >> LATE:
            self.sum_up()

    def found(self, values: np.ndarray) -> np.ndarray:
        """The ids whose shares of order 0 hold ``values``."""
        if self.finder is None:
            self.steps = max(0, self.total.bit_length() - FINDER_BITS)
            self.finder = np.repeat(np.arange(len(self.ends)), np.diff((self.ends + (1 << self.steps) - 1) >> self.steps, prepend=0))
        ids = self.finder[values >> self.steps]
        later = np.flatnonzero(self.ends[ids] <= values)
        ids[later] = np.searchsorted(self.ends, values[later], side="right")
        return ids


def share(parts_a: np.ndarray, parts_b: np.ndarray, not_a: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, width) of each lane's case; sums of products, as choices by random masks take longer."""
    rest = (1 << SCALE) - parts_a - parts_b
    return parts_a * not_a + parts_b * other, parts_a + (parts_b - parts_a) * not_a + (rest - parts_b) * other


def encode(blocks: np.ndarray, vocabulary: int) -> list[bytes]:
    """The code of each row of ``blocks`` (blocks x ids, BLOCK of them at most, ids below ``vocabulary``)."""
    if blocks.shape[1] > BLOCK:
        raise ValueError(f"a block has {BLOCK} ids at most")
    return [_encoded(block, vocabulary) for block in blocks]


def decode(codes: list[bytes], n: int, vocabulary: int) -> np.ndarray:
    """The blocks (blocks x ``n`` ids) of ``codes``."""
    return np.stack([_decoded(code, n, vocabulary) for code in codes])


def _encoded(block: np.ndarray, vocabulary: int) -> bytes:
    n, lanes = len(block), lanes_for(len(block))
    model, steps = Model(lanes, n, vocabulary), -(-n // lanes)
    padded = np.zeros(lanes * steps, dtype=np.uint32)
    padded[:n] = block
    low, span = np.zeros(lanes, dtype=np.int64), np.full(lanes, FULL - 1)
    words: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def put_out() -> None:
        """Puts out words wherever the span has become small."""
        small = np.flatnonzero(span < LOW)
        while len(small):
            own = low[small]
            words.append((own >> 32).astype(np.int32))
            owners.append(small.astype(np.int16))
            low[small] = (own & HALF) << 16
            wider = span[small] << 16
            span[small] = wider
            small = small[wider < LOW]

    last = second = np.zeros(lanes, dtype=np.int64)
    for column in np.ascontiguousarray(padded.reshape(lanes, steps).T):
        ids = column.astype(np.int64)
        a, b, parts_a, parts_b = model.predict(last, second)
        not_a = a != ids
        other = not_a & (b != ids)
        begin, width = share(parts_a, parts_b, not_a, other)
        unit = span >> SCALE
        low += begin * unit
        span = width * unit
        put_out()
        rest = np.flatnonzero(other)
        others = ids[rest]
        if len(rest):
            unit = span[rest] // model.total
            low[rest] += model.starts[others] * unit
            span[rest] = model.counts[others] * unit
            put_out()
        model.learn(ids, others)
        last, second = ids, last
    # of the numbers that are left, one that ends in zeros
    words += [((low + HALF) >> 32).astype(np.int32), np.zeros(2 * lanes, dtype=np.int32)]
    owners += [np.arange(lanes, dtype=np.int16)] * 3
    return _placed(np.concatenate(words), np.concatenate(owners), lanes)


def _placed(words: np.ndarray, owners: np.ndarray, lanes: int) -> bytes:
    """The words with their carries added, where the reader takes them in: three of every lane first, then one whenever a lane had put one out."""
    order = np.argsort(owners, kind="stable")
    words = words[order]
    while (over := words >> 16).any():  # a lane's first word never carries
        words &= 0xFFFF
        words[:-1] += over[1:]
    sizes = np.bincount(owners, minlength=lanes)
    firsts = np.cumsum(sizes) - sizes
    places = np.empty(len(words), dtype=np.int64)
    places[3:] = order[:-3] + 3 * lanes
    for k in range(3):
        places[firsts + k] = np.arange(lanes) + k * lanes
    out = np.empty(len(words), dtype="<u2")
    out[places] = words
    return out.tobytes()


def _decoded(data: bytes, n: int, vocabulary: int) -> np.ndarray:
    lanes = lanes_for(n)
    model, steps = Model(lanes, n, vocabulary), -(-n // lanes)
    words = np.frombuffer(data[: len(data) // 2 * 2] + bytes(6 * lanes), dtype="<u2")
    code = words[:lanes].astype(np.int64) << 32 | words[lanes : 2 * lanes].astype(np.int64) << 16 | words[2 * lanes : 3 * lanes]
    at = 3 * lanes
    span = np.full(lanes, FULL - 1)

    def take_in() -> None:
        nonlocal at
        small = np.flatnonzero(span < LOW)
        while len(small):
            own = words[at : at + len(small)]
            at += len(small)
            if len(own) < len(small):  # damaged: its checksum will tell
                own = np.zeros(len(small), dtype=np.int64)
            code[small] = code[small] << 16 | own
            wider = span[small] << 16
            span[small] = wider
            small = small[wider < LOW]

    out = np.empty((steps, lanes), dtype=np.uint32)
    last = second = np.zeros(lanes, dtype=np.int64)
    for k in range(steps):
        a, b, parts_a, parts_b = model.predict(last, second)
        unit = span >> SCALE
        not_a, other = code >= parts_a * unit, code >= (parts_a + parts_b) * unit
        begin, width = share(parts_a, parts_b, not_a, other)
        code -= begin * unit
        span = width * unit
        take_in()
        ids = a + (b - a) * not_a
        rest = np.flatnonzero(other)
        others = rest
        if len(rest):
            own = code[rest]
            unit = span[rest] // model.total
            others = model.found(np.minimum((own / unit).astype(np.int64), model.total - 1))  # exact below 2^52
            code[rest] = own - model.starts[others] * unit
            span[rest] = model.counts[others] * unit
            take_in()
            ids[rest] = others
        model.learn(ids, others)
        out[k] = ids
        last, second = ids, last
    return np.ascontiguousarray(out.T).reshape(-1)[:n]
