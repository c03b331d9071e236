"""A bidirectional window network in numpy: each token from those on both sides.

The embeddings of the ``SIDE`` tokens before and after a position are joined and go
through one hidden layer. The position itself is never an input, so the model masks it by
construction. The output has two levels: a distribution over classes of tokens, and one
over the tokens of the class, so that each of C * M tokens has a probability of its own
at the cost of C + M outputs. Token t is number t % M of class t // M. Texts are laid end
to end with ``SIDE`` edge marks between them; a window never sees another text.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

SIDE, WIDTH, HIDDEN = 2, 16, 32
BATCH, STEP = 2048, 0.05
#: Positions scored at once.
SCORED = 4096
#: Batches put in the order of their classes at once.
SORTED = 64
#: Scores beyond this, either way, are shifted before they are exponents.
FAR = 60


def _runs(classes: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, from, to) of the positions of each class in sorted ``classes``."""
    ends = (np.flatnonzero(classes[1:] != classes[:-1]) + 1).tolist()
    starts = [0, *ends] if len(classes) else []
    return list(zip(classes[starts].tolist(), starts, [*ends, len(classes)]))


def _order(numbers: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0; short ones are sorted by digits."""
    return np.argsort(numbers.astype(np.uint16) if numbers.max(initial=0) < 1 << 16 else numbers, kind="stable")


def _powers(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """exp of ``scores`` in place, up to a factor for every row, and what the row lost."""
    lost: np.ndarray | float = 0.0
    if scores.size and max(scores.max(), -scores.min()) > FAR:
        lost = scores.max(axis=1)
        scores -= lost[:, None]
    return np.exp(scores, out=scores), lost


def _sums(rows: np.ndarray) -> np.ndarray:
    """The sum of every row; a product is faster than a sum over short rows."""
    return rows @ np.ones(rows.shape[1], dtype=rows.dtype)


def _cells(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each row's wanted place is in the flat ``scores``."""
    return np.arange(0, scores.size, scores.shape[1]) + wanted


def _slopes(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of the mean loss by every score, in place: softmax, less one at the wanted place."""
    shares, n = _powers(scores)[0], np.float32(len(wanted))
    shares *= (1 / (_sums(shares) * n))[:, None]
    shares.reshape(-1)[_cells(shares, wanted)] -= 1 / n
    return shares


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights with the bias as the row of an input that is always 1."""
    return np.concatenate([weights, bias[..., None, :]], axis=-2, dtype=np.float32)


def _by_class(hidden: np.ndarray, members: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The scores of every position's class's members."""
    inside = np.empty((len(hidden), members.shape[2]), dtype=np.float32)
    for c, first, last in runs:
        hidden[first:last].dot(members[c], inside[first:last])
    return inside


@dataclass
class Net:
    """``embed`` has a row per token and a last one for the edge."""

    embed: np.ndarray
    into: np.ndarray
    into_bias: np.ndarray
    classes: np.ndarray
    classes_bias: np.ndarray
    members: np.ndarray
    members_bias: np.ndarray

    @staticmethod
    def shapes(classes: int, members: int) -> list[tuple[int, ...]]:
        side = 2 * SIDE
        return [
            (classes * members + 1, WIDTH), (side, WIDTH, HIDDEN), (HIDDEN,),
            (HIDDEN, classes), (classes,), (classes, HIDDEN, members), (classes, members),
        ]

    @staticmethod
    def start(unigram: np.ndarray, members: int) -> Net:
        """Before training: the frequencies of the tokens, whatever the context."""
        rng, (first, *_) = np.random.default_rng(7), Net.shapes(len(unigram) // members, members)
        counts = (unigram + 1).reshape(-1, members)
        of_class = counts.sum(axis=1)
        return Net(
            rng.normal(0, 0.3, first),
            rng.normal(0, (2 * SIDE * WIDTH) ** -0.5, (2 * SIDE, WIDTH, HIDDEN)),
            np.zeros(HIDDEN),
            np.zeros((HIDDEN, len(counts))),
            np.log(of_class / of_class.sum()),
            np.zeros((len(counts), HIDDEN, members)),
            np.log(counts / of_class[:, None]),
        )

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @staticmethod
    def shaped(flat: np.ndarray, classes: int, members: int) -> Net:
        out, at = [], 0
        for shape in Net.shapes(classes, members):
            size = int(np.prod(shape))
            out.append(np.array(flat[at : at + size]).reshape(shape))
            at += size
        return Net(*out)

    @property
    def edge(self) -> int:
        return len(self.embed) - 1

    def lay(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens with edge marks, and where each text's tokens stand."""
        at = np.arange(len(tokens)) + SIDE * (1 + np.repeat(np.arange(len(lengths)), lengths))
        laid = np.full(len(tokens) + SIDE * (len(lengths) + 1), self.edge, dtype=np.int64)
        laid[at] = tokens
        return laid, at

    def around(self, laid: np.ndarray, at: np.ndarray) -> np.ndarray:
        steps = [d for d in range(-SIDE, SIDE + 1) if d]
        return laid.take(at[:, None] + np.array(steps))

    def score(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The summed conditional log probability of every text's tokens."""
        laid, at = self.lay(tokens, lengths)
        # The first layer is a sum of one row per neighbour.
        rows = np.einsum("vw,swh->svh", self.embed, self.into).astype(np.float32)
        bias, width = self.into_bias.astype(np.float32), self.members.shape[2]
        classes, members = _with_bias(self.classes, self.classes_bias), _with_bias(self.members, self.members_bias)
        logs = np.zeros(len(at))
        for start in range(0, len(at), SCORED):
            some = at[start : start + SCORED]
            # In the order of classes, members' products run on whole slices.
            order = _order(laid[some] // width)
            some = some[order]
            near, wanted = self.around(laid, some), laid[some]
            sums = rows[0].take(near[:, 0], axis=0)
            for k in range(1, 2 * SIDE):
                sums += rows[k].take(near[:, k], axis=0)
            sums += bias
            hidden = np.ones((len(some), HIDDEN + 1), dtype=np.float32)
            np.tanh(sums, out=hidden[:, :HIDDEN])
            home, place = wanted // width, wanted % width
            inside = _by_class(hidden, members, _runs(home))
            logs[start + order] = _log_share(hidden @ classes, home) + _log_share(inside, place)
        ends = np.cumsum(lengths)
        sums = np.concatenate([[0.0], np.cumsum(logs)])
        return sums[ends] - sums[ends - lengths]


def _log_share(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The log of the softmax of every row at one of its places; ``scores`` is used up."""
    told = scores.reshape(-1)[_cells(scores, wanted)]
    powers, lost = _powers(scores)
    return told - lost - np.log(_sums(powers))


class Trainer:
    """Adaptive gradient steps on batches of masked positions, in single precision."""

    def __init__(self, net: Net):
        # Biases are rows of their weights; the net's parts are views of these.
        self.classes = _with_bias(net.classes, net.classes_bias)
        self.members = _with_bias(net.members, net.members_bias)
        embed, into, into_bias = (p.astype(np.float32) for p in net.parts()[:3])
        self.net = Net(
            embed, into, into_bias,
            self.classes[:-1], self.classes[-1], self.members[:, :-1], self.members[:, -1],
        )
        moved = [embed, into, into_bias, self.classes, self.members]
        self.seen = {id(p): np.full(p.shape, 1e-4, dtype=np.float32) for p in moved}
        #: Where each token's numbers are in the flat ``embed``, two by two.
        self.pairs = np.arange(embed.size // 2).reshape(len(embed), -1)
        self.positions = 0

    def _move(self, part: np.ndarray, slope: np.ndarray) -> None:
        """A step on a part; what has no slope does not move. ``slope`` is used up."""
        seen, size = self.seen[id(part)], slope * slope
        seen += size
        slope *= np.float32(STEP)
        slope /= np.sqrt(seen, out=size)
        part -= slope

    def step(self, near: np.ndarray, wanted: np.ndarray) -> None:
        net, n, width = self.net, len(wanted), self.net.members.shape[2]
        home = wanted // width
        if (home[1:] < home[:-1]).any():
            # In the order of classes, so that each is a slice.
            order = _order(home)
            near, wanted, home = near[order], wanted[order], home[order]
        place, runs, into = wanted - home * width, _runs(home), net.into.reshape(-1, HIDDEN)
        inputs = net.embed.take(near, axis=0).reshape(n, -1)
        sums = inputs @ into
        sums += net.into_bias
        hidden = np.ones((n, HIDDEN + 1), dtype=np.float32)
        own = np.tanh(sums, out=hidden[:, :HIDDEN])
        share = _slopes(hidden @ self.classes, home)
        inside = _slopes(_by_class(hidden, self.members, runs), place)
        back, slopes = np.empty((n, HIDDEN), dtype=np.float32), np.zeros_like(self.members)
        turned, of_member = hidden.T, net.members.transpose(0, 2, 1)
        for c, first, last in runs:
            of_class = inside[first:last]
            of_class.dot(of_member[c], back[first:last])
            turned[:, first:last].dot(of_class, slopes[c])
        back += share @ net.classes.T
        self._move(self.members, slopes)
        self._move(self.classes, hidden.T @ share)
        np.multiply(own, own, out=sums)
        back *= np.subtract(1, sums, out=sums)
        # One row per neighbour and position, summed by token, two numbers at a time.
        sums, rows = np.zeros(net.embed.shape), (back @ into.T).astype(np.float64)
        pairs = self.pairs.take(near, axis=0).ravel()
        np.add.at(sums.reshape(-1).view(np.complex128), pairs, rows.reshape(-1).view(np.complex128))
        slope = (inputs.T @ back).reshape(net.into.shape)
        self._move(net.embed, sums.astype(np.float32))
        self._move(net.into, slope)
        self._move(net.into_bias, back.sum(axis=0))
        self.positions += n

    def learn(self, tokens: np.ndarray, lengths: np.ndarray, every: int, turn: int) -> None:
        """One pass over the texts; each ``every``-th position is masked and predicted,
        in another ``turn`` others."""
        laid, at = self.net.lay(tokens, lengths)
        at = at[turn % every :: every]
        # Neighbouring positions are alike; a batch takes them from all over the slice.
        at = np.random.default_rng(len(at) + turn).permutation(at)
        classes, width, most = len(self.net.members), self.net.members.shape[2], SORTED * BATCH
        for first in range(0, len(at), most):
            some = at[first : first + most]
            # Each batch in the order of classes, all in one sort.
            some = some[_order(np.arange(len(some)) // BATCH * classes + laid[some] // width)]
            for start in range(0, len(some), BATCH):
                batch = some[start : start + BATCH]
                self.step(self.net.around(laid, batch), laid[batch])
