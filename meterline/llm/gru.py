"""A gated recurrent language model with a class-factored softmax, in numpy.

A symbol is a frequent word or the class of a rare one. The output gives the class of the next token, and within a class
of frequent words the word. Documents run in step; windows are ``WINDOW`` tokens long and pass their state on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN, EMBED, WINDOW = 24, 16, 32
#: Classes of frequent words, words in each, classes of rare words. Symbol 0 is the end of a text (and the start).
HEAD_CLASSES, PER_CLASS, TAIL_CLASSES = 32, 32, 32
HEAD = HEAD_CLASSES * PER_CLASS
CLASSES, SYMBOLS = HEAD_CLASSES + TAIL_CLASSES, HEAD + TAIL_CLASSES
RATE, CLIP = 0.01, 1.0
#: Texts that are scored in step.
IN_STEP = 2048

SHAPES = {
    "embed": (SYMBOLS, EMBED), "w": (EMBED, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
    "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,), "word_w": (HEAD_CLASSES, HIDDEN, PER_CLASS), "word_b": (HEAD_CLASSES, PER_CLASS),
}


#: Class of every symbol; the last place serves -1.
CLASS = np.repeat(np.arange(CLASSES + 1), [PER_CLASS] * HEAD_CLASSES + [1] * TAIL_CLASSES + [1]) % CLASSES


def initial(counts: np.ndarray) -> np.ndarray:
    """Flat parameters that give every context the smoothed frequencies of the symbols."""
    rng = np.random.default_rng(5)
    p = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    for k in ("embed", "w", "u"):
        p[k] = rng.normal(0, 0.3 / np.sqrt(SHAPES[k][0] if k != "embed" else 1), SHAPES[k]).astype(np.float32)
    smooth = counts + 0.1
    per_class = np.concatenate([smooth[:HEAD].reshape(HEAD_CLASSES, PER_CLASS).sum(1), smooth[HEAD:]])
    p["class_b"] = np.log(per_class / per_class.sum()).astype(np.float32)
    p["word_b"] = np.log(smooth[:HEAD].reshape(HEAD_CLASSES, PER_CLASS) / per_class[:HEAD_CLASSES, None]).astype(np.float32)
    return flat(p)


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float32)


def shaped(theta: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = theta[at : at + n].reshape(s)
        at += n
    return out


#: First symbols of the classes of frequent words, and the end.
_BOUNDS = np.arange(HEAD_CLASSES + 1) * PER_CLASS
#: Beyond this the greatest value is taken off before the exponential.
_FAR = 40
#: Tokens that the output is made for at a time, so that what is in work stays near the processor.
AT_ONCE = 8192


def _exponentials(x: np.ndarray, bound: float) -> np.ndarray | float:
    """The exponentials of each column up to a factor, in place; the logarithm of the factor. No value is beyond the bound."""
    off = 0.0
    if x.size and not bound < _FAR:
        off = x.max(axis=0)
        x -= off
    np.exp(x, out=x)
    return off


def _frequent(goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Places of the frequent words among the symbols, sorted by symbol; the words; where each class begins in them."""
    order = np.argsort(goal.astype(np.uint16), kind="stable")  # by digits, which is faster; -1 comes last
    words = goal[order]
    at = np.searchsorted(words.astype(np.uint16), _BOUNDS.astype(np.uint16)).tolist()
    return order[: at[-1]], words[: at[-1]], at


@dataclass
class Model:
    """Parameters made ready. Inside, a token is a column, so that gates and classes are runs of memory."""

    p: dict[str, np.ndarray]

    def __post_init__(self) -> None:
        # a sigmoid is 0.5 + 0.5 * tanh(x / 2): the halves are taken beforehand
        halves = np.repeat(np.array([0.5, 0.5, 1], np.float32), HIDDEN)
        gates = (self.p["embed"] @ self.p["w"] + self.p["b"]) * halves
        self.gates, self.u = (np.ascontiguousarray(x.T) for x in (gates, self.p["u"] * halves))
        # biases are a last column, states have a last row of ones for them
        self.class_w = np.vstack([self.p["class_w"], self.p["class_b"]]).T.copy()
        self.word_w = np.concatenate([self.p["word_w"].transpose(0, 2, 1), self.p["word_b"][:, :, None]], axis=2)
        # a state is between -1 and 1
        self.bound, self.word_bound = (float(np.abs(w).sum(axis=-1).max()) for w in (self.class_w, self.word_w))

    def step(self, h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states after one more input symbol per column."""
        g, s = self.gates.take(symbols, axis=1, mode="wrap"), self.u @ h
        zr = s[: 2 * HIDDEN]
        zr += g[: 2 * HIDDEN]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        c = s[2 * HIDDEN :]
        c *= zr[HIDDEN:]
        c += g[2 * HIDDEN :]
        np.tanh(c, out=c)
        c -= h
        c *= zr[:HIDDEN]
        c += h
        return c

    def advance(self, h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The same with a row for each state."""
        return self.step(h.T, symbols).T

    def words(self, x: np.ndarray, at: list[int], out: np.ndarray) -> np.ndarray:
        """For columns sorted by class what the words of the class get; in the memory of ``out``."""
        out = out.reshape(-1)[: PER_CLASS * at[-1]].reshape(PER_CLASS, at[-1])
        for k in range(HEAD_CLASSES):
            if at[k] < at[k + 1]:
                np.matmul(self.word_w[k], x[:, at[k] : at[k + 1]], out=out[:, at[k] : at[k + 1]])
        return out

    def logs(self, x: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each symbol after its state; ``x`` has a row of ones."""
        part = self.class_w @ x
        found = part.reshape(-1).take(CLASS[goal] * len(goal) + np.arange(len(goal)))
        found -= _exponentials(part, self.bound)
        found -= np.log(part.sum(axis=0))
        order, words, at = _frequent(goal)
        if len(order):
            part = self.words(x.take(order, axis=1, mode="wrap"), at, part)
            more = part.reshape(-1).take(words % PER_CLASS * len(order) + np.arange(len(order)))
            more -= _exponentials(part, self.word_bound)
            more -= np.log(part.sum(axis=0))
            found[order] += more
        return found

    def log_probability(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The same with a row for each state."""
        return self.logs(np.vstack([h.T, np.ones(len(h), h.dtype)]), np.asarray(target, np.int64))

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log of the probability of every whole text (symbols, the last one 0)."""
        total = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        for s in range(0, len(order), IN_STEP):
            some = order[s : s + IN_STEP]
            total[some] = self._in_step([texts[i] for i in some])
        return total

    def _in_step(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores of texts, the longest first: every step takes the next symbol of those that have one."""
        size = np.array([len(t) for t in texts])
        symbols, first = np.concatenate(texts).astype(np.int64), np.cumsum(size) - size
        total, last = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        h = np.zeros((HIDDEN, len(texts)), np.float32)
        live = np.searchsorted(-size, -np.arange(int(size.max())), side="left").tolist()
        states, goals = np.ones((HIDDEN + 1, AT_ONCE + len(texts)), np.float32), np.empty(AT_ONCE + len(texts), np.int64)
        held: list[int] = []
        used = 0
        for t, n in enumerate(live):
            h = self.step(h[:, :n], last[:n])
            last = symbols.take(first[:n] + t)
            states[:-1, used : used + n], goals[used : used + n] = h, last
            held.append(n)
            used += n
            if used >= AT_ONCE or t + 1 == len(live):
                found, at = self.logs(states[:, :used], goals[:used]), 0
                for k in held:
                    total[:k] += found[at : at + k]
                    at += k
                held.clear()
                used = 0
        return total


class Trainer:
    """Adam on windows of a block of texts, gradients cut at the start of a window."""

    def __init__(self, theta: np.ndarray, rate: float = RATE) -> None:
        self.theta, self.rate = theta.copy(), rate
        self.m, self.v, self.n = np.zeros_like(theta), np.zeros_like(theta), 0
        self.memory: dict[str, np.ndarray] = {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Memory for an array that a window fills, kept for the next window."""
        size = int(np.prod(shape))
        if name not in self.memory or self.memory[name].size < size:
            self.memory[name] = np.empty(size, self.theta.dtype)
        return self.memory[name][:size].reshape(shape)

    def learn(self, block: np.ndarray, last: np.ndarray) -> None:
        """One pass over rows of symbols, padded with -1; ``last`` has the symbols before them."""
        h = np.zeros((len(block), HIDDEN), np.float32)
        for at in range(0, block.shape[1], WINDOW):
            target = block[:, at : at + WINDOW]
            live = (target >= 0).any(axis=1)
            if not live.all():
                target, h, last, block = target[live], h[live], last[live], block[live]
            if not len(target):
                break
            grad, h, last = self._window(h, last, target)
            self.n += 1
            norm = float(np.sqrt(grad @ grad))
            grad *= min(1.0, CLIP / (norm + 1e-9))
            step = grad - self.m
            step *= 0.1
            self.m += step
            grad *= grad
            grad -= self.v
            grad *= 0.01
            self.v += grad
            np.multiply(self.v, 1 / (1 - 0.99**self.n), out=grad)
            np.sqrt(grad, out=grad)
            grad += 1e-6
            np.multiply(self.m, self.rate / (1 - 0.9**self.n), out=step)
            step /= grad
            self.theta -= step

    def _window(self, h: np.ndarray, last: np.ndarray, target: np.ndarray):
        p, room = shaped(self.theta), self._room
        model = Model(p)
        rows, steps = target.shape
        goal = target.T.ravel().astype(np.int64)
        inputs = np.concatenate([last, np.maximum(goal, 0)])
        inputs, last = inputs[: steps * rows], inputs[steps * rows :]
        # states before and after each step, and ones; what the gradient of a state is multiplied by on its way back
        states = room("states", HIDDEN + 1, steps + 1, rows)
        states[:-1, 0], states[-1] = h.T, 1
        keep, ways = room("keep", steps, HIDDEN, rows), room("ways", steps, 4, HIDDEN, rows)
        g, s, h, x = room("g", 3 * HIDDEN, rows), room("s", 3 * HIDDEN, rows), room("h", HIDDEN, rows), room("x", HIDDEN, rows)
        zr, z, r, sc = s[: 2 * HIDDEN], s[:HIDDEN], s[HIDDEN : 2 * HIDDEN], s[2 * HIDDEN :]
        g_zr, c = g[: 2 * HIDDEN], g[2 * HIDDEN :]
        h[:] = states[:-1, 0]
        for t in range(steps):
            by_cr, by_z, by_r, by_c = ways[t]  # the candidate's recurrent part, the gates z and r, the candidate
            model.gates.take(inputs[t * rows : (t + 1) * rows], axis=1, out=g, mode="wrap")
            np.matmul(model.u, h, out=s)
            zr += g_zr
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            np.multiply(sc, r, out=x)
            c += x
            np.tanh(c, out=c)
            left = np.subtract(1, z, out=keep[t])
            np.subtract(c, h, out=x)
            x *= z
            h += x
            states[:-1, t + 1] = h
            np.multiply(x, left, out=by_z)  # the slope of a sigmoid is itself times what it lacks of 1
            c *= c
            np.subtract(1, c, out=c)
            np.multiply(c, z, out=by_c)
            np.multiply(by_c, r, out=by_cr)
            np.subtract(1, r, out=r)
            sc *= r
            np.multiply(by_cr, sc, out=by_r)
        d = {k: np.empty(shape, self.theta.dtype) for k, shape in SHAPES.items()}
        dstates = self._output_gradient(model, states.reshape(HIDDEN + 1, -1)[:, rows:], goal, d).reshape(HIDDEN, steps, rows)
        u = np.concatenate([p["u"][:, 2 * HIDDEN :], p["u"][:, : 2 * HIDDEN]], axis=1)
        dh = np.zeros((HIDDEN, rows), self.theta.dtype)
        for t in range(steps - 1, -1, -1):
            dh += dstates[:, t]
            back = np.multiply(dh, ways[t], out=ways[t]).reshape(4 * HIDDEN, rows)
            dh *= keep[t]
            dh += np.matmul(u, back[: 3 * HIDDEN], out=x)
        back = ways.reshape(steps, 4 * HIDDEN, rows)
        du = np.matmul(back[:, : 3 * HIDDEN], states[:-1, :-1].transpose(1, 2, 0)).sum(axis=0)
        d["u"][:] = np.concatenate([du[HIDDEN:], du[:HIDDEN]]).T
        back = back[:, HIDDEN:]
        # the ones give the sums
        seen = room("seen", EMBED + 1, steps, rows)
        seen[-1] = 1
        p["embed"].T.copy().take(inputs, axis=1, out=seen[:-1].reshape(EMBED, -1), mode="wrap")
        dw = np.matmul(back, seen.transpose(1, 2, 0)).sum(axis=0)
        d["w"][:], d["b"][:] = dw[:, :-1].T, dw[:, -1]
        np.matmul(p["w"], back, out=seen[:-1].transpose(1, 0, 2))
        for i, row in enumerate(seen[:-1].reshape(EMBED, -1)):
            d["embed"][:, i] = np.bincount(inputs, row, SYMBOLS)
        return np.concatenate([d[k].ravel() for k in SHAPES]), h.T.copy(), last

    def _output_gradient(self, model: Model, x: np.ndarray, goal: np.ndarray, d: dict[str, np.ndarray]) -> np.ndarray:
        """Gradient of the mean loss by every state (none where the goal is -1); those by the output's weights go to ``d``."""
        some = goal >= 0
        n = max(1, int(some.sum()))
        part = np.matmul(model.class_w, x, out=self._room("part", CLASSES, len(goal)))
        _exponentials(part, model.bound)
        part *= (some / (part.sum(axis=0) * n)).astype(x.dtype)
        part.reshape(-1)[CLASS[goal] * len(goal) + np.arange(len(goal))] -= (some / n).astype(x.dtype)
        dclass = part @ x.T
        d["class_w"][:], d["class_b"][:] = dclass[:, :-1].T, dclass[:, -1]
        dx = np.matmul(model.class_w[:, :-1].T, part, out=self._room("dx", HIDDEN, len(goal)))
        d["word_w"][:], d["word_b"][:] = 0, 0
        order, words, at = _frequent(goal)
        if len(order):
            few = x.take(order, axis=1, mode="wrap")
            part = model.words(few, at, part)
            _exponentials(part, model.word_bound)
            part *= 1 / (part.sum(axis=0) * n)
            part.reshape(-1)[words % PER_CLASS * len(order) + np.arange(len(order))] -= 1 / n
            more = np.zeros((HIDDEN, len(order) + 1), x.dtype)
            for k in range(HEAD_CLASSES):
                if at[k] < at[k + 1]:
                    own = part[:, at[k] : at[k + 1]]
                    dword = few[:, at[k] : at[k + 1]] @ own.T
                    d["word_w"][k], d["word_b"][k] = dword[:-1], dword[-1]
                    np.matmul(model.word_w[k, :, :-1].T, own, out=more[:, at[k] : at[k + 1]])
            place = np.full(len(goal), len(order))  # where there is nothing
            place[order] = np.arange(len(order))
            dx += more.take(place, axis=1, mode="wrap")
        return dx
