"""A bidirectional gated recurrent network over bytes, in numpy.

Every byte of a window gets a probability for each class, from a state that has read the window up to
it and one that has read it back to it. Arrays have the windows of a batch as their last axis.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BYTES = 256


@dataclass
class Direction:
    """Gates z (keep), r (reset) and n (new), stacked: the input's share by byte, the state's share."""

    table: np.ndarray  # 3 * hidden, BYTES
    recurrent: np.ndarray  # 3 * hidden, hidden
    out: np.ndarray  # classes, hidden


@dataclass
class Network:
    forward: Direction
    backward: Direction
    bias: np.ndarray  # classes
    window: int

    def parameters(self) -> list[np.ndarray]:
        return [p for d in (self.forward, self.backward) for p in (d.table, d.recurrent, d.out)] + [self.bias]


def fresh(classes: int, hidden: int, window: int, rng: np.random.Generator) -> Network:
    def drawn(*shape: int) -> np.ndarray:
        return rng.normal(0, shape[-1] ** -0.5 if shape[-1] < BYTES else 0.3, shape).astype(np.float32)

    def direction() -> Direction:
        return Direction(drawn(3 * hidden, BYTES), drawn(3 * hidden, hidden), drawn(classes, hidden))

    return Network(direction(), direction(), np.zeros(classes, np.float32), window)


def _order(steps: int, back: bool) -> range:
    return range(steps - 1, -1, -1) if back else range(steps)


def states(way: Direction, x: np.ndarray, back: bool) -> np.ndarray:
    """The state after every byte of ``x`` (steps, windows), as steps, hidden, windows."""
    hidden = way.recurrent.shape[1]
    out = np.empty((len(x), hidden, x.shape[1]), np.float32)
    state = np.zeros((hidden, x.shape[1]), np.float32)
    given, own = np.empty((3 * hidden, x.shape[1]), np.float32), np.empty((3 * hidden, x.shape[1]), np.float32)
    for t in _order(len(x), back):
        np.take(way.table, x[t], axis=1, out=given, mode="clip")
        np.matmul(way.recurrent, state, out=own)
        gates = given[: 2 * hidden]
        gates += own[: 2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        new, reset = given[2 * hidden :], own[2 * hidden :]
        reset *= gates[hidden:]
        new += reset
        np.tanh(new, out=new)
        np.subtract(state, new, out=reset)
        reset *= gates[:hidden]
        np.add(new, reset, out=out[t])
        state = out[t]
    return out


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """Each byte's probability of each class: steps, classes, windows."""
    x = x.astype(np.intp)
    score = net.forward.out @ states(net.forward, x, False)
    score += net.backward.out @ states(net.backward, x, True)
    score += net.bias[:, None]
    score -= score.max(axis=1, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(axis=1, keepdims=True)
    return score


def _way_gradient(way: Direction, x: np.ndarray, back: bool, reached: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time: gradients of a direction from those of its scores (``wanted``)."""
    hidden = way.recurrent.shape[1]
    later = np.zeros(reached.shape[1:], np.float32)
    recurrent = np.zeros_like(way.recurrent)
    inputs = np.empty((len(x), 3 * hidden, x.shape[1]), np.float32)
    steps = list(_order(len(x), back))
    for place in range(len(steps) - 1, -1, -1):
        t = steps[place]
        before = reached[steps[place - 1]] if place else np.zeros_like(later)
        given, own = way.table[:, x[t]], way.recurrent @ before
        gates = 0.5 + 0.5 * np.tanh(0.5 * (given[: 2 * hidden] + own[: 2 * hidden]))
        keep, reset = gates[:hidden], gates[hidden:]
        new = np.tanh(given[2 * hidden :] + reset * own[2 * hidden :])
        change = later + way.out.T @ wanted[t]
        new_in = change * (1 - keep) * (1 - new * new)
        grad = inputs[t]
        grad[:hidden] = change * (before - new) * keep * (1 - keep)
        grad[hidden : 2 * hidden] = new_in * own[2 * hidden :] * reset * (1 - reset)
        grad[2 * hidden :] = new_in
        through = np.concatenate([grad[: 2 * hidden], new_in * reset])
        recurrent += through @ before.T
        later = change * keep + way.recurrent.T @ through
    flat = x.ravel()
    table = np.stack([np.bincount(flat, inputs[:, k].ravel(), BYTES) for k in range(3 * hidden)]).astype(np.float32)
    out = np.einsum("tcb,thb->ch", wanted, reached, optimize=True)
    return [table, recurrent, out]


def loss_and_gradients(net: Network, x: np.ndarray, weight: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over the bytes of ``weight`` 1, each with its window's label, and gradients."""
    x = x.astype(np.intp)
    ahead, behind = states(net.forward, x, False), states(net.backward, x, True)
    score = net.forward.out @ ahead + net.backward.out @ behind + net.bias[:, None]
    score -= score.max(axis=1, keepdims=True)
    chance = np.exp(score)
    chance /= chance.sum(axis=1, keepdims=True)
    scale = np.float32(1 / max(1.0, float(weight.sum())))
    columns = np.arange(x.shape[1])
    loss = -float((np.log(chance[:, label, columns] + 1e-9) * weight).sum() * scale)
    wanted = chance
    wanted[:, label, columns] -= 1
    wanted *= (weight * scale)[:, None, :]
    gradients = _way_gradient(net.forward, x, False, ahead, wanted) + _way_gradient(net.backward, x, True, behind, wanted)
    return loss, gradients + [wanted.sum(axis=(0, 2))]


def train(
    net: Network,
    x: np.ndarray,
    weight: np.ndarray,
    label: np.ndarray,
    steps: int,
    batch: int,
    rate: float,
    rng: np.random.Generator,
) -> Network:
    """Adam over random batches of the windows (steps, windows), with a rate that falls to zero."""
    parameters = net.parameters()
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        chosen = rng.integers(0, x.shape[1], min(batch, x.shape[1]))
        _, gradients = loss_and_gradients(net, x[:, chosen], weight[:, chosen], label[chosen])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients)))
        now = rate * (1 - (step - 1) / steps)
        for p, g, m, v in zip(parameters, gradients, first, second):
            g = g * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net
