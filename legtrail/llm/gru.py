"""A bidirectional gated recurrent network over bytes that labels every position; all in numpy.

Sequences of one length are run together, so nothing is padded. Weights and states are 32-bit floats.
"""

from dataclasses import dataclass

import numpy as np


@dataclass
class Network:
    """``cells`` holds the forward and the backward cell: input weights by byte, state weights, biases."""

    labels: list[str]
    cells: list[dict[str, np.ndarray]]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [cell[name] for cell in self.cells for name in ("byte", "state", "add")] + [self.out, self.bias]


def new_network(labels: list[str], hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(hidden), shape).astype(np.float32)
    none = lambda n: np.zeros(n, np.float32)
    wide = 3 * hidden
    cells = [{"byte": draw(256, wide), "state": draw(hidden, wide), "add": none(wide)} for _ in "fb"]
    return Network(labels, cells, draw(2 * hidden, len(labels)), none(len(labels)))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def states(cell: dict[str, np.ndarray], data: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each position (positions x sequences x hidden); ``trace`` gets what going back needs."""
    hidden = cell["state"].shape[0]
    inputs = cell["byte"][data.T] + cell["add"]
    h = np.zeros((len(data), hidden), np.float32)
    out = np.empty((data.shape[1], len(data), hidden), np.float32)
    for t in range(data.shape[1]):
        own = h @ cell["state"]
        gates = logistic(inputs[t, :, : 2 * hidden] + own[:, : 2 * hidden])
        keep, reset = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(inputs[t, :, 2 * hidden :] + reset * own[:, 2 * hidden :])
        if trace is not None:
            trace.append((h, keep, reset, new, own[:, 2 * hidden :]))
        h = new + keep * (h - new)
        out[t] = h
    return out


def gradients(cell: dict[str, np.ndarray], data: np.ndarray, trace: list, d_out: np.ndarray) -> list[np.ndarray]:
    """Through time from the last position to the first: gradients of the cell's byte, state and add."""
    hidden = cell["state"].shape[0]
    d_state = np.zeros_like(cell["state"])
    d_inputs = np.empty((data.shape[1], len(data), 3 * hidden), np.float32)
    d_h = np.zeros((len(data), hidden), np.float32)
    for t in range(data.shape[1] - 1, -1, -1):
        h, keep, reset, new, own_new = trace[t]
        d_h = d_h + d_out[t]
        d_new = d_h * (1 - keep) * (1 - new * new)
        d_keep = d_h * (h - new) * keep * (1 - keep)
        d_reset = d_new * own_new * reset * (1 - reset)
        d_own = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
        d_inputs[t] = np.concatenate([d_keep, d_reset, d_new], axis=1)
        d_state += h.T @ d_own
        d_h = d_h * keep + d_own @ cell["state"].T
    flat = d_inputs.reshape(-1, 3 * hidden)
    d_byte = np.zeros_like(cell["byte"])
    np.add.at(d_byte, data.T.ravel(), flat)
    return [d_byte, d_state, flat.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def label_positions(net: Network, data: np.ndarray) -> np.ndarray:
    """Probabilities of the labels at each position (sequences x positions x labels) of byte sequences of one length."""
    forth = states(net.cells[0], data)
    back = states(net.cells[1], data[:, ::-1])[::-1]
    return softmax(np.concatenate([forth, back], axis=2) @ net.out + net.bias).transpose(1, 0, 2)


def loss_gradients(net: Network, data: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of all positions, each with its sequence's label, and its gradients."""
    traces: tuple[list, list] = ([], [])
    forth = states(net.cells[0], data, traces[0])
    back = states(net.cells[1], data[:, ::-1], traces[1])[::-1]
    both = np.concatenate([forth, back], axis=2)
    p = softmax(both @ net.out + net.bias)
    each = np.arange(len(target))
    loss = float(-np.log(np.maximum(p[:, each, target], 1e-9)).mean())
    d = p
    d[:, each, target] -= 1
    d /= d.shape[0] * d.shape[1]
    hidden = forth.shape[2]
    d_both = d @ net.out.T
    d_out = both.reshape(-1, 2 * hidden).T @ d.reshape(-1, d.shape[2])
    ahead = gradients(net.cells[0], data, traces[0], d_both[:, :, :hidden])
    behind = gradients(net.cells[1], data[:, ::-1], traces[1], d_both[::-1, :, hidden:])
    return loss, [*ahead, *behind, d_out, d.sum(axis=(0, 1))]


def train(
    groups: dict[int, tuple[np.ndarray, np.ndarray]],
    labels: list[str],
    hidden: int = 16,
    steps: int = 500,
    batch: int = 512,
    rate: float = 0.02,
    seed: int = 7,
) -> Network:
    """Adam over batches of sequences; ``groups`` holds (bytes, label numbers) by length of sequence.

    A batch has one length, chosen by the bytes that its group holds, and as many sequences of each label as of others.
    """
    rng = np.random.default_rng(seed)
    net = new_network(labels, hidden, seed)
    held = net.parameters()
    first = [np.zeros_like(p) for p in held]
    second = [np.zeros_like(p) for p in held]
    lengths = sorted(groups)
    weight = np.array([groups[n][0].size for n in lengths], float)
    weight /= weight.sum()
    for step in range(1, steps + 1):
        data, target = groups[lengths[rng.choice(len(lengths), p=weight)]]
        share = 1 / np.bincount(target, minlength=len(labels)).clip(1)[target]
        chosen = rng.choice(len(target), batch, p=share / share.sum())
        _, found = loss_gradients(net, data[chosen], target[chosen])
        size = np.sqrt(sum(float((g * g).sum()) for g in found))
        now = rate * min(1.0, 5 / max(size, 1e-9)) * (1 - 0.9 * step / steps)
        for p, g, m, v in zip(held, found, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net
