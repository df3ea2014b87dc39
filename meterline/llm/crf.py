"""A linear-chain conditional random field over hashed features, in numpy.

Sequences are lists of positions, each with the same number of feature numbers.  Training maximises the likelihood by
Adam steps over all sequences at once; decoding is Viterbi's algorithm over batches of sequences of like length.
"""

from dataclasses import dataclass

import numpy as np

_FORBIDDEN = -1e4


@dataclass
class Model:
    """``unary[feature, label]`` and ``moves[label before, label]``; ``first`` scores the label of the first position."""

    unary: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(s) for s in sequences)
    features = np.zeros((len(sequences), longest, sequences[0].shape[1]), np.int32)
    inside = np.zeros((len(sequences), longest), bool)
    for i, sequence in enumerate(sequences):
        features[i, : len(sequence)] = sequence
        inside[i, : len(sequence)] = True
    return features, inside


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def train(
    sequences: list[np.ndarray],
    labels: list[np.ndarray],
    n_features: int,
    n_labels: int,
    allowed: np.ndarray,
    allowed_first: np.ndarray,
    rounds: int = 80,
    rate: float = 0.15,
    penalty: float = 2e-4,
) -> Model:
    """The model of largest penalised likelihood that ``rounds`` steps reach; deterministic."""
    features, inside = _padded(sequences)
    gold = np.zeros(inside.shape, np.int64)
    for i, own in enumerate(labels):
        gold[i, : len(own)] = own
    count, longest = inside.shape
    rows = np.arange(count)
    blocked = np.where(allowed, 0.0, _FORBIDDEN)
    blocked_first = np.where(allowed_first, 0.0, _FORBIDDEN)
    weights = [np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)]
    means = [np.zeros_like(w) for w in weights]
    squares = [np.zeros_like(w) for w in weights]
    hot = np.eye(n_labels)[gold] * inside[:, :, None]
    for step in range(1, rounds + 1):
        unary, moves, first = weights[0], weights[1] + blocked, weights[2] + blocked_first
        scores = unary[features].sum(axis=2)
        forward = np.empty((longest, count, n_labels))
        forward[0] = scores[:, 0] + first
        for t in range(1, longest):
            new = _log_sum(forward[t - 1][:, :, None] + moves, 1) + scores[:, t]
            forward[t] = np.where(inside[:, t, None], new, forward[t - 1])
        total = _log_sum(forward[-1], 1)
        backward = np.zeros((longest, count, n_labels))
        expected_moves = np.zeros_like(moves)
        for t in range(longest - 2, -1, -1):
            ahead = scores[:, t + 1] + backward[t + 1]
            new = _log_sum(moves[None] + ahead[:, None, :], 2)
            backward[t] = np.where(inside[:, t + 1, None], new, 0.0)
            both = np.exp(forward[t][:, :, None] + moves + ahead[:, None, :] - total[:, None, None])
            expected_moves += (both * inside[:, t + 1, None, None]).sum(axis=0)
        marginal = np.exp(forward.transpose(1, 0, 2) + backward.transpose(1, 0, 2) - total[:, None, None])
        difference = hot - marginal * inside[:, :, None]
        slopes = [np.zeros_like(w) for w in weights]
        flat = difference[inside]
        for column in range(features.shape[2]):
            np.add.at(slopes[0], features[:, :, column][inside], flat)
        for t in range(1, longest):
            chosen = rows[inside[:, t]]
            np.add.at(slopes[1], (gold[chosen, t - 1], gold[chosen, t]), 1.0)
        slopes[1] -= expected_moves
        slopes[2] = difference[:, 0].sum(axis=0)
        for weight, mean, square, slope in zip(weights, means, squares, slopes, strict=True):
            slope = slope / count - penalty * weight
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope**2 - square)
            weight += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(weights[0].astype(np.float32), (weights[1] + blocked).astype(np.float32), (weights[2] + blocked_first).astype(np.float32))


def decode(model: Model, sequences: list[np.ndarray], cells: int = 200_000) -> list[np.ndarray]:
    """The likeliest labels of each sequence.  At most ``cells`` positions, or one sequence, are decoded at a time."""
    result: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sequences)
    order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(sequences[order[end]]) * (end + 1 - at) <= cells:
            end += 1
        chosen = order[at:end]
        for i, labels in zip(chosen, _viterbi(model, [sequences[i] for i in chosen]), strict=True):
            result[i] = labels
        at = end
    return result


def _viterbi(model: Model, sequences: list[np.ndarray]) -> list[np.ndarray]:
    features, inside = _padded(sequences)
    count, longest = inside.shape
    best = model.unary[features[:, 0]].sum(axis=1) + model.first
    origin = np.zeros((longest, count, len(model.first)), np.int8)
    stay = np.arange(len(model.first), dtype=np.int8)
    for t in range(1, longest):
        reached = best[:, :, None] + model.moves
        origin[t] = np.where(inside[:, t, None], reached.argmax(axis=1), stay)
        new = reached.max(axis=1) + model.unary[features[:, t]].sum(axis=1)
        best = np.where(inside[:, t, None], new, best)
    labels = np.zeros((count, longest), np.int8)
    labels[:, -1] = best.argmax(axis=1)
    for t in range(longest - 1, 0, -1):
        labels[:, t - 1] = origin[t][np.arange(count), labels[:, t]]
    return [labels[i, : len(sequence)] for i, sequence in enumerate(sequences)]
