"""A linear-chain conditional random field with two labels, in numpy.

Sequences are given as one array of token scores (how much the token's features speak for
label 1) and the lengths of the chains it falls into. Forward and backward messages are kept
as log-ratios of the two labels, and all chains are advanced together, one token a step.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Transitions(NamedTuple):
    """Log-weights of neighbouring labels, beside which 0 after 0 weighs 0."""

    from_0_to_1: float
    from_1_to_0: float
    from_1_to_1: float


def _forward(scores, starts, lengths, trans: Transitions) -> np.ndarray:
    """Log-ratio of label 1 to label 0 at each token, given the tokens up to it."""
    ratio = np.array(scores, np.float64)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    for step in range(1, longest):
        at = starts[: active[step]] + step
        before = ratio[at - 1]
        to_1 = np.logaddexp(before + trans.from_1_to_1, trans.from_0_to_1)
        to_0 = np.logaddexp(before + trans.from_1_to_0, 0.0)
        ratio[at] += to_1 - to_0
    return ratio


def _reverse(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each chain of ``values`` back to front."""
    ends = np.repeat(starts + lengths - 1, lengths)
    within = np.arange(len(values)) - np.repeat(starts, lengths)
    return values[ends - within]


def marginals(scores: np.ndarray, lengths: np.ndarray, trans: Transitions) -> np.ndarray:
    """Probability of label 1 at each token, by forward and backward messages.

    Chains have one token or more. The backward message is the forward one of the chain
    turned round, with the transitions turned round as well.
    """
    starts = np.cumsum(lengths) - lengths
    turned = Transitions(trans.from_1_to_0, trans.from_0_to_1, trans.from_1_to_1)
    ahead = _forward(scores, starts, lengths, trans)
    behind = _reverse(_forward(_reverse(scores, starts, lengths), starts, lengths, turned), starts, lengths)
    return 1.0 / (1.0 + np.exp(-(ahead + behind - scores)))


def _pair_expectations(scores, lengths, marginal, trans: Transitions) -> np.ndarray:
    """Expected numbers of neighbouring labels 01, 10 and 11, over all chains."""
    starts = np.cumsum(lengths) - lengths
    ahead = _forward(scores, starts, lengths, trans)
    turned = Transitions(trans.from_1_to_0, trans.from_0_to_1, trans.from_1_to_1)
    behind = _reverse(_forward(_reverse(scores, starts, lengths), starts, lengths, turned), starts, lengths)
    first = np.ones(len(scores), bool)
    first[starts] = False
    right = np.flatnonzero(first)
    a, b = ahead[right - 1], behind[right]
    weights = np.stack([b + trans.from_0_to_1, a + trans.from_1_to_0, a + b + trans.from_1_to_1])
    top = np.maximum(weights.max(0), 0.0)
    shares = np.exp(weights - top)
    return (shares / (shares.sum(0) + np.exp(-top))).sum(1)


def fit(
    tokens: np.ndarray, features: np.ndarray, number: int, labels: np.ndarray, lengths: np.ndarray,
    penalty: float = 0.05, rounds: int = 150, step: float = 0.3,
) -> tuple[np.ndarray, Transitions]:
    """Weights of features and transitions by gradient ascent with adaptive steps.

    ``tokens`` and ``features`` are pairs (token position, feature number); a token's score
    is the sum of its features' weights. ``penalty`` is the weight of the squared norm.
    """
    starts = np.cumsum(lengths) - lengths
    inner = np.ones(len(labels), bool)
    inner[starts] = False
    right = np.flatnonzero(inner)
    before, after = labels[right - 1], labels[right]
    seen_pairs = np.array([np.sum((before == a) & (after == b)) for a, b in ((0, 1), (1, 0), (1, 1))], float)
    seen = np.bincount(features, labels[tokens].astype(float), number)
    theta = np.zeros(number + 3)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        trans = Transitions(*theta[number:])
        scores = np.bincount(tokens, theta[features], len(labels))
        marginal = marginals(scores, lengths, trans)
        pairs = _pair_expectations(scores, lengths, marginal, trans)
        expected = np.bincount(features, marginal[tokens], number)
        slope = np.concatenate((seen - expected, seen_pairs - pairs)) - penalty * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        theta += step * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return theta[:number], Transitions(*map(float, theta[number:]))
