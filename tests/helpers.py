"""Slow forms of the statistics, written from their definitions, for the tests."""
import bisect
import math


def finite(values):
    return [float(v) for v in values if math.isfinite(v)]


def quantile(ordered, p):
    """Linear interpolation between the order statistics around position p (n - 1)."""
    at = p * (len(ordered) - 1)
    low = math.floor(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


def inner_edges(values, bins=10):
    """Edges between the quantile bins; values that repeat give fewer bins."""
    ordered = sorted(finite(values))
    edges = sorted({quantile(ordered, i * (1.0 / bins)) for i in range(bins + 1)})
    return edges[1:-1]


def shares(values, inner):
    """Share of the finite values in each half-open bin; the outer bins are open."""
    counts = [0] * (len(inner) + 1)
    for v in finite(values):
        counts[bisect.bisect_right(inner, v)] += 1
    return [c / sum(counts) for c in counts]


def stability_index(expected, actual, least=1e-6):
    total = 0.0
    for e, a in zip(expected, actual):
        e, a = max(e, least), max(a, least)
        total += (a - e) * math.log(a / e)
    return total


def ks_distance(a, b):
    a, b = sorted(finite(a)), sorted(finite(b))
    return max(abs(bisect.bisect_right(a, x) / len(a) - bisect.bisect_right(b, x) / len(b)) for x in a + b)


def average_precision(labels, scores):
    """Precision at each distinct score, weighted by the positives found there."""
    total, positives = 0.0, sum(labels)
    for s in sorted(set(scores), reverse=True):
        above = [y for y, x in zip(labels, scores) if x >= s]
        here = sum(y for y, x in zip(labels, scores) if x == s)
        total += here / positives * (sum(above) / len(above))
    return total


def roc_area(labels, scores):
    """Share of pairs of a positive and a negative in the right order, ties half."""
    pos = sorted(s for y, s in zip(labels, scores) if y == 1)
    neg = sorted(s for y, s in zip(labels, scores) if y == 0)
    won = sum(bisect.bisect_left(neg, p) + (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p)) / 2 for p in pos)
    return won / (len(pos) * len(neg))
