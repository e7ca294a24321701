"""Brute-force helpers that the tests of the training-data operators share."""


def components(nodes, links):
    """Smallest reachable node of each node, by union and find."""
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
