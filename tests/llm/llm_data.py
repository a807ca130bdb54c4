import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size string, score string, _h string"


def prose(n, seed, vocab=400):
    azar = random.Random(seed)
    return " ".join("w%d" % azar.randrange(vocab) for _ in range(n))


def rows(texts, source=lambda i: f"s{i % 3}", lang=lambda i: "en"):
    """Documents with columns of clashing names."""
    return [(i, t, lang(i), source(i), len(t or ""), -i, "x", "y", "z") for i, t in enumerate(texts)]


def brute_components(nodes, links):
    """Smallest member reachable, for each node."""
    own = {n: n for n in nodes}

    def find(x):
        while own[x] != x:
            own[x] = own[own[x]]
            x = own[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        own[max(a, b)] = min(a, b)
    return {n: find(n) for n in own}
