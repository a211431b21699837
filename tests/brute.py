"""Plain-Python reference answers for small inputs."""

from lshark.functions.minhash import HASH_PRIME


def signature(items, model):
    return [min(((1 + x) * a + b) % HASH_PRIME for x in items) for a, b in model.coeffs]


def jaccard(x, y):
    x, y = set(x), set(y)
    return len(x & y) / len(x | y)


def lsh_pairs(sets, model, threshold=None):
    sigs = {u: signature(s, model) for u, s in sets.items() if s}
    out = {}
    keys = sorted(sigs)
    for n, a in enumerate(keys):
        for b in keys[n + 1:]:
            if any(p == q for p, q in zip(sigs[a], sigs[b])):
                inter = len(set(sets[a]) & set(sets[b]))
                sim = inter / (len(set(sets[a])) + len(set(sets[b])) - inter)
                if inter > 0 and (threshold is None or 1.0 - sim < threshold):
                    out[(a, b)] = sim
    return out


def exact_pairs(sets, threshold):
    out = {}
    keys = sorted(u for u in sets if sets[u])
    for n, a in enumerate(keys):
        for b in keys[n + 1:]:
            sim = jaccard(sets[a], sets[b])
            if sim > 0 and 1.0 - sim < threshold:
                out[(a, b)] = sim
    return out
