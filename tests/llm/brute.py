"""Plain versions of the operators, for small inputs."""

import re

WORDS = re.compile(r"[^ \t-\r]+")
LOREM = (
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
).split()


def sentence(rng, n, vocabulary=400):
    return " ".join(f"{LOREM[i % len(LOREM)]}{i // len(LOREM)}" for i in rng.integers(0, vocabulary, n))


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    words = WORDS.findall(text or "")
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard_components(texts, k, percent):
    sets = {i: shingles(ascii_lower(t), k) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = smallest_reachable(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def removed_lines(texts, k, percent):
    earlier, gone = [], set()
    for doc in sorted(texts):
        if texts[doc] is None:
            continue
        for i, line in enumerate(texts[doc].split("\n")):
            tokens = shingles(line, k)
            if not tokens:
                continue
            if any(100 * len(tokens & x) >= percent * len(tokens | x) for x in earlier):
                gone.add((doc, i))
            earlier.append(tokens)
    return gone


def removed_bytes(texts, length):
    seen, out = set(), {}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


def removed_words(texts, length):
    first, out = {}, {}
    for doc in sorted(texts):
        words = (texts[doc] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first.setdefault(tuple(words[i : i + length]), doc) < doc:
                gone[i : i + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), kept)
    return out
