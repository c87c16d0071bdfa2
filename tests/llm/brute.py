"""The operators' results once more, the plain way, for small inputs."""

import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum_words(text):
    return ALNUM.findall(lower(text))


def covered(words, k):
    windows = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    times = Counter(windows)
    return {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + k)}


def longest_repeat(words):
    k = 0
    while any(n > 1 for n in Counter(tuple(words[i:i + k + 1]) for i in range(len(words) - k)).values()):
        k += 1
    return k


def quality(text):
    words = WORD.findall(text or "")
    n, repeated = len(words), len(covered(words, 8))
    failed = n < 20 or 100 * repeated > 30 * n
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    kept = not failed and 100 * len(covered(words, 5)) <= 40 * n and 100 * longest_repeat(words) <= 35 * n
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), repeated, failed, kept)


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """The least member of each node's group."""
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and found[a] != found[b]:
                    low = min(found[a], found[b])
                    found[a] = found[b] = low
                    changed = True
    return found


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def shared_runs(texts, k):
    """Ids that share ``k`` consecutive words with another id."""
    where = defaultdict(set)
    for i, text in texts.items():
        words = alnum_words(text)
        for at in range(len(words) - k + 1):
            where[tuple(words[at:at + k])].add(i)
    return set().union(*[ids for ids in where.values() if len(ids) > 1], set())
