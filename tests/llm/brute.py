"""The contracts of the operators, said once more in plain Python over whole small tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")


def ids_of(texts, end_id):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids + [end_id] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def groups(n, links):
    """Smallest number reachable from each of 0 to n - 1."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def vector_links(rows, cosine=0.93):
    """Links (i, j) between rows (vec_id, embedding, label)."""
    units = []
    for _, e, label in rows:
        x = None if not e or label is None or None in e else np.array(e, float)
        good = x is not None and np.isfinite(x).all() and (x != 0).any()
        units.append(x / np.sqrt((x * x).sum()) if good else None)
    return [(i, j) for i, a in enumerate(units) for j, b in enumerate(units[:i])
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= cosine]


def shingles(text, width):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def near_links(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    common = Counter((a, b) for rows in at.values() for i, a in enumerate(rows) for b in rows[:i])
    links = [p for p, n in common.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    return [len(s) for s in sets], links


def measures(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i:i + 3])] > 1}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def boilerplate_free(rows, max_share=0.1, min_pages=5):
    """Text of each row (text, host) less its frequent lines."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r")

    pages, on = Counter(host for _, host in rows), Counter()
    for text, host in rows:
        on.update((host, k) for k in {key(x) for x in (text or "").split("\n")} if k)

    def bad(line, host):
        n = on[host, key(line)]
        return key(line) and n >= min_pages and n > max_share * pages[host]

    return [None if text is None else "\n".join(x for x in text.split("\n") if not bad(x, host)) for text, host in rows]


def targets(sizes, weights=(5.0, 2.0, 1.0), most=3):
    """Target of each source, sizes by source; what is over a limit is shared anew until none is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        shared = sum(weight[s] for s in order if s not in capped)
        out = {s: float(most * sizes[s]) if s in capped else left * weight[s] / shared for s in order}
        over = {s for s in order if s not in capped and out[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return out
        capped |= over


def host_verdicts(hosts, max_odds=4.0, z=1.645):
    """{host: (rate, kept)} from {host: (pages, failed)}: beta-binomial moments, weighted by pages."""
    n, k = sum(p for p, _ in hosts.values()), len(hosts)
    mean = sum(f for _, f in hosts.values()) / n
    noise = mean * (1 - mean)
    room = noise * (n - sum(p * p for p, _ in hosts.values()) / n - (k - 1))
    spread = sum(p * (f / p - mean) ** 2 for p, f in hosts.values())
    share = (spread - noise * (k - 1)) / room if room > 1e-12 else 0
    if share <= 1e-12:
        return {h: (mean, True) for h in hosts}
    weight = 1 / min(share, 0.999) - 1
    odds = max_odds * mean / (1 - mean)
    out = {}
    for h, (p, f) in hosts.items():
        rate = (f + mean * weight) / (p + weight)
        out[h] = rate, rate - z * (rate * (1 - rate) / (p + weight + 1)) ** 0.5 <= odds / (1 + odds)
    return out
