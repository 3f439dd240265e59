"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def removed(rows, least=100):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)} by a set of all strings."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - least + 1):
            w = b[s:s + least]
            if w in seen:
                gone[s:s + least] = b"\1" * least
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def components(links, ids):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard(rows, threshold=0.8, n=5):
    """({doc_id: links}, {doc_id: component}) by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = words(text)
        k = min(n, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    ids, count, links = sorted(sets), defaultdict(int), []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    return {i: count[i] for i in ids}, components(links, ids)


def spans(text):
    """Base spans of secrets by whole scans."""
    out = []
    rules = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I),
              lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))
    for rank, (kind, pattern, counts) in enumerate(rules):
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if counts(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def contaminated(docs, items, length=13):
    """{doc_id: contaminated} by looking at every window."""
    windows = set()
    for text in items:
        w = words(text)
        windows |= {tuple(w[i:i + length]) for i in range(max(1, len(w) - length + 1))} if w else set()
    out, sizes = {}, {len(w) for w in windows}
    for i, text in docs:
        w, hit = words(text), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
        out[i] = bool(hit) and 20 * len(hit) >= len(w)
    return out


def tokens(rows):
    """[(doc_id, start, n_tokens, crc32)] of rows in order."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, at = [], 0
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def kept_words(rows, least=50):
    """{(doc_id, text): (n_words, n_removed, sha256)} by a table of all windows; a null id comes first."""
    order = lambda i: (i is not None, i or 0)
    split, low = [(i, t, SPLIT.findall(t or "")) for i, t in rows], {}
    for i, _, w in split:
        for s in range(len(w) - least + 1):
            x = tuple(w[s:s + least])
            low[x] = min(low.get(x, order(i)), order(i))
    out = {}
    for i, t, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - least + 1):
            if low[tuple(w[s:s + least])] < order(i):
                gone[s:s + least] = [True] * least
        kept = [x for x, g in zip(w, gone) if not g]
        out[i, t] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    def leaf(row):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            s = i - i % 3
            yield level[s:i], level[i + 1:s + 3]
            i //= 3

    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by[s], key=lambda x: x[:3]) for s in sources}
    lower = {s: levels([x[2] for x in trees[s]]) for s in sources}
    top = levels([lower[s][-1][0] for s in sources]) if sources else []
    out = []
    for j, s in enumerate(sources):
        for i, (_, _, own, row) in enumerate(trees[s]):
            way, node = [*path(lower[s], i), *path(top, j)], own
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                node = leaf((*row[:4], row[4].replace("\n", "")))
            for a, b in way:
                node = sha("".join([*a, node, *b]))
            out.append((row[0], own, lower[s][-1][0], top[-1][0], sha("".join(x for a, b in way for x in a + b)), node, node == top[-1][0]))
    return sorted(out, key=str)


def trie(rows):
    """Sorted nodes of the prefixes of rebuilt conversations, from rows (conv_id, turn, role, text)."""
    own, members, ends, children, below = defaultdict(list), defaultdict(list), defaultdict(list), defaultdict(list), {}
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        below[p] = (sum(below[x][0] for x in children[p]) or 1,
                    (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(below[x][1] for x in children[p]))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *below[p], sha(",".join(map(str, sorted(ends[p])))))
                   for p, m in members.items()), key=str)


def term_weights(rows: list, wanted) -> tuple[list, list]:
    """The wanted terms and their weights: IDF times 0.3 and the log odds beyond two standard errors."""
    from sevlens.llm.toxicity import terms

    all1 = sum(y for _, y in rows)
    all0 = len(rows) - all1
    held = [(set(terms(t)), y) for t, y in rows]
    names, out = list(wanted), []
    for x in names:
        n = [sum(x in s for s, y in held if y == v) for v in (0, 1)]
        cells = [n[1] + 0.5, all1 - n[1] + 0.5, n[0] + 0.5, all0 - n[0] + 0.5]
        odds = abs(math.log(cells[0] * cells[3] / (cells[1] * cells[2])))
        out.append((math.log(len(rows) / sum(n)) + 0.1) * (0.3 + max(0.0, odds - 2 * math.sqrt(sum(1 / c for c in cells)))))
        assert sum(n) >= 3
    return names, out


def nearest_examples(texts: dict, examples: dict, names: list, weight: list, k: int) -> dict:
    """The k largest cosines above 0 of every text with the examples, by the definition."""
    from sevlens.llm.toxicity import terms

    w = dict(zip(names, weight))

    def unit(text):
        v = {t: (1 + math.log(c)) * w[t] for t, c in terms(text).items() if t in w}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    vectors = [unit(t) for t in examples.values()]
    out = {}
    for i, text in texts.items():
        v = unit(text)
        cosines = sorted((sum(x * e.get(t, 0.0) for t, x in v.items()) for e in vectors), reverse=True)
        out[i] = [c for c in cosines[:k] if c > 0]
    return out
