"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

CLASH = ("key", "row", "fp", "n", "size", "copies", "text_hash", "score", "digest", "kept")


def table(spark, rows, schema="doc_id bigint, text string", clash=True):
    """Documents; with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, schema)
    if clash:
        for name in CLASH:
            df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def held(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def substring_dedup(rows, length=20):
    first, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            k = tuple(w[s:s + length])
            if k in first:
                gone[s:s + length] = [True] * length
            first.add(k)
        out[d] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def fingerprint(text, gram, window, longest):
    units = [u.encode() for u in re.findall(rf"[^\x20\x09-\x0D]{{1,{longest}}}", text)]

    def chain(part):
        h = 42
        for u in part:
            h = xxhash.xxh64_intdigest(u, seed=h)
        return h & ((1 << 40) - 1)

    if not units:
        return []
    hashes = [chain(units[i:i + gram]) for i in range(len(units) - gram + 1)] or [chain(units)]
    chosen = {}
    for s in range(max(1, len(hashes) - window + 1)):
        if len(hashes) <= window:
            return list(enumerate(hashes))
        at = min(range(s, s + window), key=lambda i: (hashes[i], -i))
        chosen[at] = hashes[at]
    return sorted(chosen.items())


def likeness(a, b):
    x, y = {h for _, h in a}, {h for _, h in b}
    return len(x & y) / len(x | y) if x | y else 1.0


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def personal(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum((int(c) * 2 // 10 + int(c) * 2 % 10) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    good = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
            "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)),
            "phone": lambda s: 9 <= len(digits(s)) <= 15}
    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text) if good[k](m.group())]


def simhash(text, shingle=3):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_components(rows, bits=2):
    fp = {d: simhash(t) for d, t in rows}
    ids, parent = sorted(fp), {d: d for d in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fp[a] ^ fp[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (f"{fp[d]:016x}", find(d)) for d in ids}


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """{source: size} -> {source: target}, sharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(most * sizes[s] for s in stopped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        stopped.update(over)


def lm_tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [None]


def lm_base(rows):
    counts = Counter()
    for d, t in rows:
        if not held(d, 10, 0):
            counts.update(lm_tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {d: (len(lm_tokens(t)), sum(w in counts for w in lm_tokens(t)), n,
                sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in lm_tokens(t))) for d, t in rows}


def lm_trigram(rows, vocabulary=4093):
    """Interpolated absolute discounting over the same symbols, in plain counts."""
    words = Counter()
    train = [lm_tokens(t) for d, t in rows if not held(d, 10, 0)]
    for w in train:
        words.update(w)
    n, v = sum(words.values()), len(words)
    named = {w for w, _ in sorted(((w, c) for w, c in words.items() if w is not None), key=lambda x: -x[1])[:vocabulary]}
    every = n + 0.1 * (v + 1)
    rare_n = sum(c for w, c in words.items() if w is not None and w not in named)
    rare_v = sum(1 for w in words if w is not None and w not in named)
    rare = rare_n + 0.1 * (rare_v + 1)

    def symbol(w):
        return w if w is None or w in named else "<rare>"

    def first(s):
        return rare / every if s == "<rare>" else (words[s] + 0.1) / every

    two, three = Counter(), Counter()
    for w in train:
        s = ["<s>"] + [symbol(x) for x in w]
        two.update(zip(s, s[1:]))
        three.update(zip(s, s[1:], s[2:]))

    def discount(c):
        once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
        return min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5

    extra = sum(1 for w in train if len(w) == 1)      # empty texts count as one triple
    once = sum(x == 1 for x in three.values()) + (extra == 1)
    twice = sum(x == 2 for x in three.values()) + (extra == 2)
    d2, d3 = discount(two), min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    total2, kinds2, total3, kinds3 = Counter(), Counter(), Counter(), Counter()
    for (a, _), c in two.items():
        total2[a] += c
        kinds2[a] += 1
    for (a, b, _), c in three.items():
        total3[a, b] += c
        kinds3[a, b] += 1

    def p2(a, s):
        return (max(two[a, s] - d2, 0) + d2 * kinds2[a] * first(s)) / total2[a] if total2[a] else first(s)

    def p3(a, b, s):
        c = total3[a, b]
        return (max(three[a, b, s] - d3, 0) + d3 * kinds3[a, b] * p2(b, s)) / c if c else p2(b, s)

    out = {}
    for d, t in rows:
        w = lm_tokens(t)
        s = ["<s>"] + [symbol(x) for x in w]
        log = math.log10(p2(s[0], s[1])) + sum(math.log10(p3(*x)) for x in zip(s, s[1:], s[2:]))
        out[d] = log + sum(math.log10((words[x] + 0.1) / rare) for x in w if symbol(x) == "<rare>")
    return out


def merkle_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text): the whole tree in memory."""
    def h(parts):
        return sha("".join(parts))

    def leaf(row, text):
        fields = [*map(lambda v: None if v is None else str(v), row[:4]), text]
        return h("-" if v is None else f"{len(v.encode())}:{v}" for v in fields)

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([h(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, at):
        out = []
        for nodes in levels[:-1]:
            out.append((at % 8, [x for j, x in enumerate(nodes[at // 8 * 8:at // 8 * 8 + 8]) if j != at % 8]))
            at //= 8
        return out

    def told(row):
        text = row[4]
        if text is None or row[0] is None or not held(row[0], 3, 0):
            return text
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), leaf(row, told(row)), row[0]))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(langs[k])]) for k in order}
    top = tree([trees[k][-1][0] for k in order])
    out = []
    for i, k in enumerate(order):
        for at, (_, _, own, shown, doc_id) in enumerate(sorted(langs[k])):
            steps = path(trees[k], at) + path(top, i)
            folded = shown
            for place, others in steps:
                folded = h(others[:place] + [folded] + others[place:])
            root = top[-1][0]
            out.append((doc_id, own, trees[k][-1][0], root, h(x for _, o in steps for x in o), folded, folded == root))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def alignment(rows):
    """Rows (doc_id, text): every pair of tokens compared; the tokenizers called plainly."""
    from public_tokenizers import path
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    p = SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    docs, counts = [], Counter()
    for d, text in rows:
        want = b" " + (text or "").encode()
        a = [(i, bytes(letter[c] for c in t.id_to_token(i))) for i in t.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode())
             for i in p.encode(text or "")]
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            docs.append((d, [], [], []))
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, k = [], 0
        for i, s, e in spans[0]:
            while k and spans[1][k][1] > s:
                k -= 1
            j = k
            while j < len(spans[1]) and spans[1][j][1] < e:
                if spans[1][j][2] > s:
                    links.append((i, spans[1][j][0]))
                    k = j
                j += 1
        counts.update(links)
        docs.append((d, *spans, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for d, a, b, links in docs:
        groups = []
        for e in sorted({x[2] for x in a} & {x[2] for x in b}):
            low = groups[-1][0] if groups else 0
            groups.append((e, *[",".join(str(i) for i, s, f in side if low <= s and f <= e) for side in (a, b)]))
        told = ";".join(f"{x}|{y}" for _, x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), sha(told) if a else ""))
    return sorted(out)
