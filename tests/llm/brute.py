"""The operators' results by plain loops, for small inputs."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def chat(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()), len(loss), sha(loss.encode()))
    return out


def payload(text):
    data = (text or "").encode()
    whole = data + b"\xff" * (-len(data) % 576 if data else 576)
    return len(data), len(whole), sha(whole), zlib.crc32(whole[-32:])


def pieces(docs, size=2048):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            yield doc, k, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))


def token_counts(docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [(d, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in docs]


def coder():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def byte_bpe(docs):
    enc = coder()
    for d, t in docs:
        ids = enc.encode_ordinary(t or "")
        yield d, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())


def quality(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(docs):
    """{doc: (n_shingles, component_id)} by all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    lists, parent = defaultdict(list), {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            lists[x].append(d)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = Counter()
    for members in lists.values():
        for i, a in enumerate(members):
            for b in members[:i]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeats(texts, length=400):
    """[(n_bytes, n_removed, n_spans, kept_sha256)]"""
    data = [(t or "").encode() for t in texts]
    often = Counter(hash(x[i : i + length]) for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        gone, reach = bytearray(len(x)), 0
        for i in range(len(x) - length + 1):
            if often[hash(x[i : i + length])] > 1:
                for k in range(max(i, reach), i + length):
                    gone[k] = 1
                reach = i + length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(x), sum(gone), runs, sha(bytes(b for b, g in zip(x, gone, strict=True) if not g))))
    return out


def passages(texts, length):
    """For each text, the places of words in passages of so many words that are found twice."""
    data = [WORD.findall(t or "") for t in texts]
    often = Counter(tuple(w[i : i + length]) for w in data for i in range(len(w) - length + 1))
    return [{i + k for i in range(len(w) - length + 1) if often[tuple(w[i : i + length])] > 1 for k in range(length)} for w in data]


def passage_bytes(text, places):
    """The bytes of these words, and of what stands between two of them that follow each other."""
    found = [(len(text[: m.start()].encode()), len(text[: m.end()].encode())) for m in WORD.finditer(text or "")]
    return sum(found[k][1] - (found[k - 1][1] if k - 1 in places else found[k][0]) for k in places)


def removed_bytes(texts, words, length=400):
    """For each text, the places of bytes in strings of ``length`` bytes or passages of so many words that are found twice."""
    data = [(t or "").encode() for t in texts]
    often = Counter(hash(x[i : i + length]) for x in data for i in range(len(x) - length + 1))
    out = []
    for x, t, places in zip(data, texts, passages(texts, words), strict=True):
        lost = {i + k for i in range(len(x) - length + 1) if often[hash(x[i : i + length])] > 1 for k in range(length)}
        found = [(len(t[: m.start()].encode()), len(t[: m.end()].encode())) for m in WORD.finditer(t or "")]
        for k in places:
            lost.update(range(found[k - 1][1] if k - 1 in places else found[k][0], found[k][1]))
        out.append(lost)
    return out


def component_words(words):
    return dict.fromkeys(map(" ".join, zip(words, words[1:], strict=False)))


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def vector_codes(rows, scale=1024, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector, label) -> [(vec_id, code, error, label_error)], codebooks"""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    size = width // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(xs) // len(xs) for xs in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by = defaultdict(int)
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by[lab] += e
    return [(i, "".join(f"{k:02x}" for _, k in f), e, by[lab]) for (i, _, lab), f, e in zip(kept, found, errors, strict=True)], books


def copied(docs, length=50):
    """[(doc_id, n_words, n_removed, kept_sha256)]: words in windows that start in a document with a smaller id."""
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, w in words:
        for k in range(len(w) - length + 1 if d is not None else 0):
            key = tuple(w[k : k + length])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, w in words:
        gone = {k + j for k in range(len(w) - length + 1) if d is not None and least[tuple(w[k : k + length])] < d for j in range(length)}
        out.append((d, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, top=10):
    """[(item_id, rank, doc_id, score)]"""
    counts = [(d, Counter(TERM.findall((t or "").translate(_SMALL)))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n, total = len(counts), sum(s for *_, s in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for i, text in items:
        asked = Counter(TERM.findall((text or "").translate(_SMALL)))
        found = []
        for d, c, size in counts:
            m = 25 + 75 * size * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, k, d, -s) for k, (s, *_, d) in enumerate(sorted(found)[:top], 1)]
    return out
