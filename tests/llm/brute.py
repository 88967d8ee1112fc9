"""Plain Python versions of the contracts, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = {i: i + 32 for i in range(65, 91)}


def space_words(text):
    return WORD.findall((text or "").translate(UP))


def shingles(text, k=5):
    w = space_words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def jaccard(docs):
    """docs: [(doc_id, text)] -> {doc_id: (n, component)}"""
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for d, s in sets.items():
        for t in s:
            by.setdefault(t, []).append(d)
    seen = set()
    for ds in by.values():
        if len(ds) > 1:
            for i, a in enumerate(ds):
                for b in ds[i + 1 :]:
                    if (a, b) not in seen:
                        seen.add((a, b))
                        o = len(sets[a] & sets[b])
                        if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                            x, y = sorted((find(a), find(b)))
                            up[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return ITEM.findall((text or "").translate(UP))


def decontaminate(docs, items):
    """-> {doc_id: (n_words, n_hit, n_items, sha, contaminated)}"""
    import hashlib

    wins = {}
    for i, t in items:
        w = item_words(t)
        for k in [10] if len(w) >= 10 else [len(w)]:
            if k:
                for j in range(len(w) - k + 1):
                    wins.setdefault(tuple(w[j : j + k]), set()).add(i)
    lens = {len(k) for k in wins}
    out = {}
    for d, t in docs:
        w = item_words(t)
        hit, ids = set(), set()
        for k in lens:
            for j in range(len(w) - k + 1):
                if got := wins.get(tuple(w[j : j + k])):
                    ids |= got
                    hit |= set(range(j, j + k))
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit))
    return out


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(text):
    """-> (n_assign, n_access, n_hex, base string)"""
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    n = [sum(s[1] == k for s in spans) for k in range(3)]
    return (*n, ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)))


def repeats(docs, span=50):
    """[(doc_id, text)] -> {doc_id: (n_bytes, n_removed, n_spans, sha)}; ids are distinct."""
    import hashlib

    first = {}
    data = {d: (t or "").encode() for d, t in docs}
    for d in sorted(data):
        b = data[d]
        for i in range(len(b) - span + 1):
            first.setdefault(b[i : i + span], d)
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if first[b[i : i + span]] < d:
                gone[i : i + span] = b"\1" * span
        runs = len([1 for x in bytes(gone).split(b"\0") if x])
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def base_scores(docs):
    """[(doc_id, text)] -> (N, {doc_id: (held_out, n_tokens, n_known, base)})"""
    import math
    import zlib
    from collections import Counter

    c = Counter()
    for d, t in docs:
        if zlib.crc32(str(d).encode()) % 10:
            c.update(space_words(t) + [None])
    n, v = sum(c.values()), len(c)
    out = {}
    for d, t in docs:
        w = [*space_words(t), None]
        out[d] = (zlib.crc32(str(d).encode()) % 10 == 0, len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    return n, out


# Pseudonyms: a finder without regular expressions and a Feistel network on lists of bits.

DIGITS, WORDY = set("0123456789"), set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
LOCAL, CAPITAL = WORDY | set("._%+-"), {c for c in WORDY if not c.islower()}


def _forms(*parts):
    """All concatenations of one choice of each part, in the order in which they are tried."""
    out = [""]
    for p in parts:
        out = [o + c for o in out for c in p]
    return out


# d is a digit, A a capital or digit, L a capital letter, anything else itself; (form, what must not stand before, after)
SEP = (" ", ".", "-", "")
PLUS = [("+" + f) for f in _forms(("ddd", "dd", "d"), SEP, ("(", ""), ("ddd",), (")", ""), SEP, ("ddd",), SEP, ("dddd",))]
NATIONAL = ["(ddd) ddd-dddd", "(ddd)ddd-dddd"]
THREE, TWO = ("ddd", "dd", "d"), ("dd", "d")
IPS = _forms(THREE, (".",), THREE, (".",), THREE, (".",), THREE)
DATES = ((["dddd-dd-dd"], "-"), (_forms(TWO, (".",), TWO, (".dddd",)), "."), (_forms(TWO, ("/",), TWO, ("/dddd",)) + _forms(("dddd/",), TWO, ("/",), TWO), "/"))
FOURS = [f + "d" * k for f in _forms(("dddd",), (" ", "-"), ("dddd",), (" ", "-"), ("dddd",), (" ", "-")) for k in range(7, 0, -1)]
CARDS = FOURS + [f + "d" * k for f in _forms(("dddd",), (" ", "-"), ("dddddd",), (" ", "-")) for k in (5, 4)] + ["d" * k for k in range(19, 12, -1)]
IBAN_LENGTHS = {"NO": 15, "BE": 16, "DE": 22, "GB": 22, "FR": 27, "ES": 24, "IT": 27, "NL": 18, "AT": 20, "CH": 21}


def _fits(text, i, form):
    if i + len(form) > len(text):
        return False
    return all(c in DIGITS if f == "d" else c in CAPITAL if f == "A" else c == f for f, c in zip(form, text[i : i + len(form)], strict=True))


def _after(text, j, marks=""):
    """Whether a digit, or one of ``marks`` and then a digit, follows."""
    rest = text[j : j + 2]
    return bool(rest) and (rest[0] in DIGITS or (len(rest) > 1 and rest[0] in marks and rest[1] in DIGITS))


def _end(text, i):
    """(kind, end) of the candidate that starts at i, kinds and forms in order; None if there is none."""
    if text[i] not in CAPITAL and text[i] not in "+(":
        return None
    before, before2 = text[i - 1 : i] if i else "", text[i - 2 : i] if i > 1 else ""
    split = lambda marks: before in DIGITS or (len(before2) == 2 and before2[0] in DIGITS and before2[1] in marks)
    if text[i] == "+" and not (before in DIGITS or before == "+"):
        for f in PLUS:
            if _fits(text, i, f) and not _after(text, i + len(f)):
                return "phone", i + len(f)
        at, ends = i + 2, []
        if i + 1 < len(text) and text[i + 1] in DIGITS:
            for _ in range(14):
                j = at + (text[at : at + 1] in {" ", ".", "-"})
                j += text[j : j + 1] == "("
                if text[j : j + 1] not in DIGITS or j >= len(text):
                    break
                at = j + 1 + (text[j + 1 : j + 2] == ")")
                ends.append(at)
            for at in reversed(ends[5:]):
                for e in (at, at - 1) if text[at - 1] == ")" else (at,):
                    if not _after(text, e):
                        return "phone", e
    if before not in DIGITS or not before:
        for f in NATIONAL:
            if _fits(text, i, f) and not _after(text, i + len(f)):
                return "phone", i + len(f)
    outside = not (before and (before in WORDY or before == "+"))
    for forms, marks in ((("ddd-ddd-dddd", "ddd.ddd.dddd"), ".-"), (("ddd ddd dddd",), " .-")):
        for f in forms:
            left = len(before2) == 2 and before2[0] in DIGITS and before2[1] in marks
            if outside and not left and _fits(text, i, f) and not _after(text, i + len(f), marks):
                return "phone", i + len(f)
    if not (before and (before in DIGITS or before == ".")):
        for f in IPS:
            if _fits(text, i, f) and not _after(text, i + len(f), "."):
                return "ip", i + len(f)
    for forms, no in DATES:
        if not (before and (before in DIGITS or before == no)):
            for f in forms:
                j = i + len(f)
                if _fits(text, i, f) and not _after(text, j, "." if no == "." else "") and not (no != "." and text[j : j + 1] == no):
                    return "date", j
    j = i + 11
    if not (before and (before in DIGITS or before == "-")) and _fits(text, i, "ddd-dd-dddd") and not _after(text, j) and text[j : j + 1] != "-":
        return "ssn", j
    if not (before and before in WORDY):
        for f in CARDS:
            j = i + len(f)
            if _fits(text, i, f) and not (text[j : j + 1] and text[j] in WORDY):
                return "card", j
        if text[i : i + 2].isalpha() and text[i : i + 2].isupper() and text[i : i + 2].isascii():
            spaced = IBAN_LENGTHS.get(text[i : i + 2], 0)
            body = "dd" + "A" * max(0, spaced - 4)
            for f in ["dd" + "A" * k for k in range(30, 10, -1)] + ([" ".join(("LL" + body)[k : k + 4] for k in range(0, spaced, 4))[2:]] if spaced else []):
                j = i + 2 + len(f)
                if _fits(text, i + 2, f) and not (text[j : j + 1] and text[j] in WORDY):
                    return "iban", j
    return None


def _mail(text, at):
    """(start, end) of the address around the @ at ``at``; None if there is none."""
    i = at
    while i and text[i - 1] in LOCAL:
        i -= 1
    labels, j = [], at + 1
    while True:
        k = j
        while k < len(text) and (text[k] in WORDY or text[k] == "-"):
            k += 1
        if k == j:
            break
        labels.append((j, k))
        if text[k : k + 1] != ".":
            break
        j = k + 1
    if i == at or text[i] == ".":
        return None
    for a, k in reversed(labels[1:]):
        n = 0
        while a + n < k and text[a + n] in WORDY - DIGITS:
            n += 1
        if n >= 2 and not (a + n < len(text) and text[a + n] in WORDY):
            return i, a + n
    return None


def candidates(text):
    """[(kind, start, end)]: mails first, then numbers in what is left between them; whether a value is valid is not asked."""
    mails, last = [], 0
    for at in (i for i, c in enumerate(text) if c == "@"):
        got = _mail(text, at)
        if got and got[0] >= last:
            mails.append(("email", *got))
            last = got[1]
    out, at = [], 0
    for kind, a, b in [*mails, ("", len(text), len(text))]:
        part, i = text[at:a], 0
        while i < len(part):
            got = _end(part, i)
            if got:
                out.append((got[0], at + i, at + got[1]))
                i = got[1]
            else:
                i += 1
        if kind:
            out.append((kind, a, b))
        at = b
    return out


def feistel(x, size, key, tweak, rounds=8):
    """The keyed permutation of range(size), bit by bit."""
    import hashlib

    if size < 2:
        return x
    half = max(1, -(-(size - 1).bit_length() // 2))
    n = -(-half // 8)
    while True:
        bits = [int(c) for c in format(x, f"0{2 * half}b")]
        left, right = bits[:half], bits[half:]
        for r in range(rounds):
            value = int("".join(map(str, right)), 2).to_bytes(n, "big")
            blocks = b"".join(hashlib.blake2b(f"{tweak}|{size}".encode() + bytes([r]) + k.to_bytes(4, "big") + value, key=key, digest_size=64).digest() for k in range(-(-n // 64)))
            f = [int(c) for c in format(int.from_bytes(blocks[:n], "big"), f"0{8 * n}b")][-half:]
            left, right = right, [p ^ q for p, q in zip(left, f, strict=True)]
        x = int("".join(map(str, left + right)), 2)
        if x < size:
            return x


# Quality


def kneser_ney(trusted, texts):
    """Interpolated modified Kneser-Ney trained on ``trusted``: [(words, negative log10 probability)] of ``texts``, by dictionaries."""
    import math
    from collections import Counter, defaultdict

    split = re.compile(rb"[^\x20\x09-\x0D]+").findall

    def shape(w):
        upper, lower = 65 <= w[0] <= 90, any(97 <= x <= 122 for x in w)
        end = "plain" if 97 <= w[-1] <= 122 or w[-1] >= 128 else "stop" if w[-1] in b".," else "other"
        return upper, lower, end

    count = Counter(w for t in trusted for w in split(t.encode()))
    once = Counter(shape(w) for w, n in count.items() if n == 1)
    unit = lambda w: w if count[w] > 1 else shape(w)

    def grams(t):
        u = ["<", "<", *map(unit, split(t.encode()))]
        return zip(u, u[1:], u[2:], strict=False)

    def discount(counts):
        c = Counter(counts.values())
        if not all(c[k] for k in (1, 2, 3, 4)):
            d = [0.5, 0.75, 0.9]
        else:
            y = c[1] / (c[1] + 2 * c[2])
            d = [min(k - 0.05, max(0.05, k - (k + 1) * y * c[k + 1] / c[k])) for k in (1, 2, 3)]
        return lambda n: d[min(n, 3) - 1]

    three = Counter(g for t in trusted for g in grams(t))
    two = Counter(g[1:] for g in three)
    one = Counter(g[1:] for g in two)

    def order(counts):
        d, total, freed = discount(counts), defaultdict(int), defaultdict(float)
        for g, n in counts.items():
            total[g[:-1]] += n
            freed[g[:-1]] += d(n)
        return lambda g, low: (max(0, counts[g] - d(counts[g])) / total[g[:-1]] if counts[g] else 0) + freed[g[:-1]] / total[g[:-1]] * low if g[:-1] in total else low

    d1, all1 = discount(one), sum(one.values())
    unseen = sum(d1(n) for n in one.values()) / all1 / (len(one) + 1)
    p1 = lambda w: ((one[(w,)] - d1(one[(w,)])) / all1 if one[(w,)] else 0) + unseen
    p2, p3 = order(two), order(three)
    out = []
    for t in texts:
        words = split((t or "").encode())
        nll = sum(-math.log10(p3(g, p2(g[1:], p1(g[2])))) for g in grams(t or ""))
        nll += sum(math.log10(once[shape(w)] + 1) for w in words if count[w] < 2)
        out.append((len(words), nll))
    return out
