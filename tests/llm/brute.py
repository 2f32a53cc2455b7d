"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return re.findall(WORD, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(docs):
    """{doc_id: (n_shingles, component_id)}"""
    sets, parent = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    both = Counter((a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k])
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@lru_cache
def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_rows(docs, path):
    """{doc_id: (start, n_tokens, crc)}"""
    start, out = 0, {}
    for i, text in sorted(docs):
        ids = [*tokenizer(path).encode(text or "", add_special_tokens=False).ids, 2]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def repeated_windows(docs, size=50):
    """{doc_id: (n_words, n_removed, sha)}"""
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = True
        out[i] = (len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(docs, items, size=10):
    """{doc_id: (n_words, n_hit, n_items, sha, contaminated)}"""
    known = defaultdict(set)
    for name, text in items:
        w = bench_words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            known[tuple(w[k : k + n])].add("" if name is None else str(name))
    out = {}
    for i, t in docs:
        w, hit, seen = bench_words(t), set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if found := known.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    seen |= found
        out[i] = (len(w), len(hit), len(seen), sha(",".join(sorted(seen))), bool(hit))
    return out


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text, w = text or "", words(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """Base spans as text."""
    text = text or ""
    digits = lambda t: re.sub("[^0-9]", "", t)
    tests = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p, good in tests for m in re.finditer(p, text) if good(m[0]))


def repeated_bytes(texts, size=200):
    """[(n_bytes, n_removed, n_spans, sha)] for rows in order."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[k : k + size] for b in raw for k in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - size + 1):
            if count[b[k : k + size]] > 1:
                gone[k : k + size] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, sha(bytes(x for x, g in zip(b, gone, strict=False) if not g))))
    return out


def merkle_row(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def merkle(rows, tampers=lambda doc: zlib.crc32(str(doc).encode()) % 3 == 0):
    """[(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)] for rows (doc_id, source, lang, n_chars, text)."""

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
        return out

    def way(tree, at):
        for nodes in tree[:-1]:
            first = at // 8 * 8
            yield nodes[first:at], nodes[at + 1 : first + 8]
            at //= 8

    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, merkle_row(row), row))
    names = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([leaf for *_, leaf, _ in sorted(by_lang[x])]) for x in names}
    top = levels([trees[x][-1][0] for x in names])
    out = []
    for place, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(sorted(by_lang[name])):
            path = [*way(trees[name], at), *way(top, place)]
            now = row
            if row[0] is not None and tampers(row[0]) and row[4] is not None:
                now = (*row[:4], lower(row[4]))
            h = merkle_row(now)
            for left, right in path:
                h = sha("".join([*left, h, *right]))
            proof = sha("".join(x for left, right in path for x in left + right))
            out.append((row[0], leaf, trees[name][-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return out


def simhash(text):
    import xxhash

    w, counts = words(lower(text)), [0] * 64
    n = min(3, len(w))
    grams = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] if n else []
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(grams))


def near_prints(prints, bits=3):
    """Component ids, by pairs, for (doc_id, fingerprint) rows: the smallest doc_id, without null, that links reach."""
    distinct = sorted({p for _, p in prints})
    values, parent = np.array(distinct, np.uint64), list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(distinct)):
        for b in np.flatnonzero(np.bitwise_count(values[a + 1 :] ^ values[a]) <= bits).tolist():
            x, y = root(a), root(a + 1 + b)
            parent[max(x, y)] = min(x, y)
    at, low = {p: root(k) for k, p in enumerate(distinct)}, {}
    for i, p in prints:
        if i is not None:
            low[at[p]] = min(low.get(at[p], i), i)
    return [low.get(at[p]) for _, p in prints]


def simhash_rows(docs):
    """[(doc_id, fingerprint, component_id)] in order."""
    prints = [(i, simhash(t)) for i, t in docs]
    return [(i, f"{p:016x}", c) for (i, p), c in zip(prints, near_prints(prints), strict=True)]


def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage."""
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))


def fault_of(rows):
    """blank, duplicate, truncated or None of each (role, text) in order."""
    seen = set()
    for role, text in rows:
        marks = re.findall(WORD, text)
        yield "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1][-1] not in ".!?" else None
        seen.add((role, text))


def cheapest(rows):
    """(cost, audit, turns) of rows (role, text, fault): forward over rows, with inserts before and after each."""
    due = {"0": "user", "s": "user", "u": "assistant", "a": "user"}

    def more(now):
        for _ in range(2):
            for state, (cost, audit, turns) in list(now.items()):
                offer(now, due[state][0], cost + 5, audit + "I", (*turns, (due[state], "")))
        return now

    def offer(now, state, cost, audit, turns):
        if state not in now or (cost, audit) < now[state][:2]:
            now[state] = cost, audit, turns

    now = more({"0": (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, turns) in now.items():
            offer(after, state, cost + 2, audit + "D", turns)
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] == due[state][0] or state == "0" and role[:1] == "s":
                    offer(after, role[0], cost + extra, audit + "K", (*turns, (role, text)))
                offer(after, due[state][0], cost + 1 + extra, audit + "R", (*turns, (due[state], text)))
        now = more(after)
    return min(now[s] for s in "0a" if s in now)


def repairs(rows):
    """[(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)] for rows (conv_id, turn, role, text)."""
    by_conv = {r[0]: [] for r in rows}
    for conv, turn, role, text in damaged(rows):
        by_conv[conv].append((turn is not None, turn or 0, role, sha(text), text))
    out = []
    for conv, own in by_conv.items():
        own.sort()
        turns = [t for there, t, *_ in own if there]
        faults = list(fault_of([(r, t) for *_, r, _, t in own]))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, left = cheapest([(r, t, f) for (*_, r, _, t), f in zip(own, faults, strict=True)])
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in left))))
    return out
