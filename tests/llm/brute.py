"""Plain versions of the operators, for small tables: loops over all rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def measures(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    often = Counter(grams)
    hit = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def normal(line):
    return re.sub("[0-9]", "0", " ".join(SPACE_WORD.findall(line)).translate(LOWER))


def quality(docs, min_docs=10, share=0.1, keep=50):
    """docs: (id, text, host).  Per row: measures, kept words, base_failed, kept, cleaned text."""
    hosts, lines = defaultdict(set), defaultdict(set)
    for _, text, host in docs:
        hosts[host].add(text)
        for line in (text or "").split("\n"):
            if normal(line):
                lines[host, normal(line)].add(text)
    bad = {k for k, v in lines.items() if len(v) > min_docs and len(v) > share * len(hosts[k[0]])}
    out = []
    for i, text, host in docs:
        m = measures(text)
        left = [x for x in (text or "").split("\n") if (host, normal(x)) not in bad]
        kept_words = sum(len(SPACE_WORD.findall(x)) for x in left)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        out.append((i, *m, kept_words, failed, not failed and 100 * kept_words >= keep * m[0], "\n".join(left)))
    return out


def contamination(docs, items, window=13):
    """docs, items: (id, text).  Per row: id, n_words, n_hit, item ids as strings, contaminated."""
    cut = [(i, ALNUM_WORD.findall((t or "").translate(LOWER))) for i, t in items]
    out = []
    for i, text in docs:
        words = ALNUM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, own in cut:
            size = min(window, len(own))
            grams = {tuple(own[a:a + size]) for a in range(len(own) - size + 1)} if size else set()
            for a in range(len(words) - size + 1 if size else 0):
                if tuple(words[a:a + size]) in grams:
                    hit |= set(range(a, a + size))
                    if item is not None:
                        found.add(str(item))
        out.append((i, len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def simhash(text, shingle=3):
    words = SPACE_WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(len(words) - shingle + 1, 1))]
    prints = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(p >> b & 1 for p in prints) > len(prints))


def components(prints, radius=3):
    """Component number per fingerprint of a list."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def near_duplicates(docs, radius=3):
    """docs: (id, text).  Per row: id, hex fingerprint, component id."""
    prints = [simhash(t) for _, t in docs]
    group, least = components(prints, radius), {}
    for (i, _), g in zip(docs, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(docs, prints, group)]


def shards(rows, limit):
    """rows: (key, bytes).  The bucket prefix of each row, splitting bit by bit;
    None where all rows of a bucket too large have one key."""
    bits = [f"{int(hashlib.md5(str(k if k is not None else '').encode()).hexdigest()[:15], 16):060b}" for k, _ in rows]
    out = [None] * len(rows)

    def split(members, depth):
        if not members:
            return
        if sum(rows[i][1] for i in members) <= limit or len(members) == 1:
            for i in members:
                out[i] = bits[members[0]][:depth]
        elif len({bits[i] for i in members}) > 1:
            for b in "01":
                split([i for i in members if bits[i][depth] == b], depth + 1)

    split(list(range(len(rows))), 0)
    return out


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or \
                    kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)) or \
                    kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def repeats(docs, window=35):
    """docs: (id, text).  Per row: id, n_words, n_removed, kept text's digest."""
    cut = [(i, SPACE_WORD.findall(t or "")) for i, t in docs]
    seen = Counter(tuple(w[p:p + window]) for _, w in cut for p in range(len(w) - window + 1))
    out = []
    for i, words in cut:
        gone = set()
        for p in range(len(words) - window + 1):
            if seen[tuple(words[p:p + window])] > 1:
                gone.update(range(p, p + window))
        out.append((i, len(words), len(gone), sha(" ".join(w for k, w in enumerate(words) if k not in gone))))
    return out


def fill_in_middle(rows):
    """Token lists and string pieces."""
    out = []
    for i, text in rows:
        text = text or ""
        tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        h = sha(f"1:{'' if i is None else i}")
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        n = len(tokens)
        if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((i, n, "plain", None, None, sha(text), sha(text)))
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
        spm = h4 % 100 < 20
        whole = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
        out.append((i, n, "spm" if spm else "psm", len(p), len(m), sha(whole), sha(text)))
    return out


def damage(rows):
    """(conv_id, turn, role, text) rows -> the same after damage, and all ids."""
    out = []
    for c, t, r, x in rows:
        r, x = (" " if r is None else r), (" " if x is None else x)
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 1:
            x = ""
        if k == 2:
            x = re.sub("[.!?]", "", x)
        if k == 4:
            r = "user"
        out += [(c, t, r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out, {r[0] for r in rows}


def repair(rows, ids):
    """Cheapest edits by search over (cost, letters): a forward table of the best string per state."""
    out = []
    for conv in ids:
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:32].encode(),
                                 hashlib.md5(r[3].encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, r, x in mine:
            y = x.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not y else "duplicate" if (r, x) in seen else "truncated" if y[-1] not in ".!?" else "")
            seen.add((r, x))
        grow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
        full = {"u": "user", "a": "assistant"}

        def insert(table):
            for _ in range(4):
                for s, (c, e, p) in list(table.items()):
                    for i, to in grow[s].items():
                        if i != "s":
                            new = (c + 3, e + "I", [*p, f"{full[i]}:"])
                            table[to] = min(table.get(to, new), new, key=lambda v: v[:2])
            return table

        table = insert({"": (0, "", [])})
        for (_, _, r, x), fault in zip(mine, faults):
            new = {}

            def offer(s, c, e, p):
                if s not in new or (c, e) < new[s][:2]:
                    new[s] = (c, e, p)

            for s, (c, e, p) in table.items():
                offer(s, c + 4, e + "D", p)
                if fault in ("blank", "duplicate"):
                    continue
                more = 3 if fault else 0
                if r[:1] in grow[s]:
                    offer(grow[s][r[:1]], c + more, e + "K", [*p, f"{r}:{x}"])
                for i, to in grow[s].items():
                    if i != "s":
                        offer(to, c + more + 3, e + "R", [*p, f"{full[i]}:{x}"])
            table = insert(new)
        c, e, p = min((table[s] for s in ("", "a") if s in table), key=lambda v: v[:2])
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        near = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        out.append((conv, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                    sum(k not in ("su", "ua", "au") for k in near), c, e, sha("\n".join(p))))
    return out
