"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile("[^ \t-\r]+")
TERM = re.compile("[^\x00-/:-@\\[-`{-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def suffix_dedup(texts, length):
    """texts: list of str/None -> list of (n_bytes, n_removed, n_spans, kept)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                mask[p:p + length] = b"\1" * length
        spans = sum(1 for i, m in enumerate(mask) if m and not (i and mask[i - 1]))
        out.append((len(b), sum(mask), spans, bytes(c for c, m in zip(b, mask) if not m)))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def simhash(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows, bits=3):
    """[(id, text)] -> {index: smallest id reachable}."""
    fps = [simhash(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                up[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(d, best.get(find(i), d))
    return fps, [best.get(find(i)) for i in range(len(rows))]


def decontaminate(text, items, window=10):
    """(n_words, n_hit, ids)."""
    words = TERM.findall(lower(text or ""))
    hit, ids = set(), set()
    for item, benchmark in items:
        terms = TERM.findall(lower(benchmark or ""))
        need = min(window, len(terms))
        for i in range(len(terms) - need + 1 if need else 0):
            for p in range(len(words) - need + 1):
                if words[p:p + need] == terms[i:i + need]:
                    hit |= set(range(p, p + need))
                    ids.add(item)
    return len(words), len(hit), sorted(map(str, ids))


def line_dedup(rows, min_words):
    """[(id, text)], ids different -> {id: removed line numbers}; judged by every run of lines."""
    lines = {}
    for d, text in rows:
        lines[d] = [(k, x.strip(" \t\n\x0b\x0c\r"), len(WORD.findall(x)))
                    for k, x in enumerate((text or "").split("\n")) if WORD.search(x)]
    first = {}
    runs = []
    for d in sorted(lines):
        own = lines[d]
        for i in range(len(own)):
            n = 0
            for j in range(i, len(own)):
                n += own[j][2]
                if n >= min_words:
                    content = tuple(x[1] for x in own[i:j + 1])
                    first.setdefault(content, (d, own[i][0]))
                    runs.append((d, i, j, content))
    gone = {d: set() for d in lines}
    for d, i, j, content in runs:
        if first[content] != (d, lines[d][i][0]):
            gone[d] |= {x[0] for x in lines[d][i:j + 1]}
    return gone


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def repaired(turns):
    """[(initial, fault)] -> (cost, audit): every walk over the turns by the role that came last, whole audits compared."""
    best = {"": (0, "")}

    def inserted(found):
        out = dict(found)
        for _ in range(2):
            for last, (cost, audit) in list(out.items()):
                for r in "ua":
                    if follows(last, r) and (r not in out or (cost + 5, audit + "I") < out[r]):
                        out[r] = (cost + 5, audit + "I")
        return out

    def follows(last, r):
        return r == "s" and last == "" or r == "u" and last != "u" or r == "a" and last == "u"

    best = inserted(best)
    for initial, fault in turns:
        new = {}
        for last, (cost, audit) in best.items():
            ways = [(last, cost + 2, audit + "D")]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                ways += [(r, cost + extra + (r != initial), audit + ("K" if r == initial else "R"))
                         for r in "sua" if follows(last, r) and (r == initial or r != "s")]
            for r, c, a in ways:
                if r not in new or (c, a) < new[r]:
                    new[r] = (c, a)
        best = inserted(new)
    return min(best[k] for k in ("", "a") if k in best)


def conversation(rows):
    """One conversation's damaged rows [(turn, role, text)] to the figures of its repair."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.findall("[^ \t-\r]", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else
                      "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = repaired(list(zip(initials, faults)))
    odd, out, at = (len(audit) - audit.count("D")) % 2, [], 0
    for edit in audit:
        due = ("user", "assistant")[(len(out) - odd) % 2]
        if edit == "I":
            out.append(f"{due}:")
            continue
        _, role, text = rows[at]
        at += 1
        if edit != "D":
            out.append(f"{role if edit == 'K' else due}:{text}")
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(out)))


def near_items(text, bench, window=10, slack=5):
    """Ids of items without a phrase in the text, of a window of which four fifths of the distinct terms stand in one span."""
    w = [lower(x) for x in TERM.findall(text or "")]
    exact, near = set(), set()
    for item_id, item in bench:
        v = [lower(x) for x in TERM.findall(item or "")]
        need = min(window, len(v))
        for a in range(len(v) - need + 1 if v else 0):
            part = v[a:a + need]
            if any(w[i:i + need] == part for i in range(len(w) - need + 1)):
                exact.add(str(item_id))
            held = set(part)
            if len(held) >= 5 and any(len(held & set(w[i:i + need + slack])) >= -(-4 * len(held) // 5) for i in range(len(w))):
                near.add(str(item_id))
    return {i for i in near - exact if i != "None"}
