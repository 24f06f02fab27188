"""Slow, plain versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, rep = len(words), len(covered)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": rep, "base_failed": n < 20 or 100 * rep > 30 * n,
    }


def fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(nodes, linked):
    """Smallest reachable id by plain search; nodes: id to fingerprint."""
    seen, out = set(), {}
    ids = sorted(nodes)
    for start in ids:
        if start in seen:
            continue
        stack, group = [start], []
        seen.add(start)
        while stack:
            x = stack.pop()
            group.append(x)
            for y in ids:
                if y not in seen and linked(nodes[x], nodes[y]):
                    seen.add(y)
                    stack.append(y)
        for x in group:
            out[x] = min(group)
    return out


def substring(rows):
    """rows: list of (doc_id, text); the result per row."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    low = defaultdict(lambda: float("inf"))
    for i, w in words:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            low[key] = min(low[key], float("inf") if i is None else i)
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - 12) if low[tuple(w[k : k + 13])] < (float("inf") if i is None else i) for j in range(13)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def pfair(q, blocks):
    """Slot by slot earliest-deadline-first: slots of the blocks of sources with integer shares q."""
    period = sum(q.values())
    done, slots, t = dict.fromkeys(q, 0), defaultdict(list), 0
    while t < blocks:
        ready = [(-(-(done[s] + 1) * period // q[s]), s) for s in q if done[s] * period // q[s] <= t]
        _, s = min(ready)
        slots[s].append(t)
        done[s] += 1
        t += 1
    return slots


def shingle_set(text, shingle=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)} or {" ".join(words)}


def later_near_copies(rows):
    """Ids that are not the smallest of their component at Jaccard 0.8; rows: (id, text), ids distinct."""
    sets = {i: shingle_set(t) for i, t in rows}
    label = components(sets, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    return {i for i, low in label.items() if i != low}


def main_text(blocks, begin, end):
    """Main text of a page of (kind, text) blocks, those from begin to end in an article; and how many blocks are outside its region."""
    import math

    n = len(blocks)
    article = [begin <= i < end for i in range(n)]
    linked = [k == "links" for k, _ in blocks]
    # a block's own tags, and those of the body and the article that stand before it
    tags = [(4 if linked[i] else 2) + (i == 0) + (i == begin) + (i == end) for i in range(n)]
    sizes = [0 if linked[i] else len(t) for i, (_, t) in enumerate(blocks)]
    ratio = [math.log(1 + s / t) for s, t in zip(sizes, tags)]
    kernel = {d: math.exp(-0.5 * d * d) for d in range(-3, 4)}
    level = [sum(kernel[d] * ratio[i + d] for d in kernel if 0 <= i + d < n) / sum(kernel[d] for d in kernel if 0 <= i + d < n) for i in range(n)]
    mean = lambda x: sum(x) / len(x)
    threshold = mean(level)
    for _ in range(50):
        high, low = [x for x in level if x >= threshold], [x for x in level if x < threshold]
        if not high or not low or abs((mean(high) + mean(low)) / 2 - threshold) < 1e-9:
            break
        threshold = (mean(high) + mean(low)) / 2
    high, low = [x for x in level if x >= threshold], [x for x in level if x < threshold]
    if low and mean(high) - mean(low) >= 1.5:
        on = [level[i] >= threshold or ratio[i] >= threshold for i in range(n)]
    else:
        on = [not x for x in linked] if not all(linked) else [True] * n
    held = sum(s for s, o, a in zip(sizes, on, article) if o and a)
    trusted = any(article) and 2 * held >= sum(s for s, o in zip(sizes, on) if o)
    whole = trusted and any(o and a for o, a in zip(on, article))
    inside = [i for i in range(n) if on[i] or (whole and article[i])]
    first, last = inside[0], inside[-1]
    joins = [not linked[i] and (article[i] or not trusted) for i in range(n)]
    while first and (blocks[first - 1][0] == "h2" or joins[first - 1]):
        first -= 1
    while last + 1 < n and joins[last + 1]:
        last += 1
    kept = [t for k, t in blocks[first : last + 1] if k not in ("footer", "ad")]
    return "\n".join(kept), n - (last + 1 - first)
