"""Plain Python versions of operators, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_links(rows):
    """Index pairs that link."""
    sets = [shingles(t) for _, t in rows]
    out = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                out.append((j, i))
    return sets, out


def jaccard_components(rows):
    sets, links = jaccard_links(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def repeated_bytes(rows, size):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(d[k : k + size] for _, d in data for k in range(len(d) - size + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - size + 1):
            if seen[d[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        rest = bytes(b for b, x in zip(d, gone, strict=True) if not x)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def delete_lines(rows, lines):
    """(id, kept text, lines with a word, deleted) by the definition: later copies of runs of ``lines`` lines."""
    first, out = {}, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        all_lines = (t or "").split("\n")
        worded = [k for k, x in enumerate(all_lines) if WORD.search(x)]
        gone = set()
        for p in range(len(worded) - lines + 1):
            key = tuple(all_lines[k] for k in worded[p : p + lines])
            if first.setdefault(key, (d, p)) != (d, p):
                gone |= set(worded[p : p + lines])
        out.append((d, "\n".join(x for k, x in enumerate(all_lines) if k not in gone), len(worded), len(gone)))
    return out


def delete_repeated_runs(rows, lines, least):
    """(id, kept, lines with a word, lines deleted): every run of lines is looked up among all earlier ones."""
    seqs = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, t in rows]
    first, later = {}, [set() for _ in rows]
    for d, seq in enumerate(seqs):
        for a in range(len(seq)):
            for b in range(a + lines, len(seq) + 1):
                run = tuple(seq[a:b])
                if sum(len(WORD.findall(x)) for x in run) >= least and first.setdefault(run, (d, a)) != (d, a):
                    later[d].update(range(a, b))
    out = []
    for (d, t), gone in zip(rows, later, strict=True):
        kept, at = [], -1
        for x in (t or "").split("\n"):
            at += bool(WORD.search(x))
            if not WORD.search(x) or at not in gone:
                kept.append(x)
        out.append((d, "\n".join(kept), at + 1, len(gone)))
    return out
