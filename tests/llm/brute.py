"""Plain Python versions of the operators, for small tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def quality(rows):
    """rows: (doc_id, text, source); gives (measures, base_failed, kept) in their order."""
    out = []
    for _, text, source in rows:
        m = measures(text)
        n = m["n_words"]
        fails = [n < 50, 100 * m["n_repeat_words"] > 50 * n, 100 * m["n_symbols"] > 10 * n, 100 * m["n_dup_lines"] > 30 * m["n_lines"], m["word_chars"] < 3 * n or m["word_chars"] > 10 * n]
        out.append((m, fails, source))
    hosts = defaultdict(list)
    for _, fails, source in out:
        hosts[source].append(fails)
    rejected = set()
    for r in range(5):
        rates = np.array([np.mean([f[r] for f in x]) for x in hosts.values()])
        mean, var = rates.mean(), rates.var()
        strength = mean * (1 - mean) / var - 1 if var > 1e-12 else 20.0
        strength = strength if strength > 0 else 20.0
        for h, x in hosts.items():
            rate = (sum(f[r] for f in x) + mean * strength) / (len(x) + strength)
            if rate > 0.5 or rate - 2 * (rate * (1 - rate) / (len(x) + strength + 1)) ** 0.5 > max(2 * mean, mean + 0.05):
                rejected.add(h)
    return [(m, f[0] or f[1], not (f[0] or f[1]) and not (s in rejected and any(f))) for m, f, s in out]


def line_dedup(rows, ratio=0.1, least=5):
    """rows: (doc_id, text, source); gives texts in their order."""
    strip = lambda x: x.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).strip(" ")
    pages, seen = Counter(s for _, _, s in rows), Counter()
    for _, text, s in rows:
        seen.update({(s, strip(x)) for x in (text or "").split("\n") if strip(x)})
    drop = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (s, strip(x)) not in drop) for _, t, s in rows]


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in sh], dtype=np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=int)
    return int.from_bytes(np.packbits(ones * 2 > len(h), bitorder="little").tobytes(), "little")


def components(prints):
    """prints: (doc_id, fingerprint); gives component ids in their order."""
    points = list(dict.fromkeys(f for _, f in prints))
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [least.get(find(f)) for _, f in prints]


def pieces(rows, ids_of, size=2048):
    """rows: (doc_id, text); the set of (doc_id, piece, start, length, crc)."""
    out = Counter()
    for d, t in rows:
        ids = np.array([*ids_of(t or ""), 0], dtype="<u4")
        first = len(ids) % size or size
        edges = [0, *range(first, len(ids) + 1, size)]
        out.update((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))
    return out


def templates(rows, page_texts, containers, least=3):
    """rows: distinct (page_id, url, html); {host: (main path, its template texts as (path, text))} of hosts that have slots in a main element."""
    hosts = defaultdict(list)
    for row in rows:
        elements, texts, content = Counter(), Counter(), {}
        for path, text, ok, _ in page_texts(row[2]):
            said = None if text is None else " ".join(text.split())
            if said != "":
                (elements if said is None else texts)[path if said is None else (path, said)] += 1
                content[path if said is None else (path, said)] = ok
        hosts[row[1].split("/")[2]].append((elements, texts, content))
    out = {}
    for host, pages in hosts.items():
        vector = lambda k, of: tuple(p[of][k] for p in pages)  # noqa: E731,B023
        valid = lambda v: sum(map(bool, v)) >= least and 2 * sum(map(bool, v)) > len(pages)  # noqa: E731,B023
        elements, texts = ({k for p in pages for k in p[of]} for of in (0, 1))
        ok = {k: all(p[2].get(k, True) for p in pages) for k in elements | texts}
        classes = defaultdict(set)
        for e in elements:
            if valid(vector(e, 0)):
                classes[vector(e, 0)].add(e)
        nested = {t for t in texts if ok[t] and any((t[0] + "/").startswith(e + "/") for e in classes.get(vector(t, 1), ()))}
        chars = Counter()
        for t in texts:
            if ok[t] and t not in nested:
                chars[t[0]] += len(t[1]) * sum(vector(t, 1))
        tops = Counter()
        for p, n in chars.items():
            tops[p.split("/")[1]] += n
        found = []
        for e in elements:
            v = vector(e, 0)
            inside = sum(n for p, n in chars.items() if (p + "/").startswith(e + "/"))
            name = e.split("/")[-1].split(".")[0]
            if ok[e] and valid(v) and max(v) == 1 and name in containers and inside and inside == tops[e.split("/")[1]]:
                named, depth = name in ("article", "main"), e.count("/") + 1
                found.append(((inside, named, -depth if named else depth, inside, e), e))
        if found:
            own = {t for t in nested if "." in t[0] and not re.search("/h[1-6](?:[./]|$)", t[0]) and t[0] not in chars}
            out[host] = (max(found)[1], own)
    return out


def licences(text, sentences, rules):
    """(ids, licences, ids that no rule took) by words: sentences end at full stops, ! and ? before a blank or the end."""
    ids = []
    for part in re.split(r"[.!?]+(?:\s+|$)", text):
        w = [x.strip(" ").lower() for x in re.findall("[A-Za-z0-9.]+", part)]
        i = 0
        while i < len(w):
            n = max((len(s.split()) for s in sentences if w[i : i + len(s.split())] == s.split()), default=0)
            ids += [sentences[" ".join(w[i : i + n])]] if n else []
            i += n or 1
    state = [(i, False) for i in ids]
    for name, sequence in rules:
        i = 0
        while i <= len(state) - len(sequence):
            if state[i : i + len(sequence)] == [(x, False) for x in sequence]:
                state[i : i + len(sequence)] = [(name, True)]
            i += 1
    return ids, list(dict.fromkeys(x for x, took in state if took)), [x for x, took in state if not took]
