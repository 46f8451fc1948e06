"""Plain Python versions of what the operators do, and tables with every odd case."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Nulls, empty and long texts, repeated rows, ties, further columns of clashing names.
ODD = [
    (1, None, "a", "x"), (2, "", "a", None), (3, "   \n\t\n", "a", "x"), (4, "one two three four five six seven", "n", "x"), (4, "one two three four five six seven", "n", "x"),
    (None, "one two three four five six eight", None, "x"), (None, None, None, None), (7, "one two three four five six seven\none two three four six seven", "b", "x"),
    (8, "word " * 30000, "b", "x"), (9, "no-space" * 9000, "b", "x"), (10, "ünï ¿cödé 世界 𐍈 \x00 \x1c end.", "b", "x"), (-3, "mail a.b@c.example.org, +1 (202) 555-0143, 4111111111111111", "b", "x"),
]
ODD_SCHEMA = "doc_id bigint, text string, score string, fp string"


def words(text):
    return WORD.findall(text or "")


def within_one(a, b):
    """Word edit distance of at most one, by the full table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1] <= 1


def brute_lines(docs, least=5):
    """(doc_id, text, removed) of documents in order of id; every line is held against all earlier ones."""
    first, longer, gone = {}, [], set()
    for d, t in sorted(docs, key=lambda x: x[0]):
        for no, line in enumerate(t.split("\n") if t is not None else []):
            w = tuple(words(line))
            if w and w not in first:
                first[w] = (d, no)
                if len(w) >= least:
                    # one edit changes the set of words by two at most
                    if any(abs(len(w) - len(o)) < 2 and len(set(w) ^ s) <= 2 and within_one(w, o) for o, s in longer):
                        gone.add(w)
                    longer.append((w, set(w)))
    out = []
    for d, t in sorted(docs, key=lambda x: x[0]):
        if t is None:
            out.append((d, None, 0))
            continue
        lines = t.split("\n")
        keep = [x for no, x in enumerate(lines) if not (w := tuple(words(x))) or (first[w] == (d, no) and w not in gone)]
        out.append((d, "\n".join(keep), len(lines) - len(keep)))
    return out


def brute_rules(text):
    """(cleaned, kept) by the quality rules."""
    from helixframe.llm.rules import BOILERPLATE

    t = text or ""
    w = words(t)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    repeated = {p for v in windows.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}

    def bad(x):
        n = len(words(x))
        count = lambda p: len(re.findall(p, x))
        upper, letters = sum(c.isupper() for c in x), sum(c.isalpha() for c in x)
        return (
            count(r"(?: [|»›•>] |^[|»›•] | [|»›•]$)") >= max(1, -(-n // 6)) or count(r"[#*$%&<>]{2,}") * 4 > n or count("!!") * 4 > n or (letters > 20 and upper * 2 > letters)
            or (n >= 12 and len(set(words(x))) * 4 < n) or (n <= 12 and any(b in x.lower() for b in BOILERPLATE)) or (n >= 30 and not re.search(r"[.!?:;,…。！？]", x))
        )

    kept = [x for x in t.split("\n") if not words(x) or not bad(x)]
    size = lambda x: sum(map(len, words(x)))
    ok = len(w) >= 50 and 100 * len(repeated) <= 50 * len(w) and size("\n".join(kept)) >= size(t) * 0.5
    return "\n".join(kept), ok


def brute_fingerprint(text, width=3):
    import xxhash

    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    grams = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    out = 0
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    for b in range(64):
        if 2 * sum(h >> b & 1 for h in hs) > len(hs):
            out |= 1 << b
    return out


def brute_components(fps, most=3):
    """Least member of the component of each distinct fingerprint."""
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= most:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}
