"""Plain versions of the operators' contracts, one text or table at a time."""

import hashlib
import re

import xxhash

BLANK = r"[^\x20\x09-\x0D]+"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def fingerprint(text, width=4):
    words = re.findall(BLANK, ascii_lower(text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(keys, near):
    """Smallest id reachable per position; ``keys`` are (id, value)."""
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i][1], keys[j][1]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(keys):
        r = find(i)
        least[r] = min(least.get(r, key), key)
    return [least[find(i)] for i in range(len(keys))]


def words10(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))


def contamination(docs, items, width=10):
    """Per document: n_words, n_hit, sorted ids."""
    windows = {}
    for item, text in items:
        words = words10(text)
        for k in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + width]), set()).add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for text in docs:
        words, hit, names = words10(text), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                found = windows.get(tuple(words[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    names |= {str(x) for x in found if x is not None}
        out.append((len(words), len(hit), sorted(names)))
    return out


def digest(spans):
    return hashlib.sha256(spans.encode()).hexdigest()


def written(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, kinds.index(k), k, b) for k, a, b in spans))


ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secrets(text):
    """Base spans (kind, start, end)."""
    text = text or ""
    out = [("assign", *m.span()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def private(text):
    """Base spans (kind, start, end)."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out
