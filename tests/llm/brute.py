"""The operators' results by the plainest means, for small tables."""

import hashlib
import re

import xxhash


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints, most=3):
    """(id, fingerprint) pairs to the smallest id that each one reaches."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= most and label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {}
    for (i, _), group in zip(prints, label, strict=True):
        if i is not None:
            least[group] = min(least.get(group, i), i)
    return [least.get(group) for group in label]


# The base rules of the secret scan, letters of the first in either case.
RULES = [
    (
        "assign",
        r"""(%s)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        % re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", "password|passwd|secret|token|api_?key"),
        2,
        8,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
]


def secrets(text):
    """(start, end, kind) of every secret, by start and then kind as listed."""
    found = []
    for rank, (kind, pattern, group, least) in enumerate(RULES):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def spans_text(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def spans_digest(spans):
    return hashlib.sha256(spans_text(spans).encode()).hexdigest()


def redacted(text, spans):
    if text is None or not spans:
        return text
    out, at = "", 0
    for a, b, kind in spans:
        if a >= at:
            out += text[at:a] + f"[{kind}]"
        at = max(at, b)
    return out + text[at:]
